"""URL and domain expressions: parts, predicates, priorities, scores and categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L
from .text import any_in, is_digits, lexicon_hits


def host(url: Column) -> Column:
    """Host with port, as it is written in the URL, in lower case; '' where there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def fragment(url: Column) -> Column:
    return F.regexp_extract(url, r"#(.*)$", 1)


def host_by_split(url: Column) -> Column:
    """What stands between :// and the next slash."""
    return F.split_part(F.split_part(url, F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of a root-relative or absolute href; null for other kinds."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), href)
    return F.when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)).when(href.startswith("/"), root).when(href.startswith("http"), href)


def any_pattern(text: Column, patterns: list[str]) -> Column:
    return text.rlike("(?i)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")


def skip_link(url: Column, base: Column) -> Column:
    """Another host than the page's, or a path that leads to no content."""
    return (host(url) != host(base)) | any_pattern(F.lower(url), L.SKIP_PATTERNS)


def valid_link(url: Column, base_host: Column) -> Column:
    whole = F.concat(path(url), query(url), fragment(url))
    return (
        url.rlike("^https?://") & (host(url) != "") & ((host(url) == base_host) | host(url).isin(*L.PRIORITY_HOSTS))
        & ~any_pattern(whole, L.EXCLUDE_PATTERNS) & (F.length(path(url)) >= 2)
    )


def archive_link(url: Column) -> Column:
    return any_pattern(F.concat(path(url), query(url)), L.ARCHIVE_PATTERNS)


def article_link(url: Column) -> Column:
    return ~archive_link(url) & any_pattern(F.concat(path(url), query(url)), L.ARTICLE_PATTERNS)


def should_follow(url: Column) -> Column:
    lowered = F.lower(path(url))
    return host(url).isin(*L.PRIORITY_HOSTS) | archive_link(url) | F.contains(lowered, F.lit("rss")) | F.contains(lowered, F.lit("feed")) | url.endswith(".xml") | lowered.isin(*L.HOME_PATHS)


def link_class(url: Column) -> Column:
    """0 article, 1 archive, 2 other: the order in which links are taken."""
    return F.when(article_link(url), 0).when(archive_link(url), 1).otherwise(2)


def is_pdf(url: Column) -> Column:
    return F.contains(F.lower(url), F.lit("pdf"))


def needs_js(url: Column) -> Column:
    return any_in(host(url), L.JS_HOSTS)


def is_challenge(html: Column) -> Column:
    """A page that only asks visitors to prove themselves."""
    return any_in(F.lower(html), L.CHALLENGE_PHRASES)


def url_score(url: Column) -> Column:
    """10 for .gob.mx and 5 for every other listed domain contained, 8 for every institution contained (both without spaces)."""
    lowered = F.lower(url)
    domains = 5 * lexicon_hits(lowered, L.URL_DOMAINS) + F.when(F.contains(lowered, F.lit(".gob.mx")), 5).otherwise(0)
    return domains + 8 * lexicon_hits(F.replace(lowered, F.lit(" "), F.lit("")), [t.replace(" ", "") for t in L.INSTITUTIONS])


def priority(url: Column) -> Column:
    """1, and more for official hosts, news, PDF, forums and videos, and places; 10 at most."""
    lowered = F.lower(url)
    add = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0.0))
    total = (
        F.lit(1.0) + add(any_in(lowered, L.PRIORITY_OFFICIAL), 2.0) + add(any_in(lowered, L.PRIORITY_NEWS), 1.0) + add(lowered.endswith(".pdf"), 1.5)
        + add(any_in(lowered, L.PRIORITY_SOCIAL), 0.5) + add(any_in(lowered, L.PRIORITY_PLACES), 0.8)
    )
    return F.least(total, F.lit(10.0))


def link_score(url: Column, anchor: Column, keywords: list[str] | None = None) -> Column:
    """Keywords in URL (2) and anchor (1.5), bonuses for kinds of content in the anchor and for places in either, less 1 for an anchor of
    under three characters or of digits; 0 at least."""
    u, a = F.lower(url), F.lower(anchor)
    terms = sorted({*L.LINK_KEYWORDS, *(keywords or [])})
    weighed = lambda bonus, test: F.aggregate(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in bonus.items()]), F.lit(0.0), lambda s, b: s + F.when(test(b["t"]), b["w"]).otherwise(F.lit(0.0)))
    score = 2.0 * lexicon_hits(u, terms) + 1.5 * lexicon_hits(a, terms) + weighed(L.ANCHOR_BONUS, lambda t: F.contains(a, t)) + weighed(L.PLACE_BONUS, lambda t: F.contains(u, t) | F.contains(a, t))
    return F.greatest(F.lit(0.0), score - F.when((F.length(anchor) < 3) | is_digits(anchor), 1.0).otherwise(0.0))


def link_type(url: Column, anchor: Column) -> Column:
    u, a = F.lower(url), F.lower(anchor)
    return (
        F.when(any_in(u, ["gob.mx", "gobierno"]), "government").when(any_in(u, ["unam", "ipn", "edu.mx"]), "academic")
        .when(any_in(a, ["noticia", "artículo"]), "news").when(any_in(a, ["investigación", "tesis"]), "research")
        .when(F.contains(u, F.lit("pdf")), "document").otherwise("general")
    )


# ---- domains --------------------------------------------------------------------------------------------------------


def mexican_domain(domain: Column) -> Column:
    d = F.lower(domain)
    return F.exists(F.array(*map(F.lit, L.DOMAIN_TLDS)), lambda t: F.endswith(d, t)) | any_in(d, L.DOMAIN_KEYWORDS)


def domain_indicators(domain: Column) -> Column:
    d = F.lower(domain)
    tlds = F.transform(F.filter(F.array(*map(F.lit, L.DOMAIN_TLDS)), lambda t: F.endswith(d, t)), lambda t: F.concat(F.lit("tld_"), F.replace(t, F.lit("."), F.lit("_"))))
    keys = F.transform(F.filter(F.array(*map(F.lit, L.DOMAIN_KEYWORDS)), lambda k: F.contains(d, k)), lambda k: F.concat(F.lit("keyword_"), k))
    return F.concat(tlds, keys)


def domain_score(domain: Column, rank: Column, indicators: Column) -> Column:
    base = F.when(rank <= 1000, 10.0).when(rank <= 10_000, 6.0).when(rank <= 100_000, 2.0).otherwise(0.0)
    one = lambda i: F.when(i.startswith("keyword_"), F.lit(5.0)).when(F.contains(i, F.lit("gob_mx")), F.lit(20.0)).when(F.contains(i, F.lit("edu_mx")), F.lit(15.0)).otherwise(F.lit(10.0))
    plain = ~F.contains(domain, F.lit("-")) & ~domain.rlike(r"(?U)\d")
    return base + F.aggregate(indicators, F.lit(0.0), lambda s, i: s + one(i)) + F.when(F.size(F.split(domain, r"\.")) <= 3, 1.0).otherwise(0.0) + F.when(plain, 0.5).otherwise(0.0)


def domain_category(domain: Column, indicators: Column) -> Column:
    d = F.lower(domain)
    return (
        F.when(F.exists(indicators, lambda i: F.contains(i, F.lit("gob"))), "government")
        .when(F.exists(indicators, lambda i: F.contains(i, F.lit("edu"))) | any_in(d, ["unam", "ipn"]), "education").when(any_in(d, L.NEWS_KEYWORDS), "news")
        .when(d.endswith(".com.mx") | d.endswith(".com"), "commercial").when(d.endswith(".org.mx") | d.endswith(".org"), "organization").otherwise("general")
    )


def discovery_method(source: Column) -> Column:
    s = F.lower(source)
    has = lambda t: F.contains(s, F.lit(t))
    return F.when(has("reddit"), "reddit_api").when(has("youtube"), "youtube_api").when(has("tranco"), "tranco_harvest").otherwise("traditional_config")


def content_type(source: Column) -> Column:
    s = F.lower(source)
    has = lambda t: F.contains(s, F.lit(t))
    return F.when(has("reddit"), "social_media").when(has("youtube"), "video_transcript").when(has("gov") | has("gob"), "government").when(has("edu") | has("unam"), "academic").otherwise("general_web")


def channel_handle(url: Column) -> Column:
    """Identifier or handle of a video channel's URL; null for other URLs."""
    return F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in L.CHANNEL_PATTERNS])


def genre_of(url: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url, r"/([^/]+)/artistas\.html$", 1), F.lit("")), F.lit("unknown_genre"))


def artist_of(url: Column) -> Column:
    """Last part but one of a song's URL, as words with capitals, if it has five parts at least."""
    parts = F.split(F.regexp_replace(url, "^/+|/+$", ""), "/")
    return F.when(F.size(parts) >= 5, F.initcap(F.replace(F.try_element_at(parts, F.lit(-2)), F.lit("-"), F.lit(" "))))
