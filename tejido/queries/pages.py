"""HTML extraction: text, comments, links, site rules, lyrics pages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import html, text, urls
from ..operators import boilerplate as B
from ..plans import fixtures as X
from . import query, sql
from .sinks import keep

C = F.col
BODY = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
DECODED = "replace(replace(replace(replace(replace(replace(p, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
TEXT_SQL = f"array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace({BODY}, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>'), lambda p: {sql.strip(DECODED)}), lambda p: p <> ''), chr(10))"


@query("x02_main_text", f"SELECT page_id, {TEXT_SQL} AS main_text FROM pages")
def _(t):
    return t.pages.select("page_id", html.main_text("html").alias("main_text"))


@query("x01_main_text_gated", f"SELECT page_id, length(main_text) >= 20 AS success, CASE WHEN length(main_text) >= 20 THEN main_text END AS text FROM (SELECT page_id, {TEXT_SQL} AS main_text FROM pages)")
def _(t):
    p = t.pages.select("page_id", html.main_text("html").alias("m"))
    return p.select("page_id", (F.coalesce(F.length("m"), F.lit(0)) >= 20).alias("success"), F.when(F.length("m") >= 20, C("m")).alias("text"))


def _plain_sql(fragment: str) -> str:
    out = f"regexp_replace({fragment}, {sql.lit(B.TAG)}, '', 'g')"
    for name, character in B.ENTITIES.items():
        out = f"replace({out}, {sql.lit(name)}, {sql.lit(character)})"
    return f"trim(regexp_replace({out}, {sql.lit(B.SPACE)}, ' ', 'g'))"


DENSE_SQL = f"""WITH fragments AS (
  SELECT page_id, {X.HOST_SQL} AS host, unnest(f) AS fragment, generate_subscripts(f, 1) AS pos
  FROM (SELECT page_id, url, regexp_split_to_array(regexp_replace(html, {sql.lit(B.DROPPED)}, ' ', 'g'), {sql.lit(B.BLOCKS)}) AS f FROM pages)
), blocks AS (
  SELECT *, len(string_split(block, ' ')) AS n_words, length({_plain_sql(f"array_to_string(regexp_extract_all(fragment, {sql.lit(B.ANCHOR)}, 1), ' ')")}) / length(block)::DOUBLE <= {B.LINKED} AS plain
  FROM (SELECT *, {_plain_sql('fragment')} AS block FROM fragments) WHERE block <> ''
), sizes AS (SELECT host, count(DISTINCT page_id) AS pages FROM blocks GROUP BY host
), templates AS (
  SELECT b.host, b.block FROM blocks b JOIN sizes s ON s.host = b.host GROUP BY b.host, b.block, s.pages HAVING count(DISTINCT page_id) >= {B.TEMPLATE_PAGES} AND count(DISTINCT page_id) >= s.pages * {B.TEMPLATE_SHARE}
), near AS (
  SELECT *, plain AND n_words >= {B.LONG} AS long, lag(plain AND n_words >= {B.LONG}) OVER w AS before, lead(plain AND n_words >= {B.LONG}) OVER w AS after FROM blocks WINDOW w AS (PARTITION BY page_id ORDER BY pos)
), dense AS (
  SELECT page_id, string_agg(block, chr(10) ORDER BY pos) AS text FROM near WHERE plain AND (long OR n_words >= {B.SHORT} AND (coalesce(before, false) OR coalesce(after, false)))
    AND NOT EXISTS (SELECT 1 FROM templates t WHERE t.host = near.host AND t.block = near.block) GROUP BY page_id
)
SELECT p.page_id, CASE WHEN length(d.text) >= {B.ENOUGH} THEN 'blocks' WHEN length(main_text) >= {B.LEAST} THEN 'fallback' END AS method, CASE WHEN length(d.text) >= {B.ENOUGH} THEN d.text WHEN length(main_text) >= {B.LEAST} THEN main_text END AS text
FROM (SELECT page_id, {TEXT_SQL} AS main_text FROM pages) p LEFT JOIN dense d ON d.page_id = p.page_id"""


@query("x01_main_text_dense", DENSE_SQL)
def _(t):
    return B.main_text(t.pages, keep=keep(t))


@query("x13_basic_extract", f"SELECT page_id, CASE WHEN length(main_text) < 20 THEN 'No content extracted' END AS error, CASE WHEN length(main_text) >= 20 THEN 'enhanced_basic' END AS method FROM (SELECT page_id, {TEXT_SQL} AS main_text FROM pages)")
def _(t):
    n = F.coalesce(F.length(text.strip(C("m"))), F.lit(0))
    return t.pages.select("page_id", html.main_text("html").alias("m")).select("page_id", F.when(n < 20, "No content extracted").alias("error"), F.when(n >= 20, "enhanced_basic").alias("method"))


@query("x03_element_removal", "SELECT page_id, CAST(len(regexp_extract_all(regexp_replace(html, '(?s)<nav>.*?</nav>|<footer>.*?</footer>|<header>.*?</header>', '', 'g'), '<a href=')) AS BIGINT) AS links FROM pages")
def _(t):
    return t.pages.select("page_id", F.size(html.content_links("html")).cast("long").alias("links"))


@query("x05_links_scored", f"WITH {X.LINKS_SQL} SELECT page_id, pos, link, {sql.link_type('link', 'anchor')} AS type FROM links WHERE NOT {sql.skip('link', 'url')}")
def _(t):
    return t.links.filter(~urls.skip_link(C("link"), C("url"))).select("page_id", "pos", "link", urls.link_type(C("link"), C("anchor")).alias("type"))


@query("x05_links_lateral", f"WITH {X.LINKS_SQL} SELECT page_id, CAST(pos AS INTEGER) AS pos, href, anchor FROM links")
def _(t):
    from ..functions.register import register

    register(t.spark)
    t.pages.createOrReplaceTempView("tejido_pages")
    return t.spark.sql("SELECT p.page_id, l.pos, l.href, l.anchor FROM tejido_pages p, LATERAL html_links(p.html) l")


@query("x06_link_list", f"WITH {X.LINKS_SQL} SELECT page_id, link FROM (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY CASE WHEN {sql.article('link')} THEN 0 WHEN {sql.archive('link')} THEN 1 ELSE 2 END, link) AS k FROM (SELECT DISTINCT page_id, link FROM links WHERE {sql.valid('link', sql.host('url'))})) WHERE k <= 100")
def _(t):
    w = Window.partitionBy("page_id").orderBy(urls.link_class(C("link")), "link")
    valid = t.links.filter(urls.valid_link(C("link"), urls.host(C("url")))).select("page_id", "link").distinct()
    return valid.withColumn("k", F.row_number().over(w)).filter("k <= 100").select("page_id", "link")


def _commented(t):
    """Conversations as pages with comments: the first turn an article, the others marked as comments, some of them twice."""
    item = F.concat(F.lit('<div class="comment-body">'), "text", F.lit("</div>"))
    return t.conversations.groupBy("conv_id").agg(F.concat(F.lit("<html><body><article>x</article>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", item.alias("i")))), lambda s: s["i"]), ""), F.lit("</body></html>")).alias("html"))


def _comments(t):
    from ..functions.text import comment_admissible

    found = _commented(t).select("conv_id", F.explode(html.html_comments("html", F.lit(None).cast("string"))).alias("c")).select("conv_id", "c.pos", "c.text")
    kept = found.filter(comment_admissible(C("text"))).withColumn("k", F.row_number().over(Window.partitionBy("conv_id").orderBy("pos"))).filter("k <= 200")
    return kept.groupBy("conv_id", "text").agg(F.min("pos").alias("pos"))


COMMENTS_SQL = f"SELECT conv_id, text FROM (SELECT conv_id, {sql.strip('text')} AS text, length({sql.strip('text')}) AS n FROM conversations) WHERE n BETWEEN 10 AND 2000 AND NOT (n > 20 AND text = upper(text) AND text <> lower(text)) AND len(list_filter(range(1, n - 3), lambda i: substring(text, i, 1) <> chr(10) AND substring(text, i, 5) = repeat(substring(text, i, 1), 5))) = 0 AND (n < 20 OR {sql.any_in('lower(text)', ['ñ', 'ü', 'á', 'é', 'í', 'ó', 'ú'])} OR list_has_any({sql.words('lower(text)')}, ['el', 'la', 'los', 'las', 'de', 'del', 'que', 'es', 'en', 'un', 'una']))"


@query("x04_comments", f"SELECT DISTINCT conv_id, text FROM ({COMMENTS_SQL})")
def _(t):
    return _comments(t).select("conv_id", "text")


@query("x12_text_with_comments", f"SELECT c.conv_id, coalesce(n, 0) AS comments, round(coalesce(n, 0) / (coalesce(n, 0) + 1)::DOUBLE, 6) AS comment_ratio FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN (SELECT conv_id, count(DISTINCT text) AS n FROM ({COMMENTS_SQL}) GROUP BY 1) m USING (conv_id)")
def _(t):
    n = _comments(t).groupBy("conv_id").agg(F.count("*").alias("n"))
    return t.conversations.select("conv_id").distinct().join(n, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0)).alias("comments"), F.round(F.coalesce("n", F.lit(0)) / (F.coalesce("n", F.lit(0)) + 1), 6).alias("comment_ratio"))


def _site(t, host: str, css: str):
    page = F.concat(F.lit(f'<html><body><h1 class="title">T</h1><time datetime="2024-05-01">mayo</time><div class="sidebar">no</div><div class="{css}">'), F.regexp_replace("text", "[<>&]", " "), F.lit("</div></body></html>"))
    return t.documents.select("doc_id", page.alias("html"), F.lit(host).alias("host"), "text")


PLAIN = sql.strip("regexp_replace(text, '[<>&]', ' ', 'g')")


@query("x10_site_rules", f"SELECT doc_id, length(plain) > 50 AS success, CASE WHEN length(plain) > 50 THEN plain END AS text, 'gob.mx' AS rule FROM (SELECT doc_id, {PLAIN} AS plain FROM documents)")
def _(t):
    return _site(t, "www.gob.mx", "article-body").select("doc_id", html.site_text("html", "host").alias("s")).select("doc_id", "s.success", "s.text", "s.rule")


@query("x09_site_metadata", f"SELECT doc_id, CASE WHEN length(plain) > 50 THEN 'T' END AS title, CASE WHEN length(plain) > 50 THEN '2024-05-01' END AS date FROM (SELECT doc_id, {PLAIN} AS plain FROM documents)")
def _(t):
    s = _site(t, "www.gob.mx", "article-body").select("doc_id", html.site_text("html", "host").alias("s"))
    return s.select("doc_id", F.try_element_at("s.metadata", F.lit("title")).alias("title"), F.try_element_at("s.metadata", F.lit("date")).alias("date"))


@query("x11_debate_turns", "SELECT conv_id, string_agg(upper(role) || ': ' || regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), ':', ';', 'g'), chr(10) || chr(10) ORDER BY turn) AS speeches FROM conversations GROUP BY conv_id")
def _(t):
    line = F.concat(F.upper("role"), F.lit(": "), F.regexp_replace(F.trim(F.regexp_replace("text", r"\s+", " ")), ":", ";"))
    joined = t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda s: s["l"]), "\n").alias("text"))
    return joined.select("conv_id", html.debate("text").alias("speeches"))


def _artist_page(t):
    link = F.concat(F.lit('<li><a href="/artista/'), "artist", F.lit('/">'), "artist", F.lit("</a></li>"))
    return t.songs.select("genre", "artist").distinct().groupBy("genre").agg(F.concat(F.lit('<ul class="cnt-list">'), F.array_join(F.array_sort(F.collect_list(link)), ""), F.lit("</ul>")).alias("html"))


@query("x07_artist_list", f"WITH {X.SONGS_SQL} SELECT DISTINCT genre, artist AS name, 'https://letras.example/artista/' || artist || '/' AS url FROM songs")
def _(t):
    return _artist_page(t).select("genre", F.explode(html.artist_links("html", F.lit("https://letras.example/"))).alias("a")).select("genre", "a.name", "a.url")


@query("x07_song_list", f"WITH {X.SONGS_SQL} SELECT artist, title, 'https://letras.example/' || artist || '/' || doc_id || '/' AS url FROM songs")
def _(t):
    row = F.concat(F.lit('<li class="songList-table-row --song" data-dns="'), "artist", F.lit('" data-url="'), C("doc_id").cast("string"), F.lit('" data-name="'), "title", F.lit('">x</li>'))
    page = t.songs.groupBy("artist").agg(F.array_join(F.collect_list(row), "").alias("html"))
    return page.select("artist", F.explode(html.song_links("html", F.concat(F.lit("https://letras.example/"), "artist", F.lit("/")), F.lit("https://letras.example"))).alias("s")).select("artist", "s.title", "s.url")


@query("s22_lyrics_site", f"WITH {X.SONGS_SQL} SELECT genre, count(DISTINCT artist) AS artists, true AS has_links FROM songs GROUP BY genre")
def _(t):
    p = _artist_page(t)
    return p.select("genre", F.size(html.artist_links("html", F.lit("https://letras.example/"))).cast("long").alias("artists"), html.artist_links_exist("html").alias("has_links"))


def _song_page(t):
    body = F.array_join(F.transform(F.split(F.regexp_replace("lyrics", "[<>&]", " "), "\n"), lambda p: F.concat(F.lit("<p>"), p, F.lit("</p>"))), "")
    page = F.concat(F.lit("<h1>"), "title", F.lit('</h1><div class="cnt-letra">'), body, F.lit('</div><span class="cnt-info">1,234 views</span>'))
    return t.songs.select("doc_id", "artist", page.alias("html"), F.concat(F.lit("https://letras.example/"), "artist", F.lit("/song/")).alias("url"))


@query("x08_song_page", f"WITH {X.SONGS_SQL} SELECT doc_id, title, upper(substring(artist, 1, 1)) || substring(artist, 2) AS artist, 'es' AS language, '1,234' AS views, array_to_string(list_transform(list_filter(list_transform(string_split(regexp_replace(lyrics, '[<>&]', ' ', 'g'), chr(10)), lambda p: {sql.strip('p')}), lambda p: p <> ''), lambda p: CASE WHEN right(p, 1) IN ('.', '!', '?') THEN p ELSE p || '.' END), chr(10) || chr(10)) AS lyrics FROM songs")
def _(t):
    s = _song_page(t).select("doc_id", html.song("html", "url").alias("s"))
    return s.select("doc_id", "s.title", "s.artist", "s.language", "s.views", text.lyrics_paragraphs(C("s.paragraphs")).alias("lyrics"))


@query("x14_next_page", "SELECT page_id, 'https://letras.example/lista/' || (page_id + 1) || '/' AS by_word, 'https://letras.example/lista/' || (page_id + 1) || '/' AS by_number FROM pages")
def _(t):
    n = C("page_id")
    link = lambda to, word: F.concat(F.lit('<li><a href="/lista/'), to.cast("string"), F.lit(f'/">{word}</a></li>'))
    word = F.concat(F.lit('<div class="cnt-paginacao"><ul>'), link(n + 1, "Siguiente"), F.lit("</ul></div>"))
    number = F.concat(F.lit('<div class="cnt-paginacao"><ul><li class="current">'), n.cast("string"), F.lit("</li>"), link(F.lit(7), "7"), F.lit("</ul></div>"))
    base = F.lit("https://letras.example/lista/")
    return t.pages.select("page_id", html.next_page(word, base).alias("by_word"), html.next_page(number, base).alias("by_number"))


@query("x15_page_freshness", "SELECT page_id, '2024-01-0' || (1 + page_id % 7) AS published, page_id % 2 = 0 AS has_comments, round(greatest(0, 100 - 2.0 * (8 - (1 + page_id % 7))), 6)::DOUBLE AS freshness FROM pages")
def _(t):
    day = F.concat(F.lit("2024-01-0"), (F.lit(1) + F.pmod("page_id", F.lit(7))).cast("string"))
    page = F.concat(F.lit('<time datetime="'), day, F.lit('">x</time>'), F.when(F.pmod("page_id", F.lit(2)) == 0, '<div class="comment-list"></div>').otherwise(""))
    p = t.pages.select("page_id", html.freshness(page, F.lit("")).alias("f")).select("page_id", "f.*")
    age = F.datediff(F.lit("2024-01-08").cast("date"), F.to_date("published"))
    return p.withColumn("freshness", F.round(F.greatest(F.lit(0.0), 100 - 2.0 * age), 6))
