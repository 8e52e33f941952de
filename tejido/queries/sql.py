"""Pieces of SQL for the queries' counterparts."""

from __future__ import annotations

import re

from ..functions import lexicons as L


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def array(terms) -> str:
    return "[" + ", ".join(map(lit, terms)) + "]"


def hits(text: str, terms) -> str:
    """How many terms a (lower-cased) text contains."""
    return f"CAST(len(list_filter({array(terms)}, lambda k: contains({text}, k))) AS BIGINT)"


def any_in(text: str, terms) -> str:
    return f"({hits(text, terms)} > 0)"


def matches(text: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, {lit(pattern)})) AS BIGINT)"


def any_pattern(text: str, patterns) -> str:
    return f"regexp_matches({text}, {lit('(?i)(?:' + '|'.join(f'(?:{p})' for p in patterns) + ')')})"


def n_words(text: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> '')) AS BIGINT)"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> '')"


def chars_of(text: str, characters: str) -> str:
    return f"CAST(length({text}) - length(regexp_replace({text}, {lit('[' + characters + ']')}, '', 'g')) AS BIGINT)"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"


def path(url: str) -> str:
    return f"regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def query(url: str) -> str:
    return f"regexp_extract({url}, '^[^?#]*\\?([^#]*)', 1)"


def fragment(url: str) -> str:
    return f"regexp_extract({url}, '#(.*)$', 1)"


def archive(url: str) -> str:
    return any_pattern(f"({path(url)} || {query(url)})", L.ARCHIVE_PATTERNS)


def article(url: str) -> str:
    return f"(NOT {archive(url)} AND {any_pattern(f'({path(url)} || {query(url)})', L.ARTICLE_PATTERNS)})"


def valid(url: str, base: str) -> str:
    whole = f"({path(url)} || {query(url)} || {fragment(url)})"
    return (
        f"(regexp_matches({url}, '^https?://') AND {host(url)} <> '' AND ({host(url)} = {base} OR list_contains({array(L.PRIORITY_HOSTS)}, {host(url)}))"
        f" AND NOT {any_pattern(whole, L.EXCLUDE_PATTERNS)} AND length({path(url)}) >= 2)"
    )


def skip(url: str, base: str) -> str:
    return f"({host(url)} <> {host(base)} OR {any_pattern(f'lower({url})', L.SKIP_PATTERNS)})"


def url_score(url: str) -> str:
    u = f"lower({url})"
    return f"CAST(5 * {hits(u, L.URL_DOMAINS)} + CASE WHEN contains({u}, '.gob.mx') THEN 5 ELSE 0 END + 8 * {hits(u, [t.replace(' ', '') for t in L.INSTITUTIONS])} AS BIGINT)"


def link_score(url: str, anchor: str) -> str:
    u, a = f"lower({url})", f"lower({anchor})"
    bonus = " + ".join(f"CASE WHEN contains({a}, {lit(t)}) THEN {w} ELSE 0 END" for t, w in L.ANCHOR_BONUS.items())
    place = " + ".join(f"CASE WHEN contains({u}, {lit(t)}) OR contains({a}, {lit(t)}) THEN {w} ELSE 0 END" for t, w in L.PLACE_BONUS.items())
    return f"CAST(greatest(0, 2.0 * {hits(u, L.LINK_KEYWORDS)} + 1.5 * {hits(a, L.LINK_KEYWORDS)} + {bonus} + {place} - CASE WHEN length({anchor}) < 3 OR regexp_matches({anchor}, '^\\d+$') THEN 1.0 ELSE 0 END) AS DOUBLE)"


def link_type(url: str, anchor: str) -> str:
    u, a = f"lower({url})", f"lower({anchor})"
    return (
        f"CASE WHEN {any_in(u, ['gob.mx', 'gobierno'])} THEN 'government' WHEN {any_in(u, ['unam', 'ipn', 'edu.mx'])} THEN 'academic' WHEN {any_in(a, ['noticia', 'artículo'])} THEN 'news'"
        f" WHEN {any_in(a, ['investigación', 'tesis'])} THEN 'research' WHEN contains({u}, 'pdf') THEN 'document' ELSE 'general' END"
    )


def domain_indicators(d: str) -> str:
    return (
        f"(list_transform(list_filter({array(L.DOMAIN_TLDS)}, lambda t: ends_with({d}, t)), lambda t: 'tld_' || replace(t, '.', '_'))"
        f" || list_transform(list_filter({array(L.DOMAIN_KEYWORDS)}, lambda k: contains({d}, k)), lambda k: 'keyword_' || k))"
    )


def mexican_domain(d: str) -> str:
    return f"(len(list_filter({array(L.DOMAIN_TLDS)}, lambda t: ends_with({d}, t))) > 0 OR {any_in(d, L.DOMAIN_KEYWORDS)})"


def domain_score(d: str, rank: str, indicators: str) -> str:
    one = "CASE WHEN starts_with(i, 'keyword_') THEN 5.0 WHEN contains(i, 'gob_mx') THEN 20.0 WHEN contains(i, 'edu_mx') THEN 15.0 ELSE 10.0 END"
    return (
        f"CAST(CASE WHEN {rank} <= 1000 THEN 10.0 WHEN {rank} <= 10000 THEN 6.0 WHEN {rank} <= 100000 THEN 2.0 ELSE 0.0 END + coalesce(list_sum(list_transform({indicators}, lambda i: {one})), 0)"
        f" + CASE WHEN len(string_split({d}, '.')) <= 3 THEN 1.0 ELSE 0.0 END + CASE WHEN NOT contains({d}, '-') AND NOT regexp_matches({d}, '\\d') THEN 0.5 ELSE 0.0 END AS DOUBLE)"
    )


def domain_category(d: str, indicators: str) -> str:
    return (
        f"CASE WHEN len(list_filter({indicators}, lambda i: contains(i, 'gob'))) > 0 THEN 'government' WHEN len(list_filter({indicators}, lambda i: contains(i, 'edu'))) > 0 OR {any_in(d, ['unam', 'ipn'])} THEN 'education'"
        f" WHEN {any_in(d, L.NEWS_KEYWORDS)} THEN 'news' WHEN ends_with({d}, '.com.mx') OR ends_with({d}, '.com') THEN 'commercial' WHEN ends_with({d}, '.org.mx') OR ends_with({d}, '.org') THEN 'organization' ELSE 'general' END"
    )


def looks_spanish(text: str) -> str:
    """Function words are whole tokens of letters, digits and underscores, so those are listed and looked up."""
    terms = [w for p in L.FUNCTION_WORDS for w in p.removeprefix(r"\b(").removesuffix(r")\b").split("|")]
    share = f"len(list_filter(regexp_extract_all(lower({text}), '[\\pL\\pN_]+'), lambda w: list_contains({array(terms)}, w))) / greatest({n_words(text)}, 1)::DOUBLE"
    return f"({n_words(text)} > 0 AND {share} > 0.05 OR {chars_of(text, L.SPANISH_CHARS)} > 0)"


def quality(text: str) -> str:
    """The validation ladder: text_quality, is_valid, issues of `text`, from a row with the columns that its steps compare."""
    sample = f"substring({text}, 1, 1000)"
    pattern = " ".join(f"WHEN regexp_matches({sample}, {lit(re.sub(r'.u([0-9A-F]{4})', r'\\x{\1}', p))}) THEN {k}" for k, p in enumerate(L.BINARY_PATTERNS))
    facts = (
        f"SELECT doc_id, length({text}) AS n_all, length({sample}) AS n, CASE {pattern} END AS pattern, {chars_of(sample, L.PROBLEM_CHARS + r'\x{100}-\x{10FFFF}')} AS odd,"
        f" {chars_of(sample, r'\pC\pZ')} - {chars_of(sample, ' \n\t\r')} AS unprintable, {matches(text, '�')} AS replaced, {chars_of(sample, r'\x00-\x08\x0B\x0C\x0E-\x1F')} AS controls,"
        f" {chars_of(sample, L.SPANISH_CHARS)} AS spanish, {looks_spanish(sample)} AS looks FROM documents"
    )
    steps = (
        "SELECT *, n_all < 50 AS short, pattern IS NOT NULL AS patterned, n > 50 AND odd / greatest(n, 1)::DOUBLE > 0.35 AS excess, (n - unprintable) / greatest(n, 1)::DOUBLE < 0.85 AS low, replaced > 20 AS lost"
        f" FROM ({facts})"
    )
    level = (
        "CASE WHEN short THEN 'too_short' WHEN patterned OR excess THEN 'binary' WHEN low OR lost THEN 'corrupted' WHEN spanish / greatest(n, 1)::DOUBLE >= 0.1 THEN 'good' WHEN looks THEN 'acceptable'"
        " WHEN replaced > 5 OR controls > 5 THEN 'poor' ELSE 'acceptable' END"
    )
    issues = (
        "concat_ws('; ', CASE WHEN short THEN 'too_short: ' || n_all || ' < 50' END, CASE WHEN NOT short AND patterned THEN 'binary_pattern_' || pattern || '_detected' END,"
        " CASE WHEN NOT short AND NOT patterned AND excess THEN 'excessive_problematic_chars' END, CASE WHEN NOT short AND NOT patterned AND NOT excess AND low THEN 'low_printable_ratio' END,"
        " CASE WHEN NOT (short OR patterned OR excess OR low) AND replaced > 5 THEN 'replacement_chars: ' || replaced END, CASE WHEN NOT (short OR patterned OR excess OR low OR lost) AND controls > 5 THEN 'control_chars: ' || controls END)"
    )
    return f"SELECT doc_id, text_quality, text_quality IN ('good', 'acceptable') AS is_valid, issues FROM (SELECT doc_id, {level} AS text_quality, {issues} AS issues FROM ({steps}))"
