"""Joins, aggregations, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicons as L, text, urls
from ..operators import corpus, frontier, hosts, ranking, terms
from ..plans import fixtures as X
from . import query, sql
from .sinks import keep

C = F.col
CONFIG = [("src0", 3, True), ("src1", 1, False), ("src2", 4, None)]
CONFIG_SQL = "cfg AS (SELECT * FROM (VALUES ('src0', 3, true), ('src1', 1, false), ('src2', 4, NULL)) v(name, crawl_depth, respect))"


def _config(t):
    return t.spark.createDataFrame(CONFIG, "name string, crawl_depth int, respect boolean")


@query("j01_source_config", f"WITH {CONFIG_SQL} SELECT doc_id, coalesce(crawl_depth, 2) AS crawl_depth FROM documents LEFT JOIN cfg ON source = name")
def _(t):
    return t.documents.join(F.broadcast(_config(t)), C("source") == C("name"), "left").select("doc_id", F.coalesce("crawl_depth", F.lit(2)).alias("crawl_depth"))


@query("f17_robots", f"WITH {CONFIG_SQL}, rules AS (SELECT * FROM (VALUES ('src0', '/1'), ('src3', '/2')) v(host, prefix)) SELECT doc_id, NOT (coalesce(respect, true) AND prefix IS NOT NULL AND starts_with('/' || doc_id, prefix)) AS allowed FROM documents LEFT JOIN cfg ON source = name LEFT JOIN rules ON source = host")
def _(t):
    rules = t.spark.createDataFrame([("src0", "/1"), ("src3", "/2")], "host string, prefix string")
    d = t.documents.select("doc_id", "source", F.concat(F.lit("/"), C("doc_id").cast("string")).alias("path")).join(F.broadcast(_config(t)), C("source") == C("name"), "left").join(F.broadcast(rules), C("source") == C("host"), "left")
    return d.select("doc_id", (~(F.coalesce("respect", F.lit(True)) & C("prefix").isNotNull() & F.coalesce(F.startswith(C("path"), C("prefix")), F.lit(False)))).alias("allowed"))


SAVED = "(SELECT DISTINCT substring(sha256(text), 1, 16) FROM documents WHERE doc_id % 2 = 0)"


@query("j04_hash_dedup", f"SELECT doc_id, content_hash FROM (SELECT doc_id, substring(sha256(text), 1, 16) AS content_hash, row_number() OVER (PARTITION BY substring(sha256(text), 1, 16) ORDER BY doc_id) AS k FROM documents WHERE doc_id % 2 = 1) WHERE k = 1 AND content_hash NOT IN {SAVED}")
def _(t):
    d = t.documents.select("doc_id", text.content_key(C("text")).alias("content_hash"))
    return corpus.unseen(d.filter("doc_id % 2 = 1"), d.filter("doc_id % 2 = 0")).select("doc_id", "content_hash")


@query("j04_duplicate_flag", f"SELECT doc_id, substring(sha256(text), 1, 16) IN {SAVED} AS duplicate FROM documents")
def _(t):
    d = t.documents.select("doc_id", text.content_key(C("text")).alias("content_hash"))
    return corpus.flagged(d, d.filter("doc_id % 2 = 0")).select("doc_id", "duplicate")


HOSTS = ["www.scjn.gob.mx", "cronica.diputados.gob.mx", "www.jornada.com.mx", "sub.unam.mx", "www.example.org", "milenio.com"]


@query("j05_site_rule", "SELECT * FROM (VALUES ('www.scjn.gob.mx', 'scjn.gob.mx', 'gob.mx'), ('cronica.diputados.gob.mx', 'cronica.diputados.gob.mx', 'gob.mx'), ('www.jornada.com.mx', 'jornada.com.mx', 'jornada.com.mx'), ('sub.unam.mx', 'unam.mx', 'unam.mx'), ('www.example.org', NULL, NULL), ('milenio.com', 'milenio.com', 'milenio.com')) v(host, longest, first_match)")
def _(t):
    hosts = t.spark.createDataFrame([(h,) for h in HOSTS], "host string")
    rules = F.broadcast(t.spark.createDataFrame([(k, r) for k, r in enumerate(L.SITE_RULES)], "pos int, rule string"))
    hit = hosts.join(rules, F.contains(C("host"), C("rule")), "left")
    return hit.groupBy("host").agg(F.max_by("rule", F.struct(F.length("rule"), -C("pos"))).alias("longest"), F.min_by("rule", "pos").alias("first_match"))


@query("j06_lexicon_join", f"SELECT doc_id, {sql.hits('lower(text)', L.STATES)} AS states FROM documents")
def _(t):
    states = t.spark.createDataFrame([(s,) for s in L.STATES], "term string")
    found = terms.containing(t.documents.select("doc_id", F.lower("text").alias("text")), states, "doc_id").groupBy("doc_id").agg(F.count("*").alias("states"))
    return t.documents.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("states", F.lit(0)).alias("states"))


@query("j06_term_index", "SELECT doc_id, item_id FROM documents d, (SELECT DISTINCT item_id, substring(text, 1, 40) AS term FROM benchmark) b WHERE contains(d.text, b.term) AND b.term <> ''")
def _(t):
    named = t.benchmark.select("item_id", F.substring("text", 1, 40).alias("term"))
    return terms.containing(t.documents, named, "doc_id").join(named, "term").select("doc_id", "item_id").distinct()


HOST_RULES = f"""hosts AS (SELECT page_id, {X.HOST_SQL} AS host FROM pages), rules AS (
  SELECT DISTINCT host AS rule FROM hosts WHERE length(host) % 3 = 0 UNION SELECT DISTINCT regexp_extract(host, '([^.]+[.][^.]+)$', 1) FROM hosts UNION SELECT 'ample.com')"""


@query("j10_suffix_rules", f"WITH {HOST_RULES} SELECT page_id, max_by(rule, length(rule)) AS rule, max(length(rule)) / 10.0::DOUBLE AS delay FROM hosts LEFT JOIN rules ON host = rule OR host LIKE '%.' || rule GROUP BY page_id")
def _(t):
    h = t.pages.select("page_id", urls.host(C("url")).alias("host"))
    rules = h.filter("length(host) % 3 = 0").select(C("host").alias("rule")).unionByName(h.select(F.regexp_extract("host", r"([^.]+[.][^.]+)$", 1).alias("rule"))).unionByName(t.spark.createDataFrame([("ample.com",)], "rule string"))
    return hosts.with_rule(h, rules.distinct().withColumn("delay", F.length("rule") / 10)).select("page_id", "rule", "delay")


@query("j07_cached_item", "SELECT c.conv_id, c.turn, d.doc_id IS NULL AS missed, coalesce(d.n_chars, 0) AS n_chars FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id * 11 + c.turn")
def _(t):
    c = t.conversations.select("conv_id", "turn", (C("conv_id") * 11 + C("turn")).alias("key"))
    return c.join(t.documents.select(C("doc_id").alias("key"), "n_chars"), "key", "left").select("conv_id", "turn", C("n_chars").isNull().alias("missed"), F.coalesce("n_chars", F.lit(0)).alias("n_chars"))


@query("j09_content_snapshot", "SELECT page_id, sha256(url) AS url_hash, CAST(length(html) AS BIGINT) AS html_size FROM pages")
def _(t):
    keys = ["page_id", "url_hash", "html_hash"]  # a URL may have been fetched more than once
    p = t.pages.select("page_id", text.url_key(C("url")).alias("url_hash"), F.sha2(C("html").cast("binary"), 256).alias("html_hash"), F.length("html").cast("long").alias("html_size"))
    content, snapshots = p.select(*keys).alias("c"), p.dropDuplicates(keys).alias("s")
    found = content.join(snapshots, F.expr(" and ".join(f"c.{k} <=> s.{k}" for k in keys)))
    return found.select("c.page_id", "c.url_hash", "s.html_size")


@query("j10_domain_delay", f"WITH {X.FEED_SQL}, delays AS (SELECT * FROM (VALUES ('click', 3.0), ('view', 0.5)) v(source, delay)) SELECT event_id, CAST(coalesce(delay, 1.0) AS DOUBLE) AS delay FROM feed LEFT JOIN delays USING (source)")
def _(t):
    delays = t.spark.createDataFrame([("click", 3.0), ("view", 0.5)], "source string, delay double")
    return t.feed.join(F.broadcast(delays), "source", "left").select("event_id", F.coalesce("delay", F.lit(1.0)).alias("delay"))


@query("j11_comment_parent", f"WITH {X.POSTS_SQL} SELECT c.conv_id, c.turn, 'Comentario en: ' || substring(p.text, 1, 50) || '...' AS title FROM posts c JOIN posts p ON p.conv_id = c.conv_id AND p.turn = 0 WHERE c.turn > 0")
def _(t):
    parents = t.posts.filter("turn = 0").select("conv_id", C("text").alias("parent"))
    return t.posts.filter("turn > 0").join(parents, "conv_id").select("conv_id", "turn", F.concat(F.lit("Comentario en: "), F.substring("parent", 1, 50), F.lit("...")).alias("title"))


@query("g11_discovery_totals", "SELECT source, count(*) AS urls FROM documents GROUP BY source")
def _(t):
    return t.documents.groupBy("source").agg(F.count("*").alias("urls")).orderBy(C("urls").desc(), "source")


@query("o07_sources_by_count", "SELECT source, count(*) AS urls FROM documents GROUP BY source ORDER BY urls DESC, source")
def _(t):
    return t.documents.groupBy("source").agg(F.count("*").alias("urls")).orderBy(C("urls").desc(), "source")


@query("g12_lyrics_rollup", f"WITH {X.SONGS_SQL} SELECT genre, artist, count(*) AS songs, CAST(sum({sql.n_words('lyrics')}) AS BIGINT) AS words, count(*) FILTER (NOT success) AS errors FROM songs GROUP BY ROLLUP (genre, artist)")
def _(t):
    s = t.songs.select("genre", "artist", "success", text.n_words(C("lyrics")).alias("words"))
    return s.rollup("genre", "artist").agg(F.count("*").alias("songs"), F.sum("words").alias("words"), F.count_if(~C("success")).alias("errors"))


@query("g13_crawl_rollup", f"WITH {X.SONGS_SQL} SELECT genre, count(*) AS song_count, count(*) FILTER (success) AS successful_extractions, count(DISTINCT artist) AS artist_count FROM songs GROUP BY genre")
def _(t):
    return t.songs.groupBy("genre").agg(F.count("*").alias("song_count"), F.count_if("success").alias("successful_extractions"), F.count_distinct("artist").alias("artist_count"))


@query("g15_distinct_hashes", "SELECT count(DISTINCT sha256(text)) AS hashes FROM documents")
def _(t):
    return t.documents.agg(F.count_distinct(text.content_key(C("text"))).alias("hashes"))


@query("g17_set_cardinality", f"SELECT doc_id, CAST(len(list_distinct({sql.words('lower(text)')})) AS BIGINT) AS different FROM documents")
def _(t):
    return t.documents.select("doc_id", F.size(F.array_distinct(text.words(F.lower("text")))).cast("long").alias("different"))


@query("g18_group_lists", "SELECT lang, doc_id // 1000 AS part, array_to_string(list(doc_id ORDER BY doc_id), ',') AS ids FROM documents GROUP BY ALL")
def _(t):
    # a list a stretch of ids, so that no language is gathered in one row
    return t.documents.groupBy("lang", F.expr("doc_id div 1000").alias("part")).agg(F.array_join(F.sort_array(F.collect_list("doc_id")).cast("array<string>"), ",").alias("ids"))


@query("g19_ordered_concat", "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS joined FROM conversations GROUP BY conv_id")
def _(t):
    return t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), "\n\n").alias("joined"))


@query("w02_first_match", f"WITH {X.SEGMENTS_SQL} SELECT doc_id, min(seq) AS seq FROM segments WHERE contains(line, 'the') GROUP BY doc_id")
def _(t):
    return t.segments.filter(F.contains("line", F.lit("the"))).groupBy("doc_id").agg(F.min_by("seq", "seq").alias("seq"))


TREND = f"WITH {X.POSTS_SQL} SELECT conv_id, round(score / greatest(1.0, date_diff('second', created, TIMESTAMP '{X.AS_OF}') / 3600.0), 6)::DOUBLE AS trending FROM posts WHERE turn = 0 AND score > 10 AND length(text) >= 20 AND created > TIMESTAMP '{X.AS_OF}' - INTERVAL 72 HOUR ORDER BY trending DESC, conv_id LIMIT 100"


def _trending(t, hours: int = 72):
    age = (F.unix_timestamp(t.as_of) - F.unix_timestamp("created")) / 3600
    hot = t.posts.filter((C("turn") == 0) & (C("score") > 10) & (F.length("text") >= 20) & (C("created") > t.as_of - F.make_interval(hours=F.lit(hours))))
    return hot.select("conv_id", F.round(C("score") / F.greatest(F.lit(1.0), age), 6).alias("trending")).orderBy(C("trending").desc(), "conv_id").limit(100)


@query("w03_trending_score", TREND)
def _(t):
    return _trending(t)


@query("s05_forum_trending", TREND)
def _(t):
    return _trending(t)


@query("w04_group_cap", f"WITH {X.POSTS_SQL} SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM posts WHERE turn > 0) WHERE k <= 3")
def _(t):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return t.posts.filter("turn > 0").withColumn("k", F.row_number().over(w)).filter("k <= 3").select("conv_id", "turn")


def _before(t):
    """Events with their time in seconds, and that of the user's event before."""
    rows = t.events.select("event_id", "user_id", (F.unix_micros(C("ts").cast("timestamp")) / 1e6).alias("at"))
    return ranking.previous(rows, ["user_id"], [C("at"), C("event_id")], C("at"), "before", keep(t))


@query("w05_request_spacing", "SELECT event_id, round(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 3) AS gap FROM events")
def _(t):
    return _before(t).select("event_id", F.round(C("at") - C("before"), 3).alias("gap"))


@query("r08_rate_limit_state", "SELECT event_id, greatest(0.0, round(3600.0 - (epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))), 3))::DOUBLE AS wait FROM events")
def _(t):
    return _before(t).select("event_id", F.greatest(F.lit(0.0), F.round(3600.0 - (C("at") - C("before")), 3)).alias("wait"))


@query("w06_trending_rank", f"WITH {X.POSTS_SQL} SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY author ORDER BY score DESC, conv_id, turn) AS BIGINT) AS rank FROM posts")
def _(t):
    return ranking.rank_whole(t.posts.select("conv_id", "turn", "author", "score"), [C("score").desc(), C("conv_id"), C("turn")], "rank", keep(t), ["author"]).select("conv_id", "turn", "rank")


@query("w07_keep_first", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(t):
    return frontier.first_of(t.documents.select("doc_id", text.content_key(C("text")).alias("k")), ["k"], C("doc_id")).select("doc_id")


@query("w09_batch_folder", "SELECT doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20 AS BIGINT) AS folder FROM documents")
def _(t):
    ranked = ranking.rank(t.documents.select("doc_id", "source"), "source", "doc_id", "rank")
    return ranked.select("doc_id", corpus.folder_number(C("rank"), 20).alias("folder"))


IND = sql.domain_indicators("domain")


@query("o02_top_domains_by_score", f"WITH {X.DOMAINS_SQL} SELECT domain, rank, {sql.domain_score('domain', 'rank', IND)} AS score FROM domains ORDER BY score DESC, rank LIMIT 10000")
def _(t):
    d = t.domains.withColumn("indicators", urls.domain_indicators(C("domain")))
    return d.select("domain", "rank", urls.domain_score(C("domain"), C("rank"), C("indicators")).alias("score")).orderBy(C("score").desc(), "rank").limit(10_000)


@query("o03_top_links_per_page", f"WITH {X.LINKS_SQL} SELECT page_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY {sql.link_score('link', 'anchor')} DESC, pos) AS k FROM links) WHERE k <= 200")
def _(t):
    w = Window.partitionBy("page_id").orderBy(C("score").desc(), "pos")
    return t.links.withColumn("score", urls.link_score(C("link"), C("anchor"))).withColumn("k", F.row_number().over(w)).filter("k <= 200").select("page_id", "pos")


LINK_RANK = f"CASE WHEN {sql.article('link')} THEN 0 WHEN {sql.archive('link')} THEN 1 ELSE 2 END"


@query("o04_link_order", f"WITH {X.LINKS_SQL} SELECT page_id, link, CAST(k AS BIGINT) AS k FROM (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY {LINK_RANK}, link) AS k FROM (SELECT DISTINCT page_id, link FROM links)) WHERE k <= 100")
def _(t):
    w = Window.partitionBy("page_id").orderBy(urls.link_class(C("link")), "link")
    return t.links.select("page_id", "link").distinct().withColumn("k", F.row_number().over(w).cast("long")).filter("k <= 100")


@query("o08_caps", "SELECT doc_id, substring(text, 1, 50) AS title, substring(text, 1, 500) AS description FROM documents ORDER BY doc_id LIMIT 100")
def _(t):
    return t.documents.select("doc_id", F.substring("text", 1, 50).alias("title"), F.substring("text", 1, 500).alias("description")).orderBy("doc_id").limit(100)


@query("u01_discovery_union", "SELECT url, branch FROM (SELECT url, 'pages' AS branch FROM pages UNION ALL SELECT 'https://' || source || '/' || doc_id, 'documents' FROM documents)")
def _(t):
    a = t.pages.select("url", F.lit("pages").alias("branch"))
    return a.unionByName(t.documents.select(F.concat(F.lit("https://"), "source", F.lit("/"), C("doc_id").cast("string")).alias("url"), F.lit("documents").alias("branch")))


HOT = "SELECT conv_id, 'hot' AS kind FROM posts WHERE turn = 0 ORDER BY created DESC, conv_id LIMIT 50"
TOPS = "SELECT conv_id, 'top' AS kind FROM posts WHERE turn = 0 ORDER BY score DESC, conv_id LIMIT 50"


def _forum(t, limit: int = 100):
    first = t.posts.filter("turn = 0")
    hot = first.orderBy(C("created").desc(), "conv_id").limit(limit // 2).select("conv_id", F.lit("hot").alias("kind"))
    return hot.unionByName(first.orderBy(C("score").desc(), "conv_id").limit(limit // 2).select("conv_id", F.lit("top").alias("kind")))


@query("u02_hot_and_top", f"WITH {X.POSTS_SQL} SELECT * FROM ({HOT}) UNION ALL SELECT * FROM ({TOPS})")
def _(t):
    return _forum(t)


@query("s04_forum_scan", f"WITH {X.POSTS_SQL} SELECT p.conv_id, p.kind, q.text FROM (SELECT * FROM ({HOT}) UNION ALL SELECT * FROM ({TOPS})) p JOIN posts q ON q.conv_id = p.conv_id AND q.turn = 0")
def _(t):
    landed = t.posts.filter("turn = 0").select("conv_id", F.to_json(F.struct("conv_id", "text")).alias("json"))
    read = landed.select("conv_id", F.from_json("json", "conv_id bigint, text string").alias("j")).select("conv_id", "j.text")
    return _forum(t).join(read, "conv_id")


@query("u03_keyword_union", f"SELECT source, array_to_string(list_sort(list_distinct({sql.array(L.BASE_RECURSION)} || [source])), ',') AS keywords FROM (SELECT DISTINCT source FROM documents)")
def _(t):
    return t.documents.select("source").distinct().select("source", F.array_join(F.array_sort(F.array_union(F.array(*map(F.lit, L.BASE_RECURSION)), F.array("source"))), ",").alias("keywords"))


@query("u04_distinct_links", f"WITH {X.LINKS_SQL} SELECT DISTINCT link FROM links")
def _(t):
    return t.links.select("link").distinct()


@query("u05_difference", f"WITH {X.LINKS_SQL} SELECT DISTINCT link FROM links WHERE link NOT IN (SELECT url FROM pages)")
def _(t):
    return t.links.select("link").distinct().join(t.pages.select(C("url").alias("link")), "link", "left_anti")


@query("u06_intersection", f"SELECT doc_id, list_has_any({sql.words('lower(text)')}, {sql.array(L.POST_WORDS)}) AS shared FROM documents")
def _(t):
    return t.documents.select("doc_id", F.arrays_overlap(text.words(F.lower("text")), F.array(*map(F.lit, L.POST_WORDS))).alias("shared"))


SPEAK = "(?:[A-Za-z]+):"


@query("w08_speaker_turns", f"WITH lines AS (SELECT conv_id, turn AS n, role || ': ' || text AS line, true AS opens FROM conversations UNION ALL SELECT conv_id, turn + 0.5, 'y sigue', false FROM conversations), s AS (SELECT *, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY n) AS speech FROM lines) SELECT conv_id, CAST(speech AS BIGINT) AS speech, string_agg(line, ' ' ORDER BY n) AS said FROM s GROUP BY 1, 2")
def _(t):
    c = t.conversations
    lines = c.select("conv_id", C("turn").cast("double").alias("n"), F.concat("role", F.lit(": "), "text").alias("line")).unionByName(c.select("conv_id", (C("turn") + 0.5).alias("n"), F.lit("y sigue").alias("line")))
    opens = F.regexp_like("line", F.lit("^(user|assistant|system):")).cast("int")
    numbered = lines.withColumn("speech", F.sum(opens).over(Window.partitionBy("conv_id").orderBy("n")))
    return numbered.groupBy("conv_id", "speech").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda s: s["line"]), " ").alias("said"))


@query("f14_forum_gates", f"WITH {X.POSTS_SQL} SELECT conv_id, turn FROM posts WHERE (turn = 0 AND score >= 1 AND length(text) >= 20) OR (turn > 0 AND text NOT IN ('[deleted]', '[removed]') AND length(text) BETWEEN 20 AND 5000 AND score >= -5)")
def _(t):
    post = (C("turn") == 0) & (C("score") >= 1) & (F.length("text") >= 20)
    comment = (C("turn") > 0) & ~C("text").isin("[deleted]", "[removed]") & F.length("text").between(20, 5000) & (C("score") >= -5)
    return t.posts.filter(post | comment).select("conv_id", "turn")


P3 = f"SELECT 'tranco_' || replace(domain, '.', '_') AS name, 'https://' || domain AS base_url, 'domain_' || category AS type, category IN ('news', 'commercial') AS render_js, CASE category WHEN 'government' THEN 4 WHEN 'education' THEN 5 WHEN 'news' THEN 3 WHEN 'organization' THEN 3 ELSE 2 END AS crawl_depth, category IN ('government', 'education') AS respect_robots_txt, rank FROM (SELECT domain, rank, {sql.domain_category('domain', IND)} AS category FROM domains)"


@query("p03_source_synthesis", f"WITH {X.DOMAINS_SQL} {P3}")
def _(t):
    d = t.domains.withColumn("category", urls.domain_category(C("domain"), urls.domain_indicators(C("domain"))))
    depth = F.create_map(*[F.lit(x) for kv in L.CRAWL_DEPTH.items() for x in kv])
    return d.select(F.concat(F.lit("tranco_"), F.replace("domain", F.lit("."), F.lit("_"))).alias("name"), F.concat(F.lit("https://"), "domain").alias("base_url"), F.concat(F.lit("domain_"), "category").alias("type"), C("category").isin("news", "commercial").alias("render_js"), F.coalesce(F.try_element_at(depth, C("category")), F.lit(2)).alias("crawl_depth"), C("category").isin("government", "education").alias("respect_robots_txt"), "rank")



