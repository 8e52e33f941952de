"""Readers applied to landed data that the driver's tables stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import charsets, text, urls
from ..operators import ranking
from ..plans import fixtures as X
from ..sources import readers, services
from . import query, sql
from .sinks import folder, keep

C = F.col
SETTINGS = """
politeness: {user_agent: bot, request_delay: 1, timeout: 30}
extraction: {}
validation: {min_words: 5, min_sentences: 1}
storage: {output_dir: out, state_db: state, snapshot_dir: snap}
concurrency: {num_threads: 16}
"""
CATALOG = """
sources:
  - {name: gobierno, type: web, base_url: 'https://gob.example', urls: ['https://gob.example/a', 'https://gob.example/b'], crawl_depth: 3, respect_robots_txt: true}
  - {name: foro, type: reddit, api_limit: 100, crawl_comments: true, start_urls: ['https://foro.example/']}
  - {name: videos, type: youtube}
"""


@query("s01_config", "SELECT * FROM (VALUES ('concurrency', 1), ('extraction', 0), ('politeness', 3), ('storage', 3), ('validation', 2)) v(section, keys)")
def _(t):
    return t.spark.createDataFrame([(k, len(v or {})) for k, v in readers.config(SETTINGS).items()], "section string, keys int")


@query("s02_source_catalog", "SELECT * FROM (VALUES ('gobierno', 'web', 3, NULL), ('foro', 'reddit', NULL, 100), ('videos', 'youtube', NULL, NULL)) v(name, type, crawl_depth, api_limit)")
def _(t):
    return readers.source_catalog(t.spark, CATALOG).select("name", "type", "crawl_depth", "api_limit")


@query("s03_seeds", "SELECT * FROM (VALUES ('gobierno', 'https://gob.example/a'), ('gobierno', 'https://gob.example/b'), ('foro', 'https://foro.example/')) v(name, url)")
def _(t):
    return readers.seeds(readers.source_catalog(t.spark, CATALOG))


#: Videos a response holds, and the most a channel gives.
PER_RESPONSE, PER_CHANNEL = 50, 500


def _landed(t):
    """Documents as responses of a video service: a source is a channel, its newest documents come first."""
    ranked = ranking.rank(t.documents.select("doc_id", "source", (-C("doc_id")).alias("newest")), "source", "newest", "k").withColumn("page", F.floor((C("k") - 1) / PER_RESPONSE))
    item = F.struct(F.struct(F.struct(C("doc_id").cast("string").alias("videoId")).alias("resourceId")).alias("snippet"))
    packed = ranked.groupBy("source", "page").agg(F.array_sort(F.collect_list(F.struct("k", item.alias("item")))).alias("rows"))
    token = lambda c: F.concat(F.lit("p"), c.cast("string"))
    following = F.when(F.size("rows") == PER_RESPONSE, token(C("page") + 1))
    landed = packed.select(C("source").alias("channel_id"), F.when(C("page") > 0, token(C("page"))).alias("token"), F.to_json(F.struct(following.alias("nextPageToken"), F.col("rows.item").alias("items"))).alias("json"))
    return landed


UPLOADED = f"SELECT source AS channel_id, rank, doc_id AS video_id FROM (SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS INTEGER) AS rank FROM documents) WHERE rank <= {PER_CHANNEL}"


@query("s06_channel_videos", UPLOADED)
def _(t):
    found = readers.channel_videos(keep(t)(_landed(t)), PER_CHANNEL, keep(t))
    return found.select("channel_id", "rank", C("video_id").cast("long").alias("video_id"))


@query("s06_uploads_source", UPLOADED)
def _(t):
    to = folder(t, "uploads")
    named = _landed(t).select("channel_id", F.coalesce("token", F.lit(services.FIRST)).alias("token"), C("json").alias("value"))
    named.repartition("channel_id", "token").write.partitionBy("channel_id", "token").text(to)
    services.register(t.spark)
    found = t.spark.read.format("channel_uploads").option("path", to).option("most", PER_CHANNEL).load()
    return found.select("channel_id", C("rank").cast("int").alias("rank"), C("video_id").cast("long").alias("video_id"))


@query("s07_channel_id", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'UC' || doc_id WHEN 1 THEN 'h' || doc_id END AS handle FROM documents")
def _(t):
    i = C("doc_id").cast("string")
    url = F.when(C("doc_id") % 3 == 0, F.concat(F.lit("https://youtube.com/channel/UC"), i, F.lit("?x=1"))).when(C("doc_id") % 3 == 1, F.concat(F.lit("https://www.youtube.com/@h"), i)).otherwise(F.lit("https://example.org/c/x"))
    return t.documents.select("doc_id", urls.channel_handle(url).alias("handle"))


CLEANED = f"regexp_replace(regexp_replace({sql.strip('line')}, '\\[.*?\\]', '', 'g'), '\\s+', ' ', 'g')"


@query("s08_transcripts", f"WITH {X.SEGMENTS_SQL} SELECT doc_id AS video_id, coalesce(string_agg(cleaned, ' ' ORDER BY seq) FILTER (cleaned <> ''), '') AS text FROM (SELECT doc_id, seq, {CLEANED} AS cleaned FROM segments WHERE lang IN ('es', 'fr')) GROUP BY doc_id")
def _(t):
    own = t.segments.select(C("doc_id").alias("video_id"), "lang", "seq", C("line").alias("text"))
    return readers.transcripts(own.unionByName(own.filter("lang = 'es'").withColumn("lang", F.lit("fr")).withColumn("text", F.lit("otra"))), ["es", "fr"])


@query("s09_trending_videos", "SELECT doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS BIGINT) AS rank, n_chars AS views, CAST(NULL AS BIGINT) AS likes FROM documents")
def _(t):
    v = t.documents.select("doc_id", "source", C("n_chars").cast("string").try_cast("bigint").alias("views"), F.lit("n/a").try_cast("bigint").alias("likes"))
    return ranking.rank_whole(v, [C("views").desc(), C("doc_id")], "rank", keep(t), ["source"]).select("doc_id", "rank", "views", "likes")


@query("s10_ranked_domains", f"WITH {X.DOMAINS_SQL} SELECT rank, domain FROM domains")
def _(t):
    lines = t.domains.select(F.concat(C("rank").cast("string"), F.lit(", "), F.upper("domain")).alias("value"))
    bad = t.spark.createDataFrame([("no-comma",), ("x,y.example",)], "value string")
    return readers.ranked_domains(lines.unionByName(bad))


def _feeds(t):
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    date = F.when(C("published_date").isNotNull(), F.concat(F.lit("<pubDate>"), F.date_format(C("published_date").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss Z"), F.lit("</pubDate>"))).otherwise("")
    item = F.concat(F.lit("<item><title>"), esc(C("title")), F.lit("</title><link>"), F.when(C("event_id") % 7 != 0, C("url")).otherwise(""), F.lit("</link><category>"), "source", F.lit("</category>"), date, F.lit("<description>"), esc(C("description")), F.lit("</description></item>"))
    dealt = t.feed.withColumn("part", F.floor(C("event_id") / 100))
    return dealt.groupBy("source", "part").agg(F.concat(F.lit('<?xml version="1.0"?><rss><channel>\x01'), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("xml")).select("source", F.concat(F.lit("https://feed.example/"), C("part").cast("string")).alias("feed_url"), "xml")


ENTRY = f"WITH {X.FEED_SQL} SELECT url, title, description, strftime(date_trunc('second', published_date), '%Y-%m-%d %H:%M:%S') AS published, source, url AS entry_id, source AS categories FROM feed WHERE event_id % 7 <> 0"


@query("s11_feed_scan", ENTRY)
def _(t):
    e = readers.feed_entries(_feeds(t))
    return e.select("url", "title", "description", F.date_format("published_date", "yyyy-MM-dd HH:mm:ss").alias("published"), "source", "entry_id", F.array_join("categories", ",").alias("categories"))


@query("s11_feed_files", ENTRY)
def _(t):
    to = folder(t, "feeds")
    date = F.date_format(C("published_date").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss Z")
    link = F.when(C("event_id") % 7 != 0, C("url")).otherwise("")
    items = t.feed.select("title", link.alias("link"), C("source").alias("category"), date.alias("pubDate"), "description", "source")
    items.write.format("xml").option("rootTag", "rss").option("rowTag", "item").option("nullValue", "").partitionBy("source").save(to)
    e = readers.read_feeds(t.spark, to)
    return e.select("url", "title", "description", F.date_format("published_date", "yyyy-MM-dd HH:mm:ss").alias("published"), F.regexp_extract("file", "source=([^/]*)", 1).alias("source"), "entry_id", F.array_join("categories", ",").alias("categories"))


@query("s12_feed_entry", f"SELECT source, count(*) AS entries, count(published) AS dated FROM ({ENTRY}) GROUP BY source")
def _(t):
    return readers.feed_entries(_feeds(t)).groupBy("source").agg(F.count("*").alias("entries"), F.count("published_date").alias("dated"))


@query("s16_sitemap", "SELECT url FROM pages")
def _(t):
    to = folder(t, "sitemaps")
    t.pages.select(F.concat(F.lit(" "), "url", F.lit(" ")).alias("loc")).write.format("xml").option("rootTag", "urlset").option("rowTag", "url").save(to)
    return readers.read_sitemaps(t.spark, to).select("url")


@query("s17_feed_links", f"WITH {X.FEED_SQL} SELECT DISTINCT url FROM feed WHERE event_id % 7 <> 0 AND {sql.valid('url', repr('feed.example.com'))}")
def _(t):
    found = readers.feed_entries(_feeds(t)).select("url").distinct()
    return found.filter(urls.valid_link(C("url"), F.lit("feed.example.com")))


@query("s18_pdf_text", "SELECT item_id, regexp_replace(text, '[()\\\\]', ' ', 'g') AS text FROM benchmark")
def _(t):
    shown = F.regexp_replace("text", r"[()\\]", " ")
    pdf = F.concat(F.lit("%PDF-1.4\n1 0 obj << >> stream\nBT ("), shown, F.lit(") Tj ET\nendstream endobj\n%%EOF")).cast("binary")
    return t.benchmark.select("item_id", readers.pdf_text(pdf).alias("text"))


ROWS = "item_id || chr(9) || length(text)"


@query("s18_pdf_tables", f"SELECT item_id, regexp_replace(text, '[()\\\\]', ' ', 'g') || chr(10) || 'id' || chr(10) || 'n' || chr(10) || replace({ROWS}, chr(9), chr(10)) || repeat(chr(10), 3) || '[TABLA]' || chr(10) || 'id' || chr(9) || 'n' || chr(10) || {ROWS} || chr(10) || '[/TABLA]' || chr(10) AS text, 1 AS total_pages, 1 AS tables_found, 'no. ' || item_id AS title, '' AS author FROM benchmark")
def _(t):
    shown, i = F.regexp_replace("text", r"[()\\]", " "), C("item_id").cast("string")
    cell = lambda x, y, s: F.concat(F.lit(f"1 0 0 1 {x} {y} Tm ("), s, F.lit(") Tj "))
    cells = F.concat(cell(72, 600, F.lit("id")), cell(200, 600, F.lit("n")), cell(72, 580, i), cell(200, 580, F.length("text").cast("string")))
    head = F.concat(F.lit("%PDF-1.4\n1 0 obj << /Title (no. "), i, F.lit(") >> endobj 2 0 obj << /Type /Page >> endobj 3 0 obj << >> stream\nBT /F1 12 Tf 72 700 Td ("))
    pdf = F.concat(head, shown, F.lit(") Tj ET BT "), cells, F.lit("ET\nendstream endobj\n%%EOF")).cast("binary")
    return t.benchmark.select("item_id", readers.pdf(pdf).alias("p")).select("item_id", "p.text", "p.total_pages", "p.tables_found", "p.title", "p.author")


@query("s19_corpus_scan", "SELECT doc_id, substring(sha256(text), 1, 16) AS content_hash FROM documents")
def _(t):
    path = F.concat(F.lit("/corpus/"), "source", F.lit("/"), text.file_name(C("source"), F.lit("2024-01-01").cast("date"), text.content_key(C("text"))))
    return t.documents.select("doc_id", readers.key_of_file(path).alias("content_hash"))


@query("s20_byte_scan", "SELECT doc_id, true AS utf8, text FROM documents")
def _(t):
    raw = t.documents.select("doc_id", F.encode("text", "UTF-8").alias("content"))
    return raw.select("doc_id", F.is_valid_utf8(C("content").cast("string")).alias("utf8"), readers.decoded(C("content")).alias("text"))


@query("v03_encoding", "SELECT doc_id, regexp_replace(text, '[^\\x{00}-\\x{FF}]', '?', 'g') AS text FROM documents")
def _(t):
    latin = t.documents.select("doc_id", F.encode(F.regexp_replace("text", r"[^\x{00}-\x{FF}]", "?"), "ISO-8859-1").alias("content"))
    return latin.select("doc_id", readers.decoded(C("content")).alias("text"))


@query("s23_robots_rules", f"WITH {X.DOMAINS_SQL} SELECT domain AS host, agent, rule, path FROM domains, (VALUES ('*', 'disallow', '/privado'), ('*', 'allow', '/'), ('bot', 'disallow', '/x'), ('other', 'disallow', '/x')) v(agent, rule, path)")
def _(t):
    lines = F.array(*map(F.lit, ["User-agent: *", "Disallow: /privado # no", "Allow: /", "User-Agent: Bot", "User-agent: other", "Disallow:", "Disallow: /x"]))
    return readers.robots_rules(t.domains.select(C("domain").alias("host"), F.posexplode(lines).alias("seq", "line")))


#: Documents in the charsets that they can be written in, with byte order marks and without.
WRITTEN = ["UTF-8", "UTF-8 mark", "UTF-16BE", "UTF-16LE", "UTF-16 mark", "ISO-8859-1"]


@query("v03_charsets", "SELECT doc_id, CASE WHEN doc_id % 6 = 5 THEN regexp_replace(text, '[^\\x{00}-\\x{FF}]', '?', 'g') ELSE text END AS text, 0 AS errors FROM documents")
def _(t):
    kind = F.pmod("doc_id", F.lit(6))
    latin = F.regexp_replace("text", r"[^\x{00}-\x{FF}]", "?")
    content = F.when(kind == 0, F.encode("text", "UTF-8")).when(kind == 1, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"))).when(kind == 2, F.encode("text", "UTF-16BE")).when(kind == 3, F.encode("text", "UTF-16LE")).when(kind == 4, F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE"))).otherwise(F.encode(latin, "ISO-8859-1"))
    return t.documents.select("doc_id", charsets.decoded(content).alias("d")).select("doc_id", "d.text", C("d.errors").cast("int").alias("errors"))
