"""The driver's tables in the shapes that the engine works on, as DataFrames and as SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, urls
from ..operators import ranking
from . import scratch

#: Times are taken from here, never from the clock.
BASE, AS_OF = "2024-01-01 00:00:00", "2024-01-08 00:00:00"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def as_of(self):
        return F.lit(AS_OF).cast("timestamp")

    @cached_property
    def frontier(self) -> DataFrame:
        labels = self.labels.select("doc_id", "quality")
        d = self.documents.join(labels, "doc_id", "left")
        status = F.when(F.col("quality") == 1, "completed").when(F.col("quality") == 0, "failed").otherwise("pending")
        url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"))
        rows = d.select("doc_id", url.alias("url"), "source", status.alias("status"), "n_chars")
        done = F.col("status") == "completed"
        return rows.select(
            F.sha2(F.col("url").cast("binary"), 256).alias("url_hash"), "url", "source", "status", (F.lit(BASE).cast("timestamp") + F.make_interval(mins=F.col("doc_id").cast("int"))).alias("created_at"),
            (F.lit(BASE).cast("timestamp") + F.make_interval(mins=(F.col("doc_id") + 30).cast("int"))).alias("updated_at"), F.when(done, F.floor(F.col("n_chars") / 4)).otherwise(0).cast("long").alias("token_count"),
            F.when(done, F.col("n_chars")).otherwise(0).cast("long").alias("content_size"), (F.pmod("doc_id", F.lit(100)) / 10).alias("mexican_score"), F.pmod("doc_id", F.lit(250)).cast("double").alias("processing_time_ms"),
            F.lit(0).alias("retry_count"), urls.priority(F.col("url")).alias("priority_score"), "doc_id",
        )

    @cached_property
    def links(self) -> DataFrame:
        """page_id, url (of the page), pos, href, anchor, link (absolute)."""
        rows = self.pages.select("page_id", "url", F.explode(html.html_links("html")).alias("l")).select("page_id", "url", "l.*")
        return rows.withColumn("link", urls.resolve(F.col("url"), F.col("href")))

    @cached_property
    def domains(self) -> DataFrame:
        """rank and domain of the pages' hosts, the most frequent first. Hosts are ranked over ranges of their order."""
        hosts = self.pages.groupBy(urls.host(F.col("url")).alias("domain")).agg(F.count("*").alias("n"))
        return ranking.rank_whole(hosts, [F.col("n").desc(), F.col("domain")], "rank", scratch.keeper(self.spark)).withColumn("rank", F.col("rank").cast("int"))

    @cached_property
    def posts(self) -> DataFrame:
        """Threads of conversations: the first turn is the post, the others are its comments."""
        return self.conversations.select("conv_id", "turn", F.col("role").alias("author"), "text", F.pmod(F.col("conv_id") * 7 + F.col("turn") * 3, F.lit(25)).cast("long").alias("score"), (F.lit(BASE).cast("timestamp") + F.make_interval(hours=F.pmod("conv_id", F.lit(168)).cast("int"))).alias("created"))

    @cached_property
    def feed(self) -> DataFrame:
        e = self.events
        return e.select(F.concat(F.lit("https://feed.example.com/"), F.col("event_id").cast("string")).alias("url"), F.concat(F.col("event_type"), F.lit(" nota "), F.col("event_id").cast("string")).alias("title"), F.col("props").alias("description"), F.when(F.pmod("event_id", F.lit(10)) != 0, F.col("ts")).alias("published_date"), F.col("event_type").alias("source"), "event_id", "user_id", "value", "ts")

    @cached_property
    def segments(self) -> DataFrame:
        return self.documents.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("seq", "line"))

    @cached_property
    def songs(self) -> DataFrame:
        return self.documents.select("doc_id", F.col("source").alias("artist"), F.col("lang").alias("genre"), F.concat(F.lit("Song "), F.col("doc_id").cast("string")).alias("title"), F.col("text").alias("lyrics"), (F.pmod("doc_id", F.lit(13)) != 0).alias("success"))


# ---- the same in SQL ------------------------------------------------------------------------------------------------
URL_SQL = "'https://' || source || '.example.com/' || lang || '/' || d.doc_id"


def priority_sql(u: str) -> str:
    from ..functions import lexicons as L

    any_ = lambda terms: "(" + " OR ".join(f"contains(lower({u}), '{t}')" for t in terms) + ")"
    return (
        f"least(10.0, 1.0 + CASE WHEN {any_(L.PRIORITY_OFFICIAL)} THEN 2.0 ELSE 0.0 END + CASE WHEN {any_(L.PRIORITY_NEWS)} THEN 1.0 ELSE 0.0 END + CASE WHEN lower({u}) LIKE '%.pdf' THEN 1.5 ELSE 0.0 END"
        f" + CASE WHEN {any_(L.PRIORITY_SOCIAL)} THEN 0.5 ELSE 0.0 END + CASE WHEN {any_(L.PRIORITY_PLACES)} THEN 0.8 ELSE 0.0 END)::DOUBLE"
    )


FRONTIER_SQL = f"""frontier AS (
  SELECT *, sha256(url) AS url_hash, {priority_sql('url')} AS priority_score FROM (
    SELECT d.doc_id, {URL_SQL} AS url, source,
      CASE WHEN quality = 1 THEN 'completed' WHEN quality = 0 THEN 'failed' ELSE 'pending' END AS status,
      TIMESTAMP '{BASE}' + to_minutes(CAST(d.doc_id AS INTEGER)) AS created_at, TIMESTAMP '{BASE}' + to_minutes(CAST(d.doc_id + 30 AS INTEGER)) AS updated_at,
      CASE WHEN quality = 1 THEN n_chars // 4 ELSE 0 END AS token_count, CASE WHEN quality = 1 THEN n_chars ELSE 0 END AS content_size,
      (d.doc_id % 100) / 10.0::DOUBLE AS mexican_score, CAST(d.doc_id % 250 AS DOUBLE) AS processing_time_ms, 0 AS retry_count
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  )
)"""
HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
LINKS_SQL = """links AS (
  SELECT page_id, url, pos - 1 AS pos, hrefs[pos] AS href, trim(anchors[pos]) AS anchor, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || hrefs[pos] AS link
  FROM (SELECT *, unnest(generate_series(1, len(hrefs))) AS pos FROM (
    SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS anchors FROM pages))
)"""
DOMAINS_SQL = f"""domains AS (
  SELECT domain, n, CAST(row_number() OVER (ORDER BY n DESC, domain) AS INTEGER) AS rank FROM (SELECT {HOST_SQL} AS domain, count(*) AS n FROM pages GROUP BY 1)
)"""
POSTS_SQL = f"""posts AS (
  SELECT conv_id, turn, role AS author, text, (conv_id * 7 + turn * 3) % 25 AS score, TIMESTAMP '{BASE}' + to_hours(CAST(conv_id % 168 AS INTEGER)) AS created FROM conversations
)"""
FEED_SQL = """feed AS (
  SELECT 'https://feed.example.com/' || event_id AS url, event_type || ' nota ' || event_id AS title, props AS description,
    CASE WHEN event_id % 10 <> 0 THEN ts END AS published_date, event_type AS source, event_id, user_id, value, ts FROM events
)"""
SEGMENTS_SQL = """segments AS (
  SELECT doc_id, lang, source, CAST(k - 1 AS INTEGER) AS seq, parts[k] AS line FROM (
    SELECT *, unnest(generate_series(1, len(parts))) AS k FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS parts FROM documents))
)"""
SONGS_SQL = "songs AS (SELECT doc_id, source AS artist, lang AS genre, 'Song ' || doc_id AS title, text AS lyrics, doc_id % 13 <> 0 AS success FROM documents)"
