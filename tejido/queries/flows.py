"""Streams, micro-batches and iteration; streams run over the same tables with their available data and give what a batch would."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import frontier as O
from ..operators import language
from ..plans import fixtures as X
from ..streaming import flows, retries, state
from . import query, sql
from .sinks import folder, keep

C = F.col


def stream(t, name: str):
    """A table as a stream of files."""
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.dir}/{name}.parquet*")


WORK = f"""WITH {X.FRONTIER_SQL}, taken AS (SELECT url_hash FROM frontier WHERE status = 'pending' ORDER BY priority_score DESC, created_at, url_hash LIMIT 96)
SELECT status, count(*) AS n, CAST(sum(token_count) AS BIGINT) AS tokens FROM (SELECT CASE WHEN url_hash NOT IN (SELECT * FROM taken) THEN status WHEN doc_id % 4 = 0 THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN url_hash IN (SELECT * FROM taken) AND doc_id % 4 <> 0 THEN 10 ELSE token_count END AS token_count FROM frontier) GROUP BY status"""


def _process(taken):
    bad = C("doc_id") % 4 == 0
    return taken.select("url_hash", F.when(bad, "failed").otherwise("completed").alias("status"), F.when(~bad, 10).cast("long").alias("token_count"))


@query("r01_work_loop", WORK)
def _(t):
    done = flows.work(t.frontier, _process, 32, 3, t.as_of, keep(t))
    return done.groupBy("status").agg(F.count("*").alias("n"), F.sum("token_count").alias("tokens"))


@query("r02_batch_results", "SELECT doc_id, CASE WHEN n_chars < 100 THEN 'failed' ELSE 'completed' END AS status, CASE WHEN n_chars < 100 THEN 'too short' END AS error FROM documents")
def _(t):
    short = C("n_chars") < 100
    return t.documents.select("doc_id", F.when(short, "failed").otherwise("completed").alias("status"), F.when(short, "too short").alias("error"))


#: How long an attempt at a document takes, and whether it fails, by its number; a document that is stuck never comes back.
TOOK, BROKEN, STUCK = "(doc_id * 37 + attempt * 11) % 150", "(doc_id + attempt) % 3 = 0", "doc_id % 50 = 7"
TRIED = f"""CASE WHEN {STUCK} OR {TOOK} > 120 THEN 'timeout' WHEN {BROKEN} THEN 'failed' ELSE 'completed' END"""
RETRIED = f"""WITH RECURSIVE tries AS (
  SELECT doc_id, 1 AS attempt, 0.0::DOUBLE AS due FROM documents
  UNION ALL
  SELECT doc_id, attempt + 1, (due + CASE WHEN {STUCK} OR {TOOK} > 120 THEN 120 ELSE {TOOK} END + power(2, attempt - 1))::DOUBLE FROM tries WHERE attempt < 3 AND {TRIED} <> 'completed'
), told AS (SELECT *, {TRIED} AS status, CASE WHEN {STUCK} OR {TOOK} > 120 THEN 'timeout' WHEN {BROKEN} THEN 'broken' END AS error FROM tries)"""


def _attempt(queue):
    back = queue.filter(f"not ({STUCK})").withColumn("took", F.expr(f"cast({TOOK} as double)"))
    return back.withColumn("error", F.when(F.expr(BROKEN), "broken"))


@query("r02_retries", f"{RETRIED} SELECT doc_id, attempt, due, status, error FROM told")
def _(t):
    return retries.run(t.documents.select("doc_id"), _attempt, keep(t)).attempts.select("doc_id", "attempt", "due", "status", "error")


@query("r02_dead_letters", f"{RETRIED} SELECT doc_id, error FROM told WHERE attempt = 3 AND status <> 'completed'")
def _(t):
    return retries.run(t.documents.select("doc_id"), _attempt, keep(t)).dead.select("doc_id", "error")


#: A host leads to its pages, a page to its links, a link to its host, which closes circles.
EDGES = f"""{X.LINKS_SQL}, edges AS (SELECT {X.HOST_SQL} AS parent, url AS child FROM pages UNION SELECT url, link FROM links UNION SELECT link, {X.HOST_SQL.replace('url', 'link')} FROM links),
 hosts AS (SELECT DISTINCT {X.HOST_SQL} AS node FROM pages)"""


def _edges(t):
    host = lambda c: urls.host(C(c))
    found = t.links.select("url", "link")
    return t.pages.select(host("url").alias("parent"), C("url").alias("child")).unionByName(found.select(C("url").alias("parent"), C("link").alias("child"))).unionByName(found.select(C("link").alias("parent"), host("link").alias("child"))).distinct()


def _hosts(t):
    return t.pages.select(urls.host(C("url")).alias("node"))


REACH = f"WITH RECURSIVE {EDGES}, reach AS (SELECT node, 0 AS depth FROM hosts UNION SELECT child, depth + 1 FROM reach JOIN edges ON parent = node WHERE depth < 6) SELECT node, min(depth) AS depth FROM reach GROUP BY node"


@query("r03_recursive_growth", REACH)
def _(t):
    return flows.reachable(t.spark, _hosts(t), keep(t)(_edges(t)), 6, keep(t))


#: Steps after which a walk ends.
STEPS = 50


@query("r04_cycle_guard", f"WITH RECURSIVE {EDGES}, reach AS (SELECT node, 0 AS depth FROM hosts UNION SELECT child, depth + 1 FROM reach JOIN edges ON parent = node WHERE depth < {STEPS}) SELECT count(DISTINCT node) AS nodes FROM reach")
def _(t):
    return flows.reachable(t.spark, _hosts(t), keep(t)(_edges(t)), STEPS, keep(t)).agg(F.count("*").alias("nodes"))


@query("r05_stream_dedup", "SELECT event_type, user_id FROM events GROUP BY 1, 2")
def _(t):
    out, state = folder(t, "seen"), folder(t, "state")
    first = flows.first_seen(stream(t, "events").withColumn("ts", C("ts").cast("timestamp")), "ts", "60 days", "event_type", "user_id").select("event_type", "user_id")
    flows.run_stream(first, flows.batch_sink(out), state)
    return t.spark.read.schema("event_type string, user_id bigint, batch bigint").parquet(out).drop("batch")


@query("r06_rolling_counts", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    e = t.events.withColumn("ts", C("ts").cast("timestamp"))
    return flows.rolling_counts(e, "ts", "1 hour", "event_type").select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("r06_rolling_days", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, count(*) AS n FROM events GROUP BY 1")
def _(t):
    e = t.events.withColumn("ts", C("ts").cast("timestamp"))
    return flows.rolling_counts(e, "ts", "1 day").select(F.date_format("start", "yyyy-MM-dd").alias("start"), "n")


@query("r06_trailing_counts", "SELECT event_type, count(*) FILTER (ts > m - INTERVAL 1 HOUR) AS last_hour, count(*) FILTER (ts > m - INTERVAL 1 DAY) AS last_day FROM events, (SELECT max(ts) AS m FROM events) GROUP BY 1")
def _(t):
    e = t.events.withColumn("ts", C("ts").cast("timestamp"))
    now = F.lit(e.agg(F.max("ts")).first()[0])
    return flows.trailing_counts(e, "ts", now, {"last_hour": "INTERVAL 1 HOUR", "last_day": "INTERVAL 1 DAY"}, "event_type")


@query("r06_sliding_counts", """WITH w AS (SELECT event_type, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE, time_bucket(INTERVAL 15 MINUTE, ts), INTERVAL 15 MINUTE)) AS start FROM events)
SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def _(t):
    out = folder(t, "sliding")
    windows = flows.sliding_counts(stream(t, "events").withColumn("ts", C("ts").cast("timestamp")), "ts", "1 hour", "15 minutes", "10 minutes", "event_type")
    flows.run_counted(windows, flows.batch_sink(out), folder(t, "state"))
    return t.spark.read.parquet(out).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query("r07_freshness_horizon", f"WITH {X.FEED_SQL} SELECT event_id FROM feed WHERE published_date IS NULL OR published_date >= TIMESTAMP '2024-01-28' - INTERVAL 48 HOUR")
def _(t):
    return flows.fresh(t.feed, "published_date", F.lit("2024-01-28").cast("timestamp") - F.expr("INTERVAL 48 HOURS")).select("event_id")


@query("r10_populate", "SELECT sha256(url) AS url_hash, 'traditional_config' AS method, 'pending' AS status FROM (SELECT DISTINCT url FROM pages)")
def _(t):
    out, state = folder(t, "frontier"), folder(t, "state")

    rows = lambda df: O.first_of(O.new_rows(df.select("url", F.lit("pages").alias("source")), t.as_of), ["url_hash"], C("url")).select("url_hash", C("discovered_from").alias("method"), "status")
    put = flows.batch_sink(out, rows, ["url_hash"])
    flows.run_stream(stream(t, "pages"), put, state)
    flows.run_stream(stream(t, "pages"), lambda df, n: put(df, n + 1_000_000), folder(t, "state"))  # all of it comes once more
    return t.spark.read.parquet(out).drop("batch")


@query("r11_running_totals", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def _(t):
    out, state = folder(t, "totals"), folder(t, "state")
    sums = stream(t, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    sums.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(out)).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out).select("event_type", "n", F.round("total", 4).alias("total"))


@query("r12_alerts", f"""WITH {X.FRONTIER_SQL} SELECT start, tokens, errors FROM (SELECT strftime(date_trunc('hour', updated_at), '%Y-%m-%d %H:00') AS start, CAST(sum(token_count) AS BIGINT) AS tokens,
  count(*) FILTER (status = 'failed') AS errors, count(*) AS n FROM frontier WHERE status <> 'pending' GROUP BY 1) WHERE tokens < 1000000 OR errors / n::DOUBLE > 0.3""")
def _(t):
    hour = F.date_format("updated_at", "yyyy-MM-dd HH:00")
    hourly = t.frontier.filter("status <> 'pending'").groupBy(hour.alias("start")).agg(F.sum("token_count").alias("tokens"), F.count_if(C("status") == "failed").alias("errors"), F.count("*").alias("n"))
    return flows.alerts(hourly).select("start", "tokens", "errors")


FOUND = "list_distinct(regexp_extract_all(lower(text), '\\p{L}+'))"
KINDS = ", ".join(f"len(list_intersect({FOUND}, {sql.array(w)})) AS n_{lang}" for lang, w in text.FUNCTION_WORDS.items())
MOST = f"greatest({', '.join(f'n_{lang}' for lang in text.FUNCTION_WORDS)})"


@query("a22_language_words", f"SELECT doc_id, {sql.hits('lower(text)', ['ción', 'ñ'])} > 0 AS spanish_marks, CASE WHEN {MOST} = 0 THEN NULL {' '.join(f'WHEN n_{lang} = {MOST} THEN {sql.lit(lang)}' for lang in text.FUNCTION_WORDS)} END AS language FROM (SELECT doc_id, text, {KINDS} FROM documents)")
def _(t):
    return t.documents.select("doc_id", (text.lexicon_hits(F.lower("text"), ["ción", "ñ"]) > 0).alias("spanish_marks"), text.language(C("text")).alias("language"))


GAP = "SELECT event_id, ts, lag(ts) OVER (PARTITION BY {keys} ORDER BY ts, event_id) AS before FROM events"


@query("r08_keyed_delay_state", f"SELECT event_id, CASE WHEN before IS NULL THEN 0.0 ELSE greatest(0.0, round(3600.0 - (epoch(ts) - epoch(before)), 3)) END::DOUBLE AS wait FROM ({GAP.format(keys='user_id')})")
def _(t):
    out, where = folder(t, "waits"), folder(t, "state")
    flows.run_stream(state.waits(stream(t, "events").withColumn("ts", C("ts").cast("timestamp")), "user_id", "event_id", "ts", 3600), flows.batch_sink(out), where)
    return t.spark.read.schema("id bigint, wait double, batch bigint").parquet(out).select(C("id").alias("event_id"), "wait")


@query("r05_expiring_keys", f"SELECT event_id FROM ({GAP.format(keys='event_type, user_id')}) WHERE before IS NULL OR ts - before > INTERVAL 1 DAY")
def _(t):
    out, where = folder(t, "again"), folder(t, "state")
    flows.run_stream(state.new_again(stream(t, "events").withColumn("ts", C("ts").cast("timestamp")), ["event_type", "user_id"], "event_id", "ts", "1 DAY"), flows.batch_sink(out), where)
    return t.spark.read.schema("id bigint, batch bigint").parquet(out).select(C("id").alias("event_id"))


@query("a22_rank_profiles")
def _(t):
    return t.documents.select("doc_id", language.language(C("text"), language.learn(t.documents)).alias("l")).select("doc_id", C("l.lang").alias("language"), F.round("l.margin", 6).alias("margin"))
