"""The frontier's queries: insertion, dequeue, updates, progress, yield, sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus, frontier, ranking
from ..plans import fixtures as X
from ..schemas import TARGET_TOKENS
from . import query, sql

C, W = F.col, f"WITH {X.FRONTIER_SQL} "
DONE = "status = 'completed'"
FAIL = "status LIKE 'failed%'"
R6 = lambda name: F.round(name, 6).alias(name)


@query("flagship_corpus_stats", f"""SELECT source, count(*) AS files, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(length(text) // 4) AS BIGINT) AS tokens, CAST(sum({sql.n_words('text')}) AS BIGINT) AS words
FROM (SELECT *, row_number() OVER (PARTITION BY substring(sha256(text), 1, 16) ORDER BY doc_id) AS k FROM documents) WHERE k = 1 GROUP BY source ORDER BY tokens DESC""")
def _(t):
    from ..functions import text

    keyed = t.documents.select("doc_id", "source", F.length("text").alias("chars"), text.token_estimate(C("text")).alias("tokens"), text.n_words(C("text")).alias("words"), text.content_key(C("text")).alias("content_hash"))
    first = keyed.groupBy("content_hash").agg(F.min_by(F.struct("source", "chars", "tokens", "words"), "doc_id").alias("d"))
    return first.groupBy("d.source").agg(F.count("*").alias("files"), F.sum("d.chars").alias("chars"), F.sum("d.tokens").alias("tokens"), F.sum("d.words").alias("words")).orderBy(C("tokens").desc())


@query("s21_frontier_scan", f"{W} SELECT url_hash, url, source, status, token_count FROM frontier")
def _(t):
    return t.frontier.select("url_hash", "url", "source", "status", "token_count")


@query("k05_insert_if_absent", f"{W}, new AS (SELECT url, source FROM pages, (SELECT 'pages' AS source) UNION ALL SELECT url, source FROM frontier WHERE doc_id % 3 = 0) SELECT count(DISTINCT url) AS n, count(DISTINCT url) FILTER (source = 'pages') AS added FROM (SELECT url, source FROM frontier UNION SELECT url, 'pages' FROM pages WHERE url NOT IN (SELECT url FROM frontier))")
def _(t):
    new = frontier.new_rows(t.pages.select("url", F.lit("pages").alias("source")).unionByName(t.frontier.filter("doc_id % 3 = 0").select("url", "source")), t.as_of)
    whole = frontier.insert_if_absent(t.frontier.drop("doc_id"), new)
    return whole.agg(F.count_distinct("url_hash").alias("n"), F.count_if(C("source") == "pages").alias("added"))


@query("j02_anti_insert", f"{W} SELECT sha256(url) AS url_hash, {X.priority_sql('url')} AS priority FROM (SELECT DISTINCT url FROM pages) WHERE sha256(url) NOT IN (SELECT url_hash FROM frontier)")
def _(t):
    new = frontier.new_rows(t.pages.select("url", F.lit("pages").alias("source")), t.as_of)
    return frontier.absent(new, t.frontier).select("url_hash", C("priority_score").alias("priority"))


@query("j03_status_merge", f"{W} SELECT url_hash, CASE WHEN doc_id % 5 = 0 THEN 'completed' ELSE status END AS status, CASE WHEN doc_id % 5 = 0 THEN 77 ELSE token_count END AS token_count FROM frontier")
def _(t):
    changes = t.frontier.filter("doc_id % 5 = 0").select("url_hash", F.lit("completed").alias("status"), F.lit(77).cast("long").alias("token_count"))
    return frontier.update(t.frontier, changes, ["status", "token_count"]).select("url_hash", "status", "token_count")


@query("k06_status_update", f"{W} SELECT url_hash, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE status END AS status, mexican_score FROM frontier")
def _(t):
    changes = t.frontier.filter("doc_id % 5 = 0").select("url_hash", F.lit(None).cast("string").alias("status"), F.lit(True).alias("set_status"), F.lit(None).cast("double").alias("mexican_score"))
    return frontier.update(t.frontier, changes, ["status", "mexican_score"]).select("url_hash", "status", "mexican_score")


@query("o01_priority_dequeue", f"{W} SELECT url_hash, priority_score, doc_id FROM frontier WHERE status = 'pending' AND priority_score >= 0.5 ORDER BY priority_score DESC, created_at, url_hash LIMIT 32")
def _(t):
    return frontier.dequeue(t.frontier, 32, 0.5).select("url_hash", "priority_score", "doc_id")


@query("j08_mark_batch", f"{W} SELECT status, count(*) AS n FROM (SELECT CASE WHEN url_hash IN (SELECT url_hash FROM frontier WHERE status = 'pending' ORDER BY priority_score DESC, created_at, url_hash LIMIT 32) THEN 'processing' ELSE status END AS status FROM frontier) GROUP BY 1")
def _(t):
    return frontier.mark(t.frontier, frontier.dequeue(t.frontier, 32), "processing", t.as_of).groupBy("status").agg(F.count("*").alias("n"))


@query("r09_status_lifecycle", f"{W} SELECT status, CAST(sum(retry_count) AS BIGINT) AS retries, count(*) AS n FROM (SELECT CASE WHEN url_hash IN (SELECT url_hash FROM frontier WHERE status = 'pending' ORDER BY priority_score DESC, created_at, url_hash LIMIT 32) THEN 'pending' ELSE status END AS status, CASE WHEN url_hash IN (SELECT url_hash FROM frontier WHERE status = 'pending' ORDER BY priority_score DESC, created_at, url_hash LIMIT 32) THEN 1 ELSE 0 END AS retry_count FROM frontier) GROUP BY 1")
def _(t):
    taken = frontier.mark(t.frontier, frontier.dequeue(t.frontier, 32), "processing", t.as_of)
    back = frontier.released(taken, t.as_of + F.expr("INTERVAL 2 HOURS"))
    return back.groupBy("status").agg(F.sum("retry_count").alias("retries"), F.count("*").alias("n"))


OVERALL = f"SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'processing') AS processing, count(*) FILTER ({DONE}) AS completed, count(*) FILTER ({FAIL}) AS failed, count(*) FILTER (status = 'blocked') AS blocked, CAST(sum(token_count) AS BIGINT) AS total_tokens, round(avg(token_count), 6) AS avg_tokens, CAST(sum(content_size) AS BIGINT) AS total_size, round(avg(mexican_score), 6) AS avg_score, round(avg(processing_time_ms), 6) AS avg_ms FROM frontier"


@query("g01_progress", f"{W} {OVERALL}")
def _(t):
    return frontier.progress(t.frontier).withColumns({c: F.round(c, 6) for c in ("avg_tokens", "avg_score", "avg_ms")})


BY_SOURCE = f"SELECT source, count(*) AS total, count(*) FILTER ({DONE}) AS completed, count(*) FILTER ({FAIL}) AS failed, CAST(sum(token_count) AS BIGINT) AS tokens, round(avg(token_count), 6) AS avg_tokens, round(avg(mexican_score), 6) AS avg_score, round(avg(priority_score), 6) AS avg_priority, round(count(*) FILTER ({DONE}) / count(*)::DOUBLE * 100, 1) AS success_rate FROM frontier GROUP BY source"


@query("g02_by_source", f"{W} {BY_SOURCE}")
def _(t):
    return frontier.by_source(t.frontier).withColumns({c: F.round(c, 6) for c in ("avg_tokens", "avg_score", "avg_priority")}).orderBy(C("tokens").desc(), "source")


YIELD = f"SELECT domain, total_urls, completed_urls, total_tokens, round(avg_tokens_per_url, 1) AS avg_tokens_per_url, round(total_tokens / total_urls::DOUBLE, 1) AS yield_efficiency FROM (SELECT split_part(split_part(url, '://', 2), '/', 1) AS domain, count(*) AS total_urls, count(*) FILTER ({DONE}) AS completed_urls, CAST(sum(token_count) AS BIGINT) AS total_tokens, avg(token_count) AS avg_tokens_per_url FROM frontier WHERE url LIKE 'http%' GROUP BY 1 HAVING count(*) >= 5) ORDER BY total_tokens DESC, domain LIMIT 20"


@query("g03_domain_yield", f"{W} {YIELD}")
def _(t):
    return frontier.domain_yield(t.frontier)


@query("o05_top_domains", f"{W} SELECT domain, total_tokens FROM ({YIELD})")
def _(t):
    return frontier.domain_yield(t.frontier).select("domain", "total_tokens")


@query("g04_throughput", f"{W} SELECT round(avg(CASE WHEN token_count > 0 THEN token_count END), 6) AS tokens_per_success, count(*) FILTER ({DONE} AND created_at > TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 1 HOUR) AS recent_successes, count(*) FILTER ({DONE} AND created_at > TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 1 DAY) AS daily_successes FROM frontier")
def _(t):
    return frontier.throughput(t.frontier, F.lit("2024-01-01 12:00:00").cast("timestamp")).withColumn("tokens_per_success", F.round("tokens_per_success", 6))


@query("g05_report", f"{W} SELECT total, completed, round(completed / total::DOUBLE * 100, 1) AS success_rate, total_tokens, round(total_tokens / {TARGET_TOKENS}::DOUBLE * 100, 6) AS progress_percentage, round(total_size / 1048576.0::DOUBLE, 2) AS size_mb, round(avg_tokens, 1) AS avg_tokens FROM ({OVERALL})")
def _(t):
    return frontier.progress_report(t.frontier)


STATS = f"SELECT source AS source_name, count(*) AS total_urls, count(*) FILTER ({DONE}) AS completed_urls, count(*) FILTER ({FAIL}) AS failed_urls, CAST(sum(token_count) AS BIGINT) AS total_tokens, round(count(*) FILTER ({DONE}) / count(*)::DOUBLE * 100, 6) AS success_rate FROM frontier GROUP BY source"


@query("g06_source_stats", f"{W} {STATS}")
def _(t):
    return frontier.source_stats(t.frontier, t.as_of).select("source_name", "total_urls", "completed_urls", "failed_urls", "total_tokens", R6("success_rate"))


@query("k08_stats_upsert", f"{W} {STATS} UNION ALL SELECT 'gone', 1, 1, 0, 5, 100.0")
def _(t):
    now = frontier.source_stats(t.frontier, t.as_of).select("source_name", "total_urls", "completed_urls", "failed_urls", "total_tokens", R6("success_rate"))
    row = lambda name: t.spark.createDataFrame([(name, 1, 1, 0, 5, 100.0)], now.schema)
    return frontier.upsert(row("gone").unionByName(row("src1")), now, "source_name")


SESSION = "SELECT *, CASE WHEN status <> 'completed' THEN 'failed' END AS error_message FROM frontier WHERE status <> 'pending'"
TOTALS = f"SELECT count(*) AS processed, count(*) FILTER ({DONE}) AS successful, CAST(coalesce(sum(token_count) FILTER ({DONE}), 0) AS BIGINT) AS tokens, CAST(coalesce(sum(content_size) FILTER ({DONE}), 0) AS BIGINT) AS size, count(*) FILTER (status <> 'completed') AS errors FROM ({SESSION})"


@query("g07_session_totals", f"{W} SELECT *, round(processed / 600.0::DOUBLE, 6) AS urls_per_second, round(tokens / 600.0::DOUBLE, 6) AS tokens_per_second, round(successful / processed::DOUBLE * 100, 6) AS success_rate FROM ({TOTALS})")
def _(t):
    return frontier.session_totals(t.frontier.filter("status <> 'pending'"), 600.0)


BREAKDOWN = f"SELECT source, count(*) AS processed, count(*) FILTER ({DONE}) AS successful, CAST(coalesce(sum(token_count) FILTER ({DONE}), 0) AS BIGINT) AS tokens FROM ({SESSION}) GROUP BY source"


@query("g08_session_by_source", f"{W} {BREAKDOWN}")
def _(t):
    return frontier.session_by_source(t.frontier.filter("status <> 'pending'"))


@query("g14_leaderboard", f"{W} SELECT source, processed, successful, tokens, round(successful / greatest(processed, 1)::DOUBLE * 100, 1) AS success_rate FROM ({BREAKDOWN}) ORDER BY tokens DESC, source LIMIT 10")
def _(t):
    by = frontier.session_by_source(t.frontier.filter("status <> 'pending'"))
    return by.withColumn("success_rate", F.round(C("successful") / F.greatest("processed", F.lit(1)) * 100, 1)).orderBy(C("tokens").desc(), "source").limit(10)


@query("o06_top_sources", f"{W} SELECT source, tokens FROM ({BREAKDOWN}) ORDER BY tokens DESC, source LIMIT 10")
def _(t):
    return frontier.session_by_source(t.frontier.filter("status <> 'pending'")).select("source", "tokens").orderBy(C("tokens").desc(), "source").limit(10)


FILES = "SELECT source, lang AS domain, length(text) AS bytes, length(text) // 4 AS tokens FROM documents"


@query("g09_corpus_stats", f"SELECT CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(domain) = 0 THEN 'domain' ELSE 'total' END AS level, source, domain, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(bytes) / 1048576.0::DOUBLE, 6) AS size_mb, round(sum(tokens) / {TARGET_TOKENS}::DOUBLE * 100, 6) AS progress FROM ({FILES}) GROUP BY GROUPING SETS ((source), (domain), ())")
def _(t):
    from ..functions import text

    files = t.documents.select("source", C("lang").alias("domain"), F.length("text").cast("long").alias("bytes"), text.token_estimate(C("text")).alias("tokens"))
    return corpus.statistics(files, TARGET_TOKENS)


@query("g10_running_counters", "SELECT doc_id, CAST(sum(n_chars // 4) OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS tokens, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS files FROM documents")
def _(t):
    rows = t.documents.select("doc_id", "source", F.expr("n_chars div 4").alias("n"))
    return ranking.rank(ranking.running(rows, "source", "doc_id", C("n"), "tokens"), "source", "doc_id", "files").select("doc_id", "tokens", "files")


@query("g20_status_bundle", f"{W} SELECT f.total, f.total_tokens, s.sources, c.files FROM ({OVERALL}) f, (SELECT count(DISTINCT source) AS sources FROM frontier) s, (SELECT count(*) AS files FROM documents) c")
def _(t):
    p = frontier.progress(t.frontier).select("total", "total_tokens")
    return p.crossJoin(t.frontier.agg(F.count_distinct("source").alias("sources"))).crossJoin(t.documents.agg(F.count("*").alias("files")))


@query("k09_ttl_delete", f"{W} SELECT url_hash FROM frontier WHERE NOT (status = 'completed' AND updated_at < TIMESTAMP '{X.AS_OF}' - INTERVAL 7 DAY)")
def _(t):
    return frontier.retained(t.frontier, t.as_of, 7, "updated_at", C("status") == "completed").select("url_hash")


REOPENED = f"""{W}, taken AS (SELECT url_hash, doc_id FROM frontier WHERE status = 'pending' ORDER BY priority_score DESC, created_at, url_hash LIMIT 200)
SELECT url_hash, source, CASE WHEN url_hash NOT IN (SELECT url_hash FROM taken) THEN status WHEN doc_id % 4 = 0 THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN url_hash IN (SELECT url_hash FROM taken) AND doc_id % 4 <> 0 THEN 10 ELSE token_count END AS token_count FROM frontier
UNION ALL SELECT sha256(url), 'pages', 'pending', 0 FROM (SELECT DISTINCT url FROM pages) WHERE url NOT IN (SELECT url FROM frontier)"""


@query("s21_reopened_frontier", REOPENED)
def _(t):
    from ..operators.store import Store
    from ..schemas import FRONTIER
    from .sinks import folder

    root = folder(t, "store")
    Store(t.spark, root, f"{FRONTIER}, doc_id bigint").insert(t.frontier)
    for _ in range(2):  # two sessions, each of which opens what the one before has left
        s = Store(t.spark, root, f"{FRONTIER}, doc_id bigint")
        s.transact(lambda s: frontier.dequeue(s.read(), 100).withColumn("status", F.lit("processing")))
        bad = C("doc_id") % 4 == 0
        s.merge(s.read().filter("status = 'processing'").select("url_hash", F.when(bad, "failed").otherwise("completed").alias("status"), F.when(~bad, 10).cast("long").alias("token_count")), ["status", "token_count"])
    s = Store(t.spark, root, f"{FRONTIER}, doc_id bigint")
    s.insert(frontier.new_rows(t.pages.select("url", F.lit("pages").alias("source")), t.as_of))
    return s.read().select("url_hash", "source", "status", "token_count")
