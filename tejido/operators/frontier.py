"""The crawl frontier: insertion, dequeue, status updates, progress, yield, retention; all on DataFrames of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..schemas import TARGET_TOKENS


def new_rows(found: DataFrame, as_of: Column, discovered_from: str | None = None) -> DataFrame:
    """Frontier rows of (url, source): key, priority, method and type of content; pending."""
    return found.select(
        text.url_key(F.col("url")).alias("url_hash"), "url", "source", F.lit("pending").alias("status"), as_of.alias("created_at"), as_of.alias("updated_at"),
        urls.priority(F.col("url")).alias("priority_score"), (F.lit(discovered_from) if discovered_from else urls.discovery_method(F.col("source"))).alias("discovered_from"),
        urls.content_type(F.col("source")).alias("content_type"), F.lit(0).cast("long").alias("token_count"), F.lit(0).alias("retry_count"),
    )


def first_of(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key, the least in the order given. Rows are reduced in each task before the shuffle, so a key with many of them
    is no burden."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    best = F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)]))
    return rows.groupBy(*keys).agg(best.alias("best_")).select(*keys, "best_.*").select(rows.columns)


def absent(new: DataFrame, frontier: DataFrame, key: str = "url_hash") -> DataFrame:
    """Rows of new whose key the frontier lacks, one a key."""
    return first_of(new, [key], -F.col("priority_score"), F.col("source")).join(frontier.select(key), key, "left_anti")


def insert_if_absent(frontier: DataFrame, new: DataFrame) -> DataFrame:
    return frontier.unionByName(absent(new, frontier), allowMissingColumns=True)


def dequeue(frontier: DataFrame, k: int, least: float = 0.0) -> DataFrame:
    """The k pending rows of the highest priority, earlier ones first; a top-k, not a sort of the whole."""
    return frontier.filter((F.col("status") == "pending") & (F.col("priority_score") >= least)).orderBy(F.col("priority_score").desc(), F.col("created_at"), F.col("url_hash")).limit(k)


def mark(frontier: DataFrame, batch: DataFrame, status: str, as_of: Column) -> DataFrame:
    """The frontier with the batch's rows in another status; the batch is as small as its limit."""
    taken = F.broadcast(batch.select("url_hash", F.lit(True).alias("taken_")))
    return frontier.join(taken, "url_hash", "left").withColumn("status", F.when(F.col("taken_"), F.lit(status)).otherwise(F.col("status"))).withColumn("updated_at", F.when(F.col("taken_"), as_of).otherwise(F.col("updated_at"))).drop("taken_").select(frontier.columns)


def update(frontier: DataFrame, changes: DataFrame, columns: list[str]) -> DataFrame:
    """Merge by key: where a change has a value it replaces the row's; `set_<column>`, if there is such a flag, lets a null replace one too."""
    flags = {c: f"set_{c}" for c in columns if f"set_{c}" in changes.columns}
    renamed = changes.select("url_hash", *[F.col(c).alias(f"new_{c}") for c in columns], *flags.values(), F.lit(True).alias("hit_"))
    joined = frontier.join(renamed, "url_hash", "left")
    for c in columns:
        given = F.col(flags[c]) if c in flags else F.col(f"new_{c}").isNotNull()
        joined = joined.withColumn(c, F.when(F.col("hit_") & given, F.col(f"new_{c}")).otherwise(F.col(c)))
    return joined.select(frontier.columns)


def failed(status: Column) -> Column:
    return status.startswith("failed")


def progress(frontier: DataFrame) -> DataFrame:
    """One row: counts by status, tokens, size, mean score and time."""
    n = lambda s: F.count_if(F.col("status") == s)
    return frontier.agg(
        F.count("*").alias("total"), n("pending").alias("pending"), n("processing").alias("processing"), n("completed").alias("completed"),
        F.count_if(failed(F.col("status"))).alias("failed"), n("blocked").alias("blocked"), F.sum("token_count").alias("total_tokens"),
        F.avg("token_count").alias("avg_tokens"), F.sum("content_size").alias("total_size"), F.avg("mexican_score").alias("avg_score"), F.avg("processing_time_ms").alias("avg_ms"),
    )


def progress_report(frontier: DataFrame) -> DataFrame:
    """Success rate, progress towards the target, megabytes, rounded."""
    p = progress(frontier)
    return p.select(
        "total", "completed", F.round(F.coalesce(F.try_divide(F.col("completed"), F.col("total")), F.lit(0.0)) * 100, 1).alias("success_rate"), F.coalesce("total_tokens", F.lit(0)).alias("total_tokens"),
        F.round(F.coalesce("total_tokens", F.lit(0)) / F.lit(TARGET_TOKENS) * 100, 6).alias("progress_percentage"), F.round(F.coalesce("total_size", F.lit(0)) / 1048576, 2).alias("size_mb"),
        F.round(F.coalesce("avg_tokens", F.lit(0.0)), 1).alias("avg_tokens"),
    )


def by_source(frontier: DataFrame) -> DataFrame:
    grouped = frontier.groupBy("source").agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(failed(F.col("status"))).alias("failed"),
        F.sum("token_count").alias("tokens"), F.avg("token_count").alias("avg_tokens"), F.avg("mexican_score").alias("avg_score"), F.avg("priority_score").alias("avg_priority"),
    )
    return grouped.withColumn("success_rate", F.round(F.col("completed") / F.col("total") * 100, 1))


def source_stats(frontier: DataFrame, as_of: Column) -> DataFrame:
    return frontier.groupBy(F.col("source").alias("source_name")).agg(
        F.lit(None).cast("timestamp").alias("unused_"), F.count("*").alias("total_urls"), F.count_if(F.col("status") == "completed").alias("completed_urls"),
        F.count_if(failed(F.col("status"))).alias("failed_urls"), F.sum("token_count").alias("total_tokens"), F.avg("mexican_score").alias("avg_mexican_score"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"), (F.count_if(F.col("status") == "completed") / F.count("*") * 100).alias("success_rate"),
    ).drop("unused_").withColumn("last_updated", as_of)


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """changes over table by key."""
    return table.join(changes.select(key), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def domain_yield(frontier: DataFrame, least: int = 5, k: int = 20) -> DataFrame:
    """Hosts with `least` URLs or more, those with the most tokens first."""
    grouped = frontier.filter(F.col("url").startswith("http")).groupBy(urls.host_by_split(F.col("url")).alias("domain")).agg(
        F.count("*").alias("total_urls"), F.count_if(F.col("status") == "completed").alias("completed_urls"), F.sum("token_count").alias("total_tokens"), F.avg("token_count").alias("avg_tokens_per_url"),
    )
    return grouped.filter(F.col("total_urls") >= least).withColumn("yield_efficiency", F.round(F.col("total_tokens") / F.col("total_urls"), 1)).withColumn("avg_tokens_per_url", F.round("avg_tokens_per_url", 1)).orderBy(F.col("total_tokens").desc(), "domain").limit(k)


def throughput(frontier: DataFrame, as_of: Column) -> DataFrame:
    done = lambda span: F.count_if((F.col("status") == "completed") & (F.col("created_at") > as_of - F.expr(f"INTERVAL {span}")))
    return frontier.agg(F.avg(F.when(F.col("token_count") > 0, F.col("token_count"))).alias("tokens_per_success"), done("1 HOUR").alias("recent_successes"), done("1 DAY").alias("daily_successes"))


def retained(rows: DataFrame, as_of: Column, days: int, stamp: str, only: Column | None = None) -> DataFrame:
    """Rows that are younger than so many days, or not subject to the rule."""
    old = F.col(stamp) < as_of - F.make_interval(days=F.lit(days))
    return rows.filter(~F.coalesce(old & only if only is not None else old, F.lit(False)))


def released(frontier: DataFrame, as_of: Column, lease: str = "1 HOUR") -> DataFrame:
    """Rows that have been processing for longer than the lease are pending again."""
    stuck = (F.col("status") == "processing") & (F.col("updated_at") < as_of - F.expr(f"INTERVAL {lease}"))
    return frontier.withColumn("retry_count", F.when(stuck, F.col("retry_count") + 1).otherwise(F.col("retry_count"))).withColumn("status", F.when(stuck, "pending").otherwise(F.col("status")))


def session_totals(results: DataFrame, seconds: float) -> DataFrame:
    """processed, successful, tokens, size, errors, and rates of result rows (status, token_count, content_size, error_message)."""
    ok = F.col("status") == "completed"
    return results.agg(
        F.count("*").alias("processed"), F.count_if(ok).alias("successful"), F.coalesce(F.sum(F.when(ok, F.col("token_count"))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(ok, F.col("content_size"))), F.lit(0)).alias("size"), F.count_if(~ok).alias("errors"),
    ).withColumn("urls_per_second", F.round(F.col("processed") / F.lit(seconds), 6)).withColumn("tokens_per_second", F.round(F.col("tokens") / F.lit(seconds), 6)).withColumn("success_rate", F.round(F.coalesce(F.try_divide(F.col("successful"), F.col("processed")), F.lit(0.0)) * 100, 6))


def session_by_source(results: DataFrame) -> DataFrame:
    ok = F.col("status") == "completed"
    return results.groupBy("source").agg(F.count("*").alias("processed"), F.count_if(ok).alias("successful"), F.coalesce(F.sum(F.when(ok, F.col("token_count"))), F.lit(0)).alias("tokens"))
