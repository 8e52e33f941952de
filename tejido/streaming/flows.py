"""Incremental work: micro-batches over the frontier, recursive growth, stateful dedup, rolling counts, running totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import frontier as O


def run_stream(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything that has landed, in micro-batches, until there is no more; the checkpoint lets a lost run go on."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def batch_sink(folder: str, rows: Callable[[DataFrame], DataFrame] = lambda df: df, keys: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A sink of rows(batch), each batch in a folder of its own (batch=n): a batch that comes again after a failure takes its own place.
    With keys, rows whose keys an earlier batch has written are left out, so that what is delivered twice is kept once."""

    def put(batch: DataFrame, n: int) -> None:
        spark, new = batch.sparkSession, rows(batch)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if keys and path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            before = spark.read.schema(T.StructType([*new.schema.fields, T.StructField("batch", T.LongType())])).parquet(folder)
            new = new.join(before.filter(F.col("batch") < n).select(*keys), keys, "left_anti")
        new.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return put


def rolling_counts(events: DataFrame, stamp: str, span: str, *keys: str) -> DataFrame:
    """Events by key in tumbling windows."""
    return events.groupBy(F.window(stamp, span), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sliding_counts(events: DataFrame, stamp: str, span: str, step: str, late: str, *keys: str) -> DataFrame:
    """Rows by key in windows of `span` that begin every `step`; as a stream, a window is given out once, when no row of it can come any more: rows may
    be `late` behind the newest. Later ones are dropped; run_counted() tells how many."""
    return events.withWatermark(stamp, late).groupBy(F.window(stamp, span, step), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def run_counted(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> dict[str, int]:
    """As run_stream(); how many rows came (`rows`), and how many of the windows' rows were too late (`late`), one for each window that they belong to."""
    query = stream.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    told = query.recentProgress
    return {"rows": sum(p.numInputRows for p in told), "late": sum(s.numRowsDroppedByWatermark for p in told for s in p.stateOperators)}


def trailing_counts(events: DataFrame, stamp: str, as_of: Column, spans: dict[str, str], *keys: str) -> DataFrame:
    """Events by key in the spans (name: interval) that end at as_of."""
    return events.groupBy(*keys).agg(*[F.count_if(F.col(stamp) > as_of - F.expr(span)).alias(name) for name, span in spans.items()])


def first_seen(stream: DataFrame, stamp: str, horizon: str, *keys: str) -> DataFrame:
    """Rows whose keys have not come within the horizon; state older than that is dropped."""
    return stream.withWatermark(stamp, horizon).dropDuplicatesWithinWatermark(list(keys))


def fresh(entries: DataFrame, stamp: str, cutoff: Column) -> DataFrame:
    """Entries since the cutoff; those without a date are let in."""
    return entries.filter(F.col(stamp).isNull() | (F.col(stamp) >= cutoff))


def alerts(hourly: DataFrame, least_tokens: int = 1_000_000, most_errors: float = 0.3) -> DataFrame:
    """Hours (tokens, errors, n) with too few tokens or too many errors."""
    return hourly.withColumn("low_yield", F.col("tokens") < least_tokens).withColumn("error_rate_high", F.coalesce(F.try_divide(F.col("errors"), F.col("n")), F.lit(0.0)) > most_errors).filter("low_yield or error_rate_high")


def reachable(spark: SparkSession, seeds: DataFrame, edges: DataFrame, most: int, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node and depth of what is reached from seeds (node) over edges (parent, child) in at most `most` steps, each node once.

    Every round joins the newest nodes only, against what has been visited, and writes no others; keep() materialises a round's nodes, and what has been
    visited is all rounds' tables.
    """
    visited = newest = keep(seeds.distinct().withColumn("depth", F.lit(0)))
    for depth in range(1, most + 1):
        step = newest.join(edges, newest.node == edges.parent).select(F.col("child").alias("node")).distinct()
        newest = keep(step.join(visited, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if newest.isEmpty():
            break
        visited = visited.unionByName(newest)
    return visited


def work(frontier: DataFrame, process: Callable[[DataFrame], DataFrame], batch: int, rounds: int, as_of: Column, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The frontier after so many rounds of: take the best pending rows, process them, merge status and tokens. It ends early
    when none is pending."""
    for _ in range(rounds):
        taken = keep(O.dequeue(frontier, batch))
        if taken.isEmpty():
            break
        frontier = keep(O.update(O.mark(frontier, taken, "processing", as_of), process(taken), ["status", "token_count"]))
    return frontier
