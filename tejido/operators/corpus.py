"""Corpus assembly: admission, hash dedup, statistics, and the text, snapshot and record sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .frontier import first_of

#: Files that one folder holds at most.
FOLDER_CAP = 10_000


def admitted(docs: DataFrame, column: str = "text") -> DataFrame:
    """docs with clean_text and reject_reason: refused are binary texts, and those of under 20 characters after cleaning."""
    found = text.quality(F.col(column))
    rows = docs.withColumn("found_", found).withColumn("clean_text", text.clean(F.col(column)))
    reason = F.when(~F.col("found_.is_valid") & F.col("found_.is_binary"), "binary").when(F.length("clean_text") < 20, "too_short")
    return rows.withColumn("reject_reason", reason).drop("found_")


def unseen(docs: DataFrame, saved: DataFrame, key: str = "content_hash", order: str = "doc_id") -> DataFrame:
    """One row for each content key, the first, unless it has been saved."""
    return first_of(docs, [key], F.col(order)).join(saved.select(key).distinct(), key, "left_anti")


def flagged(docs: DataFrame, saved: DataFrame, key: str = "content_hash") -> DataFrame:
    """docs with duplicate: whether its key has been saved."""
    marks = saved.select(key).distinct().withColumn("duplicate", F.lit(True))
    return docs.join(marks, key, "left").withColumn("duplicate", F.coalesce("duplicate", F.lit(False)))


def statistics(files: DataFrame, target: int) -> DataFrame:
    """Rows for each source, each domain, and the whole: files, bytes, tokens, megabytes, progress."""
    sets = files.groupingSets([["source"], ["domain"], []], "source", "domain").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.grouping_id().alias("g_"),
    )
    level = F.when(F.col("g_") == 1, "source").when(F.col("g_") == 2, "domain").otherwise("total")
    return sets.select(level.alias("level"), "source", "domain", "files", "bytes", "tokens", F.round(F.col("bytes") / 1048576, 6).alias("size_mb"), F.round(F.col("tokens") / F.lit(target) * 100, 6).alias("progress"))


def folder_number(rank: Column, cap: int = FOLDER_CAP) -> Column:
    """The folder of the rank-th file (from 1) where each takes `cap` of them."""
    return F.floor((rank - 1) / cap)


def write_texts(docs: DataFrame, folder: str) -> None:
    """Texts by source and domain, with key and file name beside them; the commit protocol makes the write atomic."""
    docs.select("source", "domain", "content_hash", "file_name", "text").write.partitionBy("source", "domain").option("maxRecordsPerFile", FOLDER_CAP).mode("append").parquet(folder)


def read_texts(spark, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def write_snapshots(pages: DataFrame, folder: str) -> None:
    """Raw pages by content key, gzip."""
    pages.select("content_hash", "url", "source", "html").write.option("compression", "gzip").mode("append").parquet(folder)


def snapshot_record(url: Column, source: Column, key: Column, saved_at: Column, html: Column) -> Column:
    return F.to_json(F.struct(url.alias("url"), source.alias("source"), key.alias("content_hash"), F.date_format(saved_at, "yyyy-MM-dd'T'HH:mm:ss").alias("saved_at"), F.length(html).alias("html_size"), F.lit(True).alias("compressed")))


def content_links(texts: DataFrame, snapshots: DataFrame, linked_at: Column) -> DataFrame:
    """Content and snapshot of one key."""
    return texts.select("content_hash", F.col("file_name").alias("content_file")).join(snapshots.select("content_hash", "snapshot_file"), "content_hash").withColumn("linked_at", linked_at)


def write_metric(spark, folder: str, rows: DataFrame) -> None:
    rows.write.mode("append").parquet(folder)
