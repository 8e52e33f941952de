"""What several operators share: scratch tables, batch slices, balanced keys."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a Python step holds as Python objects at once.
SLICE_BYTES = 2 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and spark.sparkContext.master.startswith("local["):
        # a single process, as in tests: driver and executors are one
        base = getattr(spark.sparkContext, "_tejido_scratch", None) or tempfile.mkdtemp(prefix="tejido-")
        spark.sparkContext._tejido_scratch = base
    if not base:
        raise ValueError("spark.checkpoint.dir is not set; tables between steps need a folder that driver and executors share")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_dir(spark)}/tejido-{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame, kind: str = "cut") -> DataFrame:
    """Write df to the shared scratch folder and read it back: its lineage ends there, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tejido_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete a table written by cut() that no later step reads."""
    delete(df.sparkSession, df._tejido_path)


def release(spark: SparkSession) -> None:
    """Shuffle files that no table needs any more go now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """path with the scheme and host that Spark's writers take for it, so that tasks which open it themselves find the same place."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def fresh(name: str, columns: list[str]) -> str:
    """name, or name with underscores before it, such that no column is called so (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_keys(spark: SparkSession, n: int) -> list[int]:
    """n integers that repartition(n, key) sends to n different partitions, so that n groups load n tasks evenly."""
    from pyspark.sql import functions as F

    first = spark.range(n * 40).groupBy(F.expr(f"pmod(hash(int(id)), {n})").alias("p")).agg(F.min("id").alias("k"))
    found = {r.p: int(r.k) for r in first.collect()}  # at most n rows
    spare = iter(range(n * 40, n * 41))
    return [found[p] if p in found else next(spare) for p in range(n)]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy pieces of batch whose values in column hold about `most` bytes, one row at least."""
    if batch.num_rows == 0:
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class IntTable:
    """Exact hash table from int64 keys (>= 0) to int32 values in numpy: open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4 - 1).bit_length()) if len(keys) else 4
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        todo_k, todo_v = np.asarray(keys, np.int64), np.asarray(values, np.int32)
        at = self._slot(todo_k)
        while len(todo_k):
            free = self.keys[at] == -1
            _, first = np.unique(at, return_index=True)
            win = np.zeros(len(at), bool)
            win[first] = True
            win &= free
            self.keys[at[win]] = todo_k[win]
            self.values[at[win]] = todo_v[win]
            todo_k, todo_v, at = todo_k[~win], todo_v[~win], (at[~win] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], np.int32(-1))
        miss = np.flatnonzero((found != keys) & (found != -1))
        at = at[miss]
        while len(miss):
            at = (at + 1) & self.mask
            want, found = keys[miss], self.keys[at]
            hit = found == want
            out[miss[hit]] = self.values[at[hit]]
            more = ~hit & (found != -1)
            miss, at = miss[more], at[more]
        return out
