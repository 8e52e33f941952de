"""Folders for tables between steps, which driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder in spark.checkpoint.dir. Only where that is unset and Spark is one process, as in tests, a local one, which goes with the process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and spark.sparkContext.master.partition("[")[0] == "local":
        base = getattr(spark.sparkContext, "_tejido_tables", None)
        if not base:
            base = spark.sparkContext._tejido_tables = tempfile.mkdtemp(prefix="tejido-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set; tables between steps need a folder that driver and executors share")
    return f"{base.rstrip('/')}/tejido-{kind}-{uuid.uuid4().hex}"


def keeper(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """A function that writes a table between steps and reads it back, which ends its lineage."""

    def put(df: DataFrame) -> DataFrame:
        to = scratch(spark, "round")
        df.write.parquet(to)
        out = spark.read.schema(df.schema).parquet(to)
        out._tejido_path = to
        return out

    return put


def forget(df: DataFrame) -> None:
    """Delete a table that keeper() wrote and that no later step reads."""
    path = getattr(df, "_tejido_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
