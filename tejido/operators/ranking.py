"""Ranks and running sums within a key that may hold a large share of all rows.

Rows are cut into strides of a whole-number order column. Sums over strides are made in each task before the shuffle; a window over one row
a stride carries them forward, another one over the rows of one stride does the rest. No task holds a whole key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Values of the order column that one stride spans.
STRIDE = 1 << 16


def running(rows: DataFrame, key: str, order: str, value: Column, into: str, stride: int = STRIDE) -> DataFrame:
    """rows with `into`: the sum of value over the key's rows up to this one in the order of `order`, a whole-number column without
    repeats within a key. A null key is a key; rows with a null order come first, together."""
    marked = rows.withColumn("stride_", F.coalesce(F.floor(F.col(order) / stride), F.lit(-(2**62)))).withColumn("value_", value)
    sums = marked.groupBy(F.col(key).alias("key_"), F.col("stride_").alias("s_")).agg(F.sum("value_").alias("sum_"))
    before = F.sum("sum_").over(Window.partitionBy("key_").orderBy("s_").rowsBetween(Window.unboundedPreceding, -1))
    carried = sums.select("key_", "s_", F.coalesce(before, F.lit(0)).alias("before_"))
    within = F.sum("value_").over(Window.partitionBy(key, "stride_").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    joined = marked.withColumn("within_", within).join(carried, F.col(key).eqNullSafe(F.col("key_")) & (F.col("stride_") == F.col("s_")))
    return joined.withColumn(into, F.col("before_") + F.col("within_")).select(*rows.columns, into)


def rank(rows: DataFrame, key: str, order: str, into: str, stride: int = STRIDE) -> DataFrame:
    """rows with `into`: 1 for a key's first row in the order of `order`, and so on."""
    return running(rows, key, order, F.lit(1).cast("long"), into, stride)


def placed(rows: DataFrame, order: list[Column], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows with part_ and place_: rows in the order given, in ranges of which each is a part, and their numbers within. keep() materialises them, so
    that all later steps see the same ranges. Equal rows are in any order."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at_", F.monotonically_increasing_id())  # the part's number, and 33 bits of the row's
    return keep(ranged.withColumn("part_", F.shiftright("at_", 33)).withColumn("place_", F.col("at_").bitwiseAND((1 << 33) - 1)).drop("at_"))


def rank_whole(rows: DataFrame, order: list[Column], into: str, keep: Callable[[DataFrame], DataFrame], keys: list[str] = ()) -> DataFrame:
    """rows with `into`: 1 for the first row in the order given, and so on; with keys, within each one, null keys too. No range is one task's alone, and
    a key may have any share of the rows: what goes before a range is a sum over ranges, what goes before a key the least rank of its rows."""
    whole = placed(rows, [*map(F.col, keys), *order], keep)
    sizes = whole.groupBy("part_").agg(F.count("*").alias("n_"))  # a row a range
    before = sizes.select(F.col("part_").alias("p_"), F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_"))
    ranked = whole.join(F.broadcast(before), F.col("part_") == F.col("p_")).withColumn(into, F.col("before_") + F.col("place_") + 1).select(*rows.columns, into)
    if not keys:
        return ranked
    firsts = ranked.groupBy(*[F.col(k).alias(f"key{n}_") for n, k in enumerate(keys)]).agg(F.min(into).alias("first_"))
    same = [F.col(k).eqNullSafe(F.col(f"key{n}_")) for n, k in enumerate(keys)]
    return ranked.join(firsts, same).withColumn(into, F.col(into) - F.col("first_") + 1).select(*rows.columns, into)


def previous(rows: DataFrame, keys: list[str], order: list[Column], value: Column, into: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows with `into`: the value of the row before in the order given, within the keys; null for a key's first row, or where that value is. Rows of a key are dealt by
    range; a range's first row gets what the last range of the key before it ends with."""
    whole = placed(rows.withColumn("value_", value), [*map(F.col, keys), *order], keep)
    within = F.lag(F.struct("value_")).over(Window.partitionBy("part_", *keys).orderBy("place_"))
    ends = whole.groupBy("part_", *keys).agg(F.max_by(F.struct("value_"), "place_").alias("end_"))  # a row a range and key
    ahead = ends.select(F.col("part_").alias("p_"), *[F.col(k).alias(f"key{n}_") for n, k in enumerate(keys)], F.lag("end_").over(Window.partitionBy(*keys).orderBy("part_")).alias("carried_")).filter("carried_ is not null")
    same = [F.col("part_") == F.col("p_"), F.col("first_"), *[F.col(k).eqNullSafe(F.col(f"key{n}_")) for n, k in enumerate(keys)]]
    marked = whole.withColumn("within_", within).withColumn("first_", F.col("within_").isNull())
    return marked.join(ahead, same, "left").withColumn(into, F.coalesce("within_", "carried_")["value_"]).select(*rows.columns, into)
