"""Connected components of a table of links, by turns of large and small stars.

Every round maps links to links: a node's larger neighbours are tied to the least node that it knows, then every node's
smaller neighbours to the least of those. It ends when the links are stars around the least node of each component.
A node's links are never gathered in one place: minima are summed in each task before a shuffle, and the
joins that bring them back are salted by the other end of the link.

Before the first round, the files of links, which a hash has dealt, are read in parts of a bounded size, and each part is reduced to a
forest of stars; where many links tie the same nodes together, most of them go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import cut, drop_cut

#: Links that one task reduces to a forest before the rounds, about, and the least number of such tasks.
FOREST, TASKS = 500_000, 4
#: Parts into which the links of one node are dealt in joins.
SALT = 16


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first())


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of i and j, pair by pair; root holds each one's tree, the least member, before and after."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends = [(b.column("big").to_numpy(zero_copy_only=False), b.column("small").to_numpy(zero_copy_only=False)) for b in batches]
    if not ends:
        return
    big, small = (np.concatenate(x) for x in zip(*ends, strict=True))
    ids, places = np.unique(np.concatenate([big, small]), return_inverse=True)
    root = np.arange(len(ids))
    unite(root, places[: len(big)], places[len(big) :])
    tied = np.flatnonzero(root != np.arange(len(ids)))
    yield pa.RecordBatch.from_arrays([pa.array(ids[tied], pa.int64()), pa.array(ids[root[tied]], pa.int64())], ["big", "small"])


def _lowest(links: DataFrame, keys: DataFrame) -> DataFrame:
    """links (node, other) with `low`, the value of keys (node, low); null where node has none."""
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return links.withColumn("salt", F.pmod(F.hash("other"), F.lit(SALT))).join(salted, ["node", "salt"], "left").drop("salt")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (bigint): every node that has a link to another, with the least node reachable.

    Links may be in either direction, repeated, or from a node to itself; those with a null end are passed over. No links: no rows.
    """
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    ends = links.select(F.greatest(a, b).cast("long").alias("big"), F.least(a, b).cast("long").alias("small"))
    given = cut(ends.filter("big > small").distinct(), "links")
    parts = max(TASKS, math.ceil(given.count() / FOREST))
    now = cut(given.coalesce(parts).mapInArrow(_forest, "big bigint, small bigint").distinct(), "links")
    drop_cut(given)
    mark = _mark(now)
    while mark[0]:
        # large star: of a node that has a smaller neighbour, the larger ones are tied to the smallest; others already are
        low = now.groupBy(F.col("big").alias("node")).agg(F.min("small").alias("low"))
        tied = _lowest(now.select(F.col("small").alias("node"), F.col("big").alias("other")), low)
        large = tied.select(F.col("other").alias("big"), F.coalesce("low", "node").alias("small")).distinct()
        # small star: a node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy(F.col("big").alias("node")).agg(F.min("small").alias("low"))
        joined = _lowest(large.select(F.col("big").alias("node"), F.col("small").alias("other")), low)
        after = joined.select(F.explode(F.array(F.struct(F.col("other").alias("big"), F.col("low").alias("small")), F.struct(F.col("node").alias("big"), F.col("low").alias("small")))).alias("x")).select("x.*").filter("big > small").distinct()
        after = cut(after, "links")
        drop_cut(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return now.select(F.col("big").alias("node"), F.col("small").alias("component")).union(now.select(F.col("small").alias("node"), F.col("small").alias("component"))).distinct()
