"""Mixing sources to target weights by Pfair scheduling (operator 6).

A source of weight w owes its i-th block no earlier than slot floor((i-1)/w) and before slot ceil(i/w); taking, in each
slot, the released block with the earliest deadline keeps every source within less than one block of w times the number of
slots at any time. Weights are taken as the fractions that they are, over the whole stream.

Slots are planned in chunks by tasks. Before slot t, a source of weight w has had the whole part of w t blocks, or one more; which sources have had
one more at the border of two chunks is all that one chunk must know of the others. At a border, a block that may be one more is taken
in the order of deadlines, as long as every last stretch of slots before the border has room for all blocks that are released within it and must come
before the border. How much room there is follows from the border and the weights alone, and is summed up by tasks; the driver
takes the blocks border by border, a step a source and border. Taking them by deadlines, subject to room, leaves as few as can be for every later
deadline (the room of nested stretches is a matroid, for which the greedy choice is best for all deadlines at once), so by Hall's theorem
for intervals there is a schedule from each border to the next within all releases and deadlines, and the earliest deadline first finds it. No
table is sorted as a whole, no source is gathered in one task, and the driver holds a bounded number of borders and sources (BORDERS).
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import cut, shuffle_width, spread_keys

#: Documents of a block.
BLOCK = 16
#: Natural shares are raised to this power where no weights are given: rare sources gain.
POWER = 0.9
#: Documents that are ranked together.
BUCKET = 4096
#: Slots of a chunk at least, and values (a source at a border) that the driver looks at, about; chunks grow beyond.
CHUNK, BORDERS = 1 << 16, 1 << 22
#: Sources up to which the table of sources is sent to every task.
SENT = 1 << 14
#: Tasks that plan, at most; beyond, each plans several chunks.
MOST_TASKS = 10_000


def exact_shares(weights: dict[str | None, float]) -> tuple[dict[str | None, int], int]:
    """The weights, as the decimals that they are written as, in whole shares of a period; it may be far longer than any stream."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    exact = {s: Fraction(repr(float(w))) for s, w in weights.items()}
    unit = math.lcm(*(w.denominator for w in exact.values()))
    share = {s: int(w * unit) for s, w in exact.items()}
    both = math.gcd(*share.values())
    share = {s: v // both for s, v in share.items()}
    return share, sum(share.values())


def by_name(share: dict[str | None, int]) -> list[str | None]:
    """The sources, the null one first."""
    return sorted(share, key=lambda s: (s is not None, s or ""))


def room(parts: list[int], period: int, start: int, stop: int) -> tuple[list[int], list[int], list[int]]:
    """At the border stop, for the chunk from start: the sources that may have had one more block than the whole part of their due, by deadline; for each
    the number of the last of the stretches before the border that must have room for it (-1: released before start); and the room of those
    stretches, the longest first."""
    whole = [p * stop // period for p in parts]
    some = [k for k, p in enumerate(parts) if p * stop % period]
    must = np.zeros(stop - start, np.int64)
    for k, p in enumerate(parts):
        first = -(-p * start // period)
        if first < whole[k]:
            np.add.at(must, np.array([i * period // p - start for i in range(first, whole[k])], np.int64), 1)
    free = np.arange(stop - start, 0, -1) - np.cumsum(must[::-1])[::-1]  # of the stretch from each slot on
    release = {k: whole[k] * period // parts[k] - start for k in some}
    marks = sorted({r for r in release.values() if r >= 0})
    edges = [0, *(r + 1 for r in marks)]
    bounds = [int(free[a:b].min()) for a, b in zip(edges, edges[1:], strict=False)]
    order = sorted(some, key=lambda k: (-(-(whole[k] + 1) * period // parts[k]), k))
    number = {r: j for j, r in enumerate(marks)}
    return order, [number.get(release[k], -1) for k in order], bounds


def border(parts: list[int], period: int, stop: int, before: list[int], order: list[int], stretch: list[int], bounds: list[int]) -> list[int]:
    """Blocks that each source has had before the border stop, from those before the border that precedes it and what room() says."""
    had = [p * stop // period for p in parts]
    lacking = stop - sum(had)
    done = [k for k in order if before[k] > had[k]]  # had already, and due after the border
    for k in done:
        had[k] += 1
    lacking -= len(done)
    left, done = np.array(bounds, np.int64), set(done)
    for k, j in zip(order, stretch, strict=True):
        if not lacking:
            break
        if k not in done and (left[: j + 1] > 0).all():
            left[: j + 1] -= 1
            had[k] += 1
            lacking -= 1
    assert not lacking
    return had


def slots(parts: list[int], period: int, start: int, stop: int, had: list[int], last: list[int]) -> Iterator[tuple[int, int]]:
    """(k, i) of the slots from start to stop, from what each source has had before start to what it has had before stop: the released block with the
    earliest deadline; ties by number."""
    coming = [(i * period // parts[k], k, i) for k, i in enumerate(had) if i < last[k]]
    heapq.heapify(coming)
    ready: list[tuple[int, int, int]] = []
    for slot in range(start, stop):
        while coming and coming[0][0] <= slot:
            _, k, i = heapq.heappop(coming)
            heapq.heappush(ready, (min(stop, -(-((i + 1) * period) // parts[k])), k, i))
        due, k, i = heapq.heappop(ready)
        assert slot < due
        yield k, i
        if i + 1 < last[k]:
            heapq.heappush(coming, ((i + 1) * period // parts[k], k, i + 1))


def planned(spark: SparkSession, share: dict[str | None, int], period: int, blocks: list[int]) -> tuple[DataFrame, list[int]]:
    """k, number, slot of all blocks until each source k has been seen whole, as a table in the scratch folder, and the blocks of each source."""
    parts = [share[s] for s in by_name(share)]
    latest = max(-(-b * period // p) for b, p in zip(blocks, parts, strict=True))
    size = max(CHUNK, -(-latest * len(parts) // BORDERS))
    chunks = -(-latest // size)
    numbers = spark.range(0, chunks, 1, min(chunks, MOST_TASKS))

    def rooms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([c]), *(pa.array([v], pa.list_(pa.int64())) for v in room(parts, period, c * size, (c + 1) * size))], ["id", "order", "stretch", "bounds"])

    had, states = [0] * len(parts), []
    for row in sorted(numbers.mapInArrow(rooms, "id bigint, order array<bigint>, stretch array<bigint>, bounds array<bigint>").collect()):  # BORDERS values of each, about
        last = border(parts, period, (row.id + 1) * size, had, row.order, row.stretch, row.bounds)
        states.append((row.id, _more(parts, period, row.id * size, had), _more(parts, period, (row.id + 1) * size, last)))
        had = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, had, last in zip(*(batch.column(x).to_pylist() for x in ("id", "had", "last")), strict=True):
                start, stop = c * size, (c + 1) * size
                each = slots(parts, period, start, stop, _blocks(parts, period, start, had), _blocks(parts, period, stop, last))
                for at in range(start, stop, CHUNK):
                    k, i = zip(*itertools.islice(each, CHUNK), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int64()), pa.array(range(at, at + len(k)), pa.int64())], ["k", "number", "slot"])

    given = spark.createDataFrame(states, "id bigint, had binary, last binary").repartition(min(chunks, MOST_TASKS), "id")
    whole = cut(given.mapInArrow(run, "k int, number bigint, slot bigint"), "plan")
    ends = _small(spark.createDataFrame(list(enumerate(blocks)), "k int, blocks bigint"), len(blocks))
    end = whole.join(ends, "k").filter(F.col("number") == F.col("blocks") - 1).agg(F.max("slot")).first()[0] + 1
    plan = whole.filter(F.col("slot") < end)
    seen = {r.k: r.n for r in plan.groupBy("k").agg(F.max("number").alias("n")).collect()}  # a row a source
    return plan, [seen[k] + 1 for k in range(len(blocks))]


def _more(parts: list[int], period: int, slot: int, had: list[int]) -> bytes:
    """A bit for each source that has had one block more than the whole part of its due."""
    return np.packbits([h > p * slot // period for h, p in zip(had, parts, strict=True)]).tobytes()


def _blocks(parts: list[int], period: int, slot: int, more: bytes) -> list[int]:
    return [p * slot // period + int(m) for p, m in zip(parts, np.unpackbits(np.frombuffer(more, np.uint8), count=len(parts)), strict=True)]


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, source, block, epoch, slot, place: where each document stands in the mixed stream.

    A source's documents are put into blocks of `block` in the order of a hash of doc_id; slot is the block's slot in the stream,
    place the document's within its block. The stream ends with the slot in which the last source has been seen
    whole, so no document is left out; sources that are through before begin anew (epoch 1 and on). Over any first t slots, a
    source of weight w (as a part of all weights) has within less than one block of w t. Without weights, a source's weight is its number of
    documents to the power POWER. A weight for a source that has no documents is passed over; a source with documents and no weight is an error.
    Null sources are one source. Repeated rows, and ties of the hash, are ranked in any order. No rows give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    sizes = {r.source: r.n for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}  # a row a source
    schema = "doc_id bigint, source string, block bigint, epoch bigint, slot bigint, place int"
    if not sizes:
        return spark.createDataFrame([], schema)
    if weights is None:
        weights = {s: float(n) ** POWER for s, n in sizes.items()}
    if lacking := [s for s in sizes if s not in weights]:
        raise ValueError(f"no weight for {lacking[:5]}")
    share, period = exact_shares({s: weights[s] for s in sizes})
    names = by_name(share)
    blocks = [-(-sizes[s] // block) for s in names]
    plan, given = planned(spark, share, period, blocks)
    table = spark.createDataFrame([(k, s, blocks[k], given[k], max(1, -(-sizes[s] // BUCKET))) for k, s in enumerate(names)], "k int, of string, blocks bigint, given bigint, parts int")
    known = rows.join(_small(table, len(names)), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    hashed = known.withColumn("hash", F.xxhash64(F.col("doc_id"), F.lit(17)))
    # a rank within a source: ranks within parts of the hash's range, plus the rows of all parts before
    within = hashed.withColumn("part", F.floor((F.shiftrightunsigned("hash", 33)) * F.col("parts") / F.lit(1 << 31)).cast("int"))
    counts = within.groupBy("source", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(F.col("source").alias("s"), F.col("part").alias("p"), "before")
    own = F.row_number().over(Window.partitionBy("source", "part").orderBy("hash", "doc_id")) - 1
    ranked = within.withColumn("own", own).join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    rank = F.col("before") + F.col("own")
    placed = ranked.withColumn("block", F.floor(rank / block)).withColumn("place", F.pmod(rank, F.lit(block)).cast("int"))
    last = F.floor((F.col("given") - 1 - F.col("block")) / F.col("blocks"))  # every block is given once at least
    each = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    numbered = each.withColumn("number", F.col("epoch") * F.col("blocks") + F.col("block"))
    return numbered.join(plan, ["k", "number"]).select("doc_id", "source", "block", "epoch", "slot", "place")


def _small(table: DataFrame, sources: int) -> DataFrame:
    """Sent to every task while it has at most SENT sources; a shuffle beyond."""
    return F.broadcast(table) if sources <= SENT else table


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK) -> DataFrame:
    """The documents of the mixed stream, all columns, once for each epoch in which they come, in the stream's order: partitions,
    and files that are written of them, hold successive stretches of slots, sorted.

    Rows that share doc_id and source stand in the same places, those of the first of them.
    """
    spark = docs.sparkSession
    where = cut(mix(docs, weights, block).groupBy("doc_id", "source", "epoch").agg(F.min(F.struct("slot", "place")).alias("at")), "mix")
    end = where.agg(F.max("at.slot")).first()[0]
    if end is None:
        return docs
    n = shuffle_width(spark)
    names = docs.columns
    tagged = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("of"))
    joined = tagged.join(where, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("of").eqNullSafe(F.col("source"))).select("row", "at")
    stretch = F.floor(F.col("at.slot") * n / F.lit(end + 1)).cast("int")
    keys = F.array(*[F.lit(k) for k in spread_keys(spark, n)])
    dealt = joined.withColumn("key", F.get(keys, stretch)).repartition(n, "key").sortWithinPartitions("at")
    return dealt.select(*[F.col("row").getField(c).alias(c) for c in names])
