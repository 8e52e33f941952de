"""Exact range join of embeddings by angle (operator 7).

Pivots cut the sphere into cells: a vector belongs to its nearest pivot. A vector within the join's angle of a cell's members can
lie outside that cell by no more than this angle, by the triangle inequality; so every vector is a member of its own cell,
and a candidate of the cells whose border is that near. Two vectors of different cells are near each other's cell, so it is enough that the
one of the lesser cell goes to the greater. Cells, cut into parts of a bounded size, are joined independently: a part's members
stay in memory, its candidates stream past. Cosines come from float32 products, and from double precision where the rounding
error's bound leaves a doubt.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import cut, drop_cut, spread_keys
from .components import connected_components, unite

#: Members of a part, while there are few parts; beyond PARTS parts members grow, to so many numbers, since every part has candidates of its own.
ROWS, PARTS, NUMBERS = 4096, 64, 1 << 21
#: Most pivots; their vectors go to every task.
PIVOTS = 1024
#: Candidates compared at once.
COLUMNS = 256


def doubles(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows over their norms; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells_near(u: np.ndarray, pivots: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """Own cell of each unit vector, and (vectors x cells) whether a cell's border is within angle of it."""
    sims = u @ pivots.T
    own = sims.argmax(axis=1)
    apart = np.linalg.norm(pivots[:, None] - pivots[None], axis=2) if len(pivots) <= PARTS else None
    near = np.ones(sims.shape, bool)
    edge = math.sin(angle) + 1e-9
    for i in range(len(pivots)):
        gap = apart[i].copy() if apart is not None else np.linalg.norm(pivots - pivots[i], axis=1)
        gap[gap == 0] = np.inf  # equal pivots have no border
        near[:, i] = ((sims - sims[:, i : i + 1]) / gap).max(axis=1) <= edge
    near[np.arange(len(u)), own] = True
    return own, near


def members_of_part(n: int, d: int) -> int:
    """Members of a part for n vectors of d numbers: ROWS up to PARTS parts, then more, as far as they have NUMBERS numbers at most."""
    return max(ROWS, min(-(-n // PARTS), NUMBERS // max(1, d)))


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        yield int(d), batch.filter(pa.array(sizes == d))


def join_cells(classes: DataFrame, least: float) -> DataFrame:
    """kind, a, b, n from classes (rep, h, n, v), each different vector v once with its n rows.

    kind 0: class (rep a, h b) is linked to n other rows, to be summed over a class's rows, of which each class has one at least;
    kind 1: links a, b that join up all linked classes.
    """
    spark = classes.sparkSession
    angle = math.acos(least)
    lengths = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    main, n = (lengths[0].d, lengths[0].n) if lengths else (0, 0)
    most = members_of_part(n, main)
    count = max(1, min(PIVOTS, -(-n // most)))
    picked = classes.filter(F.size("v") == main).orderBy(F.xxhash64("h", "rep"), "rep", "h").limit(count).collect()  # at most PIVOTS rows
    pivots = unit(np.array([r.v for r in picked], np.float64)) if picked else np.zeros((1, 0))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in by_length(batch, "v"):
                own = cells_near(unit(doubles(part.column("v"))), pivots, angle)[0] if d == main else np.zeros(part.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, d, np.int32)), pa.array(own.astype(np.int32))], [*part.schema.names, "d", "cell"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = cut(classes.select("rep", "h", "n", "v").mapInArrow(place, f"rep bigint, h bigint, n bigint, v {kind}, d int, cell int"), "placed")
    parts: dict[tuple[int, int], list[int]] = {}  # a row a length and cell
    total = 0
    for r in placed.groupBy("d", "cell").agg(F.count("*").alias("n")).sort("d", "cell").collect():
        parts[r.d, r.cell] = list(range(total, total := total + -(-r.n // members_of_part(n, r.d))))
    keys = spread_keys(spark, max(1, total))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in by_length(batch, "v"):
                own = part.column("cell").to_numpy(zero_copy_only=False)
                if d == main:
                    near = cells_near(unit(doubles(part.column("v"))), pivots, angle)[1]
                else:
                    near = np.ones((part.num_rows, 1), bool)
                h = part.column("h").to_numpy(zero_copy_only=False)
                mine = np.empty(part.num_rows, np.int64)
                for cell in np.unique(own).tolist():
                    at = np.flatnonzero(own == cell)
                    groups = np.array(parts[d, cell])
                    mine[at] = groups[np.abs((h[at] >> 7) % len(groups))]
                yield sent(part, np.arange(part.num_rows), mine, 0)
                for (length, cell), groups in parts.items():
                    if length == d:
                        for g in groups:
                            rows = np.flatnonzero(near[:, cell] & (mine < g))
                            if len(rows):
                                yield sent(part, rows, np.full(len(rows), g), 1)

    def sent(part: pa.RecordBatch, rows: np.ndarray, to: np.ndarray, role: int) -> pa.RecordBatch:
        some = part.take(pa.array(rows))
        return pa.RecordBatch.from_arrays([pa.array(np.array(keys)[to], pa.int64()), pa.array(to.astype(np.int32)), pa.array(np.full(len(rows), role, np.int8)), *(some.column(c) for c in ("rep", "h", "n", "v"))], ["key", "part", "role", "rep", "h", "n", "v"])

    dealt = placed.mapInArrow(deal, f"key bigint, part int, role tinyint, rep bigint, h bigint, n bigint, v {kind}")
    spread = dealt.repartition(max(1, total), "key").drop("key").sortWithinPartitions("part", "role")
    out = spread.mapInArrow(lambda batches: _joined(batches, least), "kind tinyint, a bigint, b bigint, n bigint")
    out._tejido_path = placed._tejido_path
    return out


class Part:
    """The members of a part of a cell, their counts so far, and what ties them together."""

    def __init__(self, number: int, least: float):
        self.number, self.least, self.chunks, self.ready = number, least, [], False
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, batch: pa.RecordBatch) -> None:
        self.chunks.append((*_columns(batch), unit(doubles(batch.column("v")))))

    def begin(self) -> None:
        """All members are there: they meet each other."""
        self.rep, self.h, self.n, self.u = (np.concatenate(x) for x in zip(*self.chunks, strict=True))
        self.chunks, self.ready = [], True
        self.u32 = self.u.astype(np.float32)
        self.count = np.zeros(len(self.rep), np.int64)
        self.root = np.arange(len(self.rep))
        self.doubt = (self.u.shape[1] + 8) * 2.4e-7  # bounds the rounding error of a float32 product
        for k in range(0, len(self.u), COLUMNS):
            mask = self.near(self.u[k : k + COLUMNS])
            self.count += mask @ self.n[k : k + COLUMNS]
            i, j = np.nonzero(mask)
            unite(self.root, i, j + k)

    def near(self, some: np.ndarray) -> np.ndarray:
        """Members x some: whether the cosine is `least` or more."""
        sims = self.u32 @ some.astype(np.float32).T
        mask = sims >= self.least + self.doubt
        i, j = np.nonzero((sims >= self.least - self.doubt) & ~mask)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            good = np.einsum("ij,ij->i", self.u[a], some[b]) >= self.least
            mask[a[good], b[good]] = True
        return mask

    def meet(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rep, h, n = _columns(batch)
        u = unit(doubles(batch.column("v")))
        for k in range(0, len(u), COLUMNS):
            mask = self.near(u[k : k + COLUMNS])
            columns = np.flatnonzero(mask.any(axis=0))
            if not len(columns):
                continue
            self.count += mask @ n[k : k + COLUMNS]
            mask = mask[:, columns]
            first = mask.argmax(axis=0)
            self.links.append((rep[k : k + COLUMNS][columns], self.rep[first]))
            i, j = np.nonzero(mask)
            unite(self.root, i, first[j])
            yield _made(0, rep[k : k + COLUMNS][columns], h[k : k + COLUMNS][columns], self.n @ mask)

    def end(self) -> Iterator[pa.RecordBatch]:
        if not self.ready:
            self.begin()
        yield _made(0, self.rep, self.h, self.count - 1)  # each has met itself
        a, b = (np.concatenate(x) for x in zip(*[*self.links, (self.rep, self.rep[self.root])], strict=True))
        apart = a != b
        yield _made(1, a[apart], b[apart], np.zeros(int(apart.sum())))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "h", "n"))


def _made(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), *(pa.array(x.astype(np.int64)) for x in (a, b, n))], ["kind", "a", "b", "n"])


def _joined(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    now: Part | None = None
    for batch in batches:
        numbers, roles = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "role"))
        code = numbers.astype(np.int64) * 2 + roles
        edges = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else []
        for start, stop in zip(edges, [*edges[1:], len(code)], strict=True):
            if now is None or now.number != numbers[start]:
                if now:
                    yield from now.end()
                now = Part(int(numbers[start]), least)
            for at in range(start, stop, 2048):
                some = batch.slice(at, min(2048, stop - at))
                if roles[start] == 0:
                    now.add(some)
                    continue
                if not now.ready:
                    if not now.chunks:
                        break  # no members: nothing to join
                    now.begin()
                yield from now.meet(some)
    if now and (now.ready or now.chunks):
        yield from now.end()


def near_duplicates(vectors: DataFrame, least: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row: links are pairs of rows with a cosine of `least` or more.

    Vectors that are null, empty or zero, hold null or non-finite numbers, or have no id, link with nothing; nor do vectors of different
    lengths. Equal vectors are joined once, and each of their rows links with all others of them. component_id is the
    least vec_id reachable, itself included; without links it is the row's own. Rows that share an id are one node.
    """
    given = F.col(embedding)
    sound = F.coalesce((F.size(given) > 0) & F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(given, lambda x: x != 0) & F.col(vec_id).isNotNull(), F.lit(False))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(sound, F.transform(given, lambda x: x + F.lit(0).cast(_number(vectors, embedding)))).alias("v")).withColumn("h", F.xxhash64("v"))
    whole = rows.filter("v is not null")
    classes = cut(whole.groupBy("h", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors")
    joined = join_cells(classes, least)
    found = cut(joined, "joined")
    drop_cut(joined)
    linked = connected_components(found.filter("kind = 1"))
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("rep"), F.col("b").alias("h")).agg(F.sum("n").alias("n_links"))
    told = classes.join(counts, ["rep", "h"]).join(linked.withColumnRenamed("node", "rep"), "rep", "left").select("h", "v", "n_links", F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(told, ["h", "v"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _number(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.elementType.simpleString()
