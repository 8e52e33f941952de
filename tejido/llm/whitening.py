"""Embedding whitening (operator 12), by a singular value decomposition that is merged as a hierarchy.

Each task summarises its vectors by their number, exact sums, and all singular values and right vectors of the centred rows; no dimension is
cut off. Two summaries merge by stacking their scaled vectors and one row for the distance of their means, and decomposing
that anew, which loses nothing. Summaries meet FAN at a time in tasks of their own, round by round, until one is left; it has the size
of a square matrix of the dimensions, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import cut, drop_cut

#: An entry c becomes the whole number floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Components that a report holds at most.
COMPONENTS = 32
#: Summaries that one task merges.
FAN = 16
#: Vectors that are decomposed or projected at once.
ROWS = 4096
#: Bound on the dimensions: the model, a square matrix of them, goes to the driver and to every task (32 MB).
MOST_DIMS = 2048
#: Entries beyond have no exact whole number in double precision.
MOST_ENTRY = 2.0**45


@dataclass(frozen=True)
class Summary:
    """n rows of whole numbers: their sums, and singular values and right vectors of the rows less their means."""

    n: int
    sums: np.ndarray  # object: whole numbers of any size
    values: np.ndarray
    vectors: np.ndarray

    @property
    def scaled(self) -> np.ndarray:
        return self.values[:, None] * self.vectors


def decomposed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors of rows; of many rows by way of their triangular factor."""
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    _, values, vectors = np.linalg.svd(rows, full_matrices=False)
    return values, vectors


def summary(x: np.ndarray) -> Summary:
    """The summary of rows of int64, not none."""
    sums = x.sum(axis=0, dtype=object)
    base = np.array([int(s) // len(x) for s in sums], np.int64)
    rest = np.array([(int(s) - int(b) * len(x)) / len(x) for s, b in zip(sums, base, strict=True)])
    return Summary(len(x), sums, *decomposed((x - base) - rest))


def merged(a: Summary, b: Summary) -> Summary:
    """The summary of the rows of both."""
    n = a.n + b.n
    apart = np.array([float(int(s) * b.n - int(t) * a.n) / (a.n * b.n) for s, t in zip(a.sums, b.sums, strict=True)])
    return Summary(n, a.sums + b.sums, *decomposed(np.vstack([a.scaled, b.scaled, np.sqrt(a.n / n * b.n) * apart])))


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """x of the vectors in column that hold no null or non-finite entry (all of one length), as int64, and which rows those are."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths > 0)
    if not len(at):
        return np.empty((0, 0), np.int64), at
    flat = pc.list_flatten(column.take(pa.array(at)))
    entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), -1)  # nulls as NaN
    whole = np.isfinite(entries).all(axis=1)
    entries, at = entries[whole], at[whole]
    if len(entries) and np.abs(entries).max() > MOST_ENTRY:
        raise ValueError(f"an entry beyond {MOST_ENTRY:.0f}")
    return np.floor(entries * SCALE).astype(np.int64) + OFFSET, at


def usable(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """vectors whose embedding is neither null nor empty and holds only finite entries, of the most frequent length among those (the greatest of equals)."""
    good = F.col(embedding).isNotNull() & (F.size(embedding) > 0) & F.forall(embedding, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    kept = vectors.filter(good)
    length = kept.groupBy(F.size(embedding).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if length is None:
        return kept
    if length.dims > MOST_DIMS:
        raise ValueError(f"vectors of over {MOST_DIMS} dimensions")
    return kept.filter(F.size(embedding) == length.dims)


SUMMARIES = "key bigint, n bigint, sums array<string>, values array<double>, vectors array<double>"


def _packed(key: int, s: Summary) -> pa.RecordBatch:
    columns = [pa.array([key], pa.int64()), pa.array([s.n], pa.int64()), pa.array([[str(v) for v in s.sums]], pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array([v.ravel()], pa.list_(pa.float64())) for v in (s.values, s.vectors))], ["key", "n", "sums", "values", "vectors"])


def _unpacked(row: dict) -> Summary:
    sums = np.array([int(v) for v in row["sums"]] + [None], object)[:-1]
    return Summary(row["n"], sums, np.array(row["values"]), np.array(row["vectors"]).reshape(-1, len(sums)))


def in_pairs(parts: list, merge: Callable) -> object:
    """All parts merged, neighbours first, so that errors grow with the logarithm of their number."""
    while len(parts) > 1:
        parts = [merge(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def hierarchy(rows: DataFrame, unpack: Callable, merge: Callable, pack: Callable) -> dict | None:
    """The one row that is left when the rows of summaries (key, ...) have been merged, FAN at a time in the order of their keys; None if there are none."""
    now = cut(rows, "summaries")
    schema = now.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["key"] // FAN != group:
                    if held:
                        yield pack(group, in_pairs(held, merge))
                    held, group = [], row["key"] // FAN
                held.append(unpack(row))
        if held:
            yield pack(group, in_pairs(held, merge))

    while now.select("key").limit(2).count() > 1:
        after = cut(now.repartition(F.floor(F.col("key") / FAN)).sortWithinPartitions("key").mapInArrow(run, schema), "summaries")
        drop_cut(now)
        now = after
    last = now.first()
    drop_cut(now)
    return None if last is None else last.asDict()


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums; eigenvalues of the covariance of their whole numbers (all), and the unit eigenvectors (rows) of those above 0, as far as asked for."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        if len(x) and self.n * (int(np.abs(x).max()) + max(map(abs, self.sums)) // self.n + 1) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array([*self.sums, None], object)[:-1]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n x - S)^2, exactly; an OverflowError if one is no int64."""
        apart = self.centred(x)
        if apart.dtype == object or len(apart) and float(np.abs(apart).max()) ** 2 * apart.shape[1] > 2.0**62:
            apart = apart.astype(object)
        total = (apart * apart).sum(axis=1)
        return np.array([int(v) for v in total], np.int64) if total.dtype == object else total

    def whitened(self, x: np.ndarray) -> np.ndarray:
        k = len(self.components)
        return (self.centred(x) / self.n).astype(np.float64) @ (self.components / np.sqrt(self.eigenvalues[:k, None])).T


def fit(vectors: DataFrame, embedding: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of usable() vectors; None if there are none.

    Eigenvalues fall; of equal ones any basis may come. An eigenvector's largest entry (the first of equals) is positive. Directions in which the
    vectors don't vary, beyond rounding, are no components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                x, _ = whole_numbers(batch.column(0).slice(k, ROWS))
                if len(x):
                    part = summary(x)
                    now = part if now is None else merged(now, part)
        if now is not None:
            yield _packed(TaskContext.get().partitionId(), now)

    row = hierarchy(vectors.select(embedding).mapInArrow(run, SUMMARIES), _unpacked, merged, _packed)
    if row is None:
        return None
    whole = _unpacked(row)
    e = whole.values**2 / whole.n
    rank = int((whole.values > whole.values[0] * len(whole.sums) * np.finfo(float).eps).sum()) if len(e) and e[0] > 0 else 0
    v = whole.vectors[: min(rank, components)]
    at = np.abs(v).argmax(axis=1)
    return Whitening(whole.n, [int(s) for s in whole.sums], e, v * np.sign(v[np.arange(len(v)), at])[:, None])


MOMENTS = "key bigint, n bigint, mean array<double>, moment array<double>"


def identity_error(vectors: DataFrame, model: Whitening, embedding: str = "embedding") -> float:
    """The largest absolute entry of the covariance of all whitened vectors less the identity; 0 if there is no component."""
    k = len(model.components)
    if not k:
        return 0.0

    def merge(a: tuple, b: tuple) -> tuple:
        n, apart = a[0] + b[0], b[1] - a[1]
        return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] / n * b[0])

    def pack(key: int, s: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([s[0]], pa.int64()), *(pa.array([v.ravel()], pa.list_(pa.float64())) for v in s[1:])], ["key", "n", "mean", "moment"])

    def unpack(row: dict) -> tuple:
        return row["n"], np.array(row["mean"]), np.array(row["moment"]).reshape(k, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for j in range(0, batch.num_rows, ROWS):
                x, _ = whole_numbers(batch.column(0).slice(j, ROWS))
                if len(x):
                    w = model.whitened(x)
                    mean = w.mean(axis=0)
                    part = len(w), mean, (w - mean).T @ (w - mean)
                    now = part if now is None else merge(now, part)
        if now is not None:
            yield pack(TaskContext.get().partitionId(), now)

    n, _, moment = unpack(hierarchy(vectors.select(embedding).mapInArrow(run, MOMENTS), unpack, merge, pack))
    return float(np.abs(moment / n - np.eye(k)).max())


REPORT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, model: Whitening, embedding: str = "embedding") -> DataFrame:
    """vec_id, deviation, whitened (array): usable() vectors projected on the model's components, to variance 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                x, at = whole_numbers(part.column(1))
                if len(x):
                    w = model.whitened(x)
                    ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array(model.deviations(x)), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], ["vec_id", "deviation", "whitened"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), embedding).mapInArrow(run, "vec_id bigint, deviation bigint, whitened array<double>")


def report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable() vector and component.

    Vectors that are null, empty or hold null or non-finite entries have no rows, nor have those of another than the most frequent length. A null vec_id
    and repeated rows count like any others. Vectors that vary in fewer directions than asked for have fewer components, equal ones none, so no
    rows; neither has an empty table. Entries beyond MOST_ENTRY, deviations beyond 64 bits and vectors of over MOST_DIMS are errors. Of equal eigenvalues
    any basis may come, the same for all rows.
    """
    kept = usable(vectors)
    model = fit(kept, components=components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], REPORT)
    error, trace = identity_error(kept, model), float(model.eigenvalues.sum())
    told = whiten(kept, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(e) / trace) for e in model.eigenvalues[: len(model.components)]]) if trace else F.array().cast("array<double>")
    return told.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, "at").alias("explained"), F.lit(error).alias("identity_error"))
