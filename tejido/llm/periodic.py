"""Runs of words that repeat with a period (operator 13), by probing harmonic grids.

A run of period p that is at least 2 p words long holds two neighbouring points of the grid 0, p, 2p, ... So for each p only the words at
jp and (j+1)p are compared, n log n comparisons for all periods of n words. Where they are equal the run is extended to both sides by comparing
stretches of the words with those p further on, first short ones, then longer ones. Grid points within a run whose period divides p are
skipped: they can only lead to that run again. Periods are taken in doublings (no period divides another one of the same doubling),
all documents of a batch and all periods of a doubling in one array.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import slices

#: A run has so many words, and so many periods.
WORDS, PERIODS = 12, 2
#: Bytes of text, and grid points, that are looked at together.
SLICE, PROBES = 1 << 20, 1 << 20
#: Words that are compared at once: at first, and at most.
CHUNK, MOST_CHUNK = 8, 8192
#: Elements of arrays made for a comparison.
CELLS = 1 << 21

RUNS = np.dtype([("doc", np.int64), ("start", np.int64), ("length", np.int64), ("period", np.int64)])


def codes(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words only."""
    seen: dict[bytes, int] = {}
    return np.fromiter(map(seen.setdefault, words, range(len(words))), np.int64, len(words))


def agreeing(w: np.ndarray, i: np.ndarray, p: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """For each k, how many of the words w[i], w[i + step], ... are equal to those p further on in turn, up to `most` of them."""
    out = np.zeros(len(i), np.int64)
    at, size = np.flatnonzero(most > 0), CHUNK
    while len(at):
        still = []
        for k in range(0, len(at), max(1, CELLS // size)):
            part = at[k : k + max(1, CELLS // size)]
            left = np.minimum(most[part] - out[part], size)
            off = np.minimum(np.arange(size), left[:, None] - 1)  # beyond the end, the last one again
            here = (i[part] + step * out[part])[:, None] + step * off
            differ = w[here] != w[here + p[part][:, None]]
            whole = ~differ.any(axis=1)
            out[part] += np.where(whole, left, differ.argmax(axis=1))
            still.append(part[whole & (out[part] < most[part])])
        at, size = np.concatenate(still), min(2 * size, MOST_CHUNK)
    return out


def runs_of(w: np.ndarray, counts: np.ndarray, least: int = WORDS) -> np.ndarray:
    """Runs (RUNS) of the documents whose words' codes stand in w one after another, counts words each; sorted by document, start, period."""
    begin = np.cumsum(counts) - counts
    found = np.empty(0, RUNS)
    low = 1
    while True:
        docs = np.flatnonzero(counts >= np.maximum(least, PERIODS * low))
        if not len(docs):
            break
        periods = np.minimum(counts[docs] // PERIODS, 2 * low - 1) - low + 1
        doc, p = np.repeat(docs, periods), low + np.arange(periods.sum()) - np.repeat(np.cumsum(periods) - periods, periods)
        new, points = [], (counts[doc] - 1) // p
        ends = np.cumsum(points)
        start = 0
        while start < len(doc):  # all points of a grid together
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - points[start] + PROBES, side="right")))
            new.append(_probed(w, begin, counts, doc[start:stop], p[start:stop], points[start:stop], found, least))
            start = stop
        found = np.sort(np.concatenate([found, *new]), order=["doc", "start", "period"])
        low *= 2
    return found


def _probed(w: np.ndarray, begin: np.ndarray, counts: np.ndarray, doc: np.ndarray, p: np.ndarray, points: np.ndarray, found: np.ndarray, least: int) -> np.ndarray:
    """Runs with the periods p in the documents doc, sorted by both, whose grids have so many points."""
    first = np.cumsum(points) - points
    grid = np.repeat(np.arange(len(doc)), points)
    j = np.arange(points.sum()) - first[grid]
    i = begin[doc][grid] + j * p[grid]
    hit = w[i] == w[i + p[grid]]
    # what runs of a period that divides p cover
    of = found[found["length"] > p.min(initial=1)]
    of = of[(of["doc"] >= doc[0]) & (of["doc"] <= doc[-1])]
    low, high = np.searchsorted(doc, of["doc"]), np.searchsorted(doc, of["doc"], side="right")
    there = high > low
    of, low, high = of[there], low[there], high[there]
    # periods of one document are successive: multiples of the run's period among them
    multiple = -(-p[low] // of["period"])
    n = np.maximum(0, np.minimum(p[high - 1], of["length"] - 1) // of["period"] - multiple + 1)
    run = np.repeat(np.arange(len(of)), n)
    times = multiple[run] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    q = times * of["period"][run]
    row = low[run] + q - p[low[run]]
    a, b = -(-of["start"][run] // q), (of["start"][run] + of["length"][run] - 1) // q - 1  # from and to j
    a, b = first[row] + a, first[row] + np.minimum(b, points[row] - 1)
    some = a <= b
    marks = np.zeros(len(i) + 1, np.int32)
    np.add.at(marks, a[some], 1)
    np.add.at(marks, b[some] + 1, -1)
    hit &= np.cumsum(marks[:-1]) == 0

    at = np.flatnonzero(hit)
    if not len(at):
        return np.empty(0, RUNS)
    grid, j, i = grid[at], j[at], i[at]
    base, size, period = begin[doc][grid], counts[doc][grid], p[grid]
    right = agreeing(w, i, period, np.minimum(period, base + size - period - i), 1)
    # a point whose words agree up to the next one goes on there
    whole = right == period
    on = np.concatenate([whole[:-1] & (grid[1:] == grid[:-1]) & (j[1:] == j[:-1] + 1), [False]])
    heads = np.flatnonzero(~np.concatenate([[False], on[:-1]]))
    tails = np.flatnonzero(~on)
    left = agreeing(w, i[heads] - 1, period[heads], np.minimum(period[heads] - 1, i[heads] - base[heads]), -1)
    start = i[heads] - left - base[heads]
    stop = i[tails] + right[tails] + period[tails] - base[tails]
    long = stop - start >= np.maximum(least, PERIODS * period[heads])
    out = np.empty(int(long.sum()), RUNS)
    out["doc"], out["start"], out["length"], out["period"] = doc[grid[heads]][long], start[long], (stop - start)[long], period[heads][long]
    return out


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []  # of bytes, split() knows ASCII white space only


#: How a document's words are changed before runs are looked for: doc_id and words to words.
Edit = Callable[[int | None, list[bytes]], list[bytes]]


def _found(part: pa.RecordBatch, edit: Edit | None, least: int) -> Iterator[tuple[int | None, list[bytes], np.ndarray]]:
    """doc_id, words and runs of each row of part (doc_id, text)."""
    ids = part.column("doc_id").to_pylist()
    words = [split_words(t) for t in part.column("text").to_pylist()]
    if edit is not None:
        words = [edit(d, x) for d, x in zip(ids, words, strict=True)]
    counts = np.array([len(x) for x in words], np.int64)
    runs = runs_of(np.concatenate([codes(x) for x in words]), counts, least) if len(words) else np.empty(0, RUNS)
    cuts = np.searchsorted(runs["doc"], np.arange(len(words) + 1))
    for k, (d, x) in enumerate(zip(ids, words, strict=True)):
        yield d, x, runs[cuts[k] : cuts[k + 1]]


def kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, runs["start"] + runs["period"], 1)
    np.add.at(marks, runs["start"] + runs["length"], -1)
    return np.cumsum(marks[:-1]) == 0


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def find_runs(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; in words, by start and period) of every row of docs.

    A run is a stretch of at least `least` words and two periods in which words that are a period apart are equal, that no word beside it
    extends, and that has no smaller period. Words are what stands between ASCII white space, compared byte by byte. Null and empty texts, and
    those of fewer words, have no runs; texts of any length are taken whole. Rows that repeat a doc_id, or have none, are each looked at alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                out = [(d, len(x), [dict(zip(("start", "length", "period"), map(int, (r["start"], r["length"], r["period"])), strict=True)) for r in runs]) for d, x, runs in _found(part, None, least)]
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_words", "runs"])

    return _rows(docs).mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>")


def collapse_runs(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """docs, all columns, with texts less what their runs repeat: words that stay are joined by a space where a text has runs; other texts are as they were."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                rows = pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), part.column("text")], ["doc_id", "text"])
                for k, (_, words, runs) in enumerate(_found(rows, None, least)):
                    if len(runs):
                        texts[k] = _joined(words, runs).decode("utf-8", "surrogatepass")
                columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, schema)


def _joined(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    return b" ".join([words[k] for k in np.flatnonzero(kept(len(words), runs)).tolist()])


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The edit that the report looks at: in a tenth of the documents, by a checksum of doc_id, the words from a place on repeat the first p of them."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


REPORT = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def report(docs: DataFrame, edit: Edit | None = planted, least: int = WORDS) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli; of equal ones the least start, then period; null without one),
    runs_sha256 and collapsed_sha256 of every row of docs, after `edit`.

    Rows are as find_runs() has them. A null doc_id has no edit, a null text no words.
    """
    names = [c.split()[0] for c in REPORT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                out = []
                for d, words, runs in _found(part, edit, least):
                    top = (None,) * 4
                    if len(runs):
                        r = runs[np.argmax(runs["length"])]  # the first of equals
                        top = int(r["start"]), int(r["length"]), int(r["period"]), 1000 * int(r["length"]) // int(r["period"])
                    told = "".join(f"{s},{n},{p}\n" for s, n, p in zip(runs["start"].tolist(), runs["length"].tolist(), runs["period"].tolist(), strict=True))
                    out.append((d, len(runs), *top, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(_joined(words, runs)).hexdigest()))
                kinds = [pa.int64()] * 6 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return _rows(docs).mapInArrow(run, REPORT)
