"""Language identification (operator 4): multinomial naive Bayes over hashed character n-grams.

Counts of n-grams by language are summed on the executors, one row a language and bucket; the matrix of
log-probabilities, languages by buckets, is of a size set by parameters and goes to every task. A batch of texts is
scored at once: the n-grams of all its characters are hashed in numpy, the matrix is gathered at those buckets only,
and the sums over each text's stretch are its scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import fresh, slices

#: Buckets of n-grams, a power of two.
BUCKETS = 1 << 15
#: Lengths of n-grams in code points.
ORDERS = (1, 2, 3)
#: Added to every count.
ALPHA = 0.5
#: Bound on the languages that a model may have: the matrix then holds MOST x BUCKETS floats (64 MB) at most.
MOST = 512
#: Texts are hashed in stretches of so many code points.
STRETCH = 1 << 18
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def ngram_buckets(points: np.ndarray, buckets: int = BUCKETS) -> list[np.ndarray]:
    """For each order, the bucket of the n-gram that begins at each place; shorter by order less one."""
    out, rolling = [], np.zeros(len(points), np.uint64)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    for n in range(1, max(ORDERS) + 1):
        rolling = rolling[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(1)
        if n in ORDERS:
            out.append(((rolling * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int32))
        if len(rolling) <= 1:
            break
    return out


def stretches(texts: list[str], most: int = STRETCH) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """Lower-cased pieces of texts, each text begun and ended by a space: row numbers, pieces, and how many n-grams' starts a piece owns.

    A group holds about `most` code points. A longer text is cut; a piece then shows the next ones' first code points as well, so that
    every n-gram of the text is within the piece that owns its start, and counts once.
    """
    rows, parts, own, size = [], [], [], 0
    for k, text in enumerate(texts):
        text = f" {text.lower()} "
        for at in range(0, len(text), most):
            rows.append(k)
            parts.append(text[at : at + most + max(ORDERS) - 1])
            own.append(min(most, len(text) - at))
            size += own[-1]
            if size >= most:
                yield np.array(rows), parts, np.array(own)
                rows, parts, own, size = [], [], [], 0
    if rows:
        yield np.array(rows), parts, np.array(own)


def owned(sizes: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """Whether the n-gram that begins at each place of the pieces ends within its piece, which owns the start."""
    ends = np.cumsum(sizes)
    keep = np.ones(int(ends[-1]), bool)
    lost = sizes - np.minimum(own, np.maximum(0, sizes - n + 1))
    for j in range(1, int(lost.max()) + 1):
        keep[ends[lost >= j] - j] = False
    return keep[: max(0, len(keep) - n + 1)]


def count_ngrams(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, bucket, n: n-grams of all texts with a language, summed in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        sums: list[np.ndarray] = []
        for batch in batches:
            for part in slices(batch, text):
                by: dict[str, list[str]] = {}
                for t, name in zip(part.column(text).to_pylist(), part.column(lang).to_pylist(), strict=True):
                    if has_letter(t) and name is not None:
                        by.setdefault(name, []).append(t)
                for name, texts in by.items():
                    if name not in names:
                        names[name] = len(sums)
                        sums.append(np.zeros(BUCKETS, np.int64))
                        if len(sums) > MOST:
                            raise ValueError(f"more than {MOST} languages")
                    for _, parts, own in stretches(texts):
                        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                        for n, found in zip(ORDERS, ngram_buckets(codes("".join(parts))), strict=False):
                            sums[names[name]] += np.bincount(found[owned(sizes, own, n)], minlength=BUCKETS)
        for name, k in names.items():
            at = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(sums[k][at], pa.int64())], ["lang", "bucket", "n"])

    counted = labelled.select(text, lang).mapInArrow(run, "lang string, bucket int, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order of name, and log-probabilities as buckets x languages."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray):
        self.langs = langs
        smooth = counts.astype(np.float64) + ALPHA
        self.log = np.ascontiguousarray(np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))
        self.prior = np.log(docs / docs.sum())

    def score(self, texts: list[str]) -> np.ndarray:
        """Joint log-probabilities, texts x languages."""
        out = np.tile(self.prior, (len(texts), 1))
        for rows, parts, own in stretches(texts, max(1 << 12, STRETCH * 8 // max(8, len(self.langs)))):
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            starts = np.cumsum(sizes) - sizes
            for n, found in zip(ORDERS, ngram_buckets(codes("".join(parts))), strict=False):
                gathered = self.log[found]
                gathered[~owned(sizes, own, n)] = 0
                some = starts < len(found)  # a last piece of fewer code points has no n-gram
                np.add.at(out, rows[some], np.add.reduceat(gathered.astype(np.float64), starts[some], axis=0))
        return out


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """A model of all labelled rows; None if none has a language and a letter. Rows without a language are passed over."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    docs = {r[lang]: r["n"] for r in rows.groupBy(lang).agg(F.count("*").alias("n")).limit(MOST + 1).collect()}
    if len(docs) > MOST:
        raise ValueError(f"more than {MOST} languages")
    # at most MOST x BUCKETS rows
    found = count_ngrams(rows, text, lang).groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
    langs, counts = [], []
    for r in found.sort("lang").toLocalIterator():
        cells = np.array([(c.bucket, c.n) for c in r.cells], np.int64)
        row = np.zeros(BUCKETS, np.int64)
        row[cells[:, 0]] = cells[:, 1]
        langs.append(r.lang)
        counts.append(row)
    if not langs:
        return None
    return Model(langs, np.array(counts), np.array([docs[x] for x in langs], np.float64))


def predict(df: DataFrame, model: Model | None, text: str = "text", into: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """df with two columns, language and score (0 to 1: the prediction's share of probability), from the text alone; if `into` has a third
    name, with the margin too: by how much, for each n-gram, the log-probability is above the next language's (infinite with one language).

    Null, empty or letterless text: `und` with score and margin 0; so is every text if the model is None. Of equal scores, the
    first language by name. Texts of any length are scored whole. All columns and repeated rows stay; columns called as the new ones are replaced.
    """
    kept = df.drop(*into)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, kind, False) for name, kind in zip(into, (T.StringType(), T.DoubleType(), T.DoubleType()), strict=False))])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text).to_pylist()
                names, scores, margins = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
                rows = [k for k, t in enumerate(texts) if has_letter(t)] if own else []
                if rows:
                    log = own.score([texts[k] for k in rows])
                    best = log.argmax(axis=1)
                    scores[rows] = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
                    two = np.partition(log, -2, axis=1) if log.shape[1] > 1 else np.tile([-np.inf, 0.0], (len(rows), 1))
                    margins[rows] = (two[:, -1] - two[:, -2]) / [len(ORDERS) * (len(texts[k]) + 1) for k in rows]
                    for k, b in zip(rows, best, strict=True):
                        names[k] = own.langs[b]
                made = (pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, *made[: len(into)]], [*part.schema.names, *into])

    return kept.mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4; null without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Learnt from the labelled documents of folds 0, 1 and 3; documents without an id
    are in no fold: they are not learnt from and not held out."""
    model = train(docs.filter(fold(F.col("doc_id")) != 2))
    rows = docs.select("doc_id", "text", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, margin: float = 0.05) -> DataFrame:
    """The documents, all columns, whose language is predicted with a score of `least` or more, and by `margin` or more for each n-gram;
    the rest is rejected. (A score is a product over all n-grams and near 1 for any longer text; the margin tells which are in doubt: prose
    of one language has about 2, a text of several or of none less than a tenth of that.) Repeated rows stay or go together; ties are in doubt."""
    model = train(docs.filter(fold(F.col("doc_id")) != 2))
    lang, score, gap = (fresh(name, docs.columns) for name in ("lang_pred", "score", "margin"))
    scored = predict(docs, model, into=(lang, score, gap))
    return scored.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least) & (F.col(gap) >= margin)).drop(lang, score, gap)
