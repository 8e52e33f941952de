"""Lempel-Ziv phrase fingerprints (operator 1).

A text is parsed into dictionary phrases: each is the shortest stretch that has not been a phrase before (LZ78). The set
of phrases is hashed, and the least hashes are the fingerprint: a bottom-k sketch, whose likeness to another
estimates the share of phrases that two texts have in common, as a compressor would find it. Sets of
up to K phrases are compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import shuffle_width, slices, spread_keys

#: Hashes in a fingerprint, each of 32 bits.
K = 128
#: Code points hashed at once.
STRETCH = 1 << 18
_MUL = np.uint64(0xD6E8FEB86659FD93)


class Parser:
    """An LZ78 parse as a trie of phrases. It can go on with more text, and take back what it has learnt to go on in another way."""

    def __init__(self):
        self.root: dict = {}
        self.node = self.root  # of the phrase that is open

    def cuts(self, text: str, start: int = 0, learnt: list | None = None) -> list[int]:
        """Where phrases end in text, read from `start` on; new phrases are added to `learnt` as (node, character)."""
        root, node, out = self.root, self.node, []
        for at, c in enumerate(text[start:] if start else text, start + 1):
            below = node.get(c)
            if below is None:
                node[c] = {}
                out.append(at)
                if learnt is not None:
                    learnt.append((node, c))
                node = root
            else:
                node = below
        self.node = node
        return out

    def feed(self, text: str) -> list[str]:
        """The phrases of a text, from the first on."""
        ends = self.cuts(text)
        return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _inverse() -> np.uint64:
    return np.uint64(pow(int(_MUL), -1, 1 << 64))


_INV = _inverse()
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MUL and its inverse to the powers 0 to n, modulo 2**64."""
    size = 1 << max(12, n.bit_length())
    if size not in _powers:
        with np.errstate(over="ignore"):
            _powers[size] = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, x, np.uint64))]) for x in (_MUL, _INV))
    return _powers[size]


def phrase_hashes(text: str, ends: list[int], start: int = 0) -> np.ndarray:
    """32-bit hashes of the phrases of text that follow each other from `start` on: a polynomial over their code points, mixed."""
    edges = np.array([start, *ends], np.int64)
    out, k = [], 0
    while k < len(ends):
        stop = max(k + 1, int(np.searchsorted(edges, edges[k] + STRETCH, side="right")) - 1)
        points = np.frombuffer(text[edges[k] : edges[stop]].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        up, down = powers(len(points))
        at = edges[k : stop + 1] - edges[k]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(points * up[: len(points)])])
        h = np.diff(sums[at]) * down[at[:-1]] + np.diff(at).astype(np.uint64)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        out.append((h >> np.uint64(32)).astype(np.uint32))
        k = stop
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k least different hashes, in order."""
    if len(hashes) > 8 * k:
        least = np.unique(np.partition(hashes, 2 * k)[: 2 * k])
        if len(least) >= k:
            return least[:k]
    return np.unique(hashes)[:k]


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common phrases, from the k least hashes of the union; two empty fingerprints are alike."""
    if not len(a) and not len(b):
        return 1.0
    union = np.union1d(a, b)[:k]
    return float(np.isin(union, a, assume_unique=True)[np.isin(union, b, assume_unique=True)].sum() / len(union))


def fingerprint_text(text: str | None) -> np.ndarray:
    """Fingerprint of a text. What the text's end leaves open has been a phrase before and adds none."""
    return bottom(phrase_hashes(text or "", Parser().cuts(text or "")))


def to_hex(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def fingerprint(df: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """df with the column `into`: the fingerprint of the whole text, hexadecimal, 8 digits a hash; '' for a null or empty text.

    Equal texts have equal fingerprints. All columns and repeated rows stay; a column called as `into` is replaced.
    """
    from pyspark.sql import types as T

    kept = df.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = pa.array([to_hex(fingerprint_text(t)) for t in part.column(text).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, into])

    return kept.mapInArrow(run, schema)


def edited(text: str, follower: str) -> tuple[str, str, str]:
    """What stays of text, what was its end (the last quarter of its code points, rounded down), and what takes that place:
    as many first code points of follower, or all that it has."""
    n = len(text) // 4
    cut = len(text) - n
    return text[:cut], text[cut:], follower[:n]


def edit_ring(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The next document is that of the next larger doc_id, after the last the first. Rows are dealt into ranges of doc_id,
    each sorted within one task; the first row of a range goes to the range before it as well, so that each row meets the
    next one without a global sort. Rows of one doc_id follow each other by text, null texts first; a null doc_id
    comes before all. A null text counts as empty. A single document is its own next.
    """
    spark = docs.sparkSession
    n = shuffle_width(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    edges = sorted(set(ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n).alias("q")).first().q or [])) if n > 1 else []
    place = below(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), edges)
    # one row a range: its least doc_id
    found = ids.select(place.alias("range"), "doc_id").groupBy("range").agg(F.min(F.struct("doc_id")).getField("doc_id").alias("least")).collect()
    first = {r["range"]: NULL_ID if r["least"] is None else r["least"] for r in found}
    order = sorted(first) or [0]
    before = {r: order[k - 1] for k, r in enumerate(order)}
    keys = dict(zip(order, spread_keys(spark, len(order)), strict=True))
    listed = lambda d, kind: F.array(*[F.lit(d.get(r, 0)).cast(kind) for r in range(order[-1] + 1)])
    at = lambda d, place, kind="int": F.get(listed(d, kind), place)
    is_first = F.coalesce(F.col("doc_id"), F.lit(NULL_ID)) == at(first, F.col("range"), "long")
    own = F.struct(F.col("range"), F.lit(False).alias("tail"))
    shown = F.struct(at(before, F.col("range")).alias("range"), F.lit(True).alias("tail"))
    both = rows.withColumn("range", place).select("doc_id", "text", F.explode(F.when(is_first, F.array(own, shown)).otherwise(F.array(own))).alias("to"))
    dealt = both.select(at(keys, F.col("to.range")).alias("key"), "to.range", "to.tail", "doc_id", "text").repartition(len(order), "key")
    return dealt.drop("key").sortWithinPartitions("range", "tail", "doc_id", "text").mapInArrow(_ring, RING)


def below(value: Column, edges: list[int]) -> Column:
    """How many of the sorted edges are at most value, by halving."""
    top = 1 << len(edges).bit_length()
    listed = F.array(*[F.lit(e).cast("long") for e in edges], *[F.lit(2**63 - 1).cast("long")] * (top - len(edges)))
    steps = F.array(*[F.lit(top >> k) for k in range(1, top.bit_length())]) if top > 1 else F.array().cast("array<int>")
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(listed, at + step - 1) <= value, at + step).otherwise(at))
    return F.least(found, F.lit(len(edges)))


#: Stands for a null doc_id where it is compared.
NULL_ID = -(2**63)
RING = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _both(text: str, follower: str) -> tuple[str, np.ndarray, np.ndarray]:
    """SHA-256 of the edited text, and the fingerprints of text and edited text, whose common start is parsed once."""
    stays, _, start = edited(text, follower)
    parser, learnt = Parser(), []
    ends = parser.cuts(stays)
    common, node, at = phrase_hashes(stays, ends), parser.node, ends[-1] if ends else 0
    own = bottom(np.concatenate([common, phrase_hashes(text, parser.cuts(text, len(stays), learnt), at)]))
    for above, c in reversed(learnt):
        del above[c]
    changed, parser.node = stays + start, node
    other = bottom(np.concatenate([common, phrase_hashes(changed, parser.cuts(changed, len(stays)), at)]))
    return hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, other


def _ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the rows of whole ranges in order, each range closed by the next one's first row (tail)."""
    names = [x.split()[0] for x in RING.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    place = text = doc_id = None  # the row whose next one is to come; text None: the range is closed
    waiting = None  # the row before it, whose next row's fingerprint is to come
    for batch in batches:
        for part in slices(batch, "text"):
            out: list[tuple] = []
            for place_, tail, doc_id_, text_ in zip(*(part.column(c).to_pylist() for c in ("range", "tail", "doc_id", "text")), strict=True):
                if place_ != place:
                    place, doc_id, text, waiting = place_, doc_id_, text_, None
                    continue
                if text is None:  # the range is closed; more rows of the next range's first doc_id
                    continue
                digest, own, other = _both(text, text_)
                if waiting:
                    out.append((*waiting[0], likeness(waiting[1], own)))
                waiting = ((doc_id, len(text), digest, to_hex(own), to_hex(other), likeness(own, other)), own)
                doc_id, text = doc_id_, text_
                if tail:
                    out.append((*waiting[0], likeness(own, fingerprint_text(text_))))
                    text = waiting = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
