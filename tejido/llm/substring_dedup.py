"""Repeated passages across documents, by collinear chaining of shared word k-mers (operator 5).

Of every stretch of WINDOW successive k-mers, the one with the least hash is a seed; so two texts that share K + WINDOW - 1
words in a row share a seed. All occurrences of a seed are one class, whose representative is the first in the order of doc_id and place;
each is linked to it, so the links grow with the occurrences, not with their pairs. Occurrences are sorted as a whole into ranges of
hash and document, so that a seed that every document holds is shared out among tasks. The links of two documents are chained in
order, with a cost for gaps, by the maximum of scores kept in a Fenwick tree; chains are aligned word by word, and extended at
both ends, on the words of both texts.

Passages that are the same word by word have a way of their own, which does not depend on what else holds their parts: each run
of as many words as a passage has is linked by its own hash to the first document that holds the whole run. Only runs are looked at
all of whose seeds come in several documents. Successive runs that have their least k-mer in common travel as one row; rows that are equal
as a whole are a class too, of which one member stands for all.

What is left are stretches of shared seeds that other documents hold first each, none of which holds a passage of the stretch. There, seeds
are linked once more in pairs: two seeds that stand close together, and have other first holders, are one class with the same pair in all
other such stretches, whose first holder has both. Those links are chained and aligned like the first ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import cut, drop_cut, fresh, release, shuffle_width, slices
from .lz_fingerprint import powers

#: Words of a k-mer, and k-mers of which one at least is a seed.
K, WINDOW = 5, 4
#: A passage has so many words in both documents, and so great a share of equal words.
WORDS, SIMILARITY = 50, 0.8
#: Least seeds of a chain, and words from its first to its last.
SEEDS, SPAN = 2, 10
#: Cost of a word of distance between linked seeds, on either side; a seed counts K.
GAP = 0.05
#: Words beside a chain that are looked at for its extension.
MARGIN = 128
#: How far a score may fall in an extension before it ends.
FALL = 8
#: Requests for words of one document that one task serves.
SERVED = 50_000
#: Bytes of text hashed at once: so few that the arrays made of them stay in a core's cache.
SLICE = 1 << 17
#: Rows of seeds that one task sorts, about, and rows of links that it hands on at once.
SORTED, GIVEN = 2_000_000, 1 << 16
#: Successive runs that travel as one row at most.
RUNS = 256
#: A seed is paired with so many seeds after it, which stand at most REACH words further on.
PAIRS, REACH = 8, 60
#: Shared seeds that are no further apart than NEAR words are one stretch, which is looked at again if it has so many words (EXTENT).
NEAR, EXTENT = 40, 25
#: Classes of rows that an anchor has in one place at most; beyond that, runs meet by their own hashes.
CLASSES = 4096


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (between ASCII white space, A-Z in lower case) of all texts, and each text's number of words."""
    column = pc.fill_null(column, "")
    n = len(column)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    first = ends[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[first : ends[-1]] if ends[-1] > first else np.empty(0, np.uint8)
    ends = ends - first
    data = data + ((data - np.uint8(65)) < 26) * np.uint8(32)  # below 65 it wraps
    inside = (data != 32) & ((data - np.uint8(9)) > 4)
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    cuts = ends[:-1][ends[:-1] < len(data)]
    before[cuts] = False  # a text's first word starts there, whatever ends the text before
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    last = ends[1:][ends[1:] > 0] - 1
    after[last] = False
    stops = np.flatnonzero(inside & ~after) + 1
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.multiply(data.astype(np.uint64) + np.uint64(1), up[: len(data)]), out=sums[1:])
    h = (sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64)
    counts = np.searchsorted(starts, ends[1:]) - np.searchsorted(starts, ends[:-1])
    return mixed_bits(h), counts


def mixed_bits(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` successive words."""
    n = len(words) - size + 1
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * np.uint64(0x2545F4914F6CDD1D) + words[j : j + n]
    return mixed_bits(h)


def seeds_of(words: np.ndarray, counts: np.ndarray, size: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and word position of the seeds of all texts."""
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = run_hashes(words, size)
    whole = text[:n] == text[size - 1 :]  # the k-mer lies within one text
    at = np.flatnonzero(whole)
    h, text = h[at], text[at]
    begin = np.cumsum(counts) - counts
    # the last least hash of each window; a text with fewer k-mers has one window
    best, where = h.copy(), np.arange(len(h))
    for j in range(1, min(window, len(h))):
        less = (h[j:] <= best[:-j]) & (text[j:] == text[:-j])
        np.copyto(best[:-j], h[j:], where=less)
        np.copyto(where[:-j], np.arange(j, len(h)), where=less)
    opens = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.empty(0, bool)
    ahead = np.concatenate([text[window - 1 :] == text[: max(0, len(text) - window + 1)], np.zeros(min(window - 1, len(text)), bool)])
    held = np.zeros(len(h), bool)
    held[where[ahead | opens]] = True
    picked = np.flatnonzero(held)
    return h[picked], text[picked], at[picked] - begin[text[picked]]


#: h: a seed's hash, whose last bit tells what the row is: 0: the first occurrence of a seed in a document, and those after it, told apart by their
#: turn (by_turn); 1: those after it once more, under the seed's own hash.
SEED_ROWS = "h bigint, doc bigint, pos bigint"


def seed_rows(docs: DataFrame) -> DataFrame:
    """SEED_ROWS of docs. All of it follows from the document alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                h, text, pos = seeds_of(*word_hashes(part.column("text")))
                order, several = order_of(h, text, pos)
                several = order[several]  # most seeds come once in these texts, so they have no turns
                sorted_, of = h[several], text[several]
                again = np.sort(several[np.flatnonzero((sorted_[1:] == sorted_[:-1]) & (of[1:] == of[:-1])) + 1])
                turned = h.copy()
                turned[several] = by_turn(sorted_, of)
                h, text, pos = np.concatenate([turned & ~np.uint64(1), h[again] | np.uint64(1)]).view(np.int64), np.concatenate([text, text[again]]), np.concatenate([pos, pos[again]])
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids[text]), pa.array(pos, pa.int64())], ["h", "doc", "pos"])

    return docs.mapInArrow(run, SEED_ROWS)


def by_turn(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Seeds, sorted by hash and document, told apart by their turn within the document: the second occurrence in one meets
    the second in another, so texts that repeat a line many times are chained as a whole. (The second meets a first one by kind 1.)"""
    if not len(h):
        return h
    opens = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    places = np.arange(len(h))
    turn = (places - np.maximum.accumulate(np.where(opens, places, 0))).astype(np.uint64)
    return np.where(turn > 0, mixed_bits(h ^ (turn * np.uint64(0x9E3779B97F4A7C15))), h)


#: What a row of met() is: a link, a row whose class may have begun in an earlier range, the head of such a class in a range, a link that is one of
#: the first of its class.
LINK, EDGE, HEAD, LEAD = 0, 1, 2, 3


def met(seeds: DataFrame) -> DataFrame:
    """role, h, kind, a, a_pos, b, b_pos. LINK: an occurrence (b, b_pos) and its class's representative (a, a_pos); of one document only where
    the class has others, too. EDGE: an occurrence in the class with which a range begins; HEAD: the least occurrence in a range of the
    classes with which it begins and ends. Which rows are EDGE depends on the ranges, what links() makes of them does not."""
    parts = max(shuffle_width(seeds.sparkSession), -(-seeds.count() // SORTED))
    spread = seeds.repartitionByRange(parts, "h", "doc", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("h", "doc", "pos")] for b in batches if b.num_rows]
        if not held:
            return
        h, doc, pos = in_order(*(np.concatenate(z) for z in zip(*held, strict=True)))
        del held
        kind, h = (h & 1).astype(np.int8), h & ~1
        opens = np.concatenate([[True], h[1:] != h[:-1]])
        at = np.maximum.accumulate(np.where(opens, np.arange(len(h)), 0))
        a, a_pos = doc[at], pos[at]
        before = np.concatenate([[0], np.cumsum(kind == 0)])
        many = before[1:] - before[at]  # documents of the class so far
        ends = np.unique([0, at[-1]])  # heads of the first and the last class
        yield _met(np.full(len(ends), HEAD), h[ends], kind[ends], doc[ends], pos[ends], doc[ends], pos[ends])
        edge = h == h[0]
        linked = np.flatnonzero(~edge & ((a != doc) | (kind == 1) & (many > 1)))
        role = np.where(np.concatenate([[True], at[linked[1:]] != at[linked[:-1]]]), LEAD, LINK)[: len(linked)]
        edge = np.flatnonzero(edge)
        for k in range(0, len(linked), GIVEN):
            some = linked[k : k + GIVEN]
            yield _met(role[k : k + GIVEN], h[some], kind[some], a[some], a_pos[some], doc[some], pos[some])
        for k in range(0, len(edge), GIVEN):
            some = edge[k : k + GIVEN]
            yield _met(np.full(len(some), EDGE), h[some], kind[some], doc[some], pos[some], doc[some], pos[some])

    return spread.mapInArrow(run, "role tinyint, h bigint, kind tinyint, a bigint, a_pos bigint, b bigint, b_pos bigint")


def order_of(h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows by hash, document and place, and where in it the rows are whose hash comes again. Most hashes come once, so only the others
    are sorted by more than that."""
    order = np.argsort(h)
    same = h[order]
    same = same[1:] == same[:-1]
    again = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    some = order[again]
    order[again] = some[np.lexsort((pos[some], doc[some], h[some]))]
    return order, again


def in_order(h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows sorted by hash, document and place."""
    order, _ = order_of(h, doc, pos)
    return h[order], doc[order], pos[order]


def _met(*columns: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int8(), pa.int64(), pa.int8(), *(pa.int64(),) * 4)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds, strict=True)], ["role", "h", "kind", "a", "a_pos", "b", "b_pos"])


def links(seeds: DataFrame) -> DataFrame:
    """a, a_pos, b, b_pos, lead: occurrences of seeds (SEED_ROWS) with the first of all documents' occurrences; a is not above b, and equals it for
    later occurrences in the first document. Every first occurrence is in a row, a few for each class, that has lead."""
    given = cut(seeds, "seeds")
    rows = cut(met(given), "met")
    drop_cut(given)
    # two heads a range at most
    heads = rows.filter(F.col("role") == HEAD).groupBy("h").agg(F.min(F.struct("kind", "a", "a_pos")).alias("head")).select(F.col("h").alias("of"), F.col("head.a").alias("first"), F.col("head.a_pos").alias("first_pos"))
    asked = rows.filter(F.col("role") != HEAD).join(F.broadcast(heads), F.when(F.col("role") == EDGE, F.col("h")) == F.col("of"), "left")
    out = asked.select(F.coalesce("first", "a").alias("a"), F.coalesce("first_pos", "a_pos").alias("a_pos"), "b", "b_pos", "kind", F.col("role").isin(EDGE, LEAD).alias("lead")).filter("a <> b or kind = 1").drop("kind")
    out._tejido_path = rows._tejido_path
    return out


class Fenwick:
    """Maxima of prefixes, with the number of the seed that holds each."""

    def __init__(self, n: int):
        self.n, self.score, self.who = n, [float("-inf")] * (n + 1), [-1] * (n + 1)

    def put(self, i: int, score: float, who: int) -> None:
        while i <= self.n:
            if score > self.score[i]:
                self.score[i], self.who[i] = score, who
            i += i & -i

    def best(self, i: int) -> tuple[float, int]:
        score, who = float("-inf"), -1
        while i:
            if self.score[i] > score:
                score, who = self.score[i], self.who[i]
            i -= i & -i
        return score, who


def chain(x: list[int], y: list[int]) -> list[list[int]]:
    """Chains of seeds (x, y), sorted by x and then y: both grow along a chain, whose score is K a seed less GAP for each word
    between successive seeds' places, on both sides. Every seed is in one chain at most, the best ones first."""
    n = len(x)
    rank = {v: k + 1 for k, v in enumerate(sorted(set(y)))}
    tree = Fenwick(len(rank))
    score, back = [0.0] * n, [-1] * n
    k = 0
    while k < n:
        stop = k
        while stop < n and x[stop] == x[k]:
            lead, who = tree.best(rank[y[stop]] - 1)
            gain = lead - GAP * (x[stop] + y[stop])
            score[stop] = K + max(0.0, gain)
            back[stop] = who if gain > 0 else -1
            stop += 1
        for i in range(k, stop):
            tree.put(rank[y[i]], score[i] + GAP * (x[i] + y[i]), i)
        k = stop
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = back[i]
        if len(path) >= SEEDS:
            out.append(path[::-1])
    return out


def chains(found: DataFrame) -> DataFrame:
    """id, a, b, a_seeds, b_seeds: chains of at least SEEDS seeds over SPAN words. Links are dealt by pairs of documents,
    whose number is bound by the documents' lengths."""
    dealt = found.repartition("a", "b").sortWithinPartitions("a", "b", "a_pos", "b_pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "a_pos", "b_pos")]
            rows = [np.concatenate(z) for z in zip(kept, new, strict=True)] if kept else new
            if not len(rows[0]):
                continue
            edge = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            edge = int(edge[-1]) + 1 if len(edge) else 0
            kept = [z[edge:] for z in rows]
            yield from done([z[:edge] for z in rows])
        if kept:
            yield from done(kept)

    def done(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b, x, y = rows
        if len(a) < 2:
            return
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        again = np.concatenate([[False], ~new[1:] & (x[1:] == x[:-1]) & (y[1:] == y[:-1])])
        a, b, x, y, new = (z[~again] for z in (a, b, x, y, new))
        starts = np.flatnonzero(new)
        stops = np.concatenate([starts[1:], [len(a)]])
        out: list[tuple] = []
        dx, dy = x[1:] - x[:-1], y[1:] - y[:-1]
        breaks = np.concatenate([[0], np.cumsum((dx <= 0) | (dy <= 0) | (dx + dy >= K / GAP))])  # before the step from each row to the next
        whole = breaks[stops - 1] == breaks[starts]  # all in order and close: one chain, as the tree would find
        wide = (stops - starts >= SEEDS) & (x[stops - 1] - x[starts] + K >= SPAN)
        for s, e, one in zip(starts[wide].tolist(), stops[wide].tolist(), whole[wide].tolist(), strict=True):
            xs, ys = x[s:e], y[s:e]
            for px, py in [(xs, ys)] if one else [(xs[p], ys[p]) for p in chain(xs.tolist(), ys.tolist())]:
                if min(px[-1] - px[0], py[-1] - py[0]) + K >= SPAN:
                    out.append((int(a[s]), int(b[s]), px, py))
        if out:
            ca, cb, cx, cy = zip(*out, strict=True)
            places = [pa.array([v.astype(np.int32) for v in z], pa.list_(pa.int32())) for z in (cx, cy)]
            yield pa.RecordBatch.from_arrays([pa.array(ca, pa.int64()), pa.array(cb, pa.int64()), *places], ["a", "b", "a_seeds", "b_seeds"])

    made = dealt.mapInArrow(run, "a bigint, b bigint, a_seeds array<int>, b_seeds array<int>")
    return made.withColumn("id", F.xxhash64("a", "b", F.col("a_seeds")[0], F.col("b_seeds")[0]))


def word_codes(docs: DataFrame) -> DataFrame:
    """doc_id, words (32 bits of each word's hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, counts = word_hashes(part.column("text"))
                flat = (h >> np.uint64(32)).astype(np.uint32)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * 4
                words = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), words], ["doc_id", "words"])

    return docs.mapInArrow(run, "doc_id bigint, words binary")


def with_words(found: DataFrame, codes: DataFrame) -> DataFrame:
    """id, side, start, words: for each chain and side, the document's words from MARGIN before it to MARGIN after it.

    A document meets the requests for it in one task, or, if they are many, in several, each of which serves SERVED at most.
    """
    ask = lambda side: found.select("id", F.lit(side).cast("tinyint").alias("side"), F.col("ab"[side]).alias("doc_id"), F.col(f"{'ab'[side]}_seeds")[0].alias("start"), (F.element_at(f"{'ab'[side]}_seeds", -1) + K).alias("stop"))
    asked = ask(0).unionByName(ask(1))
    parts = asked.groupBy("doc_id").agg(F.ceil(F.count("*") / SERVED).cast("int").alias("parts"))
    many = parts.filter("parts > 1")
    texts = codes.join(parts, "doc_id").select("doc_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "words")
    asking = asked.join(many, "doc_id", "left").withColumn("part", F.coalesce(F.pmod(F.hash("id"), F.col("parts")), F.lit(0))).drop("parts")
    no = lambda kind: F.lit(None).cast(kind)
    both = texts.select("doc_id", "part", "words", no("long").alias("id"), no("tinyint").alias("side"), no("int").alias("start"), no("int").alias("stop")).unionByName(asking.withColumn("words", no("binary")))
    dealt = both.repartition("doc_id", "part").sortWithinPartitions("doc_id", "part", F.col("words").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc = words = None
        for batch in batches:
            ids, docs, starts, stops, sides = (batch.column(c).to_pylist() for c in ("id", "doc_id", "start", "stop", "side"))
            out: list[tuple] = []
            size = 0
            for k, i in enumerate(ids):
                if i is None:
                    if doc != docs[k] or words is None:  # of rows that repeat a doc_id, the first is taken
                        doc, words = docs[k], batch.column("words")[k].as_py()
                elif docs[k] == doc:
                    start = max(0, starts[k] - MARGIN)
                    out.append((i, sides[k], start, words[4 * start : 4 * (stops[k] + MARGIN)]))
                    size += len(out[-1][-1])
                    if size > SLICE:
                        yield served(out)
                        out, size = [], 0
            if out:
                yield served(out)

    def served(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int8(), pa.int32(), pa.binary()), strict=True)], ["id", "side", "start", "words"])

    return dealt.mapInArrow(run, "id bigint, side tinyint, start int, words binary")


def same_words(x: np.ndarray, y: np.ndarray) -> int:
    """Words of x and y that an alignment can pair: those on the diagonal if x and y are of one length, or else a longest
    common subsequence."""
    if len(x) == len(y):
        return int(np.count_nonzero(x == y))
    if not len(x) or not len(y):
        return 0
    at: dict[int, int] = {}  # the places in y of each word, as bits
    for k, v in enumerate(y.tolist()):
        at[v] = at.get(v, 0) | 1 << k
    # bits of free, from below: places in y that add nothing to the common subsequence of x so far and y up to there
    free = every = (1 << len(y)) - 1
    for v in x.tolist():
        if take := free & at.get(v, 0):
            free = (free + take | free - take) & every
    return len(y) - free.bit_count()


def extension(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Words by which an alignment goes on along its diagonal, and how many of them are equal: the best score, a word's
    equality counting 1 and a difference -1, that is reached before the score falls by FALL."""
    n = min(len(x), len(y))
    score = same = top = length = within = 0
    for k in range(0, n, MARGIN):
        for j, equal in enumerate((x[k : min(n, k + MARGIN)] == y[k : min(n, k + MARGIN)]).tolist(), k + 1):
            if equal:
                score, same = score + 1, same + 1
                if score > top:
                    top, length, within = score, j, same
            else:
                score -= 1
                if top - score >= FALL:
                    return length, within
    return length, within


def align(x: np.ndarray, y: np.ndarray, x0: int, x1: int, y0: int, y1: int, inner: int) -> tuple[int, int, int, int, int]:
    """From and to in x and y, and equal words, of a chain of seeds from x0 and y0 to x1 and y1 with so many equal words (inner), extended."""
    left, same_left = extension(x[:x0][::-1], y[:y0][::-1])
    right, same_right = extension(x[x1:], y[y1:])
    return x0 - left, x1 + right, y0 - left, y1 + right, inner + same_left + same_right


def widened(x: np.ndarray, y: np.ndarray, found: tuple[int, int, int, int, int], words: int, similarity: float) -> tuple[int, int, int, int, int]:
    """found, or, where it has too few words because unequal ones stand at its ends, `words` words around it on its diagonals, if they are alike enough.
    No more of the words at the ends are unequal than of those between, so that what is the same word by word is not made longer."""
    a, b, c, d, same = found
    need = words - min(b - a, d - c)
    if need <= 0 or same + need < similarity * words:
        return found
    before, after = min(a, c, need), min(len(x) - b, len(y) - d, need)
    if before + after < need:
        return found
    left = np.concatenate([[0], np.cumsum(x[a - before : a][::-1] == y[c - before : c][::-1])])
    right = np.concatenate([[0], np.cumsum(x[b : b + after] == y[d : d + after])])
    k = np.arange(need - after, before + 1)  # words to the left
    more = left[k] + right[need - k]
    best = int(more.argmax())
    if same + more[best] < similarity * (max(b - a, d - c) + need) or need - more[best] > max(b - a, d - c) - same:
        return found
    return a - int(k[best]), b + need - int(k[best]), c - int(k[best]), d + need - int(k[best]), same + int(more[best])


def aligned(x: np.ndarray, y: np.ndarray, xs: np.ndarray, ys: np.ndarray, words: int, similarity: float) -> Iterator[tuple[int, int, int, int, int]]:
    """Alignments of a chain that are long and alike enough: of the whole, or else of the parts before and after the gap with
    the most unequal words."""
    dx, dy = np.diff(xs), np.diff(ys)
    between = np.zeros(len(dx), np.int64)  # words between each seed and the next that an alignment pairs
    for k in np.flatnonzero(np.minimum(dx, dy) > K).tolist():
        between[k] = same_words(x[xs[k] + K : xs[k + 1]], y[ys[k] + K : ys[k + 1]])
    lost = np.maximum(np.maximum(dx, dy) - K, 0) - between
    equal = [K, *(K + np.cumsum(np.minimum(K, np.minimum(dx, dy)) + between)).tolist()]  # up to each seed
    stack = [(0, len(xs))]
    while stack:
        i, j = stack.pop()
        inner = equal[j - 1] - equal[i] + K
        found = widened(x, y, align(x, y, int(xs[i]), int(xs[j - 1]) + K, int(ys[i]), int(ys[j - 1]) + K, inner), words, similarity)
        a, b, c, d, same = found
        if min(b - a, d - c) >= words and same >= similarity * max(b - a, d - c):
            yield found
        elif j - i > 1 and max(b - a, d - c) >= words:
            worst = int(np.argmax(lost[i : j - 1]))
            if lost[i + worst]:
                stack += [(i + 1 + worst, j), (i, i + 1 + worst)]


def shared_places(linked: DataFrame) -> DataFrame:
    """doc_id, places, holders: where the seeds of each document stand that come in several documents, sorted, and the document that holds each
    first. A document has fewer of them than words."""
    firsts = linked.filter("lead").select(F.col("a").alias("doc_id"), F.col("a_pos").alias("pos"), F.col("a").alias("holder")).distinct()
    later = linked.select(F.col("b").alias("doc_id"), F.col("b_pos").alias("pos"), F.col("a").alias("holder"))
    each = firsts.unionByName(later).repartition("doc_id").groupBy("doc_id", "pos").agg(F.min("holder").alias("holder"))
    listed = each.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "holder"))).alias("at"))
    return listed.select("doc_id", F.col("at.pos").alias("places"), F.col("at.holder").alias("holders"))


def _parts(column: pa.Array, kind: type) -> Callable[[int], np.ndarray]:
    """The k-th value of a column of binaries or lists, as an array that shares its memory."""
    buffers, first, n = column.buffers(), column.offset, len(column)
    ends = np.frombuffer(buffers[1], np.int32)[first : first + n + 1]
    if pa.types.is_list(column.type):
        data = column.values.to_numpy(zero_copy_only=False)
        return lambda k: data[ends[k] : ends[k + 1]]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return lambda k: data[ends[k] : ends[k + 1]].view(kind)


def least_of_next(h: np.ndarray, n: int) -> np.ndarray:
    """The least of each n successive values."""
    size = 1
    while 2 * size <= n:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (n - size)], h[n - size :]) if n > size else h


def runs_of(words: np.ndarray, places: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Anchor, place and hashes of successive runs of `size` words that have their least k-mer, the anchor, in common; only runs of
    words that have a shared seed in each stretch of WINDOW k-mers."""
    if len(words) < size or not len(places):
        return
    cuts = np.flatnonzero(np.diff(places) > WINDOW)
    starts, stops = places[np.concatenate([[0], cuts + 1])] - WINDOW + 1, places[np.concatenate([cuts, [len(places) - 1]])] - (size - K - WINDOW + 1)
    starts, stops = np.maximum(starts, 0), np.minimum(stops, len(words) - size) + 1
    up, down = powers(len(words))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((words.astype(np.uint64) + np.uint64(1)) * up[: len(words)])])
    gram = lambda n, a, b: mixed_bits((sums[a + n : b + n] - sums[a:b]) * down[a:b])
    for a, b in zip(starts[starts < stops].tolist(), stops[starts < stops].tolist(), strict=True):
        anchor = least_of_next(gram(K, a, b + size - K), size - K + 1)
        whole = gram(size, a, b)
        edges = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]]))
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            for k in range(i, j, RUNS):  # one k-mer over and over
                yield int(anchor[i].view(np.int64)), a + k, whole[k : min(j, k + RUNS)]


def same_runs(codes: DataFrame, places: DataFrame, words: int) -> tuple[DataFrame, list[DataFrame]]:
    """first_id, first_start, doc_id, start, n_words: every run of at least `words` words that an earlier document holds word by word,
    against the first document that holds the `words` words from each place on; a run is cut where that document, or its place, changes.
    Also the tables that it reads, to be dropped."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "words", SLICE):
                ids, texts, at = part.column("doc_id").to_pylist(), _parts(part.column("words"), np.uint32), _parts(part.column("places"), np.int64)
                out: list[tuple] = []
                for k, doc in enumerate(ids):
                    for anchor, place, grams in runs_of(texts(k), at(k).astype(np.int64), words):
                        data = grams.tobytes()
                        out.append((anchor, xxhash.xxh3_64_intdigest(data) - (1 << 63), doc, place, data))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["anchor", "digest", "doc", "pos", "grams"])

    runs = cut(codes.join(places.select("doc_id", "places"), "doc_id").mapInArrow(hashed, "anchor bigint, digest bigint, doc bigint, pos int, grams binary"), "runs")
    classes = runs.groupBy("anchor", "digest").agg(F.min(F.struct("doc", "pos", "grams")).alias("lead")).select("anchor", "digest", "lead.*")
    crowded = cut(runs.select("anchor", "digest").distinct().groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > CLASSES).select("anchor"), "crowded")
    tables, usual = [runs, crowded], classes
    any_crowded = not crowded.isEmpty()
    if any_crowded:  # the classes are read by two branches then
        classes = cut(classes, "classes")
        tables.append(classes)
        usual = classes.join(crowded, "anchor", "left_anti")
    spread = usual.repartition("anchor").sortWithinPartitions("anchor", "doc", "pos")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            for part in slices(batch, "grams", SLICE):
                rows = pa.concat_tables([kept, pa.table(part)]).combine_chunks() if kept is not None else pa.table(part)
                anchor = rows["anchor"].to_numpy()
                edge = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
                kept = rows.slice(edge)
                if edge:
                    yield first_holders(rows.slice(0, edge))
        if kept is not None:
            yield first_holders(kept)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "grams", SLICE):
                sizes = pc.binary_length(part.column("grams")).to_numpy(zero_copy_only=False).astype(np.int64) // 8
                row = np.repeat(np.arange(len(sizes)), sizes)
                off = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                gram = np.frombuffer(b"".join(part.column("grams").to_pylist()), np.int64)
                anchor, digest, doc, pos = (pa.array(part.column(c).to_numpy(zero_copy_only=False)[row]) for c in ("anchor", "digest", "doc", "pos"))
                yield pa.RecordBatch.from_arrays([anchor, digest, pa.array(off, pa.int32()), pa.array(gram), doc, pos], ["anchor", "digest", "off", "gram", "doc", "pos"])

    held = spread.mapInArrow(told, "anchor bigint, digest bigint, off int, n int, a bigint, a_pos int")
    if any_crowded:
        apart = classes.join(crowded, "anchor", "left_semi").mapInArrow(each, "anchor bigint, digest bigint, off int, gram bigint, doc bigint, pos int")
        first = apart.groupBy("anchor", "gram").agg(F.min(F.struct("doc", "pos", "off")).alias("first"))
        held = held.unionByName(apart.join(first, ["anchor", "gram"]).select("anchor", "digest", "off", F.lit(1).alias("n"), F.col("first.doc").alias("a"), (F.col("first.pos") + F.col("first.off")).alias("a_pos")))
    tied = runs.select("anchor", "digest", "doc", "pos").join(held, ["anchor", "digest"]).filter("a < doc").select("a", "a_pos", F.col("doc").alias("b"), (F.col("pos") + F.col("off")).alias("b_pos"), "n")
    dealt = tied.repartition("a", "b").sortWithinPartitions("a", "b", F.col("b_pos") - F.col("a_pos"), "b_pos")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the run that the rows so far ended with: a, its place, b, its places from and to
        for batch in batches:
            a, x, b, y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "a_pos", "b", "b_pos", "n"))
            if not len(a):
                continue
            stop = y + n
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (y[1:] - x[1:] != y[:-1] - x[:-1]) | (y[1:] > stop[:-1])])
            starts = np.flatnonzero(new)
            ends = np.maximum.reduceat(stop, starts)
            out = [z.astype(np.int64) for z in (a[starts], x[starts], b[starts], y[starts], ends)]
            if kept is not None:
                ka, kx, kb, ky, kz = kept
                if ka == out[0][0] and kb == out[2][0] and ky - kx == out[3][0] - out[1][0] and out[3][0] <= kz:
                    out[1][0], out[3][0], out[4][0] = kx, ky, max(kz, out[4][0])
                else:
                    out = [np.concatenate([[v], z]) for v, z in zip(kept, out, strict=True)]
            kept = [z[-1] for z in out]
            yield shown([z[:-1] for z in out])
        if kept is not None:
            yield shown([np.array([v], np.int64) for v in kept])

    def shown(out: list[np.ndarray]) -> pa.RecordBatch:
        a, x, b, y, z = out
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(x, pa.int32()), pa.array(b), pa.array(y, pa.int32()), pa.array(z - y + words - 1, pa.int32())], ["first_id", "first_start", "doc_id", "start", "n_words"])

    return dealt.mapInArrow(joined, "first_id bigint, first_start int, doc_id bigint, start int, n_words int"), tables


def first_holders(rows: pa.Table) -> pa.RecordBatch:
    """anchor, digest, off, n, a, a_pos: for each row (anchor, digest, doc, pos, grams; sorted by anchor, doc, pos), the stretches of its grams
    that the same document holds first, in the same order. Equal grams have equal anchors."""
    data = rows["grams"].combine_chunks()
    data = data.chunk(0) if isinstance(data, pa.ChunkedArray) else data
    sizes = pc.binary_length(data).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    gram = np.frombuffer(b"".join(data.to_pylist()), np.uint64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    off = np.arange(len(gram)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    anchor, digest, doc, pos = (rows[c].to_numpy() for c in ("anchor", "digest", "doc", "pos"))
    order = np.lexsort((np.arange(len(gram)), gram, anchor[row]))
    g, w = gram[order], anchor[row][order]
    opens = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
    lead = np.empty(len(gram), np.int64)
    lead[order] = order[np.maximum.accumulate(np.where(opens, np.arange(len(g)), 0))]
    a, a_pos = doc[row[lead]], pos[row[lead]] + off[lead]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (a_pos[1:] != a_pos[:-1] + 1)])
    at = np.flatnonzero(new)
    n = np.diff(np.concatenate([at, [len(gram)]]))
    return pa.RecordBatch.from_arrays([pa.array(anchor[row[at]]), pa.array(digest[row[at]]), pa.array(off[at], pa.int32()), pa.array(n, pa.int32()), pa.array(a[at]), pa.array(a_pos[at], pa.int32())], ["anchor", "digest", "off", "n", "a", "a_pos"])


def left_over(places: np.ndarray, holders: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From and to places of pairs of shared seeds (places, sorted) that other documents hold first each; of the seeds that no span (starts,
    stops) holds, in stretches of at least EXTENT words."""
    if len(starts):
        marks = np.zeros(len(places) + 1, np.int64)
        np.add.at(marks, np.searchsorted(places, starts), 1)
        np.add.at(marks, np.searchsorted(places, np.maximum(starts, stops - K + 1)), -1)
        free = np.cumsum(marks[:-1]) == 0
        places, holders = places[free], holders[free]
    if len(places) < 2:
        return places[:0], places[:0]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(places) > NEAR) + 1, [len(places)]])
    long = np.repeat(places[edges[1:] - 1] - places[edges[:-1]] + K >= EXTENT, np.diff(edges))
    places, holders = places[long], holders[long]
    pairs = [(places[:-j][apart], places[j:][apart]) for j in range(1, min(PAIRS, len(places) - 1) + 1) for apart in [(places[j:] - places[:-j] <= REACH) & (holders[j:] != holders[:-j])]]
    return tuple(np.concatenate(z) for z in zip(*pairs, strict=True)) if pairs else (places[:0], places[:0])


def pair_rows(docs: DataFrame, places: DataFrame, covered: DataFrame) -> DataFrame:
    """SEED_ROWS of pairs of shared seeds (places) that no passage found so far (covered: doc_id, start, stop) holds; pos is the first one's place times
    64, plus the distance of the second. What holds a pair holds both parts of a text that have other first holders each."""
    spans = covered.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    both = places.join(spans, "doc_id", "left").select("doc_id", "places", "holders", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                each = [_parts(part.column(c), np.int64) for c in ("places", "holders", "starts", "stops")]
                left = [left_over(*(of(i).astype(np.int64) for of in each)) for i in range(part.num_rows)]
                some = [i for i, v in enumerate(left) if len(v[0])]
                if some:
                    ends = [pa.array([left[i][k].astype(np.int32) for i in some], pa.list_(pa.int32())) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(some)), *ends], ["doc_id", "ones", "others"])

    left = cut(both.mapInArrow(keep, "doc_id bigint, ones array<int>, others array<int>"), "left")
    texts = docs.join(left, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, counts = word_hashes(part.column("text"))
                begin = np.cumsum(counts) - counts
                ones = part.column("ones").to_pylist()
                text = np.repeat(np.arange(len(ones)), [len(p) for p in ones])
                one, other = np.array([x for p in ones for x in p], np.int64), np.array([x for p in part.column("others").to_pylist() for x in p], np.int64)
                held = other + K <= counts[text]  # else the places are those of another row with this doc_id
                text, one, other = text[held], one[held], other[held]
                h = np.zeros((2, len(one)), np.uint64)
                for j in range(K):
                    for k, at in enumerate((one, other)):
                        h[k] = h[k] * np.uint64(0x2545F4914F6CDD1D) + words[begin[text] + at + j]
                h, pos = mixed_bits(mixed_bits(h[0]) * np.uint64(3) + h[1]), one * 64 + other - one
                order = np.lexsort((pos, text, h))
                h, text, pos = h[order], text[order], pos[order]
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array((by_turn(h, text) & ~np.uint64(1)).view(np.int64)), pa.array(ids[text]), pa.array(pos)], ["h", "doc", "pos"])

    out = texts.mapInArrow(run, SEED_ROWS)
    out._tejido_path = left._tejido_path
    return out


PASSAGES = "first_id bigint, first_start int, first_stop int, doc_id bigint, start int, stop int, n_words int, n_same int, similarity double"


def alike(found: DataFrame, codes: DataFrame, words: int, similarity: float) -> DataFrame:
    """PASSAGES: the chains found (id, a, b, a_seeds, b_seeds), aligned on the words of both documents."""
    served = with_words(found, codes)
    asked = found.select("id", F.lit(None).cast("tinyint").alias("side"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("binary").alias("words"), "a", "b", "a_seeds", "b_seeds")
    both = asked.unionByName(served, allowMissingColumns=True).repartition("id").sortWithinPartitions("id", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = x = None  # the chain (id, a, b, and its seeds), and the words of its first side from a place on
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
        names = [c.split()[0] for c in PASSAGES.split(", ")]
        for batch in batches:
            ids, sides, starts, a_ids, b_ids = (batch.column(c).to_pylist() for c in ("id", "side", "start", "a", "b"))
            words_of = _parts(batch.column("words"), np.uint32)
            a_seeds, b_seeds = (_parts(batch.column(c), np.int32) for c in ("a_seeds", "b_seeds"))
            out: list[tuple] = []
            for k, side in enumerate(sides):
                if side is None:
                    now, x = (ids[k], a_ids[k], b_ids[k], a_seeds(k).astype(np.int64), b_seeds(k).astype(np.int64)), None
                elif now is not None and ids[k] == now[0]:
                    if side == 0:
                        x = starts[k], words_of(k)
                    elif x is not None:
                        (x0, xw), y0, yw = x, starts[k], words_of(k)
                        xs, ys = now[3] - x0, now[4] - y0
                        if xs[-1] + K > len(xw) or ys[-1] + K > len(yw):  # another row of a repeated doc_id
                            continue
                        for a, b, c, d, same in aligned(xw, yw, xs, ys, words, similarity):
                            out.append((now[1], a + x0, b + x0, now[2], c + y0, d + y0, d - c, same, same / max(b - a, d - c)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([int(v) if i < 8 else float(v) for v in c], t) for i, (c, t) in enumerate(zip(zip(*out, strict=True), kinds, strict=True))], names)

    return both.mapInArrow(run, PASSAGES)


def beside(rows: DataFrame, told: DataFrame) -> DataFrame:
    """rows (PASSAGES) that are not within one of told against the same document."""
    by = told.select(F.col("first_id").alias("by"), F.col("doc_id").alias("of"), F.col("start").alias("from"), F.col("stop").alias("to"))
    inside = (F.col("first_id") == F.col("by")) & (F.col("doc_id") == F.col("of")) & (F.col("start") >= F.col("from")) & (F.col("stop") <= F.col("to"))
    return rows.join(by, inside, "left_anti")


def passages(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of docs that come, alike, in an earlier document: word numbers [start, stop) in doc_id, and in first_id, whose id is less.

    A passage has `words` words on both sides, and a share of at least `similarity` of equal words. A passage that comes in many documents
    gives a row or two for each but the first, not one for each pair. What an earlier document holds word by word is within rows, whole; what is
    alike is found against the documents that hold its seeds first or, where those hold less than a passage of it, against the first that hold two of its
    seeds close together. Rows follow from the documents, not from how they are dealt to tasks.
    Documents with a null doc_id or text, and texts of fewer than K words, have no passages; of rows that repeat a doc_id one is taken, that with the
    least text (by bytes). Of equal alignments the one that begins first is taken. Texts of any length are taken whole. Words are compared
    by 32 bits of a hash. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).filter("doc_id is not null and text is not null")
    spark, once = rows.sparkSession, None
    if not rows.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = once = cut(rows.groupBy("doc_id").agg(F.min("text").alias("text")), "once")
    linked = links(seed_rows(rows))
    found, places = cut(chains(linked.filter("a <> b").drop("lead")), "chains"), cut(shared_places(linked), "places")
    drop_cut(linked)
    del linked
    release(spark)
    codes = word_codes(rows)
    first = cut(alike(found, codes, words, similarity), "alike")
    drop_cut(found)
    del found
    release(spark)
    runs, tables = same_runs(codes, places, words)
    stop = F.col("start") + F.col("n_words")
    runs = runs.select("first_id", "first_start", (F.col("first_start") + F.col("n_words")).alias("first_stop"), "doc_id", "start", stop.alias("stop"), "n_words", F.col("n_words").alias("n_same"), F.lit(1.0).alias("similarity"))
    same = cut(beside(runs, first), "same")
    for table in tables:
        drop_cut(table)
    told = first.unionByName(same)
    pairs = pair_rows(rows, places, told)
    tied = links(pairs)
    at = lambda side, plus: (F.shiftright(f"{side}_pos", 6) + F.lit(plus) * F.col(f"{side}_pos").bitwiseAND(63)).alias(f"{side}_pos")
    each = tied.filter("a <> b").select("a", "b", F.explode(F.array(*[F.struct(at("a", k), at("b", k)) for k in (0, 1)])).alias("x")).select("a", "b", "x.*")
    more = cut(chains(each), "chains")
    drop_cut(tied)
    drop_cut(pairs)
    others = None
    if not more.isEmpty():
        of = more.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        others = cut(alike(more, word_codes(rows.join(of, "doc_id", "left_semi")), words, similarity), "alike")
    out = cut(told if others is None else told.unionByName(beside(others, told)), "passages")
    for table in (first, same, places, more, others, once):
        if table is not None:
            drop_cut(table)
    return out


def cut_repeats(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """docs without the passages that an earlier document holds, all columns; documents that are left empty go.

    The first occurrence stays. A passage goes with the white space after it. n_chars, if there is such a column, is set anew for
    texts that were cut. Rows with a null doc_id or text stay as they are; so do rows that repeat a doc_id with a text that has
    fewer words than the passage's end.
    """
    spans = passages(docs, words, similarity).groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    own, mark = fresh("spans", docs.columns), fresh("id", docs.columns)
    marked = docs.withColumn(mark, F.col("doc_id").cast("long")).join(spans.select(F.col("doc_id").alias(f"{mark}_"), F.col("spans").alias(own)), F.col(mark) == F.col(f"{mark}_"), "left").drop(mark, f"{mark}_")
    names = [f.name for f in docs.schema.fields]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts, spans_ = part.column("text").to_pylist(), part.column(own).to_pylist()
                stay = np.ones(len(texts), bool)
                sizes = part.column("n_chars").to_pylist() if "n_chars" in names else None
                for k, (text, spans__) in enumerate(zip(texts, spans_, strict=True)):
                    if text is not None and spans__:
                        texts[k] = without(text, [(s["start"], s["stop"]) for s in spans__])
                        stay[k] = bool(texts[k].strip())
                        if sizes is not None:
                            sizes[k] = len(texts[k])
                columns = {c: part.column(c) for c in names}
                columns["text"] = pa.array(texts, pa.string())
                if sizes is not None:
                    columns["n_chars"] = pa.array(sizes, part.column("n_chars").type)
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names).filter(pa.array(stay))

    return marked.mapInArrow(run, schema)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """text less the words [start, stop) of each span, with the white space that follows them."""
    import re

    at = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    out, done = [], 0
    for start, stop in sorted(spans):
        if stop >= len(at):  # the span is of another text
            continue
        if at[start] > done:
            out.append(text[done : at[start]])
        done = max(done, at[stop])
    return "".join([*out, text[done:]])
