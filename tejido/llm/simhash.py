"""SimHash fingerprints and near-duplicate links by bit-sliced comparison (operator 3).

Fingerprints that differ in few bits agree on most of the blocks that 64 bits are cut into; so rows meet in buckets
of a choice of agreeing blocks. Within a bucket, fingerprints are stored as bit planes, one bit of 64 rows in a machine word.
A fingerprint is compared with 64 others at once: differing bits of each plane are added up in bitwise
carry-save counters, and words in which every row has come to differ in more bits than the radius are abandoned
half-way. Buckets beyond ROWS rows are cut into parts, and every two parts meet in a task.

Fingerprints of 64 bits tell copies with few changes; for a likeness of 0.8 of five-word shingles they are too short, as a tenth and more
of the bits differ. Wide fingerprints, of several hashes for each shingle, tell those from chance; their buckets are samples
of bits, enough of them that a pair within the radius misses all buckets with a probability of MISS at most.

Bits only name candidates where documents are deleted: keep_first() counts the shingles that texts have in common. Candidates that
hang together are cut into parts, and every two parts meet in a task, which ties those texts that are alike enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import cut, slices
from .components import connected_components, unite

#: Seed of the shingles' hash.
SEED = 42
#: Rows of a bucket, or of a part of one, that are compared in one place.
ROWS = 4096
#: Words (64 comparisons) that are under way at once.
WORDS = 1 << 15
#: Rows that a bucket is expected to hold at most, for the choice of blocks.
DENSITY = 8.0
#: Of a pair of wide fingerprints that differ in the radius, the probability of having no bucket in common.
MISS = 0.1
#: Least bits of a sample, and rows of a bucket, on average, from which samples grow.
SAMPLE, WIDE_DENSITY = 12, 1024
#: Share of shingles, of those that either text has, which near copies have in common.
LIKENESS = 0.8
#: Least texts of a part of candidates that are verified in one place, and parts that candidates are cut into while parts are small.
PART, PARTS = 128, 32
#: Shingles (8 bytes each) of a part of candidates on average, at most.
SHINGLES = 1 << 20
_LANES = np.uint64(0x0101010101010101)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of 64-bit hashes."""
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 255):  # eight counters of a byte in a word
        part = hashes[k : k + 255]
        for j in range(8):
            counts[j::8] += np.frombuffer(((part >> np.uint64(j)) & _LANES).sum(dtype=np.uint64).tobytes(), np.uint8)
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist()))


def fingerprint_text(text: str | None, words: int = 4) -> int:
    """Lower-cases A-Z, takes words between ASCII white space and their shingles, repeats included; no words: 0."""
    return majority(shingle_hashes(text, words))


def wide_fingerprint(text: str | None, words: int, lanes: int) -> list[int]:
    """64 bits a lane; the first is that of fingerprint_text(), the others are of further hashes, mixed from its hashes."""
    return wide_majority(shingle_hashes(text, words), lanes)


def wide_majority(h: np.ndarray, lanes: int) -> list[int]:
    out = [majority(h)]
    for k in range(1, lanes):
        x = h + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(majority(x ^ (x >> np.uint64(31))))
    return out


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    m = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    stops = ends[words - 1 :].tolist() if len(tokens) >= words else [len(joined)]
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:m].tolist(), stops, strict=True)), np.uint64, m)


def fingerprint(df: DataFrame, words: int = 4, text: str = "text", into: str = "simhash", lanes: int = 1) -> DataFrame:
    """df with the column `into`, binary: the fingerprint's bits, 8 bytes a lane, least byte first. Null text counts as empty:
    all bits 0. Rows and columns stay; a column called as `into` is replaced."""
    kept = df.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = [np.array(wide_fingerprint(t, words, lanes), np.uint64).tobytes() for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], [*part.schema.names, into])

    return kept.mapInArrow(run, schema)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of values (rows x lanes of 64 bits): plane b, word w holds bit b of rows 64 w to 64 w + 63, row 64 w lowest."""
    n, lanes = -(-len(values) // 64) * 64, values.shape[1]
    padded = np.zeros((n, lanes), np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8 * lanes), axis=1, bitorder="little")  # row, bit
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(of: np.ndarray, values: np.ndarray, rows: np.ndarray, words: np.ndarray, radius: int) -> np.ndarray:
    """For each (row, word), the lanes of the word whose fingerprints differ from the row's in at most radius bits."""
    out = np.zeros(len(rows), np.uint64)
    live = np.arange(len(rows))
    digits = radius.bit_length()
    zero = np.zeros(len(rows), np.uint64)
    state = [zero] * digits  # the bits of every lane's count, least first
    over, mine, total = zero, values[rows], len(of)
    for b in range(0, total, 2):
        own = mine[:, b // 64]
        x = of[b, words] ^ (_ALL * ((own >> np.uint64(b % 64)) & np.uint64(1)))
        y = of[b + 1, words] ^ (_ALL * ((own >> np.uint64(b % 64 + 1)) & np.uint64(1)))
        half = state[0] ^ x
        carry = (state[0] & x) | (half & y)  # two planes are saved into one carry
        state[0] = half ^ y
        for k in range(1, digits):
            state[k], carry = state[k] ^ carry, state[k] & carry
        over = over | carry
        if b % 16 == 14 or b + 2 >= total:
            far = over | _beyond(state, radius)
            if b + 2 >= total:
                out[live] = ~far
                return out
            keep = far != _ALL
            if keep.mean() < 0.8:
                live, words, mine, over = live[keep], words[keep], mine[keep], over[keep]
                state = [z[keep] for z in state]
                if not len(live):
                    return out
    return out


def _beyond(state: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is above radius."""
    above, equal = np.zeros_like(state[0]), np.full_like(state[0], _ALL)
    for k in reversed(range(len(state))):
        if radius >> k & 1:
            equal &= state[k]
        else:
            above |= equal & state[k]
            equal &= ~state[k]
    return above


def spanning(values: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (row, root) that tie together all rows that are linked within a group; rows are sorted by group."""
    n = len(values)
    root = np.arange(n)
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    stops = np.concatenate([starts[1:], [n]])
    stop_of = np.repeat(stops, stops - starts)
    of = planes(values)
    first, last = np.arange(1, n + 1) // 64, (stop_of - 1) // 64  # words that hold later rows of the same group
    many = np.maximum(0, np.where(np.arange(1, n + 1) < stop_of, last - first + 1, 0))
    ends = np.cumsum(many)
    at = 0
    while at < n:
        base = ends[at] - many[at]
        to = max(at + 1, int(np.searchsorted(ends, base + WORDS, side="right")))
        rows = np.repeat(np.arange(at, to), many[at:to])
        words = np.arange(len(rows)) - np.repeat(ends[at:to] - many[at:to] - base, many[at:to]) + first[rows]
        lanes = within(of, values, rows, words, radius)
        hit = np.flatnonzero(lanes)
        for k in range(0, len(hit), 4096):
            part = hit[k : k + 4096]
            bits = np.unpackbits(lanes[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            which, lane = np.nonzero(bits)
            i, j = rows[part[which]], words[part[which]] * 64 + lane
            good = (j > i) & (j < stop_of[i])
            unite(root, i[good], j[good])
        at = to
    tied = np.flatnonzero(root != np.arange(n))
    return tied, root[tied]


def block_choice(n: int, radius: int) -> int:
    """Blocks to cut 64 bits into, so that n random fingerprints leave about DENSITY to a bucket."""
    for blocks in range(radius + 1, 2 * radius + 5):
        bits = 64 * (blocks - radius) // blocks
        if n / 2**bits <= DENSITY:
            break
    return blocks


def exact_masks(n: int, radius: int) -> list[np.ndarray]:
    """Bits of each bucket's key: for each choice of blocks, those of the blocks. Fingerprints of 64 bits within the radius agree
    on all blocks of at least one choice."""
    blocks = block_choice(n, radius)
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [np.concatenate([np.arange(edges[k], edges[k + 1]) for k in chosen]) for chosen in combinations(range(blocks), blocks - radius)]


def sampled_masks(n: int, radius: int, bits: int) -> list[np.ndarray]:
    """Bits of each bucket's key: samples of a size that leaves at most about WIDE_DENSITY of n to a bucket, and as many as MISS asks for."""
    size = max(SAMPLE, min(30, math.ceil(math.log2(max(2, n / WIDE_DENSITY)))))
    same = math.prod((bits - radius - k) / (bits - k) for k in range(size))
    rng = np.random.default_rng(SEED)
    return [np.sort(rng.choice(bits, size, replace=False)) for _ in range(math.ceil(math.log(MISS) / math.log(1 - same)))]


def near_links(classes: DataFrame, radius: int = 4, lanes: int = 1) -> DataFrame:
    """a, b (bigint): links among classes (id, simhash; each simhash once) that join up all within the radius of each other.

    Not all pairs are given, but every two fingerprints within the radius are joined by a path of links, since within a bucket a
    tree is enough: with one lane always, with more but for the probability MISS.
    """
    n = classes.count()
    masks = exact_masks(n, radius) if lanes == 1 else sampled_masks(n, radius, 64 * lanes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                bits = np.unpackbits(unpacked(part.column("simhash")).view(np.uint8), axis=1, bitorder="little")
                for t, mask in enumerate(masks):
                    key = np.zeros((len(bits), 8), np.uint8)
                    packed = np.packbits(bits[:, mask], axis=1, bitorder="little")
                    key[:, : packed.shape[1]] = packed
                    key = (key.view(np.int64)[:, 0] << 16 | t) if len(mask) <= 47 else key.view(np.int64)[:, 0] ^ t
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(key)], [*part.schema.names, "bucket"])

    placed = classes.select("id", "simhash").mapInArrow(place, "id bigint, simhash binary, bucket bigint")
    large = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > ROWS)
    parts = F.ceil(F.col("n") / ROWS).cast("int")
    own = F.pmod(F.xxhash64("simhash"), parts).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.xxhash64("bucket", F.least(k, own), F.greatest(k, own)))
    groups = F.when(F.col("n").isNull(), F.array(F.col("bucket"))).otherwise(pairs)
    dealt = placed.join(large, "bucket", "left").select("id", "simhash", F.explode(groups).alias("group"))
    # sorted by id too, a tree's root is the least id; the trees of most buckets then have the same links
    spread = dealt.repartition("group").sortWithinPartitions("group", "id")
    return spread.mapInArrow(lambda batches: _compared(batches, radius), "a bigint, b bigint")


def unpacked(column: pa.Array) -> np.ndarray:
    """Fingerprints as rows x lanes."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint64).reshape(len(column), -1) if len(column) else np.empty((0, 1), np.uint64)


def _compared(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    kept: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column("group").to_numpy(zero_copy_only=False), unpacked(batch.column("simhash")), batch.column("id").to_numpy(zero_copy_only=False)]
        rows = [np.concatenate(x) for x in zip(kept, new, strict=True)] if kept else new
        edge = int(np.searchsorted(rows[0], rows[0][-1]))  # the last group may go on
        kept = [x[edge:] for x in rows]
        yield from _tied([x[:edge] for x in rows], radius)
    if kept:
        yield from _tied(kept, radius)


def _tied(rows: list[np.ndarray], radius: int) -> Iterator[pa.RecordBatch]:
    groups, values, ids = rows
    if len(groups) < 2:
        return
    same = groups[1:] == groups[:-1]
    paired = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    groups, values, ids = groups[paired], values[paired], ids[paired]
    if len(groups):
        i, j = spanning(values, groups, radius)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(ids[i], pa.int64()), pa.array(ids[j], pa.int64())], ["a", "b"])


def _labelled(docs: DataFrame, radius: int, words: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    prints = cut(fingerprint(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), words).drop("text"), "prints")
    classes = cut(prints.groupBy("simhash").agg(F.min("doc_id").alias("id")), "classes")
    linked = connected_components(near_links(classes.filter("id is not null"), radius))
    named = classes.join(linked, classes.id == linked.node, "left").select("simhash", F.coalesce("component", "id").alias("component_id"))
    return prints, prints.join(named, "simhash").select("doc_id", "simhash", "component_id")


def components(docs: DataFrame, radius: int = 4, words: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, simhash, component_id of every row of docs.

    component_id is the least doc_id reachable through links, itself included. Equal fingerprints, those of
    repeated rows and of texts without words too, link like any others. A null doc_id takes part only through rows of
    equal fingerprint; its component_id is theirs, null if there is none. No rows give no rows.
    """
    return _labelled(docs, radius, words, doc_id, text)[1]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return components(docs).select("doc_id", F.lower(F.concat(*[F.substring(F.hex("simhash"), 15 - 2 * k, 2) for k in range(8)])).alias("fingerprint"), "component_id")


def _shingle_sets(docs: DataFrame, words: int, lanes: int) -> DataFrame:
    """doc_id, simhash, shingles (128 bits of the set of its shingles), n_shingles of docs (doc_id, text). A shingle counts once in the simhash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                prints, keys, sizes = [], [], []
                for t in part.column("text").to_pylist():
                    hashes = np.unique(shingle_hashes(t, words))
                    sizes.append(len(hashes))
                    prints.append(np.array(wide_majority(hashes, lanes), np.uint64).tobytes())
                    keys.append(set_key(hashes))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints, pa.binary()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "simhash", "shingles", "n_shingles"])

    return docs.mapInArrow(run, "doc_id bigint, simhash binary, shingles binary, n_shingles bigint")


def _alike(docs: DataFrame, radius: int, words: int, lanes: int, likeness: float) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = cut(_shingle_sets(rows, words, lanes), "prints")
    classes = cut(prints.groupBy("shingles").agg(F.min("doc_id").alias("id"), F.min("simhash").alias("simhash"), F.min("n_shingles").alias("n_shingles")), "classes")
    named = classes.filter("id is not null")
    candidates = connected_components(near_links(named.select("id", "simhash"), radius, lanes))
    members = named.join(candidates, named.id == candidates.node).select("component", "id", "simhash", "shingles", "n_shingles")
    texts = rows.withColumnRenamed("doc_id", "id")
    linked = connected_components(verified(members.join(texts, "id"), words, radius, likeness))
    leads = classes.join(linked, classes.id == linked.node, "left").select("shingles", F.coalesce("component", "id").alias("component_id"))
    return prints, prints.join(leads, "shingles").select("doc_id", "component_id")


def set_key(hashes: np.ndarray) -> bytes:
    """128 bits of a set of distinct shingle hashes."""
    return xxhash.xxh3_128_digest(np.sort(hashes).tobytes())


def alike(texts: list[np.ndarray], values: np.ndarray, radius: int, likeness: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (row, root) that tie together texts (sorted, distinct shingle hashes) within the radius whose Jaccard likeness is at
    least `likeness`. Pairs that are tied already are passed over."""
    n = len(texts)
    root = np.arange(n)
    size = np.array([len(t) for t in texts], np.int64)
    number = np.unique(np.concatenate(texts), return_inverse=True)[1] if n else np.empty(0, np.int64)  # shingles as 0, 1, ...
    ends = np.cumsum(size)
    own = np.zeros(int(number.max(initial=-1)) + 1, bool)
    bits = values.view(np.uint8)
    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]).sum(axis=1, dtype=np.int64) <= radius) + i + 1
        near = near[(root[near] != root[i]) & (np.minimum(size[near], size[i]) >= likeness * np.maximum(size[near], size[i]))]
        if not len(near):
            continue
        mine = number[ends[i] - size[i] : ends[i]]
        own[mine] = True
        for j in near.tolist():
            if root[i] != root[j]:
                both = int(own[number[ends[j] - size[j] : ends[j]]].sum())
                if both >= likeness * (size[i] + size[j] - both):
                    low, high = sorted((int(root[i]), int(root[j])))
                    root[root == high] = low
        own[mine] = False
    tied = np.flatnonzero(root != np.arange(n))
    return tied, root[tied]


def verified(members: DataFrame, words: int, radius: int, likeness: float) -> DataFrame:
    """a, b (bigint): links among members (component, id, simhash, shingles, n_shingles, text) of one component that join up all that are alike.
    Components are cut into parts of PART members, or more if there are over PARTS parts, that have SHINGLES shingles at most on average, and every two
    parts meet in a task."""
    most = F.greatest(F.lit(PART), F.least(F.lit(ROWS), F.ceil(F.col("n") / PARTS)))
    counts = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total")).filter("n > 1")
    parts = F.least(F.col("n"), F.greatest(F.ceil(F.col("n") / most), F.ceil(F.col("total") / SHINGLES))).cast("int")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.xxhash64("component", F.least(k, own), F.greatest(k, own)))
    dealt = members.join(counts, "component").withColumn("group", F.explode(pairs)).select("group", "id", "simhash", "shingles", "text")
    spread = dealt.repartition("group").sortWithinPartitions("group", "id")

    def tie(group: list[tuple]) -> pa.RecordBatch:
        ids, prints, texts = zip(*group, strict=True)
        i, j = alike(list(texts), np.array([np.frombuffer(p, np.uint64) for p in prints]), radius, likeness)
        ids = np.array(ids, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for batch in batches:
            for part in slices(batch, "text"):
                for g, i, p, key, text in zip(*(part.column(c).to_pylist() for c in ("group", "id", "simhash", "shingles", "text")), strict=True):
                    if g != now:
                        if len(group) > 1:
                            yield tie(group)
                        now, group = g, []
                    hashes = np.unique(shingle_hashes(text, words))
                    if set_key(hashes) == key:  # else another row of a repeated id
                        group.append((i, p, hashes))
        if len(group) > 1:
            yield tie(group)

    return spread.mapInArrow(run, "a bigint, b bigint")


def keep_first(docs: DataFrame, radius: int = 52, words: int = 5, lanes: int = 4, likeness: float = LIKENESS) -> DataFrame:
    """One document of each component, that with the least doc_id, all columns; rows without an id stay.

    Texts are linked if they have `likeness` of their distinct five-word shingles in common. Of 256 bits, such texts differ in 39 on
    average, with a deviation of 6, and unrelated ones in 128 with a deviation of 8; those within the radius, two deviations above the
    former, are candidates, and their shingles are counted.

    Rows of one doc_id are one document: it stays if any of them leads its component, with each of its texts once.
    """
    prints, found = _alike(docs, radius, words, lanes, likeness)
    lead = F.max(F.col("doc_id") == F.col("component_id"))
    gone = found.groupBy("doc_id").agg(lead.alias("leads")).filter("not leads").select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    ids = prints.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("m")).first()
    if ids.n == ids.m:
        return kept
    again = prints.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 and doc_id is not null").select("doc_id")
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").unionByName(once.select(docs.columns)).select(docs.columns)
