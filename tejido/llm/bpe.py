"""Byte-level BPE encoding and decoding with rank files (operator 9).

Each match of the splitting pattern is a piece. The distinct pieces of a batch that are not cached go
into padded matrices, one row a piece, pieces of like length together. In every round every row
merges its leftmost pair of least rank; ranks of pairs come from an exact hash table for the whole
matrix at once, and rows that can merge no further leave the matrix. For rows beyond LONG bytes a round a merge
would cost the square of the length; if every token ranks behind its parts, as trained vocabularies have it, a round merges
the pair of least rank in all its places, from left to right, which gives the same ids: a merge then makes no pair of less or equal rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import IntTable, slices

#: Bytes of a piece from which a round merges a pair in all its places.
LONG = 192
#: Pieces whose ids a worker keeps; beyond that it starts anew.
CACHE = 200_000
#: Rows of a matrix.
ROWS = 16_384
#: Larger than any rank.
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read on the driver; a vocabulary of at most 8 MB, which closures may carry."""
    with open(path, "rb") as f:
        data = f.read((8 << 20) + 1)
    if len(data) > 8 << 20:
        raise ValueError(f"{path} holds more than 8 MB; ranks travel to every task")
    return data


class Codec:
    """Ranks and pair table of one vocabulary, with the ids of the pieces seen of late."""

    def __init__(self, data: bytes, pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks: dict[bytes, int] = {}
        for line in data.splitlines():
            if line:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.size = max(self.ranks.values()) + 1
        keys, values = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.pairs = IntTable(np.array(keys, np.int64), np.array(values, np.int32))
        parts = np.array(keys, np.int64)
        #: Tokens that are part of one which ranks before them.
        self.late = np.zeros(self.size, bool)
        for half in (parts >> 32, parts & 0xFFFFFFFF):
            self.late[half[np.array(values, np.int64) < half]] = True
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()
        order = sorted(self.ranks.items(), key=lambda x: x[1])
        lengths = np.zeros(self.size, np.int64)
        for token, rank in order:
            lengths[rank] = len(token)
        self.lengths, self.starts = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(token for token, _ in order), np.uint8)
        self.known = np.zeros(self.size, bool)
        self.known[[rank for _, rank in order]] = True

    def forget(self) -> None:
        """An empty cache: the number of each piece, and where its ids begin among all that are kept."""
        self.cache: dict[str, int] = {}
        self.kept, self.kept_starts, self.kept_sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def merge_rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of pieces of at most width bytes."""
        n = len(pieces)
        out: list[np.ndarray] = [None] * n  # type: ignore[list-item]
        lens = np.array([len(p) for p in pieces], np.int64)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        column = np.arange(width)
        inside = column[None, :] < lens[:, None]
        ids = np.full((n, width), -1, np.int32)
        ids[inside] = self.byte_ids[flat]
        ranks = np.full((n, width), NONE, np.int32)  # of the pair that begins at each place
        if width > 1:
            r, c = np.nonzero(inside[:, 1:])
            ranks[r, c] = self._rank(ids[r, c], ids[r, c + 1])
        rows = np.arange(n)
        while len(rows):
            at = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            best = ranks[every, at]
            done = best == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[rows[k]] = ids[k, : lens[k]].copy()
                keep = ~done
                rows, ids, ranks, lens, at, best = rows[keep], ids[keep], ranks[keep], lens[keep], at[keep], best[keep]
                if not len(rows):
                    break
                width = int(lens.max())
                ids, ranks = ids[:, :width], ranks[:, :width]
                every = np.arange(len(rows))
                column = np.arange(width)
            # the pair's second id goes: what stands right of it moves one to the left
            source = column[None, :] + (column[None, :] > at[:, None])
            np.minimum(source, width - 1, out=source)
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            lens = lens - 1
            ids[every, at] = best
            ids[every, lens] = -1
            ranks[every, lens] = NONE
            ranks[every, np.maximum(lens - 1, 0)] = NONE
            right = np.flatnonzero(at + 1 < lens)
            ranks[right, at[right]] = self._rank(best[right], ids[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._rank(ids[left, at[left] - 1], best[left])
        return out

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.pairs.get(a.astype(np.int64) << 32 | b)
        return np.where(found < 0, NONE, found)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one piece of any length. A round merges the least pair in all its places, or in the first one only where its token is part
        of one that ranks before it, as that pair would come next."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        ranks = self._rank(ids[:-1], ids[1:])
        while len(ranks) and (best := ranks.min()) != NONE:
            at = np.flatnonzero(ranks == best)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))  # where places overlap, every second one goes
            at = at[(np.arange(len(at)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(at)]])))) % 2 == 0]
            if self.late[best]:
                at = at[:1]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids[at] = best
            ids, ranks = ids[stay], ranks[stay[1:]]
            at = at - np.arange(len(at))
            for near in (at[at > 0] - 1, at[at < len(ranks)]):
                ranks[near] = self._rank(ids[near], ids[near + 1])
        return ids

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of pieces into the cache."""
        new: list[tuple[str, np.ndarray]] = []
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            if (rank := self.ranks.get(raw)) is not None:
                new.append((piece, np.array([rank], np.int32)))
            elif len(raw) > LONG:
                new.append((piece, self.merge_long(raw)))
            else:
                by_width.setdefault(4 * -(-len(raw) // 4), []).append((piece, raw))
        for width, group in sorted(by_width.items()):
            for k in range(0, len(group), ROWS):
                part = group[k : k + ROWS]
                new += zip([piece for piece, _ in part], self.merge_rows([raw for _, raw in part], width), strict=True)
        if new:
            first = len(self.cache)
            self.cache.update(zip([piece for piece, _ in new], range(first, first + len(new)), strict=True))
            sizes = np.array([len(ids) for _, ids in new], np.int64)
            self.kept_starts = np.concatenate([self.kept_starts, len(self.kept) + np.cumsum(sizes) - sizes])
            self.kept_sizes = np.concatenate([self.kept_sizes, sizes])
            self.kept = np.concatenate([self.kept, *(ids for _, ids in new)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        pieces = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.cache) > CACHE:
            self.forget()
        self.learn(set(chain.from_iterable(pieces)).difference(self.cache))
        many = np.fromiter(map(len, pieces), np.int64, len(pieces))
        which = np.fromiter(map(self.cache.__getitem__, chain.from_iterable(pieces)), np.int64, int(many.sum()))
        sizes = self.kept_sizes[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.kept[np.arange(total) - np.repeat(ends - sizes - self.kept_starts[which], sizes)]
        sums, stops = np.concatenate([[0], ends]), np.cumsum(many)
        return ids, sums[stops] - sums[stops - many]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes one after another, and the number of bytes of each list of ids. An id that is no token: ValueError."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or not self.known[ids].all()):
            raise ValueError("ids that are in no vocabulary entry")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) - np.repeat(ends - lengths - self.starts[ids], lengths)
        sums = np.concatenate([[0], ends])
        stops = np.cumsum(counts)
        return self.flat[places], sums[stops] - sums[stops - counts]


_codecs: dict[tuple[int, int, str], Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    """One for each vocabulary and worker."""
    key = (len(data), hash(data), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(data, pattern)
    return _codecs[key]


def offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))


def encode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """df with the column `into`, array<int>: the ids of the whole text, each match of pattern by itself, no special tokens.

    A null or empty text has no ids. All columns stay; repeated rows are encoded each by itself; if df has a column
    called as `into`, the new one takes its place. An empty table gives an empty table.
    """
    kept = df.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part in slices(batch, text):
                ids, counts = own.encode(part.column(text).to_pylist())
                lists = pa.ListArray.from_arrays(offsets(counts), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, into])

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """df with the column `into`, binary: the bytes that the ids stand for. Null ids give null; an unknown id is an error."""
    kept = df.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.BinaryType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            step = 256
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                column = part.column(ids)
                counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat, sizes = own.decode(column.flatten().to_numpy(zero_copy_only=False), counts)
                valid = column.is_valid()
                made = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, offsets(sizes).buffers()[1], pa.py_buffer(flat)])
                if column.null_count:
                    import pyarrow.compute as pc

                    made = pc.if_else(valid, made, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, into])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: the ids that encode() gives, joined by commas, and the bytes that
    decode() gives for those ids, as SHA-256. Null and empty texts have no ids; texts of any length are taken whole; repeated rows have a
    row each. The digests are taken where the ids are made, so that neither goes through the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        name = list(map(str, range(own.size))).__getitem__
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = own.encode(part.column("text").to_pylist())
                flat, sizes = own.decode(ids, counts)
                a, b = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(sizes)])
                told = [hashlib.sha256(",".join(map(name, ids[a[k] : a[k + 1]].tolist())).encode()).hexdigest() for k in range(part.num_rows)]
                back = [hashlib.sha256(flat[b[k] : b[k + 1]].data).hexdigest() for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts), pa.array(told), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
