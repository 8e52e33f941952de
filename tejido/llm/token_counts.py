"""Token counts at every prefix by dynamic programming (operator 8).

Within a piece of the splitting pattern, the encoding of every prefix ends in one token, and what stands before that
token is the encoding of a shorter prefix. So one pass from left to right finds, for each place, the one
token ending there that can follow the last token of the shorter prefix, and one more than that prefix's count.
Two tokens can follow each other if merging their joined bytes yields just them; that is decided by undoing their
merges from the inside, comparing ranks, without encoding anything again. All distinct pieces of a batch
go through the pass together, as rows of a padded matrix; the tokens that begin at a place are found by
walking a trie for all rows at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import IntTable, slices

#: Splits text before the merges; the byte-level pre-tokenizer's fixed pattern.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces of more bytes go through the pass alone.
LONG = 64
#: Pieces whose counts a worker keeps; beyond that it starts anew.
CACHE = 400_000
ROWS = 16_384


def read_vocabulary(path: str) -> bytes:
    """The tokenizer file's bytes, read on the driver; at most 8 MB, which closures may carry."""
    with open(path, "rb") as f:
        data = f.read((8 << 20) + 1)
    if len(data) > 8 << 20:
        raise ValueError(f"{path} holds more than 8 MB; it travels to every task")
    return data


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Counter:
    """Merges of one byte-level vocabulary. Token numbers here: a byte's value, or 256 plus the rank of its merge."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only plain byte-level BPE files are read")
        added = [t for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take in their surroundings are not read")
        self.specials = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if added else None
        self.pattern = regex.compile(SPLIT)
        symbol = byte_symbols()
        number = {s: b for s, b in symbol.items()}
        parts = np.empty((256 + len(model["merges"]), 2), np.int64)
        parts[:256] = np.arange(256)[:, None]
        keys = np.empty(len(model["merges"]), np.int64)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            if a + b in number:
                raise ValueError("a token with two merges")
            parts[256 + rank] = number[a], number[b]
            keys[rank] = number[a] << 32 | number[b]
            number[a + b] = 256 + rank
        self.left, self.right = parts[:, 0].copy(), parts[:, 1].copy()
        self.merged = IntTable(keys, 256 + np.arange(len(keys), dtype=np.int32))
        self.cache: dict[str, int] = {}
        self._trie({token: [symbol[c] for c in token] for token in number}, number)
        self.pair_memo: dict[int, bool] = {}

    def _trie(self, tokens: dict[str, list[int]], number: dict[str, int]) -> None:
        nodes: dict[int, int] = {}
        token_at = [-1]
        for token, path in tokens.items():
            node = 0
            for b in path:
                key = node << 8 | b
                if key not in nodes:
                    nodes[key] = len(token_at)
                    token_at.append(-1)
                node = nodes[key]
            token_at[node] = number[token]
        self.step = IntTable(np.array(list(nodes), np.int64), np.array(list(nodes.values()), np.int32))
        self.steps = nodes
        self.token_at = np.array(token_at, np.int64)
        self.token_list = token_at

    def follows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the joined bytes of first and second are encoded as just those two tokens, for arrays of tokens."""
        out = np.ones(len(first), bool)
        a, b, limit = first.copy(), second.copy(), np.full(len(first), 2**40, np.int64)
        rows = np.arange(len(first))
        while len(rows):
            joined = self.merged.get(a << 32 | b).astype(np.int64)
            bad = (joined >= 0) & (joined < limit)
            out[rows[bad]] = False
            undo_first = a > b
            limit = np.where(undo_first, a, b + 1)
            right_of, left_of = self.right[a], self.left[b]
            a_next, b_next = np.where(undo_first, right_of, a), np.where(undo_first, b, left_of)
            # a byte can't be undone: then the other token is, down to the smaller limit
            stuck_first = undo_first & (a_next == a)
            b_next = np.where(stuck_first, left_of, b_next)
            stuck_second = ~undo_first & (b_next == b)
            a_next = np.where(stuck_second, right_of, a_next)
            limit = np.where(stuck_first, b + 1, np.where(stuck_second, a, limit))
            over = bad | (stuck_first & (left_of == b)) | (stuck_second & (right_of == a))
            go = ~over
            rows, a, b, limit = rows[go], a_next[go], b_next[go], limit[go]
        return out

    def follows_one(self, a: int, b: int) -> bool:
        key = a << 32 | b
        if key not in self.pair_memo:
            if len(self.pair_memo) > 500_000:
                self.pair_memo.clear()
            self.pair_memo[key] = bool(self.follows(np.array([a], np.int64), np.array([b], np.int64))[0])
        return self.pair_memo[key]

    def matrix(self, pieces: list[bytes], width: int) -> np.ndarray:
        """Counts at every byte prefix, 0 to width, of pieces of at most width bytes; rows are padded with 0."""
        n = len(pieces)
        lens = np.array([len(p) for p in pieces], np.int64)
        data = np.zeros((n, width), np.int64)
        data[np.arange(width)[None, :] < lens[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        last, count = np.full((n, width + 1), -1, np.int64), np.zeros((n, width + 1), np.int32)
        for start in range(width):
            rows = np.flatnonzero(lens > start)
            node = np.zeros(len(rows), np.int64)
            for end in range(start + 1, width + 1):
                node = self.step.get(node << 8 | data[rows, end - 1]).astype(np.int64)
                alive = (node >= 0) & (lens[rows] >= end)
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                token = self.token_at[node]
                here = np.flatnonzero((token >= 0) & (last[rows, end] < 0))
                if not len(here):
                    continue
                at, found = rows[here], token[here]
                if start:
                    good = self.follows(last[at, start], found)
                    at, found = at[good], found[good]
                last[at, end] = found
                count[at, end] = count[at, start] + 1
        return count

    def long_prefixes(self, piece: bytes) -> np.ndarray:
        """The same for one piece of any length, in steps that grow with its length times that of the longest token."""
        n, steps, token_at = len(piece), self.steps, self.token_list
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            node, end = 0, start
            before, now = last[start], count[start] + 1
            while end < n and (node := steps.get(node << 8 | piece[end], -1)) >= 0:
                end += 1
                token = token_at[node]
                if token >= 0 and last[end] < 0 and (not start or self.follows_one(before, token)):
                    last[end], count[end] = token, now
        return np.array(count, np.int32)

    def prefixes(self, pieces: list[str]) -> list[np.ndarray]:
        """Counts at every byte prefix of each piece."""
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        by_width: dict[int, list[tuple[int, bytes]]] = {}
        for k, piece in enumerate(pieces):
            raw = piece.encode("utf-8", "surrogatepass")
            if len(raw) > LONG:
                out[k] = self.long_prefixes(raw)
            else:
                by_width.setdefault(4 * -(-len(raw) // 4), []).append((k, raw))
        for width, group in by_width.items():
            for at in range(0, len(group), ROWS):
                part = group[at : at + ROWS]
                counts = self.matrix([raw for _, raw in part], width)
                for (k, raw), row in zip(part, counts, strict=True):
                    out[k] = row[: len(raw) + 1]
        return out

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pieces of a text outside special strings, and the number of special strings."""
        if self.special is None or not any(s in text for s in self.specials):
            return self.pattern.findall(text), 0
        parts = self.special.split(text)
        return [x for part in parts for x in self.pattern.findall(part)], len(parts) - 1

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text: the count at its longest prefix."""
        split = [self.pieces(t) if t else ([], 0) for t in texts]
        if len(self.cache) > CACHE:
            self.cache = {}
        cache = self.cache
        new = list(set(chain.from_iterable(p for p, _ in split)).difference(cache))
        for k in range(0, len(new), ROWS):
            part = new[k : k + ROWS]
            for piece, counts in zip(part, self.prefixes(part), strict=True):
                cache[piece] = int(counts[-1])
        get = cache.__getitem__
        return [n + sum(map(get, p)) for p, n in split]

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Exact token counts of text[:0], text[:1], ... text[:len(text)], each as if that prefix were a text of its own."""
        text = text or ""
        out = np.zeros(len(text) + 1, np.int64)
        base, at = 0, 0
        cuts = [(m.start(), m.end()) for m in self.special.finditer(text)] if self.special else []
        for start, end in [*cuts, (len(text), len(text))]:
            self._segment(text, at, start, base, out)
            base = out[start]
            for stop in range(start + 1, end):  # a prefix that ends inside a special string holds that part as plain text
                out[stop] = out[at] + self._plain(text[at:stop])
            if end > start:
                base = out[end] = base + 1
            at = end
        return out

    def _plain(self, text: str) -> int:
        pieces = self.pattern.findall(text)
        return int(sum(c[-1] for c in self.prefixes(pieces)))

    def _segment(self, text: str, start: int, end: int, base: int, out: np.ndarray) -> None:
        segment = text[start:end]
        spans = [m.span() for m in self.pattern.finditer(segment)]
        tables = self.prefixes([segment[a:b] for a, b in spans])
        so_far = base
        for (a, b), counts in zip(spans, tables, strict=True):
            piece = segment[a:b]
            ends = np.cumsum([0, *(len(c.encode("utf-8", "surrogatepass")) for c in piece)])
            out[start + a + 1 : start + b + 1] = so_far + counts[ends[1:]]
            if len(piece) > 2 and piece[0] == "'":  # 're, 've, 'll: cut short, quote and letter part
                out[start + a + 2] = so_far + self._plain(piece[:2])
            if a and piece[0].isspace() and segment[a - 1].isspace():  # white space at a prefix's end is one piece
                first = a - 1
                while first and segment[first - 1].isspace():
                    first -= 1
                out[start + a + 1] = (out[start + first] if first else base) + self._plain(segment[first : a + 1])
            so_far += int(counts[-1])
        if end > start:
            out[end] = so_far


_counters: dict[tuple[int, int], Counter] = {}


def counter(data: bytes) -> Counter:
    """One for each vocabulary and worker."""
    key = (len(data), hash(data))
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(data)
    return _counters[key]


def count_tokens(df: DataFrame, vocabulary: bytes, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """df with the column `into`, bigint: tokens of the whole text, as the vocabulary's own library counts them.

    Special strings inside a text are one token each; nothing is added at its ends. A null or empty text has 0 tokens.
    All columns and repeated rows stay; a column called as `into` is replaced; an empty table stays empty.
    """
    kept = df.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for batch in batches:
            for part in slices(batch, text):
                counts = pa.array(own.count(part.column(text).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, counts], [*part.schema.names, into])

    return kept.mapInArrow(run, schema)


def count_prefixes(df: DataFrame, vocabulary: bytes, text: str = "text", into: str = "prefix_tokens") -> DataFrame:
    """df with the column `into`, array<bigint>: entry i is the exact token count of the text's first i code points.

    A null text counts as empty and has the one entry 0.
    """
    kept = df.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.ArrayType(T.LongType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for batch in batches:
            for part in slices(batch, text):
                counts = pa.array([own.prefix_counts(t) for t in part.column(text).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, counts], [*part.schema.names, into])

    return kept.mapInArrow(run, schema)


def fits(prefix_tokens: str, budget: int):
    """Code points of the longest prefix of at most `budget` tokens, read from the stored counts."""
    return F.expr(f"size({prefix_tokens}) - 1 - aggregate(transform(reverse({prefix_tokens}), x -> x > {int(budget)}), named_struct('n', 0, 'go', true), (s, x) -> named_struct('n', s.n + int(s.go and x), 'go', s.go and x), s -> s.n)")


def token_report(docs: DataFrame, vocabulary: bytes, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    counted = count_tokens(docs.select("doc_id", "text"), vocabulary)
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
