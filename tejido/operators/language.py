"""Language of texts by rank profiles: each language's most frequent character n-grams in order, and how far out of place a text's own are.

After Cavnar and Trenkle, N-Gram-Based Text Categorization (1994). Profiles are learnt from labelled texts by an aggregate: tasks count the n-grams of their
texts in Arrow batches and hand on one row for each n-gram and language they met, which are summed up. A text is compared with each profile where it is.
N-grams are numbers, three code points of 21 bits from the left, so they sort as strings do; all texts of a part of a batch are counted as one array.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

#: Characters of the longest n-gram, and n-grams of a profile.
N, RANKS = 3, 400
#: Rows of counts that a task holds before it hands them on, and characters of the texts that are counted as one array (a longer text is one).
HELD, PART = 200_000, 1 << 19
#: Languages that profiles may be of; beyond is an error.
MOST_LANGUAGES = 256


_BITS = 21
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def parts(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts in order, PART characters and 2,048 of them at most at a time (so that numbers have 63 bits); null is an empty one."""
    part, size = [], 0
    for t in texts:
        if part and (size + len(t or "") > PART or len(part) == 2048):
            yield part
            part, size = [], 0
        part.append(t or "")
        size += len(t or "")
    if part:
        yield part


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text (its place), n-gram and count of the n-grams of 1 to N characters of each text's words in lower case, a word being letters between blanks, with a
    blank on either side; by text, then n-gram."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    of = np.repeat(np.arange(len(lowered) + 1), [1 + len(t) for t in lowered] + [1])  # a text begins with the blank before it
    codes[~_letters()[codes]] = 32
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes, of = codes[keep], of[keep]
    letter = codes != 32
    alphabet, short = np.unique(codes, return_inverse=True)  # numbers that keep the order and leave room for the text's place
    short, width = short + 1, len(alphabet) + 1
    # each run of blanks is one; an n-gram is of the text of any of its letters, and no word has one with a blank in the middle
    one = of * width**3 + short * width**2
    two = np.where(letter[:-1], of[:-1], of[1:]) * width**3 + short[:-1] * width**2 + short[1:] * width
    three = one[:-2] + (of[1:-1] - of[:-2]) * width**3 + short[1:-1] * width + short[2:]
    keys, n = np.unique(np.concatenate([one[letter], two[letter[:-1] | letter[1:]], three[letter[1:-1]]]), return_counts=True)
    text, keys = np.divmod(keys, width**3)
    back = np.append(0, alphabet)
    a, rest = np.divmod(keys, width**2)
    b, c = np.divmod(rest, width)
    return text, (back[a] << 2 * _BITS) | (back[b] << _BITS) | back[c], n


def gram_of(code: int) -> str:
    return "".join(chr(c) for k in (2, 1, 0) if (c := code >> k * _BITS & (1 << _BITS) - 1))


def code_of(gram: str) -> int:
    return sum(ord(c) << (2 - k) * _BITS for k, c in enumerate(gram))


@dataclass(frozen=True)
class Profiles:
    """Ranks of n-grams by language."""

    of: dict[str, dict[str, int]]
    _made: list = field(default_factory=list, compare=False, repr=False)

    def _table(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages in order, n-grams in order, and each language's ranks of those, over RANKS for none."""
        if not self._made:
            names = sorted(self.of)
            codes = np.array([*sorted({code_of(g) for p in self.of.values() for g in p}), 2**63 - 1], np.int64)  # the last one is for n-grams that no language has
            table = np.full((len(names), len(codes)), 2 * RANKS, np.int64)
            for row, name in zip(table, names, strict=True):
                own = self.of[name]
                row[np.searchsorted(codes, np.array([code_of(g) for g in own], np.int64))] = list(own.values())
            self._made.append((names, codes, table))
        return self._made[0]

    def nearest_of(self, texts: list[str | None]) -> list[tuple[str | None, float]]:
        """nearest() of each text."""
        out: list[tuple[str | None, float]] = [(None, 0.0)] * len(texts)
        if not self.of:
            return out
        names, codes, table = self._table()
        text, gram, n = counted([t or "" for t in texts])
        order = np.lexsort((-n, text))  # of equals the least n-gram first
        text, gram = text[order], gram[order]
        starts = np.searchsorted(text, np.arange(len(texts)))
        rank = np.arange(len(text)) - starts[text]
        text, gram, rank = text[rank < RANKS], gram[rank < RANKS], rank[rank < RANKS]
        at = np.searchsorted(codes, gram)
        at[codes[at] != gram] = len(codes) - 1
        away = np.empty((len(names), len(texts)), np.int64)
        for k, ranks in enumerate(table):
            own = ranks[at]
            away[k] = np.bincount(text, np.where(own < RANKS, np.abs(rank - own), RANKS), len(texts)).astype(np.int64)
        best = away.argmin(axis=0)  # of equals the least name
        least = np.sort(away, axis=0)[:2] if len(names) > 1 else None
        for i in np.unique(text).tolist():
            out[i] = names[best[i]], 1.0 if least is None else 1.0 - int(least[0, i]) / max(1, int(least[1, i]))
        return out

    def nearest(self, text: str | None) -> tuple[str | None, float]:
        """The language whose ranks are the least out of place (of equals the least name), and how much nearer it is than the next, 0 to 1; None for texts without a letter."""
        return self.nearest_of([text or ""])[0]


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(codes, return_inverse=True)
    return codes, np.bincount(at, n, len(codes)).astype(np.int64)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of the languages of docs; rows with a null text or language are passed over."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for name, (codes, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array([gram_of(c) for c in codes.tolist()], pa.string()), pa.array(n, pa.int64())], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            names = np.array(pc.cast(batch.column(1), pa.string()).to_pylist(), object)
            at = 0
            for part in parts(batch.column(0).to_pylist()):
                row, codes, n = counted(part)
                own, of = np.unique(names[at : at + len(part)], return_inverse=True)
                at += len(part)
                for k, name in enumerate(own.tolist()):
                    mine = of[row] == k
                    before = held.get(name, (codes[:0], n[:0]))
                    held[name] = _summed(np.concatenate([before[0], codes[mine]]), np.concatenate([before[1], n[mine]]))
                if sum(len(c) for c, _ in held.values()) > HELD:
                    yield from given()
        yield from given()

    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).filter("text is not null and lang is not null")
    sums = rows.mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # each task keeps no more than RANKS rows of a language before they meet
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    out: dict[str, dict[str, int]] = {}
    for r in sums.withColumn("rank", rank).filter(F.col("rank") <= RANKS).limit((MOST_LANGUAGES + 1) * RANKS).collect():
        out.setdefault(r.lang, {})[r.gram] = r["rank"] - 1
    if len(out) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    return Profiles(out)


def language(text: Column, profiles: Profiles) -> Column:
    """A struct of lang and margin of a text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            for part in parts(s.tolist()):
                yield pd.DataFrame(profiles.nearest_of(part), columns=["lang", "margin"])

    return pandas_udf(run, "lang string, margin double")(text)
