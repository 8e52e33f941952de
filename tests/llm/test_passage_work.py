"""Operator 5 does its work on a text once: the same results as plain versions, with no sort or comparison beyond what they need."""

import numpy as np
import pyarrow as pa
import pytest

from tejido.llm import substring_dedup as S


class Held:
    """Takes the place of a DataFrame: gives the function that would run on its batches."""

    def mapInArrow(self, function, _):
        return function


def plain_lcs(x, y):
    row = [0] * (len(y) + 1)
    for v in x:
        out = [0]
        for k, w in enumerate(y):
            out.append(row[k] + 1 if v == w else max(row[k + 1], out[-1]))
        row = out
    return row[-1]


def test_same_words_and_extension_against_plain_versions():
    rng = np.random.default_rng(5)
    for n, m in [(0, 0), (0, 3), (4, 0), (1, 2), (64, 65), (200, 130), *rng.integers(1, 40, (200, 2)).tolist()]:
        x, y = (rng.integers(0, 2 + n // 4, k).astype(np.uint32) for k in (n, m))
        assert S.same_words(x, y) == (int((x == y).sum()) if n == m else plain_lcs(x.tolist(), y.tolist()))
    for n in [0, 1, 5, S.MARGIN, 3 * S.MARGIN + 1, *rng.integers(1, 300, 200).tolist()]:
        x = rng.integers(0, 9, n).astype(np.uint32)
        y = np.where(rng.random(n) < rng.choice([0.05, 0.3, 0.6]), x + 1, x)
        score = top = best = same = 0
        for k in range(n):
            score += 1 if x[k] == y[k] else -1
            if top - score >= S.FALL:
                break
            if score > top:
                top, best, same = score, k + 1, int((x[: k + 1] == y[: k + 1]).sum())
        assert S.extension(x, y) == (best, same)


def test_the_gaps_of_a_chain_are_compared_once(monkeypatch):
    """Also where the chain is cut again and again since its parts are not alike enough."""
    rng = np.random.default_rng(7)
    x, y, xs, ys = [], [], [], []
    for k in range(60):
        xs.append(len(x)), ys.append(len(y))
        x += range(100 * k, 100 * k + S.K)
        y += range(100 * k, 100 * k + S.K)
        x += rng.integers(10_000, 20_000, 6 + k % 5).tolist()
        y += rng.integers(20_000, 30_000, 8 + k % 7).tolist()
    calls, plain = [], S.same_words
    monkeypatch.setattr(S, "same_words", lambda a, b: calls.append(1) or plain(a, b))
    assert not list(S.aligned(*(np.array(v, np.uint32) for v in (x, y)), np.array(xs), np.array(ys), 50, 0.8))
    assert len(calls) <= 59


def test_only_seeds_that_come_again_are_sorted_by_more_than_their_hash(monkeypatch):
    texts = [" ".join(f"w{k}_{i}" for i in range(2000)) for k in range(5)] + ["a b c d e f g h " * 40, "", "a b", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    sizes, plain = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sizes.append(len(keys[0])) or plain(keys))
    rows = pa.Table.from_batches(S.seed_rows(Held())(iter([batch])))
    assert rows.num_rows > 3000 and sum(sizes) < 400
    # the rows are those of a plain version: all occurrences, told apart by their turns, and those after the first once more
    h, text, pos = S.seeds_of(*S.word_hashes(batch.column("text")))
    want, turns = [], {}
    for v, t, p in zip(h.tolist(), text.tolist(), pos.tolist(), strict=True):
        n = turns[v, t] = turns.get((v, t), -1) + 1
        turned = int(S.mixed_bits(np.array([v], np.uint64) ^ np.array([n * 0x9E3779B97F4A7C15 % 2**64], np.uint64))[0]) if n else v
        want += [(turned & ~1, t, p)] + ([(v | 1, t, p)] if n else [])
    assert sorted((r["h"] % 2**64, r["doc"], r["pos"]) for r in rows.to_pylist()) == sorted(want)


@pytest.mark.parametrize("n", [0, 1, 3, 7, 200])
def test_seeds_against_a_plain_version(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(0, 30, n)
    words = rng.integers(0, 3, counts.sum()).astype(np.uint64)
    begin, want = np.cumsum(counts) - counts, []
    for t in range(n):
        grams = S.run_hashes(words[begin[t] : begin[t] + counts[t]], S.K).tolist() if counts[t] >= S.K else []
        picked = {max(range(k, min(k + S.WINDOW, len(grams))), key=lambda i: (-grams[i], i)) for k in range(max(1, len(grams) - S.WINDOW + 1) if grams else 0)}
        want += [(grams[i], t, i) for i in sorted(picked)]
    assert list(zip(*(v.tolist() for v in S.seeds_of(words, counts)), strict=True)) == want
