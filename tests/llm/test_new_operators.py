"""Line dedup, whitening and periodic runs: against plain versions, and on odd input."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tejido.llm import line_dedup, periodic, whitening

DOCS = "doc_id bigint, text string, lang string"
SPACE = " \t\n\x0b\f\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_lines(rows):
    """Kept text and counts of each row, by the definition."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    first = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and t is not None and len(key(line)) >= 10:
                first[key(line)] = min(d, first.get(key(line), d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or d <= first.get(key(x), d)]
        out.append((str(d), len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return sorted(out)


def line_corpus():
    rng = random.Random(4)
    pool = [f"a line that many hold {k}" for k in range(30)] + ["short", "", " \t", "EXACTLY 10", "exactly 10", "ñandú ÑANDÚ line", "ñandú ñandú line", "  The Same Line\r", "the same line"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own line {i} {k} {rng.random()}" for k in range(rng.randint(1, 40)))) for i in range(120)]
    rows += [(200 + i, "the line of a third of all rows\nother " + str(i)) for i in range(80)]  # one crowding line
    rows += [(300, None), (301, ""), (302, "\n\n"), (None, "a line that many hold 1\nx"), (None, None), (5, "another text of this id\na line that many hold 2"), (7, rows[7][1]), (7, rows[7][1])]
    rows.append((400, "\n".join(["a line that many hold 3", "the end is mine"] * 30_000)))  # a long text
    return rows


def test_line_dedup(spark, monkeypatch):
    rows = line_corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], DOCS).withColumn("print", F.lit(1)).withColumn("keep", F.lit("y")).withColumn("lines", F.lit("z")).repartition(5)
    found = line_dedup.report(df)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in found.collect()) == plain_lines(rows)
    assert line_dedup.report(df.limit(0)).count() == 0
    monkeypatch.setattr(line_dedup, "SAMPLED", 16)  # a rougher sample gives the same rows
    monkeypatch.setattr(line_dedup, "PART", 8)
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.report(df).collect()) == plain_lines(rows)


def test_crowding_lines_are_parted(spark):
    rows = spark.createDataFrame(line_corpus()[:200], "doc_id bigint, text string")
    parts = line_dedup.frequent(line_dedup.lines(rows), 40).collect()
    assert any(r.parts > 1 for r in parts) and len(parts) <= 160


def test_keep_bitmaps_and_texts(spark):
    df = spark.createDataFrame([(2, "the same long line\nb\nthe same long line", "p"), (1, "a\nthe same long line", "q"), (3, None, "r"), (4, "the same long line", "s")], DOCS).withColumn("keep", F.lit(7))
    maps = {r.doc_id: (r.n_dropped, [tuple(k) for k in r.keep]) for r in line_dedup.keep_bitmaps(df).collect()}
    assert maps == {2: (2, [(1, 1), (3, None)]), 4: (1, [(1, None)])}
    kept = line_dedup.drop_repeated_lines(df)
    assert kept.columns == df.columns
    assert {(r.doc_id, r.text, r.lang, r.keep) for r in kept.collect()} == {(2, "b", "p", 7), (1, "a\nthe same long line", "q", 7), (3, None, "r", 7), (4, "", "s", 7)}


def test_line_dedup_runs_no_python(spark):
    df = spark.createDataFrame([(1, "a line of some length", "x"), (2, "a line of some length", "x")], DOCS)
    plan = line_dedup.report(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def exact(rows, k):
    """n, sums, deviations, eigenvalues and the whitening of rows of floats, by plain arithmetic and eigh of the exact covariance."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in r] for r in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    y = np.array([[(n * r[j] - s[j]) / n for j in range(d)] for r in x])
    e, v = np.linalg.eigh(y.T @ y / n)
    return n, dev, e[::-1], y @ v[:, ::-1][:, :k] / np.sqrt(e[::-1][:k])


@pytest.mark.parametrize(("n", "dims", "parts"), [(500, 40, 23), (7, 40, 3), (90, 5, 40)])
def test_whitening(spark, n, dims, parts, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 8)
    rng = np.random.default_rng(n)
    x = (rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims)) * np.linspace(4, 1, dims)).astype(np.float32)
    rows = [(i, [float(v) for v in r], "a") for i, r in enumerate(x)]
    odd = [(1000, None, "a"), (1001, [], "a"), (1002, [float("nan")] * dims, "a"), (1003, [None] + [1.0] * (dims - 1), "a"), (1004, [float("inf")] * dims, "a"), (1005, [1.0], "a")]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, component string").repartition(parts)
    found = whitening.report(df)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    k = min(32, dims, n - 1)
    m, dev, e, w = exact(x, k)
    got = {(r.vec_id, r.component): r for r in found.collect()}
    assert set(got) == {(i, c + 1) for i in range(n) for c in range(k)}
    mine = np.array([[got[i, c + 1].whitened for c in range(k)] for i in range(n)])
    assert np.abs(np.abs(mine) - np.abs(w)).max() < 1e-6
    assert np.allclose(mine * np.sign((mine * w).sum(axis=0)), w, atol=1e-6)
    for i in range(n):
        r = got[i, 1]
        assert (r.n, r.deviation) == (m, dev[i]) and r.identity_error < 1e-9
    assert np.allclose([got[0, c + 1].explained for c in range(k)], e[:k] / e.sum(), rtol=1e-9)


def test_whitening_of_little(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert whitening.report(df).count() == 0  # no direction
    assert whitening.report(df.limit(0)).count() == 0
    more = df.union(spark.createDataFrame([(4, [1.0, 5.0])], df.schema))
    rows = whitening.report(more).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in rows) == [("3", 1, 4), ("3", 1, 4), ("4", 1, 4), ("None", 1, 4)] and rows[0].explained == 1.0
    with pytest.raises(Exception, match="beyond"):
        whitening.report(spark.createDataFrame([(1, [1e30]), (2, [0.0])], df.schema)).collect()


def test_summaries_lose_nothing():
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**20), 2**20, (300, 12)) + 10**6
    whole = whitening.in_pairs([whitening.summary(x[k : k + 7]) for k in range(0, 300, 7)], whitening.merged)
    y = x - x.mean(axis=0)
    assert whole.n == 300 and whole.sums.tolist() == x.sum(axis=0).tolist()
    assert np.allclose(whole.scaled.T @ whole.scaled, y.T @ y, rtol=1e-12, atol=1e-12 * (y * y).sum())


def test_deviations_are_exact():
    model = whitening.Whitening(10**6, [10**12] * 3, np.ones(3), np.eye(3))
    x = np.array([[10**6 + 1, 10**6 - 2, 10**6]])
    assert model.deviations(x).tolist() == [5 * 10**12]
    with pytest.raises(OverflowError):
        model.deviations(x + 10**5)


def plain_runs(w, least=12):
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            run = w[s : i + p]
            if len(run) >= max(least, 2 * p) and not any(run[q:] == run[:-q] for q in range(1, p)):
                out.append((s, len(run), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts():
    rng = random.Random(8)
    texts = [None, "", " \n", "one", "a " * 11, "a " * 12, "a b " * 6, "x " + "a b c " * 7 + "a", "A a " * 9, "é é " * 20]
    for _ in range(90):
        k, n = rng.choice([1, 2, 3, 6, 40]), rng.choice([5, 12, 13, 40, 90, 300])
        w = [f"w{rng.randrange(k)}" for _ in range(n)]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(n)
            p, e = 1 + rng.randrange(max(1, (n - a) // 2)), rng.randrange(a, n)
            for i in range(a, e):
                w[i] = w[a + (i - a) % p]
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    return texts


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize(("probes", "cells"), [(1 << 20, 1 << 21), (1, 8), (60, 100)])
def test_runs_against_plain_version(probes, cells, monkeypatch):
    monkeypatch.setattr(periodic, "PROBES", probes)
    monkeypatch.setattr(periodic, "CELLS", cells)
    docs = [words_of(t) for t in periodic_texts()]
    flat = np.concatenate([periodic.codes([w.encode() for w in d]) for d in docs])
    runs = periodic.runs_of(flat, np.array([len(d) for d in docs]))
    for k, d in enumerate(docs):
        assert [(int(r["start"]), int(r["length"]), int(r["period"])) for r in runs[runs["doc"] == k]] == plain_runs(d)


def test_periodic_report(spark):
    rows = [(i, t) for i, t in enumerate(periodic_texts())] + [(None, "a " * 20), (3, "a b " * 20), (3, "a b " * 20)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], DOCS).withColumn("start", F.lit(1)).repartition(3)
    want = []
    for d, t in rows:
        w = words_of(t)
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(w)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        told = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        want.append((str(d), len(runs), *told, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    found = periodic.report(df)
    assert sorted(map(str, want)) == sorted(str((str(r[0]), *r[1:])) for r in found.collect())
    assert periodic.report(df.limit(0)).count() == 0
    assert {(str(r.doc_id), r.n_words, str([tuple(x) for x in r.runs])) for r in periodic.find_runs(df).collect()} == {(str(d), len(words_of(t)), str(plain_runs(words_of(t)))) for d, t in rows}
    kept = periodic.collapse_runs(df)
    assert kept.columns == df.columns and {r.text for r in kept.collect() if r.doc_id is None} == {"a"}


def test_long_texts_of_one_word_take_no_time_of_their_square():
    runs = periodic.runs_of(np.zeros(300_000, np.int64), np.array([300_000]))
    assert [tuple(map(int, r)) for r in runs] == [(0, 0, 300_000, 1)]
