"""Recall of operator 5 where passages compete for first holders, and at the least similarity."""

import random

import pytest

from tejido.llm import substring_dedup


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n)]


def changed(rng, passage, n):
    out = passage[:]
    for k in rng.sample(range(len(out)), n):
        out[k] = "changed" + "".join(rng.choices("abc", k=6))
    return out


def found(spark, texts):
    rows = substring_dedup.passages(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")).collect()
    return {(r.first_id, r.doc_id): r for r in rows}


def test_alike_passages_whose_parts_have_other_first_holders(spark):
    rng = random.Random(60)
    texts = []
    for _ in range(60):
        passage = words(rng, 80)
        parts = [passage[:40], passage[40:], passage, changed(rng, passage, 3)]
        texts += [words(rng, 30) + p + words(rng, 30) for p in parts]
    pairs = found(spark, texts)
    assert sum((4 * k + 2, 4 * k + 3) in pairs for k in range(60)) == 60
    assert all(a % 4 == 2 and b == a + 1 for a, b in pairs)


def test_parts_come_again_in_between(spark):
    rng = random.Random(61)
    passage = words(rng, 80)
    near = [changed(rng, passage, 3) for _ in range(2)]
    parts = [passage[:40], passage[40:], passage, passage[:40], passage[40:], near[0], passage[:40], passage[40:], near[1]]
    pairs = found(spark, [words(rng, 30) + p + words(rng, 30) for p in parts])
    assert {b for _, b in pairs} == {5, 8} and (2, 5) in pairs


@pytest.mark.parametrize("seed", [1, 2])
def test_recall_at_the_least_similarity(spark, seed):
    rng = random.Random(seed)
    cases, texts = {}, []
    for n in (50, 60, 80):
        for percent in (80, 85, 90):
            cases[n, percent] = []
            for _ in range(60):
                passage = words(rng, n)
                cases[n, percent].append(len(texts))
                texts += [words(rng, 40) + passage + words(rng, 30), words(rng, 20) + changed(rng, passage, n * (100 - percent) // 100) + words(rng, 50)]
    pairs = found(spark, texts)
    recall = {case: sum((k, k + 1) in pairs for k in at) / len(at) for case, at in cases.items()}
    assert all(r >= 0.9 for r in recall.values()), recall
    assert sum(recall.values()) / len(recall) > 0.97 and all(b == a + 1 and a % 2 == 0 for a, b in pairs)
    for r in pairs.values():
        assert r.n_words >= 50 and r.first_stop - r.first_start >= 50 and r.n_same >= 0.8 * max(r.n_words, r.first_stop - r.first_start)


def test_one_text_of_a_repeated_id_is_taken_whatever_the_order(spark):
    rng = random.Random(3)
    passage = words(rng, 60)
    rows = [(1, " ".join(passage)), (2, " ".join(["a", *passage])), (2, " ".join(words(rng, 70))), (3, " ".join(passage))]
    told = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id bigint, text string").repartition(3)
        told.append(sorted(map(tuple, substring_dedup.passages(df).collect())))
    assert told[0] == told[1] and {r[3] for r in told[0]} == {2, 3}


def test_texts_beyond_a_slice(spark):
    rng = random.Random(4)
    passage = words(rng, 70)
    long = words(rng, 150_000)  # about a megabyte
    pairs = found(spark, [words(rng, 20) + passage, long[:140_000] + passage + long[140_000:]])
    assert pairs[0, 1].start == 140_000 and pairs[0, 1].n_same >= 70
