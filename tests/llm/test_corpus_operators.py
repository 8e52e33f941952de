"""SimHash, components, passages, mixing, embeddings, WARC, chat: against brute force, and on odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tejido.llm import chat, components, metric_join, mixing, simhash, substring_dedup, warc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))


def least_reachable(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(400, 500 + k) for k in range(60)]
    want = least_reachable(600, pairs)
    df = spark.createDataFrame([*pairs, (7, None), (None, None)], "a bigint, b bigint")
    found = {r.node: r.component for r in components.connected_components(df).collect()}
    touched = {x for p in pairs for x in p if p[0] != p[1]}
    assert found == {x: want[x] for x in touched}
    assert components.connected_components(df.limit(0)).count() == 0


def test_bit_sliced_kernel():
    rng = np.random.default_rng(5)
    for lanes, radius, n in ((1, 4, 700), (4, 52, 300)):
        v = rng.integers(0, 2**63, (n, lanes), dtype=np.uint64)
        for k in range(1, n):
            if k % 3:
                v[k] = v[k - 1]
                for b in rng.integers(0, 64 * lanes, radius + 2):
                    v[k, b // 64] ^= np.uint64(1 << int(b % 64))
        groups = np.sort(rng.integers(0, 30, n))
        d = sum(np.bitwise_count(v[:, None, c] ^ v[None, :, c]).astype(int) for c in range(lanes))
        want = least_reachable(n, [(i, j) for i, j in zip(*np.nonzero((d <= radius) & (groups[:, None] == groups[None, :])), strict=True)])
        i, j = simhash.spanning(v, groups, radius)
        root = np.arange(n)
        root[i] = j
        assert root.tolist() == want


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    base = prose(1, 300)
    texts = [base, base, base.replace(base.split()[5], "zzz", 1), None, "", " \n", "Four words are here", "one", prose(2, 80), "ÑÀ one", base.upper()]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).withColumn("simhash", F.lit("x")).withColumn("id", F.lit("y")).withColumn("fingerprint", F.lit("z"))
    found = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert [found[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert [found[i].component_id for i in range(len(texts))] == least_reachable(len(texts), pairs)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_large_buckets_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS", 16)
    rng = np.random.default_rng(2)
    v = [int(rng.integers(0, 2**62))]
    for _ in range(150):
        v.append(v[rng.integers(len(v))] ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    v = sorted(set(v))
    df = spark.createDataFrame([(i, bytearray(x.to_bytes(8, "little"))) for i, x in enumerate(v)], "id bigint, simhash binary")
    linked = {r.node: r.component for r in components.connected_components(simhash.near_links(df)).collect()}
    want = least_reachable(len(v), [(i, j) for i in range(len(v)) for j in range(i) if (v[i] ^ v[j]).bit_count() <= 4])
    assert [linked.get(i, i) for i in range(len(v))] == want


def test_near_dedup_stage(spark):
    base = prose(7, 400)
    near = base.split()
    near[50] = near[200] = "changed"
    rows = [(3, base, "en", "s", 1), (1, " ".join(near), "en", "s", 1), (9, prose(8, 300), "en", "s", 1), (9, prose(8, 300), "en", "s", 1), (None, base, "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "9", "None"]


@pytest.mark.parametrize(("part", "shingles"), [(8, 1 << 20), (4096, 700)])
def test_near_dedup_stage_against_jaccard(spark, monkeypatch, part, shingles):
    monkeypatch.setattr(simhash, "PART", part)
    monkeypatch.setattr(simhash, "SHINGLES", shingles)
    rng = random.Random(12)
    texts = []
    for k in range(12):
        base = prose(300 + k, 200).split()
        texts.append(base)
        for share in (0.5, 0.6, 0.7, 0.74, 0.77, 0.84, 0.9):  # a shared passage at the start; the rest is new
            n = round(200 * 2 * share / (1 + share))
            texts.append(base[:n] + prose(rng.randrange(10**6), 200 - n).split())
    order = rng.sample(range(len(texts)), len(texts))
    texts = [" ".join(texts[k]) for k in order]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    lead = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((lead[i], lead[j]))
                lead = [low if v == high else v for v in lead]
    kept = simhash.keep_first(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(lead))


def test_passages(spark):
    shared, fuzzy = prose(20, 70), prose(21, 80).split()
    changed = fuzzy[:]
    changed[20] = changed[55] = "other"
    del changed[40]
    texts = {
        1: prose(1, 90) + " " + shared + " " + prose(2, 50), 2: prose(3, 40) + "\n" + shared + "\n" + prose(4, 60), 3: prose(5, 100),
        4: prose(6, 30) + " " + " ".join(fuzzy), 5: " ".join(changed) + " " + prose(7, 30), 6: shared.upper(), 7: None, 8: "", 9: "few words",
    }
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], DOCS).withColumn("spans", F.lit("mine")).withColumn("id", F.lit(0))
    found = substring_dedup.passages(df).collect()
    pairs = {(r.first_id, r.doc_id) for r in found}
    assert {b for _, b in pairs} == {2, 5, 6} and (4, 5) in pairs and all(a < b for a, b in pairs)
    two = next(r for r in found if r.doc_id == 2)
    assert texts[2].split()[two.start : two.stop] == shared.split() and two.similarity == 1.0
    kept = {r.doc_id: r for r in substring_dedup.cut_repeats(df).collect()}
    assert set(kept) == {1, 2, 3, 4, 5, 7, 8, 9}
    assert kept[1].text == texts[1] and shared not in kept[2].text and kept[2].n_chars == len(kept[2].text) and kept[2].spans == "mine"
    assert kept[2].text.split() == texts[2].split()[:40] + texts[2].split()[110:]
    assert substring_dedup.passages(df.limit(0)).count() == 0


def test_every_shared_run_is_found(spark):
    rng = random.Random(11)
    pieces = [prose(100 + k, 60) for k in range(6)]
    texts = [" ".join(x for k in range(5) for x in (prose(1000 + 10 * i + k, rng.randint(5, 40)), *([rng.choice(pieces)] if rng.random() < 0.4 else []))) for i in range(40)]
    found = substring_dedup.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    seen = set()
    for i, t in enumerate(texts):
        has = {p for p in pieces if p in t}
        for p in has & seen:
            at = len(t[: t.index(p)].split())
            assert any(r.doc_id == i and r.start <= at and r.stop >= at + 60 for r in found)
        seen |= has


def test_runs_are_found_whose_parts_are_common(spark):
    one, two = prose(500, 30), prose(501, 30)
    texts = [one, two, one + " " + two, one, two, one + " " + two]  # each part's first and last holders before 5 lack the other part
    texts = [f"{prose(510 + k, 40)} {t} {prose(520 + k, 40)}" for k, t in enumerate(texts)]
    found = substring_dedup.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert any((r.first_id, r.doc_id, r.start, r.stop, r.n_same) == (2, 5, 40, 100, 60) for r in found)


def test_every_word_of_a_repeated_run_is_covered(spark):
    rng = random.Random(13)
    pieces = [prose(600 + k, 17) for k in range(12)]
    texts = [" ".join(x for k in range(12) for x in (rng.choice(pieces), *([prose(7000 + 100 * i + k, 9)] if rng.random() < 0.2 else []))) for i in range(60)]
    found = substring_dedup.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    seen, met = set(), 0
    for i, words in enumerate(map(str.split, texts)):
        windows = [tuple(words[k : k + 50]) for k in range(len(words) - 49)]
        covered = {k for r in found if r.doc_id == i for k in range(r.start, r.stop)}
        for k in (k for k, w in enumerate(windows) if w in seen):
            met += 1
            assert covered >= set(range(k, k + 50))
        seen |= set(windows)
    assert met


def test_later_copies_in_a_document_are_found(spark):
    base = prose(700, 80).split()
    copies = [base[:], base[:], base[:]]
    for k, at in enumerate((11, 37, 62)):
        copies[k][at] = copies[k][at - 7] = f"other{k}"
    y = " ".join(" ".join([*c, prose(710 + k, 30)]) for k, c in enumerate(copies))
    df = spark.createDataFrame([(1, prose(720, 30) + " " + " ".join(base)), (2, y)], "doc_id bigint, text string")
    found = substring_dedup.passages(df).collect()
    for k in range(3):
        assert any(r.doc_id == 2 and r.start <= 110 * k + 8 and r.stop >= 110 * k + 72 for r in found)


def test_fenwick_chain_is_the_best():
    rng = random.Random(4)
    for _ in range(40):
        seeds = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(14)})
        x, y = [a for a, _ in seeds], [b for _, b in seeds]
        score = [0.0] * len(seeds)
        for j in range(len(seeds)):
            score[j] = substring_dedup.K + max([0.0, *(score[i] - substring_dedup.GAP * (x[j] - x[i] + y[j] - y[i]) for i in range(j) if x[i] < x[j] and y[i] < y[j])])
        paths = substring_dedup.chain(x, y)
        used = [i for p in paths for i in p]
        assert len(used) == len(set(used)) and all(x[a] < x[b] and y[a] < y[b] for p in paths for a, b in zip(p, p[1:], strict=False))
        if paths and len(paths[0]) > 1:
            p = paths[0]
            assert substring_dedup.K * len(p) - substring_dedup.GAP * sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(p, p[1:], strict=False)) == pytest.approx(max(score))


def test_mixing(spark):
    rows = [(i, "t", "en", s, 1) for i, s in enumerate(["a"] * 300 + ["b"] * 90 + [None] * 40 + ["c"] * 3)]
    df = spark.createDataFrame(rows, DOCS).withColumn("slot", F.lit("x"))
    weights = {"a": 0.5, "b": 0.3, None: 0.15, "c": 0.05, "absent": 9.0}
    found = mixing.mix(df, weights, block=4).collect()
    assert {r.doc_id for r in found} == set(range(len(rows)))
    slots = {}
    for r in found:
        slots.setdefault(r.slot, set()).add((r.source, r.block, r.epoch))
    assert sorted(slots) == list(range(len(slots))) and all(len(v) == 1 for v in slots.values())
    share, period = mixing.exact_shares({k: v for k, v in weights.items() if k != "absent"})
    given = dict.fromkeys(share, 0)
    for t in range(len(slots)):
        given[next(iter(slots[t]))[0]] += 1
        assert all(abs(given[s] - share[s] * (t + 1) / period) < 1 for s in share)
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": 1.0})
    assert mixing.mix(df.limit(0)).count() == 0
    out = mixing.mixed(df, weights, block=4)
    assert out.columns == df.columns and out.count() == len(found)
    assert mixing.mixed(df.limit(0)).count() == 0


def test_chunks_of_slots_fit_together():
    rng = random.Random(6)
    cases = [({f"s{k}": (k + 1) ** 1.5 for k in range(n)}, size) for n, size in ((1, 4), (2, 3), (7, 16), (60, 64))]
    cases += [({f"s{k}": rng.choice([1e-4, 1e-3, 0.01, 0.5, 3.0]) * rng.random() for k in range(n)}, size) for n in (3, 8, 25) for size in (1, 2, 5, 10, 37) for _ in range(6)]
    for weights, size in cases:
        share, period = mixing.exact_shares(weights)
        parts = [share[s] for s in mixing.by_name(share)]
        had = [0] * len(parts)
        for chunk in range(60):
            start, stop = chunk * size, (chunk + 1) * size
            last = mixing.border(parts, period, stop, had, *mixing.room(parts, period, start, stop))
            for t, (k, i) in enumerate(mixing.slots(parts, period, start, stop, had[:], last), start + 1):
                assert i == had[k]
                had[k] += 1
                assert all(abs(h * period - p * t) < period for h, p in zip(had, parts, strict=True))
            assert had == last and sum(had) == stop


def test_streams_of_many_chunks(spark, monkeypatch):
    rows = [(i, "t", "en", s, 1) for i, s in enumerate(["a"] * 500 + ["b"] * 90 + [None] * 40 + ["c"] * 3)]
    df = spark.createDataFrame(rows, DOCS)
    whole = mixing.mix(df, block=2).collect()
    monkeypatch.setattr(mixing, "CHUNK", 7)
    found = mixing.mix(df, block=2).collect()
    at = {r.slot: (r.source, r.block) for r in found}
    assert sorted(at) == list(range(len(at))) and {r.doc_id for r in found} == {r.doc_id for r in whole} == set(range(len(rows)))
    share, period = mixing.exact_shares({s: float(n) ** mixing.POWER for s, n in (("a", 500), ("b", 90), (None, 40), ("c", 3))})
    had = dict.fromkeys(share, 0)
    for t in range(len(at)):
        had[at[t][0]] += 1
        assert all(abs(had[s] * period - share[s] * (t + 1)) < period for s in share)


def test_mixing_keeps_small_weights(spark):
    from fractions import Fraction

    rows = [(i, "t", "en", "hot" if i >= 24 else f"s{i % 6}", 1) for i in range(12_000)]
    weights = {"hot": 1.0, **{f"s{k}": 1e-4 * (k + 1) for k in range(6)}}
    found = mixing.mix(spark.createDataFrame(rows, DOCS), weights, block=4).select("slot", "source").distinct().collect()
    of = {r.slot: r.source for r in found}
    assert sorted(of) == list(range(len(found))) and len(found) > 8000
    exact = {s: Fraction(repr(w)) for s, w in weights.items()}
    total, given = sum(exact.values()), dict.fromkeys(weights, 0)
    for t in range(len(of)):
        given[of[t]] += 1
        assert all(abs(given[s] - w / total * (t + 1)) < 1 for s, w in exact.items())


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 8))
    x[20:60] = x[20] + rng.normal(size=(40, 8)) * 0.25
    x[60:63] = x[0]
    rows = [(i, [float(v) for v in np.float32(r)], 1) for i, r in enumerate(x)]
    odd = [(500, None, 1), (501, [0.0] * 8, 1), (502, [float("nan")] * 8, 1), (503, [1.0, None], 1), (504, [], 1), (505, [1.0, 2.0], 1), (506, [2.0, 4.0], 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, label int").withColumn("h", F.lit(1)).withColumn("n_links", F.lit(1))
    found = {r.vec_id: r for r in metric_join.near_duplicates(df).collect()}
    u = np.float32(x).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    want = least_reachable(120, [(i, j) for i, j in zip(*np.nonzero(near), strict=True)])
    assert [found[i].n_links for i in range(120)] == (near.sum(1) - 1).tolist()
    assert [found[i].component_id for i in range(120)] == want
    assert all(found[i].kept == (want[i] == i) for i in range(120))
    assert all(found[k].n_links == 0 and found[k].kept for k in (500, 501, 502, 503, 504)) and found[505].n_links == found[506].n_links == 1 and found[506].component_id == 505
    assert metric_join.near_duplicates(df.limit(0)).count() == 0


def test_many_cells_agree_with_one(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "ROWS", 40)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 6))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    found = {r.vec_id: r for r in metric_join.near_duplicates(df).collect()}
    assert [found[i].n_links for i in range(400)] == (near.sum(1) - 1).tolist()
    assert [found[i].component_id for i in range(400)] == least_reachable(400, list(zip(*np.nonzero(near), strict=True)))


PAGES = "page_id bigint, url string, html string"


def test_warc(spark):
    big = "<p>" + "ñ" * 700
    rows = [(1, "http://a/", big), (2, "http://b/\nx", big), (5, None, big), (3, "http://c/", "small"), (4, "http://d/", "small"), (6, "http://e/", None), (None, "http://f/", big), (7, "http://g/", prose(1, 400))]
    df = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit("mine")).withColumn("latest", F.lit(0))
    found = {r.page_id: r for r in warc.archived(df).collect()}
    assert len(found) == len(rows)
    for i, _, h in rows:
        raw = (h or "").encode()
        assert (found[i].payload_bytes, found[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert [(found[i].record_type, found[i].refers_to) for i in (1, 2, 5, None)] == [("revisit", 5), ("revisit", 5), ("response", None), ("response", None)]
    assert all(found[i].record_type == "response" for i in (3, 4, 6, 7))
    assert warc.archived(df.limit(0)).count() == 0


def test_warc_splits_own_what_starts_inside(tmp_path):
    records = [warc.record("response", str(k), "http://x/", random.Random(k).randbytes(200 * k) + warc.MAGIC, "00" * 20, None) for k in range(12)]
    data, starts = b"", []
    for k, r in enumerate(records):
        starts.append(len(data))
        data += warc.gzip_member(r, 4)
    data = data[: starts[5] + 12] + b"\xff" * 6 + data[starts[5] + 18 :]  # record 5 is damaged
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    for split in (1, 37, 500, 4096, 1 << 20):
        found = [o for s in range(0, len(data), split) for o, *_ in warc.records_of(str(path), len(data), s, min(s + split, len(data)))]
        assert found == [s for k, s in enumerate(starts) if k != 5], split
    stream = b"".join(zlib.decompressobj(31).decompress(data[a:b]) for a, b in zip(starts[:5], starts[1:6], strict=True))
    assert stream == b"".join(records[:5])


def test_chat(spark):
    schemas = {"add": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}}, "additionalProperties": False}}
    calls = [
        (1, "c1", None, 0, "add", '{"a": 1.0}'), (1, "c3", "c2", 1, "add", '{"a": 3}'), (1, "c2", "c1", 2, "add", '{"b":1,"a":-1}'), (1, "c4", "gone", 3, "no", "{}"),
        (2, "x", "y", 0, "add", '{"a":1}'), (2, "y", "x", 1, "add", '{"a":1}'), (2, "z", "y", 2, "add", "{"), (1, "c1", None, 9, "add", '{"a": 9}'), (None, "q", None, 0, "add", "{}"), (3, "n", None, 0, None, None),
    ]
    results = [(1, "c1", 5, "late"), (1, "c1", 4, "first"), (1, "c3", 0, "too early"), (1, "nobody", 3, "x"), (1, None, 3, "x")]
    made = chat.link_calls(
        spark.createDataFrame(calls, "conv_id bigint, call_id string, parent string, turn bigint, tool string, arguments string"), spark.createDataFrame(results, "conv_id bigint, call_id string, turn bigint, content string"), schemas,
    )
    rows = made.collect()
    assert sorted((str(r.conv_id), r.call_id, r.turn, r.status) for r in rows if r.status in ("repeated", "rejected")) == [("1", "c1", 9, "repeated"), ("None", "q", 0, "rejected")] and len(rows) == len(calls)
    found = {(r.conv_id, r.call_id): r for r in rows if r.status not in ("repeated", "rejected")}
    assert {k: (r.status, r.depth) for k, r in found.items()} == {
        (1, "c1"): ("answered", 0), (1, "c3"): ("early", 2), (1, "c2"): ("invalid", 1), (1, "c4"): ("invalid", 0), (2, "x"): ("cycle", None), (2, "y"): ("cycle", None), (2, "z"): ("cycle", None), (3, "n"): ("invalid", 0),
    }
    assert found[1, "c1"].record == '{"arguments":{"a":1},"id":"c1","name":"add","result":"first","status":"answered"}'
    assert found[1, "c2"].arguments_json == '{"a":-1,"b":1}' and len(found[1, "c2"].faults) == 2


def test_canonical_json():
    assert chat.canonical({"b": [1.0, 1e21, 1e-7, 0.000001, True, None], "a": "é\n\"", "😀": 1, "￿": 2}) == '{"a":"é\\n\\"","b":[1,1e+21,1e-7,0.000001,true,null],"😀":1,"￿":2}'
    assert chat.canonical({"z": 1, "a": {"y": 2, "b": []}}) == '{"a":{"b":[],"y":2},"z":1}'
    assert chat.canonical(1e21) == "1e+21" and chat.canonical(1e-7) == "1e-7" and chat.canonical(-0.0) == "0"


def test_plain_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c"), (1, 300, "user", None), (1, 301, "system", "s"), (2, 0, "assistant", "x"), (None, 0, "user", "q"), (1, None, "user", "q"), (1, 0, "user", "a"), (1, 0, "user", "z"), (3, 0, None, "")]
    made = chat.formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("stride", F.lit(1)).withColumn("mark", F.lit(1)).withColumn("last", F.lit(1))).collect()
    found = {(r.conv_id, r.turn): r for r in made if r.kind == "call"}
    assert set(found) == {(1, 0), (1, 300)}
    assert (found[1, 0].status, found[1, 0].n_results, found[1, 0].result_turn, found[1, 0].n_copies) == ("answered", 2, 1, 2)
    assert (found[1, 300].status, found[1, 300].depth) == ("invalid", 1)
    rest = sorted((str(r.conv_id), str(r.turn), r.kind, r.status, r.call_id, r.record) for r in made if r.kind != "call")
    assert rest == [
        ("1", "0", "message", "repeated", None, '{"content":"z","role":"user","turn":0}'), ("1", "1", "result", "linked", "call_0", '{"call":"call_0","content":"b","role":"assistant","turn":1}'),
        ("1", "2", "result", "linked", "call_0", '{"call":"call_0","content":"c","role":"assistant","turn":2}'), ("1", "301", "message", "kept", None, '{"content":"s","role":"system","turn":301}'),
        ("1", "None", "message", "rejected", None, '{"content":"q","role":"user","turn":null}'), ("2", "0", "message", "unlinked", None, '{"content":"x","role":"assistant","turn":0}'),
        ("3", "0", "message", "kept", None, '{"content":"","role":null,"turn":0}'), ("None", "0", "message", "rejected", None, '{"content":"q","role":"user","turn":0}'),
    ]
    assert sum(r.n_copies for r in made) == len(rows)
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.formatted(empty).count() == 0


def test_calls_in_texts(spark):
    call = '{"tool_calls": [{"id": "x", "name": "add", "arguments": {"b": 2, "a": 1}}, {"id": "y", "name": "add", "arguments": "{\\"a\\": \\"no\\"}", "after": "x"}]}'
    rows = [(1, 0, "user", "sum"), (1, 1, "assistant", call), (1, 2, "tool", '{"tool_call_id": "x", "content": "3"}'), (1, 3, "tool", '{"tool_call_id": "gone", "content": "?"}'), (1, 4, "tool", "plain"), (1, 5, "assistant", "It is 3"), (1, 6, "assistant", "{no call}")]
    schemas = chat.SCHEMAS | {"add": {"type": "object", "properties": {"a": {"type": "integer"}}}}
    made = chat.formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), schemas).collect()
    calls = {r.call_id: r for r in made if r.kind == "call"}
    assert {k: (r.status, r.depth, r.n_results) for k, r in calls.items()} == {"call_0": ("answered", 0, 2), "x": ("answered", 0, 1), "y": ("invalid", 1, 0)}
    assert calls["x"].record == '{"arguments":{"a":1,"b":2},"id":"x","name":"add","result":"3","status":"answered"}'
    assert sorted((r.turn, r.kind, r.status) for r in made if r.kind != "call") == [(2, "result", "linked"), (3, "result", "unlinked"), (4, "message", "kept"), (5, "result", "linked"), (6, "result", "linked")]


def test_warc_headers_of_any_length(spark, tmp_path):
    records = [warc.record("response", str(k), "http://x/" + "".join(random.Random(k).choices("abcdefghijklmnop0123456789", k=100_000 if k == 1 else 10)), b"payload", "00" * 20, None) for k in range(4)]
    members = [warc.gzip_member(r, 4) for r in records]
    starts = np.cumsum([0, *map(len, members)]).tolist()
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(members))
    assert len(members[1]) > 50_000
    for split in (starts[1], 4096, starts[4]):  # the long header begins a split
        assert [o for s in range(0, starts[4], split) for o, *_ in warc.records_of(str(path), starts[4], s, min(s + split, starts[4]))] == starts[:4]
    rows = [(k, "http://x/" + "ab" * 60_000, "x" * (900 + 100 * k)) for k in range(3)]
    found = warc.archived(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(r.page_id for r in found) == [0, 1, 2]


def test_warc_hot_payloads(spark):
    rows = [(k, "http://x/", "y" * 2000 if k % 3 else "small") for k in range(400)] + [(399, "http://again/", "y" * 2000), (399, "http://other/", "z" * 2000)]
    found = warc.archived(spark.createDataFrame(rows, PAGES).repartition(5)).collect()
    assert len(found) == len(rows)
    assert all((r.record_type, r.refers_to) == (("response", None) if r.payload_bytes < 1000 or r.page_id == 399 else ("revisit", 399)) for r in found)


def test_passages_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    rng = random.Random(21)
    line, pieces = prose(800, 14), [prose(810 + k, 55) for k in range(5)]
    texts = [" ".join(x for k in range(3) for x in (prose(8000 + 10 * i + k, rng.randint(3, 30)), line, rng.choice(pieces))) for i in range(60)] + [prose(850, 20) + " " + " ".join([line] * 30)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    one = sorted(map(tuple, substring_dedup.passages(df.coalesce(1)).collect()))
    monkeypatch.setattr(substring_dedup, "SLICE", 900)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, substring_dedup.passages(df.orderBy(F.desc("doc_id")).repartition(7)).collect())) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(one) >= 60


def common_words(x, y):
    row = [0] * (len(y) + 1)
    for v in x:
        before = row[:]
        for j, u in enumerate(y):
            row[j + 1] = before[j] + 1 if u == v else max(row[j], before[j + 1])
    return row[-1]


def test_crowded_anchors_give_the_same_passages(spark, monkeypatch):
    rng = np.random.default_rng(11)
    word = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 400, n))
    common, pieces = word(70), [word(60) for _ in range(12)]
    texts = [" ".join([word(5), pieces[rng.integers(12)], common, pieces[rng.integers(12)], word(5)]) for _ in range(40)] + ["a a " * 90, "b " + "a a " * 80]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    usual = sorted(map(tuple, substring_dedup.passages(df).collect()))
    assert len(usual) > 40
    for most in (0, 3):
        monkeypatch.setattr(substring_dedup, "CLASSES", most)
        assert sorted(map(tuple, substring_dedup.passages(df).collect())) == usual


def test_fuzzy_passages_against_plain_version(spark):
    rng = random.Random(31)
    texts, planted = [], []
    for k in range(40):
        piece = prose(900 + k, 80).split()
        changed = piece[:]
        for at in rng.sample(range(80), rng.choice([2, 4, 6, 8])):
            changed[at] = f"other{at}" if rng.random() < 0.7 else ""
        a, b = prose(1000 + k, 30).split(), prose(1100 + k, 25).split()
        texts.append(" ".join(a + piece))
        texts.append(" ".join(b + [w for w in changed if w] + prose(1200 + k, 20).split()))
        planted.append((2 * k, 2 * k + 1))
    found = substring_dedup.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for r in found:  # every row is what it says
        x, y = texts[r.first_id].split()[r.first_start : r.first_stop], texts[r.doc_id].split()[r.start : r.stop]
        assert min(len(x), len(y)) >= 50 and r.n_same >= 0.8 * max(len(x), len(y)) and r.n_same <= common_words(x, y)
    pairs = {(r.first_id, r.doc_id) for r in found}
    assert pairs <= set(planted) and len(pairs) >= 0.9 * len(planted)


def test_passages_of_odd_rows(spark):
    shared = prose(70, 60)
    rows = [(1, shared + " " + " ".join(["again"] * 3000)), (2, shared), (2, shared), (3, " ".join(["again"] * 4000)), (None, shared), (4, None), (5, "")]
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.first_id, r.doc_id) for r in found} >= {(1, 2), (1, 3)} and all(r.first_id < r.doc_id for r in found)


def test_slots_are_the_earliest_deadlines():
    from fractions import Fraction

    share, period = mixing.exact_shares({"a": 0.5, "b": 0.3, None: 0.15, "c": 0.05})
    names = sorted(share, key=lambda s: (s is not None, s or ""))
    done = dict.fromkeys(names, 0)
    for slot, (k, i) in zip(range(3 * period), mixing.slots([share[s] for s in names], period, 0, 4 * period, [0] * 4, [4 * share[s] for s in names]), strict=False):
        weight = {s: Fraction(share[s], period) for s in names}
        ready = [(-(-(done[s] + 1) // weight[s]), j) for j, s in enumerate(names) if done[s] / weight[s] <= slot or done[s] // weight[s] <= slot]
        assert (k, i) == (min(ready)[1], done[names[min(ready)[1]]])
        done[names[k]] += 1


def test_archives_lie_where_spark_writes(spark, tmp_path):
    from tejido.llm._shared import qualified

    assert qualified(spark, "/a/b") == "file:/a/b" and qualified(spark, "file:///a/b") in ("file:///a/b", "file:/a/b")
    files = warc.write(warc.roles(spark.createDataFrame([(1, "http://x/", "y" * 2000)], PAGES)), str(tmp_path / "w"))
    row = files.first()
    assert row.path.startswith("file:/") and spark.read.format("binaryFile").load(row.path).count() == 1
    assert warc.read(files, 64).count() == 1
