"""The pipeline against a plain version of all its stages, and its columns and odd rows stage by stage."""

import base64
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tejido.llm import mixing, simhash

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
STEMS = {"en": "th ing er and on re", "es": "ción que lla ño ar es", "de": "sch ung über en ich ein"}


def prose(seed, n, lang):
    rng = random.Random(f"{seed}{lang}")
    return " ".join("".join(rng.choices(STEMS[lang].split(), k=rng.randint(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(9)
    shared = [prose(900 + k, 64, "en") for k in range(3)]
    rows = []
    for i in range(90):
        lang = ("en", "es", "de")[i % 3]
        text = prose(i, rng.randint(60, 160), lang)
        if i % 10 == 4:
            text = " ".join([text, rng.choice(shared), prose(5000 + i, 30, lang)])
        rows.append([i, text, lang, "big" if i % 3 else "small"])
    for i in range(90, 100):  # copies and near copies
        words = rows[i - 80][1].split()
        if i % 2:
            words[len(words) // 2] = "changed"
        rows.append([i, " ".join(words), "en", "copies"])
    rows += [[100, None, "en", "x"], [101, "12 !?", "en", "x"], [102, "", None, None], [103, shared[0], "en", None]]
    return [(i, t, a, s, len(t or "")) for i, t, a, s in rows]


def plain(rows, hashes):
    docs = {i: (t, s) for i, t, _, s, _ in rows if t and any(map(str.isalpha, t))}
    prints = {i: sum(v << 64 * k for k, v in enumerate(simhash.wide_fingerprint(t, 5, 4))) for i, (t, _) in docs.items()}
    lead = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for i in docs:
            for j in docs:
                if lead[j] < lead[i] and (prints[i] ^ prints[j]).bit_count() <= 52:
                    lead[i], changed = lead[j], True
    docs = {i: x for i, x in docs.items() if lead[i] == i}
    windows, out = set(), {}
    for i in sorted(docs):
        words = docs[i][0].split()
        at = [tuple(words[k : k + 50]) for k in range(len(words) - 49)]
        gone = {k + j for k, w in enumerate(at) if w in windows for j in range(50)}
        windows |= set(at)
        if left := " ".join(w for k, w in enumerate(words) if k not in gone):
            out[i] = left + (" " if len(words) - 1 in gone else "")  # the white space before a passage at the end stays
    sizes = Counter(docs[i][1] for i in out)
    share, period = mixing.exact_shares({s: float(n) ** mixing.POWER for s, n in sizes.items()})
    order = {s: sorted((i for i in out if docs[i][1] == s), key=lambda i: (hashes[i], i)) for s in sizes}
    blocks = {s: [v[k : k + mixing.BLOCK] for k in range(0, len(v), mixing.BLOCK)] for s, v in order.items()}
    done, slot, times = dict.fromkeys(sizes, 0), 0, Counter()
    names = sorted(sizes, key=lambda s: (s is not None, s or ""))
    while any(done[s] < len(blocks[s]) for s in sizes):
        ready = [(-(-(done[s] + 1) * period // share[s]), k) for k, s in enumerate(names) if done[s] * period // share[s] <= slot]
        s = names[min(ready)[1]]
        times.update(blocks[s][done[s] % len(blocks[s])])
        done[s] += 1
        slot += 1
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = []
    for i, n in times.items():
        ids = e.encode_ordinary(out[i])
        found += [(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(out[i].encode()).hexdigest())] * n
    return sorted(found)


def test_run_against_plain_version(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    hashes = {r.i: r.h for r in spark.range(200).select(F.col("id").alias("i"), F.xxhash64("id", F.lit(17)).alias("h")).collect()}
    # blocks are filled in the order of the hash's upper bits
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = plain(rows, {i: h % (1 << 64) for i, h in hashes.items()})
    assert [g[0] for g in got] == [w[0] for w in want]
    assert got == want


def test_stages_keep_columns_and_empty_tables(spark):
    df = spark.createDataFrame(corpus(), DOCS).withColumn("Score", F.lit(1)).withColumn("row", F.lit("r"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, "").columns == df.columns
        none = stage(spark, df.limit(0), "")
        assert none.columns == df.columns and none.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, df.limit(0), "").count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "source_mixing", "byte_bpe"]
