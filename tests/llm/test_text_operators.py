"""Fingerprints, language, token counts, BPE: against libraries and plain versions, and on odd input."""

import base64
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tejido.llm import bpe, langid, lz_fingerprint, token_counts

P = pytest.importorskip("public_tokenizers")
ODD = [None, "", " ", "a", "\n\n", "they'll  we're\n\n  x   ", "日本語 テスト 😀😀", "x<|endoftext|>y", " 'll 'l", "\x00\x01", "é ñ", "aaaa" * 200, "a" * 3000 + "-" * 500]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, texts, extra=False):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        for name in ("ids", "decoded", "fingerprint", "n_tokens", "lang_pred", "score", "simhash", "range", "tail", "key", "spans", "id", "slot", "epoch"):
            df = df.withColumn(name, F.lit("mine"))
    return df


def reference_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_report(spark):
    df = table(spark, ODD, extra=True)
    found = {r.doc_id: r for r in token_counts.token_report(df, token_counts.read_vocabulary(P.path("byte_bpe_50k.json"))).collect()}
    t = reference_tokenizer()
    for i, x in enumerate(ODD):
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (found[i].n_tokens, found[i].n_bytes, found[i].over_limit) == (n, len((x or "").encode()), n > 1024)
    assert token_counts.token_report(df.limit(0), token_counts.read_vocabulary(P.path("byte_bpe_50k.json"))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab 'lreRE\n\té日<|endoftx>1,.", max_size=40))
def test_counts_at_every_prefix(text):
    c, t = token_counts.counter(token_counts.read_vocabulary(P.path("byte_bpe_50k.json"))), reference_tokenizer()
    assert list(c.prefix_counts(text)) == [len(t.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]


def test_prefix_counts_answer_budgets(spark):
    v = token_counts.read_vocabulary(P.path("byte_bpe_50k.json"))
    df = token_counts.count_prefixes(table(spark, ["hello there world", None]), v)
    rows = df.withColumn("fit", token_counts.fits("prefix_tokens", 2)).orderBy("doc_id").collect()
    counts = list(rows[0].prefix_tokens)
    assert rows[0].fit == max(k for k, n in enumerate(counts) if n <= 2)
    assert list(rows[1].prefix_tokens) == [0] and rows[1].fit == 0


def test_bpe_round_trip(spark):
    ranks, e = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), encoding()
    df = table(spark, ODD, extra=True)
    coded = bpe.encode(df, ranks, P.PATTERN)
    ids = {r.doc_id: list(r.ids) for r in coded.collect()}
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, ranks, P.PATTERN).collect()}
    told = {r.doc_id: r for r in bpe.round_trip(df, ranks, P.PATTERN).collect()}
    for i, x in enumerate(ODD):
        assert ids[i] == e.encode_ordinary(x or "")
        assert back[i] == (x or "").encode()
        assert told[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids[i])).encode()).hexdigest()
        assert told[i].decoded_sha256 == hashlib.sha256(back[i]).hexdigest() and told[i].n_tokens == len(ids[i])
    assert bpe.round_trip(df.limit(0), ranks, P.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60), st.integers(1, 40))
def test_bpe_matrix_and_heap_agree_with_library(text, times):
    own, e = bpe.codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN), encoding()
    text = text * times
    ids, counts = own.encode([text])
    assert ids.tolist() == e.encode_ordinary(text) and counts.tolist() == [len(ids)]
    for piece in own.pattern.findall(text):
        raw = piece.encode()
        if raw not in own.ranks:
            assert own.merge_long(raw).tolist() == own.merge_rows([raw], len(raw))[0].tolist()


def test_unknown_ids_are_an_error():
    own = bpe.codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    with pytest.raises(ValueError):
        own.decode(np.array([10**6]), np.array([1]))


def plain_parse(text):
    seen, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def test_lz_phrases_and_likeness():
    for text in ("", "a", "abababab", "the cat the dog the cat"):
        assert set(lz_fingerprint.Parser().feed(text)) == plain_parse(text)
    a, b = lz_fingerprint.fingerprint_text("the cat sat on the mat"), lz_fingerprint.fingerprint_text("the cat sat on the hat")
    x, y = plain_parse("the cat sat on the mat"), plain_parse("the cat sat on the hat")
    assert lz_fingerprint.likeness(a, b) == pytest.approx(len(x & y) / len(x | y))
    assert lz_fingerprint.likeness(a, a) == 1.0
    assert np.array_equal(lz_fingerprint.from_hex(lz_fingerprint.to_hex(a)), a)


def test_edit_ring(spark):
    texts = [None, "", "abc", "abcdefgh" * 20, "日本語" * 9, "x" * 5000, "abc"]
    df = table(spark, texts, extra=True).filter("doc_id != 3").union(table(spark, texts, extra=True).filter("doc_id = 3"))
    found = lz_fingerprint.edit_ring(df).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == list(range(len(texts)))
    for i, r in enumerate(found):
        own, after = texts[i] or "", texts[(i + 1) % len(texts)] or ""
        k = len(own) // 4
        changed = own[: len(own) - k] + after[:k]
        a, b, c = map(lz_fingerprint.fingerprint_text, (own, changed, after))
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (lz_fingerprint.to_hex(a), lz_fingerprint.to_hex(b))
        assert (r.near_edited, r.near_next) == (lz_fingerprint.likeness(a, b), lz_fingerprint.likeness(a, c))
    assert found[2].fingerprint == found[6].fingerprint
    assert lz_fingerprint.edit_ring(df.limit(0)).count() == 0


def test_edit_ring_with_null_and_repeated_ids(spark):
    rows = [(None, "n"), (5, "b"), (5, "a"), (5, None), (9, "zzzz")]
    found = lz_fingerprint.edit_ring(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in found) == [-1, 5, 5, 5, 9]


def test_language(spark):
    import random

    rng = random.Random(1)
    words = {"en": "the of and thing with that".split(), "es": "que ción los una señor año".split(), "de": "und der schön über nicht straße".split()}
    rows = []
    for i in range(240):
        lang = "en es de".split()[i % 3]
        rows.append((i, " ".join(rng.choices(words[lang], k=12)), lang if i % 7 else None, "s", 1))
    rows += [(1000, None, "en", "s", 0), (1001, "123 !?", "en", "s", 0), (1002, "", None, None, None), (None, "und der schön", "de", "s", 0)]
    found = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, DOCS)).collect()}
    for i in range(240):
        assert found[i].lang_pred == "en es de".split()[i % 3] and 0.9 < found[i].score <= 1
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert [found[i].lang_pred for i in (1000, 1001, 1002, None)] == ["und", "und", "und", "de"]
    assert not found[None].held_out
    empty = spark.createDataFrame([], DOCS)
    assert langid.identify(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "text", None, "s", 4)], DOCS)
    assert langid.identify(unlabelled).first().lang_pred == "und"


def test_language_stage_keeps_columns_and_clean_rows(spark):
    df = table(spark, ["the cat and the dog"] * 8 + [None, "12 34"], extra=True)
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == 8 and {r.score for r in kept.collect()} == {"mine"}


def test_long_texts_are_scored_in_stretches():
    model = langid.Model(["a", "b"], np.random.default_rng(0).integers(0, 9, (2, langid.BUCKETS)), np.array([1.0, 1.0]))
    text = "word " * 100_000
    assert model.score([text]).shape == (1, 2)


def plain_ngrams(text):
    padded = f" {text.lower()} "
    return [padded[k : k + n] for n in langid.ORDERS for k in range(len(padded) - n + 1)]


def test_long_texts_count_as_if_uncut(monkeypatch):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdé ß"), 600_000))
    model = langid.Model(["a", "b"], rng.integers(0, 90, (2, langid.BUCKETS)), np.array([1.0, 3.0]))
    cut = model.score([text, "short", text[:300_000]])
    monkeypatch.setattr(langid, "STRETCH", 1 << 22)
    whole = model.score([text, "short", text[:300_000]])
    assert np.allclose(cut, whole, rtol=0, atol=1e-5)
    for most in (1, 2, 3, 7, 50):
        counts = np.zeros(langid.BUCKETS, np.int64)
        for _, parts, own in langid.stretches(["Ab ba", "x", "", "yyyy" * 9], most):
            sizes = np.array([len(p) for p in parts])
            for n, found in zip(langid.ORDERS, langid.ngram_buckets(langid.codes("".join(parts))), strict=False):
                counts += np.bincount(found[langid.owned(sizes, own, n)], minlength=langid.BUCKETS)
        want = np.zeros(langid.BUCKETS, np.int64)
        for t in ("Ab ba", "x", "", "yyyy" * 9):
            for g in plain_ngrams(t):
                want[langid.ngram_buckets(langid.codes(g))[len(g) - 1][0]] += 1
        assert (counts == want).all()


def test_language_against_plain_naive_bayes(spark):
    import math
    import random
    from collections import Counter

    rng = random.Random(8)
    stems = {"en": "th ing er and on re".split(), "es": "que ción lla ño ar es".split(), "de": "sch ung über en ich ein".split()}
    rows = []
    for i in range(160):
        lang = ("en", "es", "de")[i % 3]
        text = " ".join("".join(rng.choices(stems[lang] + stems["en"], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 25)))
        rows.append((i, text, lang if i % 5 else None, "s", len(text)))
    learnt = [(t, a) for i, t, a, _, _ in rows if a and zlib.crc32(str(i).encode()) % 4 != 2]
    bucket = lambda g: int(langid.ngram_buckets(langid.codes(g))[len(g) - 1][0])
    counts = {a: Counter(bucket(g) for t, b in learnt if a == b for g in plain_ngrams(t)) for a in stems}
    total = {a: sum(c.values()) + langid.ALPHA * langid.BUCKETS for a, c in counts.items()}
    found = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, DOCS)).collect()}
    right = held = 0
    for i, text, _, _, _ in rows:
        log = {a: math.log(sum(b == a for _, b in learnt) / len(learnt)) + sum(math.log((counts[a][bucket(g)] + langid.ALPHA) / total[a]) for g in plain_ngrams(text)) for a in stems}
        best = max(sorted(log), key=log.get)
        assert found[i].lang_pred == best
        assert found[i].score == pytest.approx(1 / sum(math.exp(v - log[best]) for v in log.values()), abs=1e-3)
        if found[i].held_out:
            held += 1
            right += best == ("en", "es", "de")[i % 3]
    assert right >= 0.9 * held > 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    told = [r for r in langid.identify(docs).collect() if r.held_out and truth[r.doc_id] is not None and r.lang_pred != "und"]
    assert sum(truth[r.doc_id] == r.lang_pred for r in told) >= 0.97 * len(told) > 0


def test_margin_tells_texts_in_doubt(spark):
    df = table(spark, ["the thing and the other"] * 12).unionByName(table(spark, ["der schöne und die straße"] * 12).selectExpr("doc_id + 100 as doc_id", "text", "'de' as lang", "source", "n_chars"))
    odd = spark.createDataFrame([(900, "qqqqq" * 40, None, "s", 200), (901, "the thing and", None, "s", 13)], DOCS)
    kept = {r.doc_id for r in langid.keep_identified(df.unionByName(odd)).collect()}
    assert 900 not in kept and 901 in kept and len(kept) == 25


def test_likeness_against_true_phrase_sets():
    import random

    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    for share in (0.0, 0.3, 0.7, 0.95):
        a = [rng.choice(words) for _ in range(1500)]
        b = a[: int(len(a) * share)] + [rng.choice(words) for _ in range(len(a) - int(len(a) * share))]
        a, b = " ".join(a), " ".join(b)
        x, y = plain_parse(a), plain_parse(b)
        assert len(x) > 1000
        told = lz_fingerprint.likeness(lz_fingerprint.fingerprint_text(a), lz_fingerprint.fingerprint_text(b))
        assert told == pytest.approx(len(x & y) / len(x | y), abs=0.15)  # 3.4 deviations of a sample of 128


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abc é", max_size=60), st.text(alphabet="abd日", max_size=30))
def test_edited_text_is_parsed_as_by_itself(text, follower):
    digest, own, other = lz_fingerprint._both(text, follower)
    n = len(text) // 4
    changed = text[: len(text) - n] + follower[:n]
    assert digest == hashlib.sha256(changed.encode()).hexdigest()
    assert np.array_equal(own, lz_fingerprint.fingerprint_text(text)) and np.array_equal(other, lz_fingerprint.fingerprint_text(changed))
    assert set(lz_fingerprint.Parser().feed(text)) == plain_parse(text)


def test_very_long_and_repetitive_texts(spark):
    text = "ab" * 200_000 + "é" * 300_000
    assert len(lz_fingerprint.fingerprint_text(text)) == lz_fingerprint.K
    found = lz_fingerprint.edit_ring(spark.createDataFrame([(1, text), (2, "x" * 10), (3, text)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert found[0].fingerprint == found[2].fingerprint and found[0].n_chars == 700_000


def test_long_pieces_agree_with_library():
    own, e = bpe.codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN), encoding()
    rng = np.random.default_rng(4)
    for text in ("a" * 5000, "ab" * 4001, "日本語" * 900, "".join(rng.choice(list("etaoinshr"), 9000)), "=" * 3001 + "-" * 777):
        assert own.encode([text])[0].tolist() == e.encode_ordinary(text)
    for late in (True, False):  # a pair at a time, and all places at once where no token is late
        other = bpe.Codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
        other.late[:] = late | other.late
        assert other.merge_long(b"abcabcabc" * 30).tolist() == e.encode_ordinary("abcabcabc" * 30)


def test_rows_are_placed_by_halving(spark):
    edges = [-5, 0, 3, 3_000_000_000, 2**62]
    values = [-(2**63), -6, -5, -1, 0, 2, 3, 4, 2**40, 2**62, 2**63 - 1]
    for some in (edges, edges[:1], []):
        got = [r.p for r in spark.createDataFrame([(v,) for v in values], "v bigint").coalesce(1).select(lz_fingerprint.below(F_col("v"), some).alias("p")).collect()]
        assert got == [sum(e <= v for e in some) for v in values]


def F_col(name):
    from pyspark.sql import functions as F

    return F.col(name)
