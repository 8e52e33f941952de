"""Retries, host rules, the term index, charsets and sliding counts: cases with answers worked out by hand, and plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tejido.functions import charsets
from tejido.operators import hosts, terms
from tejido.streaming import flows, retries


def test_retries_until_done_or_dead(spark, tmp_path):
    outcomes = {  # for each row, what its attempts do: seconds and error
        1: [(5.0, None)], 2: [(5.0, "x"), (7.0, None)], 3: [(1.0, "a"), (130.0, None), (2.0, "c")], 4: [None, (1.0, None)], 5: [None, None, None],
    }
    table = spark.createDataFrame([(i, k + 1, *o) for i, each in outcomes.items() for k, o in enumerate(each) if o], "i bigint, a int, took double, error string")
    asked = []

    def attempt(queue):
        asked.append(queue.count())
        return queue.join(table, (queue.id == table.i) & (queue.attempt == table.a)).select(*queue.columns, "took", "error")

    def keep(df):
        path = str(tmp_path / str(len(list(tmp_path.iterdir()))))
        df.write.parquet(path)
        return spark.read.parquet(path)

    found = retries.run(spark.createDataFrame([(i,) for i in outcomes], "id bigint"), attempt, keep)
    log = {(r.id, r.attempt): (r.due, r.status, r.error, r.ended) for r in found.attempts.collect()}
    assert log == {
        (1, 1): (0.0, "completed", None, 5.0), (2, 1): (0.0, "failed", "x", 5.0), (2, 2): (6.0, "completed", None, 13.0),
        (3, 1): (0.0, "failed", "a", 1.0), (3, 2): (2.0, "timeout", "timeout", 122.0), (3, 3): (124.0, "failed", "c", 126.0),
        (4, 1): (0.0, "timeout", "timeout", 120.0), (4, 2): (121.0, "completed", None, 122.0),
        (5, 1): (0.0, "timeout", "timeout", 120.0), (5, 2): (121.0, "timeout", "timeout", 241.0), (5, 3): (243.0, "timeout", "timeout", 363.0),
    }
    assert asked == [5, 4, 2]
    assert sorted(r.id for r in found.done.collect()) == [1, 2, 4] and {r.id: r.error for r in found.dead.collect()} == {3: "c", 5: "timeout"}


def test_backoff_and_queue_order(spark):
    waits = [r[0] for r in spark.range(1, 7).select(retries.backoff(F.col("id"))).collect()]
    assert waits == [1.0, 2.0, 4.0, 8.0, 10.0, 10.0]
    queue = retries.queued(spark.createDataFrame([(1, 5.0), (2, 1.0), (3, 9.0), (4, 1.0)], "id bigint, at double"), F.col("at"))
    assert [r.id for r in retries.take(queue, 5.0, 3, "id").collect()] == [2, 4, 1]


def test_longest_host_rule(spark):
    rows = spark.createDataFrame([(1, "www.a.gob.mx"), (2, "gob.mx"), (3, "notgob.mx"), (4, None), (5, "A.GOB.MX"), (6, "x.org"), (7, "")], "id int, host string")
    rules = spark.createDataFrame([("gob.mx", 1.0), ("a.gob.mx", 2.0), ("mx", 0.5), ("GOB.MX", 0.7), (None, 9.0), ("b.a.gob.mx", 3.0)], "rule string, delay double")
    found = {r.id: (r.rule, r.delay) for r in hosts.with_rule(rows, rules).collect()}
    assert found == {1: ("a.gob.mx", 2.0), 2: ("GOB.MX", 0.7), 3: ("mx", 0.5), 4: (None, None), 5: ("a.gob.mx", 2.0), 6: (None, None), 7: (None, None)}
    assert hosts.with_rule(rows, rules.limit(0)).count() == 7
    assert "NestedLoop" not in hosts.with_rule(rows, rules)._jdf.queryExecution().toString()


def test_term_index_against_plain_version(spark):
    rng = random.Random(2)
    texts = [(k, "".join(rng.choices("abcñ 😀", k=rng.choice([0, 1, 2, 3, 30, 80])))) for k in range(80)] + [(90, None), (None, "abc abc"), (5, "abcabc")]
    some = {"".join(rng.choices("abcñ ", k=rng.randint(1, 6))) for _ in range(60)} | {"😀a", "a😀b"}
    df, list_ = spark.createDataFrame(texts, "id bigint, text string"), spark.createDataFrame([(t,) for t in [*some, "", None, "abc", "abc"]], "term string")
    found = sorted((str(r.id), r.term) for r in terms.containing(df, list_, "id").collect())
    assert found == sorted({(str(i), t) for i, x in texts if x for t in some | {"abc"} if t in x})
    assert {r.term for r in terms.indexed(list_).collect()} == {t for t in some | {"abc"} if len(t) >= 3}


SPANISH = "El niño comió piñón en la montaña. ¿Dónde está el camión? ¡Qué canción más bonita! Año nuevo, vida nueva: ÁRBOL, Óscar y Él. "


@pytest.mark.parametrize("charset", ["utf-8", "utf-8-sig", "utf-16-le", "utf-16-be", "utf-16", "latin-1", "cp1252", "mac_roman", "cp850", "utf-32"])
def test_charsets_come_back_whole(charset):
    text = SPANISH * 3 + ("“comillas” – raya… 100 €" if charset == "cp1252" else "")
    found, name, sure, errors = charsets.decode(text.encode(charset))
    assert found == text and errors == 0 and 0 < sure <= 1.0
    assert name.replace("-sig", "").startswith(charset[:5].replace("_", "-") if charset.startswith("utf") else {"latin-1": "latin-1"}.get(charset, charset))


def test_charsets_of_other_languages():
    for text in ("Für die Straße über Öl, schöne Grüße. " * 3, "Garçon, où es-tu? Très déçu, l'été à la forêt. " * 3, "São João não é irmão; coração à mão. " * 3):
        for charset in ("latin-1", "cp850", "mac_roman"):
            assert charsets.decode(text.encode(charset))[0] == text


def test_odd_bytes(spark):
    assert charsets.detect(None) == (None, 0.0) and charsets.detect(b"") == ("utf-8", 1.0) and charsets.detect(b"plain") == ("utf-8", 1.0)
    assert charsets.decode(b"\xff\xfe") == ("", "utf-16-le", 1.0, 0)
    assert charsets.decode("año".encode() + b"\xff\xfe" * 3)[3] >= 0
    cut = charsets.decode("﻿año".encode("utf-16-le")[:-1])
    assert cut[0].startswith("añ") and cut[3] == 1
    rows = spark.createDataFrame([(1, bytearray("ñ".encode("latin-1"))), (2, None), (3, bytearray(b"a"))], "id int, content binary").select("id", charsets.decoded(F.col("content")).alias("d")).collect()
    assert {r.id: (r.d.text, r.d.errors) for r in rows} == {1: ("ñ", 0), 2: (None, 0), 3: ("a", 0)}


def test_sliding_counts_and_late_rows(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def land(n, times):
        spark.createDataFrame([(f"2024-01-01 {x}",) for x in times], "at string").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(f"{folder}/part={n}")
        stream = spark.readStream.schema("at timestamp, part int").parquet(folder)
        told = flows.run_counted(flows.sliding_counts(stream, "at", "10 minutes", "5 minutes", "5 minutes"), flows.batch_sink(out), str(tmp_path / "state"))
        return told, sorted((str(r.start)[11:16], r.n) for r in spark.read.parquet(out).collect())

    told, found = land(1, ["10:01:00", "10:07:00", "10:21:00"])
    assert told == {"rows": 3, "late": 0} and found == [("09:55", 1), ("10:00", 2), ("10:05", 1)]
    told, found = land(2, ["10:02:00", "10:17:00", "10:40:00"])  # the first one's windows have been given out
    assert told == {"rows": 3, "late": 2}
    assert found == [("09:55", 1), ("10:00", 2), ("10:05", 1), ("10:10", 1), ("10:15", 2), ("10:20", 1)]
    batch = flows.sliding_counts(spark.read.parquet(folder).filter("hour(at) = 10 and not (minute(at) = 2)"), "at", "10 minutes", "5 minutes", "5 minutes")
    assert {(str(r.start)[11:16], r.n) for r in batch.collect()} >= set(found)


@pytest.fixture
def whole_ranges(spark):
    """Small ranges are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_and_rows_before_over_ranges(spark, whole_ranges):
    from tejido.operators import ranking
    from tejido.plans import scratch

    rng = random.Random(7)
    rows = [(k, rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(50)) for k in range(600)] + [(k, "n", None) for k in range(600, 603)]
    df, keep = spark.createDataFrame(rows, "id bigint, key string, v bigint").repartition(3), scratch.keeper(spark)
    order = sorted(rows, key=lambda r: (r[2] is not None, -(r[2] or 0), r[0]))  # as Spark has it: nulls last where values fall, so they are apart here
    got = {r.id: r["rank"] for r in ranking.rank_whole(df.filter("v is not null"), [F.col("v").desc(), F.col("id")], "rank", keep).collect()}
    assert got == {r[0]: k + 1 for k, r in enumerate(x for x in order if x[2] is not None)}
    got = {r.id: r["rank"] for r in ranking.rank_whole(df, [F.col("v"), F.col("id")], "rank", keep, ["key"]).collect()}
    before = {r.id: r.before for r in ranking.previous(df, ["key"], [F.col("v"), F.col("id")], F.col("v"), "before", keep).collect()}
    want_rank, want_before, seen = {}, {}, {}
    for i, key, v in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        n, last = seen.get(key, (0, None))
        want_rank[i], want_before[i], seen[key] = n + 1, last, (n + 1, v)
    assert got == want_rank and before == want_before
    assert ranking.rank_whole(df.limit(0), [F.col("id")], "rank", keep).count() == 0 == ranking.previous(df.limit(0), ["key"], [F.col("id")], F.col("v"), "p", keep).count()
    placed = ranking.placed(df, [F.col("key"), F.col("id")], keep)
    assert placed.filter("key = 'hot'").select("part_").distinct().count() > 1  # a key over several ranges


def test_scratch_folders_are_shared_ones():
    from tejido.plans import scratch

    class Cluster:
        def __init__(self, folder):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = type("Context", (), {"master": "yarn", "getConf": lambda self: {}})()

    assert scratch.scratch(Cluster("/shared/x/"), "k").startswith("/shared/x/tejido-k-")
    with pytest.raises(ValueError, match="checkpoint"):
        scratch.scratch(Cluster(None), "k")


def test_languages_by_rank_profiles(spark):
    from tejido.operators import language

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    learnt = language.learn(docs.filter("doc_id % 3 <> 0"))
    found = docs.filter("doc_id % 3 = 0").select("lang", language.language(F.col("text"), learnt).alias("l")).collect()
    told = [r for r in found if r.lang is not None and r.l.lang is not None]
    assert len(told) > 250 and sum(r.lang == r.l.lang for r in told) / len(told) > 0.95
    # against a plain version of counts, ranks and distances
    rows = [(1, "aa ab", "x"), (2, "ab b!", "x"), (3, "cc cd", "y"), (4, None, "y"), (5, "cd", None), (6, "12", "y")]
    small = language.learn(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    counts = {"x": {}, "y": {}}
    for _, t, name in rows:
        for w in "".join(c if c.isalpha() else " " for c in t or "").split() if name else []:
            for n in (1, 2, 3):
                for i in range(len(w) + 3 - n):
                    g = f" {w} "[i : i + n]
                    if g != " ":
                        counts[name][g] = counts[name].get(g, 0) + 1
    assert small.of == {name: {g: k for k, g in enumerate(sorted(c, key=lambda g: (-c[g], g)))} for name, c in counts.items()}
    assert small.nearest("ab")[0] == "x" and small.nearest("CD cc")[0] == "y" and small.nearest(" 1") == (None, 0.0) and small.nearest(None) == (None, 0.0)
    assert language.learn(docs.limit(0)).nearest("abc") == (None, 0.0)
    assert small.nearest("ab " * 100_000)[0] == "x"
