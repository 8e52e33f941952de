"""The lasting table: versions, conflicts, buckets that are read and written, and a harvest that is opened again."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tejido.operators.store import Conflict, Store
from tejido.plans.session import Harvest, main

SCHEMA = "url_hash string, status string, n bigint"


def store(spark, tmp_path, **more):
    return Store(spark, str(tmp_path / "t"), SCHEMA, buckets=8, **more)


def rows(spark, ids, status="pending", n=0):
    return spark.createDataFrame([(f"k{i}", status, n) for i in ids], SCHEMA)


def held(s):
    return {r.url_hash: (r.status, r.n) for r in s.read().collect()}


def test_a_reopened_table_goes_on(spark, tmp_path):
    s = store(spark, tmp_path)
    assert s.version == 0 and held(s) == {}
    s.insert(rows(spark, range(20)))
    s.merge(rows(spark, [3, 4, 99], "completed", 7), ["status", "n"])
    again = Store(spark, s.root, SCHEMA)
    assert again.version == 2 and again.buckets == 8 and len(held(again)) == 20
    assert held(again)["k3"] == ("completed", 7) and held(again)["k5"] == ("pending", 0)
    again.insert(rows(spark, range(10, 30), "late"))
    assert held(again)["k12"] == ("pending", 0) and held(again)["k25"] == ("late", 0)
    assert s.version == 2 and len(held(s)) == 20  # what it took up
    assert s.refresh() == 3 and len(held(s)) == 30
    assert again.insert(rows(spark, range(5))) == 3  # nothing new, no version


def test_two_writers_cannot_take_one_version(spark, tmp_path):
    a, b = store(spark, tmp_path), store(spark, tmp_path)
    a.insert(rows(spark, range(5)))
    name = b._write(rows(spark, [7]))
    with pytest.raises(Conflict):
        b._commit({**b.manifest, "version": 1, "sets": [name]})
    asked = []

    def late(s):
        if not asked:
            a.insert(rows(spark, [8]))  # another process comes between
        asked.append(s.version)
        return rows(spark, [9])

    b.transact(late)
    assert asked == [1, 2] and set(held(b)) == {f"k{i}" for i in (0, 1, 2, 3, 4, 8, 9)}


def test_written_bytes_follow_the_batch(spark, tmp_path):
    s = store(spark, tmp_path, fold_at=100)
    s.insert(rows(spark, range(5000)))
    size = lambda: sum(os.path.getsize(f) for f in glob.glob(f"{s.root}/data/**/*.parquet", recursive=True))
    first = size()
    s.merge(rows(spark, [1, 2], "completed"), ["status"])
    assert size() - first < first / 10
    plan = s.read(s.touched(rows(spark, [1])))._jdf.queryExecution().toString()
    assert plan.count("bucket=") <= 8 and len(s.touched(rows(spark, [1]))) == 1


def test_folds_touch_changed_buckets_only(spark, tmp_path):
    s = store(spark, tmp_path, fold_at=2)
    s.insert(rows(spark, range(40)))
    s.merge(rows(spark, range(0, 40, 2), "even"), ["status"])
    before, want = dict(s.manifest["base"]), held(s)
    assert not s.manifest["sets"] and len(before) == 8 and len(want) == 40
    s.fold_at = 1
    s.merge(rows(spark, [1], "one"), ["status"])
    changed = {b for b, name in s.manifest["base"].items() if name != before[b]}
    assert changed == {str(b) for b in s.touched(rows(spark, [1]))} and held(s) == want | {"k1": ("one", 0)}
    s.retain(F.col("status") != "even")
    assert held(s) == {k: v for k, v in (want | {"k1": ("one", 0)}).items() if v[0] != "even"}
    assert s.vacuum() > 0 and len(held(Store(spark, s.root, SCHEMA))) == 20
    s.retain(F.lit(None).cast("boolean"))
    assert held(s) == {}


def harvest_pages(spark):
    body = "<p>" + "El gobierno de México publica una noticia sobre la cultura. " * 3
    return spark.createDataFrame([(f"https://a.gob.mx/{i}", f"<html><body><article>{body} {i % 4}</article></body></html>") for i in range(8)], "url string, html string")


def test_a_harvest_goes_on_where_it_was(spark, tmp_path):
    pages, root = harvest_pages(spark), str(tmp_path / "h")
    items = pages.select("url", F.lit("s").alias("source"))
    one = Harvest(spark, root, batch=3)
    one.populate(one.discover(items=items.limit(6)), "2024-01-01 00:00:00")
    one.session(pages, "2024-01-02 00:00:00", rounds=1)
    two = Harvest(spark, root, batch=3)
    assert two.frontier().count() == 6 and two.frontier().filter("status = 'pending'").count() == 3
    two.populate(two.discover(items=items), "2024-01-03 00:00:00")
    assert two.frontier().count() == 8
    report = two.session(pages, "2024-01-03 00:00:00", rounds=9).first()
    assert report.completed == 4 and two.frontier().filter("error_message = 'duplicate'").count() == 4  # four different texts
    assert two.texts().count() == 4 and two.texts().select("content_hash").distinct().count() == 4


def test_rows_of_a_broken_round_come_again(spark, tmp_path):
    pages = harvest_pages(spark)
    h = Harvest(spark, str(tmp_path / "h"), batch=3)
    h.populate(h.discover(items=pages.select("url", F.lit("s").alias("source"))), "2024-01-01 00:00:00")
    assert h.claim("2024-01-02 00:00:00").count() == 3  # its process is lost now
    other = Harvest(spark, str(tmp_path / "h"), batch=8)
    other.session(pages, "2024-01-02 00:30:00", rounds=9)
    assert other.frontier().filter("status = 'processing'").count() == 3  # under lease
    other.session(pages, "2024-01-02 02:00:00", rounds=9)
    state = other.frontier()
    assert state.filter("status = 'processing'").count() == 0 and state.filter("retry_count = 1").count() == 3 and other.texts().count() == 4


def test_two_runs_of_the_command_line_on_one_root(spark, tmp_path):
    harvest_pages(spark).write.parquet(str(tmp_path / "pages"))
    arguments = [str(tmp_path / "cli"), "--pages", str(tmp_path / "pages"), "--rounds", "1"]
    assert main(arguments, lambda: spark) == 0
    first = Harvest(spark, arguments[0])
    state = first.frontier().count(), first.texts().count(), first.version
    assert main(arguments, lambda: spark) == 0
    again = Harvest(spark, arguments[0])
    assert (again.frontier().count(), again.texts().count(), again.version) == state == (8, 4, state[2])
