"""Keyed state with timers: against plain versions, over restarts, and after its horizon."""

from pyspark.sql import functions as F

from tejido.streaming import flows, state

ROWS = [(1, "a", "2024-01-01 00:00:00"), (2, "a", "2024-01-01 00:00:01"), (3, "b", "2024-01-01 00:00:05"), (4, None, "2024-01-01 00:00:05"), (5, "a", "2024-01-01 00:00:01")]
MORE = [(6, "a", "2024-01-01 00:00:03"), (7, "b", "2024-01-01 00:00:05.5"), (8, None, "2024-01-01 00:00:06"), (9, "c", "2024-01-01 00:00:07")]


def land(spark, rows, folder, n):
    spark.createDataFrame(rows, "id bigint, host string, at string").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(f"{folder}/part={n}")


def run(spark, folder, tmp_path, make, late="1 hour"):
    stream = spark.readStream.schema("id bigint, host string, at timestamp, part int").parquet(folder)
    out = str(tmp_path / "out")
    flows.run_stream(make(stream), flows.batch_sink(out), str(tmp_path / "state"))
    return spark.read.parquet(out)


def test_state_outlives_a_restart(spark, tmp_path):
    folder = str(tmp_path / "in")
    make = lambda s: state.gaps(s, ["host"], "id", "at", "1 HOUR", "1 hour")
    land(spark, ROWS, folder, 1)
    first = {r.id: r.gap for r in run(spark, folder, tmp_path, make).collect()}
    assert first == {1: None, 2: 1_000_000, 5: 0, 3: None, 4: None}
    land(spark, MORE, folder, 2)
    both = {r.id: r.gap for r in run(spark, folder, tmp_path, make).collect()}  # a new query on the checkpoint
    assert both == first | {6: 2_000_000, 7: 500_000, 8: 1_000_000, 9: None}


def test_keys_are_new_again_after_the_horizon(spark, tmp_path):
    folder = str(tmp_path / "in")
    make = lambda s: state.new_again(s, ["host"], "id", "at", "10 SECOND")
    land(spark, ROWS, folder, 1)
    assert {r.id for r in run(spark, folder, tmp_path, make).collect()} == {1, 3, 4}
    land(spark, [(6, "a", "2024-01-01 00:00:30"), (7, "a", "2024-01-01 00:00:39"), (8, "b", "2024-01-01 00:00:14"), (9, "z", "2024-01-01 00:01:00")], folder, 2)
    assert {r.id for r in run(spark, folder, tmp_path, make).collect()} == {1, 3, 4, 6, 9}
    land(spark, [(10, "a", "2024-01-01 00:01:30")], folder, 3)  # its timer has taken the state away
    assert {r.id for r in run(spark, folder, tmp_path, make).collect()} == {1, 3, 4, 6, 9, 10}


def test_waits(spark, tmp_path):
    land(spark, ROWS, str(tmp_path / "in"), 1)
    found = {r.id: r.wait for r in run(spark, str(tmp_path / "in"), tmp_path, lambda s: state.waits(s, "host", "id", "at", 2.5)).collect()}
    assert found == {1: 0.0, 2: 1.5, 5: 2.5, 3: 0.0, 4: 0.0}


def test_many_keys_cost_no_call_each(spark, tmp_path):
    """Keys with nulls, of one part and of many, over two batches; a part is a group, not a key."""
    folder = str(tmp_path / "in")
    rows = [(n, f"k{n % 6000}" if n % 7 else None, f"2024-01-01 00:{n % 60:02}:00") for n in range(20_000)]
    make = lambda s: state.gaps(s, ["host"], "id", "at", "50 MINUTE", "2 hours")
    land(spark, rows[:12_000], folder, 1)
    run(spark, folder, tmp_path, make)
    land(spark, [(n, k, at.replace(" 00:", " 01:")) for n, k, at in rows[12_000:]], folder, 2)
    found = {r.id: r.gap for r in run(spark, folder, tmp_path, make).collect()}
    times = sorted((k or "", (n >= 12_000) * 60 + n % 60, n) for n, k, _ in rows)
    want = {n: (at - times[i - 1][1]) * 60_000_000 if i and times[i - 1][0] == k and at - times[i - 1][1] <= 50 else None for i, (k, at, n) in enumerate(times)}
    assert found == want and state.PARTS < 6000
