"""Feed files are written by the tasks that read the entries, not by one task for each source."""

from tejido import queries as engine


def test_a_source_is_not_one_task(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    found = engine.queries()["s11_feed_files"](spark, str(tmp_path))
    files = [f for f in found.inputFiles() if "source=" in f]
    assert len(files) > len({f.split("source=")[1].split("/")[0] for f in files})
