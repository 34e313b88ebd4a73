import datetime as dt

import pytest

from pyspark.sql import functions as F

from conftest import animal_model
from docspark import Collection, by_field, by_ranges
from docspark.settings import shared_dir
from docspark.streaming.upserts import upsert_stream
from docspark.streaming.windows import windowed_stats


def test_upsert_stream(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "animalId string, name string, _seq int"
    target = Collection(spark, shared_dir(spark), animal_model(), buckets=2)
    checkpoint = str(tmp_path / "ck")

    def drain(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        upsert_stream(stream, target, checkpoint).trigger(availableNow=True).start().awaitTermination()
        return {r._id: r.name for r in target.read().collect()}

    assert drain([("a", "1", 1), ("b", "1", 1)]) == {"a": "1", "b": "1"}
    assert drain([("b", "2", 2), ("b", "3", 3), ("c", "1", 1)]) == {"a": "1", "b": "3", "c": "1"}
    # without the checkpoint everything is read again: the result is the same
    again = spark.readStream.schema(schema).parquet(source)
    upsert_stream(again, target, str(tmp_path / "ck2")).trigger(availableNow=True).start().awaitTermination()
    assert {r._id: r.name for r in target.read().collect()} == {"a": "1", "b": "3", "c": "1"}


def run(stream, target, checkpoint):
    upsert_stream(stream, target, checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_only_newer_documents_are_written(spark, tmp_path):
    schema = "animalId string, name string, _seq int"
    target = Collection(spark, shared_dir(spark), animal_model(), buckets=2)

    def written(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        before = target.last_version()
        run(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), target, str(tmp_path / "ck"))
        changes = spark.read.parquet(f"{target.path}/changes").where(f"_version > {before}")
        return sorted((r._id, r.name) for r in changes.collect())

    assert written([("a", "a5", 5), ("b", "b1", 1), ("a", "a4", 4)]) == [("a", "a5"), ("b", "b1")]
    assert written([("a", "a3", 3), ("b", "b1", 1)]) == []  # late, and a repeat
    assert written([("a", "a6", 6), ("b", "b0", 0), ("c", "c1", 1)]) == [("a", "a6"), ("c", "c1")]
    assert written([("a", "a5", 5), ("b", "b2", 2)] + [("z", "z", 0)] * 50) == [("b", "b2"), ("z", "z")]
    assert {r._id: r.name for r in target.read().collect()} == {"a": "a6", "b": "b2", "c": "c1", "z": "z"}


def test_a_batch_that_runs_again_replaces_what_it_wrote(spark, tmp_path):
    target = Collection(spark, shared_dir(spark), animal_model(), buckets=2)
    docs = spark.range(40).select(F.col("id").cast("string").alias("animalId"))
    for n in (10, 20):
        docs.limit(n).write.mode("append").parquet(str(tmp_path / "in"))
        run(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in")), target, str(tmp_path / "ck"))
    before = spark.read.parquet(f"{target.path}/changes").count()
    assert before == 30 and target.last_version() == 2
    (tmp_path / "ck" / "commits" / "1").unlink()  # as if the second batch had broken off after it was written
    (tmp_path / "ck" / "commits" / ".1.crc").unlink(missing_ok=True)
    run(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in")), target, str(tmp_path / "ck"))
    assert target.last_version() == 2 and spark.read.parquet(f"{target.path}/changes").count() == before


def test_windowed_stats(spark, tmp_path):
    start = dt.datetime(2020, 1, 1)
    rows = [(start + dt.timedelta(minutes=m), k, float(m)) for m, k in [(0, "x"), (5, "x"), (12, "y"), (31, "x")]]
    df = spark.createDataFrame(rows, "t timestamp, k string, v double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    stats = windowed_stats(stream, "t", "PT10M", late="PT1M", by=[by_field("k")], stats={"v": ["sum"]})
    query = (stats.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = {(r.k0, r.k1): (r.total, r.v_sum) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(start, "x"): (2, 5.0), (start + dt.timedelta(minutes=10), "y"): (1, 12.0)}


def test_windowed_stats_with_overlapping_ranges(spark, tmp_path):
    start = dt.datetime(2020, 1, 1)
    rows = [(start + dt.timedelta(hours=h), float(v)) for h, v in [(0, 1), (1, 5), (30, 0)]]
    df = spark.createDataFrame(rows, "t timestamp, v double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    stats = windowed_stats(stream, "t", "P1D", late="PT1S", by=[by_ranges("v", [(0, 3), (1, None)])])
    (stats.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination())
    assert {(r.k0, r.k1): r.total for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {
        (start, 0): 1, (start, 1): 2}


@pytest.mark.parametrize("unit, late, runs", [
    (("month", 1), "PT0S", [([(1, 5), (1, 31)], []), ([(1, 9), (2, 1)], [(1, 1, 3)]), ([(1, 30), (2, 28)], [(1, 1, 3)]),
                            ([(4, 1)], [(1, 1, 3), (2, 1, 2)])]),
    (("month", 1), "P35D", [([(1, 5), (2, 1)], []), ([(1, 6), (2, 2)], []), ([(3, 1)], [(1, 1, 2)]), ([(1, 7), (5, 1)], [(1, 1, 2), (2, 1, 2), (3, 1, 1)])]),
    (("week", 2), "PT0S", [([(1, 6), (1, 12)], []), ([(1, 13)], []), ([(1, 20)], [(1, 6, 3)])]),
])
def test_calendar_buckets_close_in_a_stream(spark, tmp_path, unit, late, runs):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for days, closed in runs:
        rows = [(dt.datetime(2020, month, day, 13),) for month, day in days]
        spark.createDataFrame(rows, "t timestamp").coalesce(1).write.mode("append").parquet(folder)
        stats = windowed_stats(spark.readStream.schema("t timestamp").parquet(folder), "t", unit, late=late)
        writer = stats.writeStream.outputMode("append").format("parquet").option("path", out)
        writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        got = spark.read.schema(stats.schema).parquet(out).collect()
        assert sorted((r.k0, r.total) for r in got) == [(dt.datetime(2020, m, d), n) for m, d, n in closed]
