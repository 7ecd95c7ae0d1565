"""Streams over files that arrive in steps."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyloom.schemas import struct
from tallyloom.session import scratch_path
from tallyloom.sinks.snapshot import SnapshotTable
from tallyloom.sinks.spec import LoadSpec
from tallyloom.streaming import incremental

SCHEMA = struct(k="long", v="long", ts="ts")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def drop(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_load_stream_in_steps_equals_batch(spark):
    root = scratch_path(spark, "st")
    table = SnapshotTable(spark, f"{root}/t", SCHEMA)
    spec = LoadSpec("t", ("k",), "upsert", order=("ts",))
    t0 = datetime(2024, 1, 1)
    steps = [[(1, 1, t0), (2, 1, t0)], [(2, 5, t0 + timedelta(hours=1)), (3, 1, t0)], []]
    for data in steps:
        if data:
            drop(spark, f"{root}/in", data)
        stream = incremental.stream_files(spark, f"{root}/in", SCHEMA)
        incremental.load_stream(stream, table, spec, f"{root}/state", "q").awaitTermination()
    assert rows(table.read().select("k", "v")) == [(1, 1), (2, 5), (3, 1)]


def test_repeated_epoch_adds_nothing(spark):
    table = SnapshotTable(spark, scratch_path(spark, "st"), SCHEMA)
    spec = LoadSpec("t", ("k",), "increment", order=("ts",), increment=("v",))
    batch = spark.createDataFrame([(1, 2, datetime(2024, 1, 1))], SCHEMA)
    for _ in range(2):
        table.load(batch, spec, "q-0")
    assert rows(table.read().select("k", "v")) == [(1, 2)]


def test_dedupe_over_files(spark):
    root = scratch_path(spark, "st")
    t0 = datetime(2024, 1, 1)
    for data in ([(1, 1, t0), (1, 2, t0)], [(1, 3, t0 + timedelta(hours=1)), (2, 1, t0)]):
        drop(spark, f"{root}/in", data)
        stream = incremental.stream_files(spark, f"{root}/in", SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
        kept = incremental.dedupe_stream(stream, ["k"], "ts", "2 days").select("k")
        incremental.write_files(kept, f"{root}/out", f"{root}/state").awaitTermination()
    assert rows(spark.read.schema("k long").parquet(f"{root}/out")) == [(1,), (2,)]


def test_daily_metrics_emit_each_day_once(spark):
    root = scratch_path(spark, "st")
    t0 = datetime(2024, 1, 1, 12)
    for data in ([(1, 1, t0), (1, 2, t0)], [(1, 3, t0 + timedelta(days=1))], [(1, 9, t0 + timedelta(days=9))]):
        drop(spark, f"{root}/in", data)
        stream = incremental.stream_files(spark, f"{root}/in", SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
        days = incremental.daily_metrics(stream, ["k"], "ts", "v", "1 day").select(F.date_format("day_start", "dd").alias("d"), "k", "events", "v")
        incremental.write_files(days, f"{root}/out", f"{root}/state").awaitTermination()
    out = spark.read.schema("d string, k long, events long, v long").parquet(f"{root}/out")
    assert rows(out) == [("01", 1, 2, 3), ("02", 1, 1, 3)]


def test_live_report(spark):
    root = scratch_path(spark, "st")
    schema = struct(date="string", status="string", runs="long")
    table = SnapshotTable(spark, f"{root}/t", schema)
    spec = LoadSpec("r", ("date", "status"), "upsert", order=("runs",))
    for n in (1, 2):
        spark.createDataFrame([("d", "success")] * n, "date string, status string").coalesce(1).write.mode("append").json(f"{root}/in")
        stream = spark.readStream.schema("date string, status string").json(f"{root}/in")
        incremental.upsert_updates(incremental.status_counts(stream), table, spec, f"{root}/state", "r").awaitTermination()
    assert rows(table.read()) == [("d", "success", 3)]
