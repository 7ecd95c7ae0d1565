"""Structured Streaming forms, run to completion over the given files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.queries.loads import _UPSERT_SQL, _TABLE, REPLACE, UPSERT, _batch, _shown, _target
from tallyloom.queries.registry import day_text, money, query, tab
from tallyloom.session import scratch_path
from tallyloom.sinks.snapshot import SnapshotTable
from tallyloom.sinks.spec import LoadSpec
from tallyloom.streaming import incremental


def _stream(spark, sf_dir, name):
    """The table as a stream of files, be it one file or a folder of parts."""
    table = tab(spark, sf_dir, name)
    if f"/{name}.parquet/" in next(iter(table.inputFiles()), ""):
        return incremental.stream_files(spark, f"{sf_dir}/{name}.parquet", table.schema)
    return incremental.stream_files(spark, sf_dir, table.schema, pattern=f"{name}.parquet")


@query(_UPSERT_SQL)
def stream_equals_batch(spark, sf_dir):
    """New files through the batch transform into a keyed load; equal to the batch upsert."""
    root = scratch_path(spark, "stream-load")
    table = SnapshotTable(spark, f"{root}/table", _TABLE)
    table.load(_target(spark, sf_dir), REPLACE, "base")

    def lines(df):
        return df.select(
            F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("id"),
            F.col("l_linestatus").alias("tenant"),
            F.col("l_linenumber").cast("bigint").alias("clicks"),
            money(F.col("l_extendedprice")).alias("spend"),
            F.col("l_shipdate").alias("day"),
            F.lit("2024-02-01").cast("date").alias("load_date"),
        )

    incremental.load_stream(_stream(spark, sf_dir, "lineitem"), table, UPSERT, f"{root}/state", "lines", lines).awaitTermination()
    return _shown(table.read())


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf_dir):
    """R2: first arrival of a key within the watermark; the delay spans the table."""
    root = scratch_path(spark, "stream-dedupe")
    events = _stream(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    kept = incremental.dedupe_stream(events, ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type")
    incremental.write_files(kept, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.schema(T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])).parquet(f"{root}/out")


@query("""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events
GROUP BY 1, 2
""")
def stream_daily_metrics(spark, sf_dir):
    """All days; changed totals are upserted, so the newest day is there while it still grows. The delay spans the table."""
    root = scratch_path(spark, "stream-daily")
    events = _stream(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("timestamp").alias("ts"), money(F.col("value")).alias("value")
    )
    daily = incremental.daily_metrics(events, ["event_type"], "ts", "value", "60 days")
    daily = daily.select(day_text(F.col("day_start")).alias("day"), "event_type", "events", F.col("value").cast("double").alias("value"))
    table = SnapshotTable(spark, f"{root}/table", T.StructType.fromDDL("day string, event_type string, events bigint, value double"))
    spec = LoadSpec("daily", ("day", "event_type"), "upsert", order=("events",))
    incremental.upsert_updates(daily, table, spec, f"{root}/state", "daily").awaitTermination()
    return table.read()


@query("""
WITH rows AS (SELECT *, event_id % 2 AS part, (SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 1 DAY AS mark FROM events)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
       CAST(count_if(part <> 0 AND date_trunc('day', ts) + INTERVAL 1 DAY <= mark) AS BIGINT) AS late_events
FROM rows GROUP BY 1, 2
""")
def stream_late_rows(spark, sf_dir):
    """Every other event arrives in a second batch, most of them later than the delay of one day; they are counted, kept and merged in."""
    root = scratch_path(spark, "stream-late")
    events = tab(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), money(F.col("value")).alias("value"))
    metrics = incremental.LateAware(spark, f"{root}/tables", events.schema, ["event_id"], ["event_type"], "ts", "value")
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{root}/landing")
        metrics.start(incremental.stream_files(spark, f"{root}/landing", events.schema), f"{root}/state").awaitTermination()
    metrics.correct()
    late = metrics.late.read().groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("late_events"))
    shown = metrics.daily.read().join(late, ["day", "event_type"], "left")
    return shown.select(day_text(F.col("day")).alias("day"), "event_type", "events", F.col("value").cast("double").alias("value"), F.coalesce("late_events", F.lit(0)).cast("bigint").alias("late_events"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS status, count(*) AS runs FROM events GROUP BY 1, 2")
def stream_run_report(spark, sf_dir):
    """Changed counts are upserted, so the table is the live report."""
    root = scratch_path(spark, "stream-report")
    schema = T.StructType([T.StructField("date", T.StringType()), T.StructField("status", T.StringType()), T.StructField("runs", T.LongType())])
    table = SnapshotTable(spark, f"{root}/table", schema)
    runs = _stream(spark, sf_dir, "events").select(day_text(F.col("ts")).alias("date"), F.col("event_type").alias("status"))
    spec = LoadSpec("run_report", ("date", "status"), "upsert", order=("runs",))
    incremental.upsert_updates(incremental.status_counts(runs), table, spec, f"{root}/state", "report").awaitTermination()
    return table.read()
