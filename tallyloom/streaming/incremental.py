"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.columns import ref
from tallyloom.session import staged
from tallyloom.sinks.snapshot import SnapshotTable
from tallyloom.sinks.spec import LoadSpec


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", pattern: str | None = None, per_trigger: int | None = None) -> DataFrame:
    """New files under a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def query_id(batch: DataFrame, checkpoint: str) -> str:
    """The query's own id, as its checkpoint holds it: epochs of a new checkpoint are other batches, whatever the query's name."""
    return batch.sparkSession.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def load_stream(
    stream: DataFrame,
    table: SnapshotTable,
    spec: LoadSpec,
    checkpoint: str,
    name: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """What is new goes through the batch transform into a keyed load.

    ``foreachBatch`` may repeat a batch after a failure; the load knows its
    batch id and a repeat changes nothing.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        table.load(transform(batch) if transform else batch, spec, f"{name}-{query_id(batch, checkpoint)}-{epoch}")

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 day") -> DataFrame:
    """R2: the first arrival of a key within the watermark; state is bounded by the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_metrics(stream: DataFrame, entity: Sequence[str], ts: str, metric: str, delay: str = "1 day") -> DataFrame:
    """Event count and metric sum per entity and day; appended, a day is emitted once it is past the watermark; in update mode with each change."""
    grouped = stream.withWatermark(ts, delay).groupBy(F.window(ref(ts), "1 day").alias("w"), *map(ref, entity))
    totals = grouped.agg(F.count(F.lit(1)).alias("events"), F.sum(ref(metric)).alias(metric))
    return totals.select(F.col("w.start").alias("day_start"), *map(ref, entity), "events", ref(metric))


class LateAware:
    """R3 with late rows: daily totals as a keyed table, late rows counted and kept, and merged in when asked.

    A row is late if its day had ended ``delay`` before the newest time seen in earlier batches, as a
    watermark would have it; Spark's own aggregation drops such rows uncounted. Totals of a batch are
    an increment under the batch's id, so a repeated batch changes nothing, and no state is held
    between batches but the newest time of each.
    """

    def __init__(self, spark: SparkSession, path: str, rows: T.StructType, keys: Sequence[str], entity: Sequence[str], ts: str, metric: str, delay: str = "1 day"):
        self.keys, self.entity, self.ts, self.metric, self.delay = tuple(keys), tuple(entity), ts, metric, delay
        added = [T.StructField("batch", T.StringType())]
        by = [rows[c] for c in entity]
        self.daily = SnapshotTable(spark, f"{path}/daily", T.StructType([T.StructField("day", T.DateType()), *by, T.StructField("events", T.LongType()), rows[metric]]))
        self.late = SnapshotTable(spark, f"{path}/late", T.StructType([*rows.fields, *added]))
        self.seen = SnapshotTable(spark, f"{path}/seen", T.StructType.fromDDL("query string, epoch bigint, newest timestamp"))

    def _totals(self, rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(ref(self.ts).cast("date").alias("day"), *map(ref, self.entity))
        return grouped.agg(F.count(F.lit(1)).alias("events"), F.sum(ref(self.metric)).cast(self.daily.schema[self.metric].dataType).alias(self.metric))

    def _add(self, rows: DataFrame, batch_id: str) -> None:
        self.daily.load(self._totals(rows), LoadSpec("daily", ("day", *self.entity), "increment", order=("events",), increment=("events", self.metric)), batch_id)

    def load(self, batch: DataFrame, query: str, epoch: int) -> None:
        """One micro-batch; also a repeated one."""
        rows, batch_id = staged(batch, "late-aware"), f"{query}-{epoch}"
        before = self.seen.read().filter((F.col("query") == query) & (F.col("epoch") < epoch)).agg(F.max("newest")).first()[0]
        ended = F.timestamp_add("DAY", F.lit(1), F.date_trunc("day", ref(self.ts)))
        is_late = F.coalesce(ended <= F.lit(before) - F.expr(f"INTERVAL {self.delay}"), F.lit(False)) if before else F.lit(False)
        self._add(rows.filter(~is_late), batch_id)
        self.late.load(rows.filter(is_late).withColumn("batch", F.lit(batch_id)), LoadSpec("late", self.keys, "append", order=(self.ts,)), batch_id)
        newest = rows.agg(F.max(ref(self.ts)).alias("newest")).select(F.lit(query).alias("query"), F.lit(epoch).cast("bigint").alias("epoch"), "newest")
        self.seen.load(newest, LoadSpec("seen", ("query", "epoch"), "append", order=("newest",)), batch_id)

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(lambda batch, epoch: self.load(batch, query_id(batch, checkpoint), epoch))
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def correct(self) -> None:
        """Late rows merged into the totals, once: a load for each batch that had some, under its own id."""
        late = self.late.read()
        for r in late.select("batch").distinct().orderBy("batch").collect():
            self._add(late.filter(F.col("batch") == r["batch"]), f"late-{r['batch']}")


def status_counts(stream: DataFrame) -> DataFrame:
    """Runs per date and status; use with ``update`` or ``complete`` output."""
    return stream.groupBy("date", "status").agg(F.count(F.lit(1)).alias("runs"))


def write_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append output as parquet files, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_updates(stream: DataFrame, table: SnapshotTable, spec: LoadSpec, checkpoint: str, name: str) -> StreamingQuery:
    """Changed aggregate rows upserted by key, so the table always shows the current state."""

    def load(batch: DataFrame, epoch: int) -> None:
        table.load(batch, spec, f"{name}-{query_id(batch, checkpoint)}-{epoch}")

    writer = stream.writeStream.outputMode("update").foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
