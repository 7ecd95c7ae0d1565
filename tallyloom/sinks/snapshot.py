"""Writing loads to plain parquet (K1, K3).

Without a table format a path cannot be overwritten while it is read. Here a
load writes a new directory and a one-row commit entry names the directories
that make up the table from then on. A partitioned table rewrites the touched
partitions only: merged rows are staged, then moved in by dynamic partition
overwrite. The staged entry is the point from which the load counts: readers see its
rows at once, whether or not they are moved, and the next writer of any batch moves and
commits them first. Dropping partitions is a commit entry that readers prune by. Replays
of a committed batch id change nothing. One writer per table at a time.

A load evaluates its batch once, into the shared folder, and reads the target once: known rows
are written with a mark, and counters and new rows follow from the marked files. A table
in buckets (a hash of key columns) reads and rewrites the buckets of the batch's keys only.

The log is cut into segments of SEGMENT versions. What full segments say is gathered in a checkpoint,
so the files that a reader opens are those of two segments at most.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import replace
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.columns import align_to_schema, ref
from tallyloom.session import staged
from tallyloom.sinks.merge import append_rows, apply_retention, changed_rows, fresh_rows, key_columns, merge_rows, prepare_batch
from tallyloom.sinks.spec import LoadSpec
from tallyloom.sinks.stats import LoadStats

_COMMIT = (
    "version bigint, state string, batch_id string, locations array<string>, dropped array<string>, rows_from_api bigint, rows_inserted bigint,"
    " rows_updated bigint, rows_skipped bigint, rows_filtered bigint"
)

# Touched partitions that a scan of the target lists by value; with more it is joined to them.
LISTED_PARTITIONS = 1000

# Versions of one log segment.
SEGMENT = 32

_COMMIT_FIELDS = [tuple(f.split()) for f in _COMMIT.split(",")]


class SnapshotTable:
    """A parquet table under ``path`` with a commit log."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None, buckets: int = 0, bucket_keys: Sequence[str] = ()
    ):
        if buckets and (partition_by or not bucket_keys):
            raise ValueError("buckets need key columns to hash and no partition column")
        self.spark, self.path, self.schema, self.partition_by = spark, path.rstrip("/"), schema, partition_by
        self.buckets, self.bucket_keys = buckets, tuple(bucket_keys)

    def _entries(self, folder: str, part: str, fmt: str, after: int) -> DataFrame | None:
        """Log entries under a folder, of parts later than ``after``; other parts are not opened. None without the folder."""
        try:
            rows = self.spark.read.schema(f"{_COMMIT}, {part} int").format(fmt).load(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows.filter(F.col(part) > after)

    def _checkpoint(self) -> int:
        """The last segment that a checkpoint holds; -1 without one."""
        held = self._entries("checkpoints", "upto", "parquet", -1)
        newest = held.agg(F.max("upto")).first()[0] if held is not None else None
        return -1 if newest is None else newest

    def commits(self) -> DataFrame:
        """All entries; those of a checkpoint but the last one without their locations."""
        upto = self._checkpoint()
        late = self._entries("commits", "segment", "json", upto)
        if late is None:
            return self.spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in _COMMIT_FIELDS])
        late = late.drop("segment")
        return late if upto < 0 else self._entries("checkpoints", "upto", "parquet", upto - 1).drop("upto").unionByName(late)

    def _compact(self, segment: int) -> None:
        """Gathers all entries before a segment, once its first one is about to be written."""
        if self._checkpoint() >= segment - 1:
            return
        old = self.commits().filter(F.col("version") < segment * SEGMENT)
        newest = old.filter("state = 'committed'").agg(F.max("version")).first()[0]
        if newest is None:
            return
        none = F.array().cast("array<string>")
        slim = {c: F.when(F.col("version") >= newest, F.col(c)).otherwise(none) for c in ("locations", "dropped")}
        old.withColumns(slim).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/checkpoints/upto={segment - 1}")

    def _state(self, batch_id: str = "") -> Row:
        """The last commit, the commit of one batch and the last staging, in one look at the log."""
        entry = F.struct(*[n for n, _ in _COMMIT_FIELDS])
        committed, mine = F.col("state") == "committed", F.col("batch_id") == batch_id

        def newest(condition):
            return F.max_by(F.when(condition, entry), F.when(condition, F.col("version")))

        return self.commits().agg(
            newest(committed).alias("current"),
            newest(committed & mine).alias("done"),
            newest(F.col("state") == "staged").alias("staged"),
        ).first()

    @staticmethod
    def _pending(state: Row) -> Row | None:
        """The staged load that no commit has followed."""
        version = state.current.version if state.current else 0
        return state.staged if state.staged is not None and state.staged.version > version else None

    def _settled(self, batch_id: str) -> Row:
        """The state once a load that broke after its staging is committed."""
        state = self._state(batch_id)
        left = self._pending(state)
        if left is None:
            return state
        self._overwrite_partitions(state.current, left.version, left.batch_id, left.locations[0], LoadStats.from_row(left))
        return self._state(batch_id)

    def current(self) -> Row | None:
        return self._state().current

    def read(self) -> DataFrame:
        """The table as of the last load; an empty one before the first."""
        state = self._state()
        left = self._pending(state)
        if left is None:
            return self._read(state.current)
        waiting = self.spark.read.schema(self.schema).parquet(left.locations[0])
        return self._meeting(self._read(state.current), waiting, "left_anti").unionByName(waiting)

    def _meeting(self, rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
        """Rows whose partition the others have (``left_semi``) or lack (``left_anti``)."""
        values = others.select(ref(self.partition_by).alias("__part")).distinct()
        return rows.join(values, ref(self.partition_by).eqNullSafe(F.col("__part")), how)

    def _read(self, entry: Row | None, locations: list[str] | None = None) -> DataFrame:
        """Rows of a version, or of some of its locations."""
        locations = locations if locations is not None else list(entry.locations) if entry else []
        if not locations:
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        frame = self.spark.read.schema(self.schema).parquet(*locations)
        if not self.partition_by:
            return frame
        part = ref(self.partition_by)
        if entry.dropped:
            frame = frame.filter(~F.coalesce(part.isin([F.lit(v).cast(self._part_type) for v in entry.dropped]), F.lit(False)))
        return frame.select(*map(ref, self.schema.fieldNames()))

    @property
    def _part_type(self) -> T.DataType:
        return self.schema[self.partition_by].dataType

    def _log(
        self,
        version: int,
        state: str,
        batch_id: str,
        locations: list[str],
        stats: LoadStats,
        dropped: list[str] | None = None,
    ) -> None:
        segment = version // SEGMENT
        if segment:
            self._compact(segment)
        values = [stats.rows_from_api, stats.rows_inserted, stats.rows_updated, stats.rows_skipped, stats.rows_filtered]
        row = [version, state, batch_id, F.array(*map(F.lit, locations)), F.array(*map(F.lit, dropped or [])), *values]
        cols = [(v if isinstance(v, Column) else F.lit(v)).cast(t).alias(n) for v, (n, t) in zip(row, _COMMIT_FIELDS)]
        self.spark.range(0, 1, 1, 1).select(*cols).write.mode("append").json(f"{self.path}/commits/segment={segment}")

    def _write(self, rows: DataFrame, folder: str, mode: str = "overwrite", spread: bool = True) -> str:
        """Writes a folder; ``spread`` evens out file sizes, which rows that come from whole files don't need."""
        location = f"{self.path}/{folder}"
        if self.buckets:
            rows = rows.withColumn("__bucket", self._bucket()).hint("rebalance", "__bucket")
            rows.write.mode(mode).partitionBy("__bucket").parquet(location)
        else:
            (rows.hint("rebalance") if spread else rows).write.mode(mode).parquet(location)
        return location

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*map(ref, self.bucket_keys)), F.lit(self.buckets)).cast("int")

    def _folders(self, location: str) -> list[str]:
        """What a written folder adds to the table: itself or its buckets, whose number is fixed."""
        if not self.buckets:
            return [location]
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("__bucket", T.IntegerType())])).parquet(location)
        return [f"{location}/__bucket={b}" for b in sorted(r[0] for r in written.select("__bucket").distinct().collect())]

    def _split(self, entry: Row | None, new: DataFrame) -> tuple[list[str], list[str]]:
        """Locations that may hold keys of the batch, and the others."""
        places = list(entry.locations) if entry else []
        if not self.buckets:
            return places, []
        touched = {f"__bucket={r[0]}" for r in new.select(self._bucket()).distinct().collect()}
        return [p for p in places if p.rsplit("/", 1)[1] in touched], [p for p in places if p.rsplit("/", 1)[1] not in touched]

    def _write_changes(self, new: DataFrame, target: DataFrame | None, spec: LoadSpec, folder: str) -> tuple[str, int]:
        """Known rows with their mark, then the new ones, which follow from the marks and have none; the number of new rows.

        Without a target all rows are new.
        """
        unmarked = F.lit(None).cast("boolean")
        if target is None:
            return self._write(new.withColumn("__change", unmarked), folder, spread=False), new.count()
        location = self._write(changed_rows(new, target, spec), folder, spread=False)
        marked = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("__change", T.BooleanType())])).parquet(location)
        self._write(fresh_rows(new, marked.filter("__change"), spec).withColumn("__change", unmarked), folder, "append")
        # Listed anew, with the files just added.
        return location, self.spark.read.schema("__change boolean").parquet(location).filter("__change IS NULL").count()

    def _base(self, entry: Row | None) -> str:
        """Directory whose partitions a load overwrites; a full rewrite starts a new one."""
        return entry.locations[0] if entry else f"{self.path}/data/base"

    def _overwrite_partitions(self, entry: Row | None, version: int, batch_id: str, staged: str, stats: LoadStats) -> None:
        base = self._base(entry)
        rows = self.spark.read.schema(self.schema).parquet(staged)
        writer = rows.hint("rebalance", self.partition_by).write.mode("overwrite").partitionBy(self.partition_by)
        writer.option("partitionOverwriteMode", "dynamic").parquet(base)
        dropped = list(entry.dropped) if entry else []
        if dropped:
            part = ref(self.partition_by).cast("string")
            revived = {r[0] for r in rows.select(part.alias("v")).filter(F.col("v").isin(dropped)).distinct().collect()}
            dropped = [v for v in dropped if v not in revived]
        self._log(version, "committed", batch_id, [base], stats, dropped)

    def load(self, batch: DataFrame, spec: LoadSpec, batch_id: str, as_of: date | None = None) -> LoadStats:
        """K1: run one load and return its counters.

        An empty batch is a no-op, so a replace does not empty the table, unless
        the spec allows it (trap T28).
        """
        state = self._settled(batch_id)
        if state.done is not None:
            return LoadStats.from_row(state.done)
        entry = state.current
        version = (entry.version if entry else 0) + 1
        # An order that is no column of the table ranks the batch and goes.
        ranks = [batch.schema[c] for c in spec.order if c not in self.schema.names]
        if not set(self.bucket_keys) <= set(spec.keys or self.schema.names):
            raise ValueError(f"{spec.table}: key {spec.keys} lacks a bucket column of {self.bucket_keys}")
        rows = staged(align_to_schema(batch, T.StructType([*self.schema.fields, *ranks]), spec.keys, as_of), "batch")
        sent = rows.count()
        if sent == 0 and not (spec.allow_empty and spec.mode == "replace"):
            return LoadStats()
        new = staged(prepare_batch(rows, spec).drop(*[f.name for f in ranks]).select(*map(ref, self.schema.names)), "new-rows")
        usable = new.count()
        label = f"v{version:06d}-{re.sub('[^A-Za-z0-9]+', '-', batch_id)}"
        if spec.mode == "replace":
            stats = LoadStats(sent, usable, 0, 0, sent - usable)
            merged = merge_rows(new, self._read(entry), spec)
            # May empty partitions, which a dynamic overwrite would keep.
            locations = [self._write_full(merged, label)] if self.partition_by else self._folders(self._write(merged, f"data/{label}"))
            self._log(version, "committed", batch_id, locations, stats)
            return stats
        touched, others = self._split(entry, new)
        target = self._touched(self._read(entry), new) if self.partition_by else self._read(entry, touched)
        folder = f"{'stage' if self.partition_by else 'data'}/{label}"
        added = 0
        if spec.mode == "append" and not self.partition_by:
            location = self._write(append_rows(new, target, spec), folder)
            added = self.spark.read.schema(self.schema).parquet(location).count()
            kept = [*others, *touched]
        elif spec.mode == "append":
            location = self._write(target.withColumn("__new", F.lit(False)).unionByName(append_rows(new, target, spec).withColumn("__new", F.lit(True))), folder)
            added = self.spark.read.schema("__new boolean").parquet(location).filter("__new").count()
            kept = []
        else:
            location, added = self._write_changes(new, target if touched else None, spec, folder)
            kept = others
        skipped = usable - added if spec.mode == "append" else 0
        updated = usable - added if spec.mode != "append" else 0
        stats = LoadStats(sent, added, updated, skipped, sent - usable)
        if self.partition_by:
            self._log(version, "staged", batch_id, [location], stats)
            self._overwrite_partitions(entry, version, batch_id, location, stats)
        else:
            self._log(version, "committed", batch_id, [*kept, *self._folders(location)], stats)
        return stats

    def _touched(self, target: DataFrame, new: DataFrame) -> DataFrame:
        """Target rows of the partitions that the new rows touch; a short list of values prunes the scan."""
        values = [r[0] for r in new.select(ref(self.partition_by)).distinct().limit(LISTED_PARTITIONS + 1).collect()]
        if len(values) > LISTED_PARTITIONS or None in values:
            return self._meeting(target, new, "left_semi")
        return target.filter(ref(self.partition_by).isin(values))

    def _write_full(self, rows: DataFrame, label: str) -> str:
        location = f"{self.path}/data/{label}"
        rows.hint("rebalance", self.partition_by).write.mode("overwrite").partitionBy(self.partition_by).parquet(location)
        return location

    def drop_partitions(self, values: list, batch_id: str) -> None:
        """Partitions leave the table; nothing is rewritten."""
        state = self._settled(batch_id)
        entry = state.current
        if entry is not None and state.done is None:
            gone = sorted({*entry.dropped, *map(str, values)})
            self._log(entry.version + 1, "committed", batch_id, list(entry.locations), LoadStats(), gone)

    def expire(self, column: str, as_of: date, days: int, batch_id: str) -> None:
        """A version without the rows that are older than ``days`` now; what is loaded later stays.

        By the partition column the partitions of those days leave the table and nothing is rewritten;
        rows without a day stay.
        """
        state = self._settled(batch_id)
        entry = state.current
        if entry is None or state.done is not None:
            return
        version = entry.version + 1
        if column == self.partition_by:
            cutoff = F.lit(str(as_of - timedelta(days=days))).cast(self._part_type)
            # One value per day of the table.
            old = self.read().filter(ref(column) < cutoff).select(ref(column).cast("string")).distinct().collect()
            self.drop_partitions([r[0] for r in old], batch_id)
            return
        kept = apply_retention(self.read(), column, as_of, days)
        label = f"v{version:06d}-expire"
        locations = [self._write_full(kept, label)] if self.partition_by else self._folders(self._write(kept, f"data/{label}"))
        self._log(version, "committed", batch_id, locations, LoadStats())


def load_table(table: SnapshotTable, batch: DataFrame, spec: LoadSpec, batch_id: str, as_of: date | None = None) -> LoadStats:
    """K1 for a batch with any column set; alert-only tables are not loaded."""
    if spec.alert_only:
        raise ValueError(f"{spec.table} is alert-only; write it with write_alerts")
    return table.load(batch, replace(spec, partition_by=table.partition_by or spec.partition_by), batch_id, as_of)


def write_alerts(rows: DataFrame, root: str, table: str) -> str:
    """Produced, not loaded."""
    location = f"{root.rstrip('/')}/alerts/{table}"
    rows.write.mode("append").parquet(location)
    return location
