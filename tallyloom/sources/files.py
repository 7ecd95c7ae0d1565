"""Object listings and file copies."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import staged
from tallyloom.sinks.snapshot import SnapshotTable
from tallyloom.sinks.spec import LoadSpec


def list_files(spark: SparkSession, root: str, since: datetime | None = None, pattern: str | None = None) -> DataFrame:
    """Path, name relative to the root, size and modification time; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(root).select("path", "modificationTime", "length")
    if since is not None:
        files = files.filter(F.col("modificationTime") >= F.lit(since))
    prefix = root.rstrip("/").removeprefix("file:") + "/"
    return files.withColumn("name", F.substring_index("path", prefix, -1))


SEEN = T.StructType([T.StructField("source", T.StringType()), T.StructField("name", T.StringType()), T.StructField("modified", T.TimestampType())])


class Inbox:
    """The files under ``root`` that no earlier run has read, after a stored high-water mark.

    A run reads files no older than the newest one read so far, so the scan itself leaves the rest out, and
    of those of just that time only names not read. ``done`` stores what a run has read, once for its batch id.
    """

    def __init__(self, spark: SparkSession, root: str, state: str, source: str):
        self.spark, self.root, self.source = spark, root.rstrip("/"), source
        self.seen = SnapshotTable(spark, state, SEEN)

    def _read_before(self) -> DataFrame:
        return self.seen.read().filter(F.col("source") == self.source)

    def new_files(self, pattern: str | None = None) -> DataFrame:
        """As list_files(), new ones only; fixed when called."""
        before = self._read_before()
        mark = before.agg(F.max("modified")).first()[0]
        listed = list_files(self.spark, self.root, mark, pattern)
        latest = before.filter(F.col("modified") >= F.lit(mark)) if mark else before
        return staged(listed.join(latest.select("name"), "name", "left_anti"), "new-files")

    def rows(self, files: DataFrame, schema: T.StructType | str, fmt: str = "json") -> DataFrame:
        """Rows of these files; other files are not opened."""
        every = self.spark.read.schema(schema).option("recursiveFileLookup", "true").format(fmt).load(self.root)
        span = files.agg(F.min("modificationTime").alias("lo"), F.max("modificationTime").alias("hi")).first()
        if span["lo"] is None:
            return every.limit(0)
        names = F.col("_metadata.file_path").alias("__file")
        timed = every.filter(F.col("_metadata.file_modification_time").between(F.lit(span["lo"]), F.lit(span["hi"]))).select("*", names)
        base = lambda c: F.regexp_replace(c, "^file:/+", "/")
        wanted = files.select(base(F.col("path")).alias("__base"))
        return timed.withColumn("__base", base(F.col("__file"))).join(wanted, "__base", "left_semi").drop("__file", "__base")

    def done(self, files: DataFrame, batch_id: str) -> None:
        marks = files.select(F.lit(self.source).alias("source"), "name", F.col("modificationTime").alias("modified"))
        self.seen.load(marks, LoadSpec("seen", ("source", "name"), "upsert", order=("modified",)), batch_id)


def file_names(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Distinct existing names."""
    names = list_files(spark, root).select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"))
    return names.filter(F.col("name").endswith(suffix)).distinct()


def copy_recent(spark: SparkSession, source: str, target: str, since: datetime) -> DataFrame:
    """Copy files modified since a time; one row per file with status ``migrated``, ``skipped`` or ``failed``.

    Tasks copy through the shared file system in blocks, so no file is held whole; writes go to a
    temporary name first, so a repeated task leaves the same file.
    """
    listed = list_files(spark, source).withColumn("recent", F.col("modificationTime") >= F.lit(since))

    def copy(batches):
        import os
        import shutil

        for pdf in batches:
            status = []
            for path, name, recent in zip(pdf["path"], pdf["name"], pdf["recent"]):
                if not recent:
                    status.append("skipped")
                    continue
                goal = os.path.join(target, name)
                try:
                    os.makedirs(os.path.dirname(goal), exist_ok=True)
                    part = f"{goal}.{os.getpid()}.part"
                    shutil.copyfile(path.removeprefix("file:"), part)
                    os.replace(part, goal)
                    status.append("migrated")
                except OSError:
                    status.append("failed")
            yield pd.DataFrame({"name": pdf["name"], "status": status})

    spread = listed.repartition(F.xxhash64("path"))
    return spread.select("path", "name", "recent").mapInPandas(copy, "name string, status string")


def copy_counts(copied: DataFrame) -> DataFrame:
    return copied.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def dump_csv(df: DataFrame, path: str) -> None:
    """K18."""
    df.write.mode("overwrite").option("header", True).csv(path)
