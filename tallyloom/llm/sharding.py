"""Sharding by jump consistent hashing.

A row's key is hashed to 64 bits, and the hash jumps through growing shard counts
until the next jump would pass the count in use. Key and count alone decide, no
table of shards is kept, and with one more shard a row either stays or moves into the
new one: 1/(n + 1) of the rows, which is the least that keeps shards even. Inside a
shard, rows have gapless slots, which are counted per range of a global sort, so that a shard
is numbered by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common

SHARDS = 8
LAW = "key"
# Fixed values of the published jump hash: multiplier of its generator, and 2^31.
_MULTIPLIER, _SPAN = np.uint64(2862933555777941757), float(1 << 31)


def jump(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit hash. About ln(shards) jumps a row, all rows at once."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = hashes.astype(np.uint64)
    found, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        found[moving] = ahead[moving]
        state[moving] = state[moving] * _MULTIPLIER + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1
        ahead[moving] = ((found[moving] + 1) * (_SPAN / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return found


def key_hash(*keys: Column) -> Column:
    """64 bits of md5 of the key columns as text, each with its length, so that neighbouring columns don't run into each other; null is a key of its own."""
    parts = [F.when(k.isNull(), "-").otherwise(F.concat(F.length(k.cast("string")).cast("string"), F.lit(":"), k.cast("string"))) for k in keys]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def shard_of(hashes: Column, shards: int) -> Column:
    """Shard of a column of 64-bit hashes, in Arrow batches."""

    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(jump(batch.to_numpy().view(np.uint64), shards), dtype="int32")

    return run(hashes)


def assign(docs: DataFrame, shards: int = SHARDS, keys: Sequence[str] = ("doc_id",), grown: bool = False) -> DataFrame:
    """The columns of ``docs`` with ``shard``, and with ``grown``, ``grown_shard``: the one with a shard more.

    Rows of equal keys share a shard, those without a key too; texts don't matter, so equal
    texts of other keys are spread. Columns of ``docs`` with the names of the new ones are replaced. Map-only.
    """
    new = {"shard": shards} | ({"grown_shard": shards + 1} if grown else {})
    hashed = docs.drop("shard", "grown_shard").withColumn("_hash", key_hash(*[F.col(f"`{k}`") for k in keys]))
    return hashed.withColumns({name: shard_of(F.col("_hash"), n) for name, n in new.items()}).drop("_hash")


def number(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``slot``: gapless numbers from 0 in each shard, by ``order`` (nulls first).

    Rows are sorted into ranges by shard and order; a range counts its rows of each shard, and
    the ranges before it are added. Rows that are equal in all of ``order`` are dealt out by a hash of
    the row and then in any way: equal rows are alike. An empty table has no slots.
    """
    spark = rows.sparkSession
    by = ["shard", *[f"`{c}`" for c in order], "_mix"]
    rows = rows.drop("slot")
    mixed = rows.withColumn("_mix", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.monotonically_increasing_id()))
    ranges = mixed.repartitionByRange(common.partitions(spark), *by).sortWithinPartitions(*by).drop("_mix")
    placed = common.stage(ranges.withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "ranges")
    counted = placed.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # One row a range, and one more where a shard begins inside it.
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).select("shard", "_range", "_base")
    numbered = placed.join(common.stage(offsets, "offsets"), ["shard", "_range"])
    return numbered.withColumn("slot", F.col("_base") + F.col("_row")).drop("_base", "_row", "_range")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Documents written as Parquet, a folder a shard, in slot order inside each file; returns them as read back, with ``shard`` and ``slot``."""
    ordered = number(assign(docs, shards, keys), list(keys))
    spark = docs.sparkSession
    ordered.repartitionByRange(common.partitions(spark), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(ordered.schema).parquet(path)


def grow(spark: SparkSession, path: str, target: str, shards: int, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The rows of written shards that a shard more takes, written to ``target`` as shard ``shards``; returned with the shard they leave in ``left``.

    Rows that stay are neither shuffled nor written again.
    """
    moved = assign(spark.read.parquet(path).withColumnRenamed("shard", "left").drop("slot"), shards + 1, keys).where(F.col("shard") == shards)
    moved.write.partitionBy("shard").parquet(target)
    return spark.read.schema(moved.schema).parquet(target)


def summary(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 1; null has none), text_crc32, law, shard, slot and grown_shard of every document; only these are shuffled."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    numbered = number(assign(slim, shards, grown=True), ["doc_id"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")


@common.query()
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of all documents among 8 shards, and the shard among 9. A null text is empty; rows without doc_id share a shard; repeated rows have slots of their own."""
    common.small_batches(spark)
    return summary(common.table(spark, sf_dir, "documents"))
