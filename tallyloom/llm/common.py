"""Helpers shared by the operators: batch bounds, table access and packed results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Rows and bytes of one Arrow batch, so that a worker holds a few MB of text at a time whatever the partition size.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "20000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}
# Size of a bitmap that travels to all tasks: 2 MB, however much it stands for. A full one only filters less.
BITMAP_BITS = 24


def query(oracle: str | None = None):
    """Register a query function under its own name."""

    def keep(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def partitions(spark: SparkSession, least: int = 1) -> int:
    """Shuffle partitions as the session sets them for its data."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the fold of a row."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def sampled_ids(known: DataFrame, by: str, most: int) -> DataFrame:
    """(doc_id, ``by``, _n) of at most ``most`` ids for each value of ``by``, chosen by a hash; _n counts them from 1.

    An id that repeats counts once a value; equal hashes go by id. Most ids are ruled
    out by hash before any is ranked, so a task ranks a few times ``most``, whatever a value's share of the table.
    """
    sized = known.groupBy(by).agg(F.approx_count_distinct("doc_id").alias("_ids"))
    drawn = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) < F.lit(4.0 * most * (1 << 30)) / F.col("_ids")
    # One row a value goes to all tasks: joined by shuffle, a value's rows would meet in one before they are cut.
    ids = known.select("doc_id", by).join(F.broadcast(sized), by).where(drawn).select("doc_id", by).distinct()
    rank = Window.partitionBy(by).orderBy(F.xxhash64("doc_id"), "doc_id")
    return ids.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= most)


def sampled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` with the least text of its ids; repeats are dropped in the tasks that read them. ``chosen`` is bounded by sampled_ids()."""
    keys = [c for c in chosen.columns if c in docs.columns]
    return docs.join(F.broadcast(chosen), keys).where("text is not null").groupBy(*chosen.columns).agg(F.min("text").alias("text"))


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per row out of a flat array and the number of its elements per row."""
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=ends[1:])
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch holds over 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the folder all executors share, and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left: Spark removes their shuffle files and broadcasts when the driver collects its garbage, which it may put off for long."""
    spark.sparkContext._jvm.System.gc()


def slot_of(value: Column) -> Column:
    """Bitmap slot of a 64-bit hash: its low bits."""
    return value.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))


def bitmap(df: DataFrame, slot: Column) -> bytes:
    """Slots present in ``df`` as bits. At most 2^18 rows of 64 slots each reach the driver."""
    words = df.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.astype("<i8").tobytes()


def bits_at(bits: bytes, values: np.ndarray) -> np.ndarray:
    """Whether the bits of these 64-bit hashes are set."""
    slot = values.astype(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)
    return (np.frombuffer(bits, np.uint8)[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def where_bit(df: DataFrame, column: str, bits: bytes, present: bool = True) -> DataFrame:
    """Rows whose 64-bit hash in ``column`` has its bit set, or not set; no shuffle."""
    sent = df.sparkSession.sparkContext.broadcast(bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bits_at(sent.value, batch.column(column).to_numpy()) == present))

    return df.mapInArrow(keep, df.schema)
