"""Near-duplicate vectors: sign hashes of random hyperplanes in several tables, exact cosine, components.

Equal vectors of a label collapse into one representative first. Each table hashes a
representative to the signs of its products with random hyperplanes; vectors of a
bucket are compared exactly, in blocks. A pair counts in the first table where
both share a bucket, so counts need no list of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import common
from tallyloom.llm.graph import components

THRESHOLD = 0.98
# Share of pairs at the very threshold that the tables may miss.
MISSED = 1e-5
# Vectors per block: buckets beyond are compared block by block, in tasks of two blocks.
BLOCK = 1024
SEED = 23


def table_shape(per_label: int, threshold: float = THRESHOLD, missed: float = MISSED) -> tuple[int, int]:
    """Bits and tables: buckets of a few vectors at random, and enough tables for the recall asked."""
    bits = min(24, max(6, round(math.log2(max(1, per_label) / 8))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log(1 - same))


def hyperplanes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def _hashes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    signs = (x @ hyperplanes(x.shape[1], bits, tables) >= 0).reshape(len(x), tables, bits)
    return (signs @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int32)


def linked(x: np.ndarray, signs: np.ndarray, copies: np.ndarray, side: np.ndarray, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (weighted by copies) and the least linked row, direct or through others, of each row of one task.

    ``side``: 0 and 1 where only pairs between two blocks count, all 2 within a block.
    """
    count, root = np.zeros(len(x), np.int64), np.arange(len(x))
    ones, twos = [], []
    for lo in range(0, len(x), 256):
        part = x[lo : lo + 256] @ x.T >= threshold
        i, j = np.nonzero(part)
        i += lo
        keep = (i < j) & ((side[i] == 2) | (side[i] != side[j]))
        i, j = i[keep], j[keep]
        first = (signs[i] == signs[j]).argmax(1) == table
        ones.append(i[first])
        twos.append(j[first])
    i, j = np.concatenate(ones), np.concatenate(twos)
    count += np.bincount(i, copies[j], len(x)).astype(np.int64) + np.bincount(j, copies[i], len(x)).astype(np.int64)
    while True:
        least = np.minimum(root[i], root[j])
        fresh = root.copy()
        np.minimum.at(fresh, i, least)
        np.minimum.at(fresh, j, least)
        fresh = fresh[fresh]
        if (fresh == root).all():
            return count, root
        root = fresh


def near_links(reps: DataFrame, bits: int, tables: int, threshold: float = THRESHOLD) -> DataFrame:
    """(rep, links, root): a row's partial number of links and one node of its group, by task; ``reps`` has rep, label, embedding, copies."""
    spark = reps.sparkSession
    common.small_batches(spark)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(v, np.float64) for v in batch.column("embedding").to_pylist()]
            for dim in sorted({len(v) for v in vectors}):
                at = [k for k, v in enumerate(vectors) if len(v) == dim]
                x = np.stack([vectors[k] for k in at])
                # A power of two keeps the direction exactly and very large or small vectors finite.
                x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
                x /= np.sqrt((x * x).sum(1))[:, None]
                signs = _hashes(x, bits, tables)
                fixed = [batch.column(c).take(pa.array(at)) for c in ("rep", "label", "copies")]
                blobs = [common.binaries(a.reshape(-1), np.full(len(at), a.shape[1])) for a in (signs, x)]
                for table in range(tables):
                    columns = [*fixed, pa.array(np.full(len(at), table, np.int32)), pa.array(signs[:, table]), pa.array(np.full(len(at), dim, np.int32)), *blobs]
                    yield pa.RecordBatch.from_arrays(columns, ["rep", "label", "copies", "table", "sign", "dim", "signs", "x"])

    bucket = ["table", "label", "dim", "sign"]
    rows = reps.select("rep", "label", "copies", "embedding").mapInArrow(hashed, "rep long, label string, copies long, table int, sign int, dim int, signs binary, x binary")
    rows = common.stage(rows, "signs")
    # Buckets of one vector compare nothing; large ones are cut into blocks, and each pair of blocks is a task.
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("_n")).where("_n > 1").withColumn("_blocks", F.ceil(F.col("_n") / BLOCK).cast("int"))
    placed = rows.join(sizes, bucket).withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int"))
    dealt = placed.withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
    dealt = dealt.select(*bucket, F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", "rep", "copies", "signs", "x")
    key = [*bucket, "_i", "_j"]

    def task(parts: list[pa.RecordBatch], table: int, i: int, j: int) -> pa.RecordBatch | None:
        whole = pa.Table.from_batches(parts)
        rep, copies, own = (whole.column(c).to_numpy() for c in ("rep", "copies", "_own"))
        if len(rep) < 2:
            return None
        signs, x = (np.frombuffer(b"".join(whole.column(c).to_pylist()), t).reshape(len(rep), -1) for c, t in (("signs", np.int32), ("x", np.float64)))
        order = np.argsort(rep, kind="stable")
        rep = rep[order]
        side = np.full(len(rep), 2) if i == j else (own[order] == j).astype(np.int64)
        count, root = linked(x[order], signs[order], copies[order], side, table, threshold)
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(count[some]), pa.array(rep[root[some]])], ["rep", "links", "root"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key = None
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in key], strict=True))
            lo = 0
            for at in range(1, len(keys) + 1):
                if at < len(keys) and keys[at] == keys[lo]:
                    continue
                if held_key is not None and held_key != keys[lo]:
                    if (found := task(held, held_key[0], *held_key[-2:])) is not None:
                        yield found
                    held = []
                held.append(batch.slice(lo, at - lo))
                held_key, lo = keys[lo], at
        if held and (found := task(held, held_key[0], *held_key[-2:])) is not None:
            yield found

    return dealt.repartition(common.partitions(spark), *key).sortWithinPartitions(*key).mapInArrow(compare, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; ``vectors`` has vec_id, embedding, label.

    Rows compare only within a label that is not null. Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without vec_id, link with nothing. Repeated rows count each as a
    vector. Vectors of different length never link. Other columns are ignored.
    """
    finite = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("embedding", lambda e: e != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")).withColumn("_usable", usable)
    rows = rows.withColumn("_h", F.when(F.col("_usable"), F.xxhash64("embedding"))).withColumn("_g", F.when(F.col("_usable"), F.hash("embedding")))
    same = ["label", "_h", "_g"]
    groups = rows.where("_usable").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    groups = common.stage(groups, "groups")
    most = groups.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if not most:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    bits, tables = table_shape(most, threshold)
    reps = rows.where("_usable").join(groups.withColumnRenamed("rep", "vec_id"), [*same, "vec_id"]).select(F.col("vec_id").alias("rep"), "label", "embedding", "copies").dropDuplicates(["rep", "label"])
    found = common.stage(near_links(reps, bits, tables, threshold), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_group = groups.join(links, "rep", "left").join(reached.withColumnRenamed("node", "rep"), "rep", "left")
    per_group = per_group.select(*same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("vec_id", *same).join(per_group, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


@common.query()
def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of all embeddings."""
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))
