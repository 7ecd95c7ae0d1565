"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the k smallest distinct 64-bit shingle hashes of a text, ascending.
It is a function of the shingle set alone, so sketches of parts merge into the
sketch of the whole, and two sketches estimate resemblance, containment and the
number of distinct shingles. Fewer than k values are the whole set: estimates are
then exact.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common
from tallyloom.llm.words import pieces, shingle_sets

SKETCH_SIZE = 128
SHINGLE_WORDS = 5
_SPAN = 2.0**64


def sketches(texts: pa.Array, k: int = SKETCH_SIZE, shingle: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sketch of each text; null and wordless texts have the empty sketch."""
    out = []
    for _, _, data, offsets in pieces(texts):
        values, counts = shingle_sets(data, offsets, shingle)
        ends = np.cumsum(counts)
        out += [values[e - c : e - c + min(c, k)] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
    return out


def merge(*parts: np.ndarray, k: int = SKETCH_SIZE) -> np.ndarray:
    """Sketch of the union of the sketched sets."""
    return np.unique(np.concatenate(parts))[:k]


def distinct_count(sketch: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th smallest hash as a share of the range."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[k - 1]) + 1) / _SPAN)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated Jaccard likeness: share of the union's k smallest hashes that both sketches hold. Two empty sketches are alike (1)."""
    if not len(a) and not len(b):
        return 1.0
    union = merge(a, b, k=k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], "right")) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated share of a's shingles that b has; an empty a is contained."""
    if not len(a):
        return 1.0
    joined = resemblance(a, b, k) * distinct_count(merge(a, b, k=k), k)
    return min(1.0, joined / max(1.0, distinct_count(a, k)))


def encode(sketch: np.ndarray) -> str:
    """Printable form; equal sketches have equal texts."""
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8").astype(np.uint64)


def fingerprint(docs: DataFrame, text: str = "text", k: int = SKETCH_SIZE, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The columns of ``docs`` and ``_sketch`` (binary, little-endian ascending hashes) of each whole text, in one pass without a shuffle."""
    common.small_batches(docs.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([s.astype("<u8").tobytes() for s in sketches(batch.column(text), k, shingle)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "_sketch"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(add, f"{fields}, _sketch binary")


def merge_by(sketched: DataFrame, keys: list[str], k: int = SKETCH_SIZE) -> DataFrame:
    """One merged ``_sketch`` per key.

    Hashes become rows that are cut to the k smallest distinct ones per key
    before and after the shuffle, so a hot key never meets in one task whole.
    """
    turned = lambda h: "concat(" + ", ".join(f"substring({h}, {2 * i + 1}, 2)" for i in range(7, -1, -1)) + ")"
    hexes = F.expr(f"transform(transform(sequence(0, octet_length(_sketch) div 8 - 1), i -> substring(hex(_sketch), i * 16 + 1, 16)), h -> {turned('h')})")
    rows = sketched.where("octet_length(_sketch) > 0").select(*keys, F.explode(hexes).alias("_hash")).distinct()
    rank = Window.partitionBy(*keys).orderBy("_hash")
    kept = rows.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k)
    packed = F.expr(f"unhex(array_join(transform(array_sort(collect_list(_hash)), h -> {turned('h')}), ''))")
    merged = kept.groupBy(*keys).agg(packed.alias("_found"))
    every = sketched.select(*keys).distinct()
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]
    joined = every.alias("a").join(merged.alias("b"), same, "left")
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in keys], F.coalesce("_found", F.lit(b"")).alias("_sketch"))


def next_in_order(docs: DataFrame, rows_per_range: int = 4_000, most_ranges: int = 2_000) -> DataFrame:
    """Every row of (doc_id, text) in a range of ids, each range closed by a copy of the row that follows it.

    The order is by descending doc_id (nulls last, repeated ids by text), and the
    first row follows the last one. Returns ``_range`` int, ``_tail`` boolean (the
    copy), doc_id, text. Ranges come from quantiles of all ids, ``rows / rows_per_range`` of them
    and ``most_ranges`` at most; one row per range is copied, and the list of those rows is
    all that is joined by value.
    """
    spark = docs.sparkSession
    count = docs.count()
    n = min(most_ranges, max(1, -(-count // rows_per_range)))
    bounds = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10 * n).alias("b")).first()["b"] if n > 1 else []
    bounds = sorted(set(bounds or []))
    # Ascending search for the id's place; nulls (last) go with the lowest ids.
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    ranged = docs.select(F.when(F.col("doc_id").isNull(), 0).otherwise(place).cast("int").alias("_range"), F.lit(False).alias("_tail"), "doc_id", "text")
    # The first row in order of each range: its highest id, and of repeated ids the smallest text.
    heads = ranged.groupBy("_range").agg(F.max("doc_id").alias("_head")).orderBy(F.desc("_range")).collect()
    if not heads:
        return ranged
    before = [heads[-1]["_range"], *[h["_range"] for h in heads[:-1]]]
    # One row per range.
    moves = spark.createDataFrame([(h["_range"], b, h["_head"]) for h, b in zip(heads, before, strict=True)], "_range int, _to int, _head long")
    first = Window.partitionBy("_to").orderBy(F.col("text").asc_nulls_first())
    tails = (
        ranged.alias("r")
        .join(F.broadcast(moves).alias("m"), (F.col("r._range") == F.col("m._range")) & F.col("r.doc_id").eqNullSafe(F.col("m._head")))
        .select("m._to", "r.doc_id", "r.text")
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .select(F.col("_to").alias("_range"), F.lit(True).alias("_tail"), "doc_id", "text")
    )
    return ranged.unionAll(tails)


def edited_fingerprints(docs: DataFrame, k: int = SKETCH_SIZE, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has the last floor(n / 3) code points replaced by the first as
    many (or all) of the next document, in descending doc_id; the first document
    follows the last. A null text counts as empty; a single document follows
    itself; repeated ids follow each other in order of their text. Columns other than doc_id and
    text are ignored. One shuffle by id range, then a sorted pass that holds two texts at a time.
    """
    spark = docs.sparkSession
    common.small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            ids, tails, ranges = (batch.column(c).to_pylist() for c in ("doc_id", "_tail", "_range"))
            texts = batch.column("text").to_pylist()
            found = sketches(batch.column("text"), k, shingle)
            done, edited = [], []
            for at, (doc_id, tail, where, text, sketch) in enumerate(zip(ids, tails, ranges, texts, found, strict=True)):
                text = text or ""
                if held is not None and held[0] == where:
                    old = held[2]
                    cut = len(old) // 3
                    changed = old[: len(old) - cut] + text[:cut]
                    edited.append(changed)
                    done.append((held[1], len(old), hashlib.sha256(changed.encode()).hexdigest(), held[3], sketch))
                held = None if tail else (where, doc_id, text, sketch)
            other = sketches(pa.array(edited, pa.string()), k, shingle) if edited else []
            rows = [(d, n, sha, encode(own), encode(e), resemblance(own, e, k), resemblance(own, after, k)) for (d, n, sha, own, after), e in zip(done, other, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 7, _TYPES, strict=True)], _NAMES)

    ranged = next_in_order(docs.select(F.col("doc_id").cast("long"), "text"))
    placed = ranged.repartition(common.partitions(spark), "_range").sortWithinPartitions("_range", "_tail", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    return placed.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


@common.query()
def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(common.table(spark, sf_dir, "documents"))
