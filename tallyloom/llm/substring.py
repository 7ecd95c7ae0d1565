"""Substring deduplication on a sparse de Bruijn graph of token k-mers.

The graph's edges are 25-word k-mers; of the 26 edges inside a 50-word window the
one of least hash is kept, so equal windows keep equal edges wherever they stand.
Neighbouring windows with the same edge are a path in their document and compact
into one row: edge, source coordinates and one hash of the path's windows. Rows
of an edge meet in a Spark shuffle. Where all of them have the same path the edge does not
branch, and the whole path repeats the one of the smallest id. Where paths differ the edge
branches, and its windows are verified one by one at their source coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common
from tallyloom.llm.words import mix, pieces, windows, words

WINDOW, EDGE = 50, 25
LAST_ID = (1 << 63) - 1


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - span :][: len(values) - width + 1]) if width > span else least


def paths_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, edge: int = EDGE) -> tuple[np.ndarray, ...]:
    """Compacted paths of a few texts: edge, text, first window's word, number of windows, and the window hashes of all paths in order."""
    hashes, counts, _, _ = words(data, offsets)
    grams, _, _ = windows(hashes, counts, edge)
    whole, owner, place = windows(hashes, counts, window)
    if not len(whole):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, whole
    # Place of each window's first edge among the edges of all texts.
    edges_per_text = np.maximum(0, counts - edge + 1)
    base = np.cumsum(edges_per_text) - edges_per_text
    least = _least_of(grams, window - edge + 1)[base[owner] + place]
    first = np.ones(len(least), bool)
    first[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return least[at], owner[at], place[at], np.diff(np.append(at, len(least))), whole


def repeated_in(edges: np.ndarray, ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, held: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which windows also start in a document of smaller id; rows are sorted by edge, then id.

    ``held``: edge, window hashes and least ids of the edge that the rows before ended with. Returns the marks and the same for these rows.
    """
    row = np.repeat(np.arange(len(edges)), sizes)
    keys, docs, count = hashes, ids[row], len(row)
    if held is not None and held[0] == edges[0]:
        keys, docs = np.concatenate([held[1], keys]), np.concatenate([held[2], docs])
    # Equal windows have equal edges, and the first row of a window has its least id.
    unique, begin, inverse = np.unique(keys, return_index=True, return_inverse=True)
    least = docs[begin]
    marks = (least[inverse] < docs)[len(docs) - count :]
    last = np.zeros(len(keys), bool)
    last[len(keys) - count :] = (edges == edges[-1])[row]
    if held is not None and held[0] == edges[-1]:
        last[: len(keys) - count] = True
    stay = np.zeros(len(unique), bool)
    stay[inverse[last]] = True
    return marks, (edges[-1], unique[stay], least[stay])


def repeated_spans(docs: DataFrame, window: int = WINDOW, edge: int = EDGE) -> DataFrame:
    """(_id, _hash, start, end): word spans of windows that also start in a document with a smaller id.

    ``docs`` has _id, _hash (which tell rows apart) and text. A branching edge's
    rows are read in order of id as a stream; what is kept of them is 16 bytes per distinct window.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    docs = docs.select("_id", "_hash", "text")

    def rows_of(batches: Iterator[pa.RecordBatch], bits: bytes | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(c).to_numpy() for c in ("_id", "_hash"))
            for lo, _, data, offsets in pieces(batch.column("text")):
                edges, owner, start, sizes, hashes = paths_of(data, offsets, window, edge)
                if not len(edges):
                    continue
                if bits is None:
                    path = mix(np.add.reduceat(mix(hashes), np.cumsum(sizes) - sizes) + sizes.astype(np.uint64)).view(np.int64)
                    rest = [pa.array(sizes.astype(np.int32)), pa.array(path)]
                else:
                    use = common.bits_at(bits, edges)
                    hashes = hashes[np.repeat(use, sizes)]
                    edges, owner, start, sizes = edges[use], owner[use], start[use], sizes[use]
                    rest = [common.binaries(hashes, sizes)]
                columns = [pa.array(edges.view(np.int64)), pa.array(ids[lo + owner]), pa.array(marks[lo + owner]), pa.array(start.astype(np.int32)), *rest]
                yield pa.RecordBatch.from_arrays(columns, ["_edge", "_id", "_hash", "_start", "_windows"] if bits else ["_edge", "_id", "_hash", "_start", "_count", "_path"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            edges, ids, rows, starts = (batch.column(c).to_numpy() for c in ("_edge", "_id", "_hash", "_start"))
            blob = batch.column("_windows")
            ends = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
            hashes = np.frombuffer(blob.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint64)
            sizes = np.diff(ends) // 8
            marks, held = repeated_in(edges, ids, sizes, hashes, held)
            found = np.flatnonzero(marks)
            if not len(found):
                continue
            row = np.repeat(np.arange(len(edges)), sizes)[found]
            place = found - (np.cumsum(sizes) - sizes)[row] + starts[row]
            fresh = np.ones(len(found), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
            at = np.flatnonzero(fresh)
            stop = np.append(at[1:], len(found)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row[at]]), pa.array(rows[row[at]]), pa.array(place[at].astype(np.int32)), pa.array((place[stop] + window).astype(np.int32))], ["_id", "_hash", "start", "end"]
            )

    paths = docs.mapInArrow(lambda b: rows_of(b, None), "_edge long, _id long, _hash long, _start int, _count int, _path long")
    same = Window.partitionBy("_edge")
    met = paths.select("*", F.min("_id").over(same).alias("_first"), F.max("_id").over(same).alias("_last"), (F.min("_path").over(same) != F.max("_path").over(same)).alias("_branches"))
    met = common.stage(met.where("_first < _last").drop("_last", "_path"), "paths")
    whole = met.where("not _branches and _id > _first").select("_id", "_hash", F.col("_start").alias("start"), (F.col("_start") + F.col("_count") + (window - 1)).alias("end"))
    # The bitmap holds the branching edges; other edges that it lets through are verified the same way.
    bits = common.bitmap(met.where("_branches"), common.slot_of(F.col("_edge")))
    sent = spark.sparkContext.broadcast(bits)
    open_paths = docs.mapInArrow(lambda b: rows_of(b, sent.value), "_edge long, _id long, _hash long, _start int, _windows binary")
    parted = open_paths.repartition(common.partitions(spark), "_edge").sortWithinPartitions("_edge", "_id").mapInArrow(verify, "_id long, _hash long, start int, end int")
    return whole.unionByName(parted)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, edge: int = EDGE) -> DataFrame:
    """The columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space).

    A word goes if a window of ``window`` consecutive words that covers it also starts in
    a document with a smaller doc_id; all windows are judged on the input. A null text has no words. A row without
    doc_id counts as the last document. Rows of the same id do not remove from each other. Columns with the
    names of the new ones are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    keyed = docs.select(*names).withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))).withColumn("_hash", F.xxhash64(F.col(text)))
    spans = common.stage(repeated_spans(keyed.select("_id", "_hash", F.col(text).alias("text")), window, edge), "spans")
    # At most one span per window start of one document.
    lists = spans.groupBy(F.col("_id").alias("_i"), F.col("_hash").alias("_h")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    lists = lists.select("_i", "_h", F.col("_spans.start").alias("_starts"), F.col("_spans.end").alias("_ends"))
    # Texts that surely have no span need not move.
    bits = common.bitmap(spans, common.slot_of(F.col("_hash")))
    moved = common.where_bit(keyed, "_hash", bits).join(lists, (F.col("_id") == F.col("_i")) & (F.col("_hash") == F.col("_h")), "left")
    still = common.where_bit(keyed, "_hash", bits, present=False).select(*names, *[F.lit(None).cast("array<int>").alias(c) for c in ("_starts", "_ends")])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for whole, starts, ends in zip(batch.column(text).to_pylist(), batch.column("_starts").to_pylist(), batch.column("_ends").to_pylist(), strict=True):
                parts = (whole or "").encode().split()
                counts.append(len(parts))
                if starts:
                    stay = np.ones(len(parts), bool)
                    for a, b in zip(starts, ends, strict=True):
                        stay[a:b] = False
                    parts = [parts[i] for i in np.flatnonzero(stay)]
                removed.append(counts[-1] - len(parts))
                kept.append(b" ".join(parts).decode())
            rest = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], [*names, "n_words", "n_removed", "kept_text"])

    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    schema = f"{fields}, n_words long, n_removed long, kept_text string"
    return moved.select(*names, "_starts", "_ends").mapInArrow(keep, schema).unionByName(still.mapInArrow(keep, schema))


@common.query()
def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has, removed from all documents."""
    found = remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
