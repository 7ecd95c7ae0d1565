"""Corpus pipeline: quality, repeated lines, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns
a DataFrame that is written as Parquet and read again as the next one's docs. All
but the last return the columns of ``docs``; other columns than those of documents are
carried along, whatever their names. Empty tables pass through every stage. How each stage
takes nulls, empty texts and repeated rows stands with its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common, line_dedup, mixing, ngram_join, packing, quality

NEEDED = ["doc_id", "text", "source"]


def _slim(docs: DataFrame) -> DataFrame:
    """Needed columns, and all others in one struct, so that their names can't meet an operator's."""
    others = [c for c in docs.columns if c not in NEEDED]
    return docs.select(*NEEDED, (F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("string")).alias("_others"))


def _restored(slim: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` in their order and types."""
    own = {c: F.col(c) if c in NEEDED else F.col("_others").getField(c) for c in docs.columns} | {k: v for k, v in changed.items() if k in docs.columns}
    return slim.select(*[own[f.name].cast(f.dataType).alias(f.name) for f in docs.schema])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network, fitted on the labelled ones, does not reject. Without labels of both kinds none is."""
    common.release(spark)
    net = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    scored = quality.score(_slim(docs), net, column="_score")
    return _restored(scored.where(F.col("_score") >= quality.REJECT_BELOW), docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has; n_chars follows the text. A document all of whose lines are repeats goes."""
    common.release(spark)
    cut = line_dedup.remove_lines(_slim(docs))
    whole = cut.where((F.col("n_removed") == 0) | F.exists(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(" \t\r")) != ""))
    chars = F.when(F.col("n_removed") == 0, F.col("_others").getField("n_chars")).otherwise(F.length("text").cast("long")) if "n_chars" in docs.columns else F.lit(None)
    return _restored(whole, docs, n_chars=chars)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the least doc_id, rows without one last.

    Ids may repeat or be null: documents are told apart by id and text. Of repeated rows of one
    id and text one stays. Texts without words are in no group.
    """
    common.release(spark)
    slim = _slim(docs).withColumn("_key", F.xxhash64("doc_id", "text"))
    found = ngram_join.jaccard_components(slim.select(F.col("_key").alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("_key"), "component_id").distinct()
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    first = groups.join(slim.select("doc_id", "_key").distinct(), "_key").groupBy("component_id").agg(F.min(place).alias("_first"))
    kept = common.stage(first.select("_first._key"), "kept")
    same = Window.partitionBy("_key").orderBy(F.lit(1))
    return _restored(slim.join(kept, "_key", "left_semi").withColumn("_n", F.row_number().over(same)).where("_n = 1"), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and dropped towards the target weights of their sources, in a global random order."""
    common.release(spark)
    return _restored(mixing.mix(_slim(docs)), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of 4,096 tokens."""
    common.release(spark)
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# Training, edit-distance and set joins over components, and tokenizing have no SQL form; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
