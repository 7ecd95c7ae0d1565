"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Every source has a mean repetition rate: its target share of all text over the
share it has. A document's number of copies is the Poisson distribution of that
rate inverted at a uniform number hashed from seed and id, so it does not depend
on partitioning or on other documents. Copies are then shuffled globally by
another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common
from tallyloom.session import cut_lineage

SEED = 17
# Target share of a source: its size to this power, normed; flattens large sources.
TEMPERATURE = 0.7
# Rows up to which the table of rates is sent to all tasks; beyond, it is joined by shuffle.
BROADCAST_ROWS = 20_000


def _unit(*parts: Column) -> Column:
    """52 bits of md5 as a number in [0, 1)."""
    return _bits(*parts) / F.lit(float(1 << 52))


def _bits(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def _key(docs: DataFrame) -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate): target share of all characters over the source's share of them.

    Without ``weights`` the target share is size ** temperature, normed. With
    ``weights`` they are normed over the sources present; a source not named has weight 0
    and gets no copies. Null is a source like any other. A source without characters has rate 1.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("_size"))
    if weights is None:
        share = F.pow(F.col("_size").cast("double"), F.lit(temperature))
    elif any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    else:
        share = F.lit(0.0)
        for source, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(weight))).otherwise(share)
        share = F.when(F.col("_size") > 0, share).otherwise(0.0)
    shared = sizes.withColumn("_share", share)
    total = shared.agg(F.sum("_share").alias("_all_shares"), F.sum("_size").alias("_all"))
    # One row: totals over the sources.
    rate = F.col("_share") / F.col("_all_shares") * F.col("_all") / F.col("_size")
    return shared.join(F.broadcast(total)).select("source", F.when(F.col("_size") > 0, rate).otherwise(1.0).alias("rate"))


def cumulative(rates: DataFrame) -> DataFrame:
    """(source, _cdf): ascending Poisson probabilities of at most 0, 1, 2 ... copies, far enough that the rest is below the hash's resolution."""
    k = F.explode(F.sequence(F.lit(0), F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 20).cast("int"))).alias("_k")
    upto = Window.partitionBy("source").orderBy("_k")
    terms = rates.select("source", "rate", k).withColumn("_log_factorial", F.sum(F.log(F.greatest("_k", F.lit(1)).cast("double"))).over(upto))
    log_term = F.when(F.col("rate") > 0, -F.col("rate") + F.col("_k") * F.log("rate") - F.col("_log_factorial")).when(F.col("_k") == 0, 0.0)
    summed = terms.withColumn("_c", F.sum(F.coalesce(F.exp(log_term), F.lit(0.0))).over(upto))
    return summed.groupBy("source").agg(F.array_sort(F.collect_list("_c")).alias("_cdf"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Copies of ``docs`` in a global random order: all its columns, then ``copy`` (from 1) and ``mix_order``.

    Rows with the same doc_id have the same number of copies and neighbour in no
    particular way; a null doc_id is replaced by a hash of the text. A null or empty text is a
    document of size 0. Columns named ``copy`` or ``mix_order`` are replaced. Rates are aggregated
    per source before they meet the documents and, up to a checked number
    of sources, travel to them, so that a hot source is never gathered.
    """
    docs = docs.drop("copy", "mix_order")
    table = cut_lineage(cumulative(repetition_rates(docs, weights, temperature)).withColumnRenamed("source", "_source"))
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    drawn = docs.withColumn("_u", _unit(F.lit(f"{seed}"), _key(docs)))
    counted = drawn.join(table, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_n", F.size(F.filter("_cdf", lambda c: c <= F.col("_u"))))
    copies = counted.where("_n > 0").withColumn("copy", F.explode(F.expr("sequence(1, _n)")))
    order = _bits(F.lit(f"{seed} order"), _key(docs), F.col("copy").cast("string"))
    return copies.withColumn("mix_order", order).select(*docs.columns, "copy", "mix_order").orderBy("mix_order")


ORACLE = f"""
with sized as (select source, sum(coalesce(length(text), 0))::bigint as size from documents group by source),
shared as (select source, size, pow(size::double, {TEMPERATURE}) as share from sized),
rated as (
  select source, case when size > 0 then share / (select sum(share) from shared) * (select sum(size) from shared) / size else 1.0 end as rate from shared),
terms as (select source, rate, k from (select source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::bigint + 1)) as k from rated)),
logs as (select source, rate, k, sum(ln(greatest(k, 1)::double)) over (partition by source order by k) as lf from terms),
cdf as (select source, k, sum(exp(-rate + k * ln(rate) - lf)) over (partition by source order by k) as c from logs),
keyed as (
  select *, coalesce(doc_id::varchar, md5(coalesce(text, ''))) as mix_key from documents),
counted as (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars, d.mix_key,
    (select count(*) from cdf where cdf.source is not distinct from d.source
       and c <= ('0x' || substr(md5('{SEED}:' || d.mix_key), 1, 13))::bigint / 4503599627370496.0) as n
  from keyed d),
copies as (select *, unnest(range(1, n + 1)) as copy from counted where n > 0)
select doc_id, text, lang, source, n_chars, copy::int as copy,
  ('0x' || substr(md5('{SEED} order:' || mix_key || ':' || copy::varchar), 1, 13))::bigint as mix_order
from copies
"""


@common.query(ORACLE)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to temperature-flattened source weights."""
    return mix(common.table(spark, sf_dir, "documents"))
