"""Keyed loads: target from the orders, batch from their lines (repeated keys, null keys, new and known orders)."""

from __future__ import annotations

from contextlib import suppress
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.columns import ref
from tallyloom.queries.registry import day_text, money, query, tab
from tallyloom.session import scratch_path
from tallyloom.sinks import merge
from tallyloom.sinks.snapshot import SnapshotTable
from tallyloom.sinks.spec import LoadSpec
from tallyloom.sources.keyvalue import KeyValueTable, to_entities

_SIDES = """
WITH target AS (
  SELECT o_orderkey AS id, o_orderstatus AS tenant, 1 AS clicks, CAST(o_totalprice AS DECIMAL(18,2)) AS spend, o_orderdate AS day, DATE '2024-01-01' AS load_date
  FROM orders WHERE o_orderstatus IN ('F', 'O')),
batch AS (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS id, l_linestatus AS tenant, l_linenumber AS clicks,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS spend, l_shipdate AS day, DATE '2024-02-01' AS load_date FROM lineitem),
last AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day DESC, clicks DESC, spend DESC, tenant DESC) AS rn
         FROM batch WHERE id IS NOT NULL) WHERE rn = 1),
first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day, clicks, spend, tenant) AS rn
          FROM batch WHERE id IS NOT NULL) WHERE rn = 1)
"""
_OUT = "SELECT id, tenant, CAST(clicks AS BIGINT) AS clicks, CAST(spend AS DOUBLE) AS spend, day, strftime(load_date, '%Y-%m-%d') AS load_date FROM "


def _target(spark, sf_dir):
    return tab(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("tenant"),
        F.lit(1).cast("bigint").alias("clicks"),
        money(F.col("o_totalprice")).alias("spend"),
        F.col("o_orderdate").alias("day"),
        F.lit(date(2024, 1, 1)).alias("load_date"),
    )


def _batch(spark, sf_dir):
    return tab(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("id"),
        F.col("l_linestatus").alias("tenant"),
        F.col("l_linenumber").cast("bigint").alias("clicks"),
        money(F.col("l_extendedprice")).alias("spend"),
        F.col("l_shipdate").alias("day"),
        F.lit(date(2024, 2, 1)).alias("load_date"),
    )


def _shown(df):
    return df.withColumns({"spend": F.col("spend").cast("double"), "load_date": day_text(F.col("load_date"))})


def _merged(spark, sf_dir, spec, batch=None):
    batch = _batch(spark, sf_dir) if batch is None else batch
    return _shown(merge.merge_rows(merge.prepare_batch(batch, spec), _target(spark, sf_dir), spec))


APPEND = LoadSpec("t", ("id",), "append", order=("day",))
REPLACE = LoadSpec("t", ("id",), "replace", order=("day",))
UPSERT = LoadSpec("t", ("id",), "upsert", order=("day",))
PARTIAL = LoadSpec("t", ("id",), "upsert", order=("day",), update=("clicks", "load_date"))
INCREMENT = LoadSpec("t", ("id",), "increment", order=("day",), increment=("clicks", "spend"))


@query(_SIDES + _OUT + "(SELECT * FROM target UNION ALL SELECT * FROM first WHERE id NOT IN (SELECT id FROM target))")
def load_append(spark, sf_dir):
    """K2: only new keys; the first row of a key."""
    return _merged(spark, sf_dir, APPEND)


@query(_SIDES + _OUT + "first")
def load_replace(spark, sf_dir):
    """K3."""
    return _merged(spark, sf_dir, REPLACE)


@query(_SIDES + ", f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day, clicks, spend, tenant) AS rn "
       "FROM batch WHERE id IS NOT NULL AND tenant = 'F') WHERE rn = 1) " + _OUT + "(SELECT * FROM target WHERE tenant <> 'F' UNION ALL SELECT * FROM f)")
def load_scoped(spark, sf_dir):
    """K4: one tenant's rows are replaced, the others stay."""
    spec = LoadSpec("t", ("id",), "replace", order=("day",), scope={"tenant": ["F"]})
    return _merged(spark, sf_dir, spec, _batch(spark, sf_dir).filter("tenant = 'F'"))


_UPSERT_SQL = _SIDES + _OUT + "(SELECT * FROM target WHERE id NOT IN (SELECT id FROM last) UNION ALL SELECT * FROM last)"


@query(_UPSERT_SQL)
def load_upsert(spark, sf_dir):
    """K5: the last row of a key wins."""
    return _merged(spark, sf_dir, UPSERT)


@query(_SIDES + _OUT + """(
  SELECT t.id, t.tenant, coalesce(n.clicks, t.clicks) AS clicks, t.spend, t.day, coalesce(n.load_date, t.load_date) AS load_date
  FROM target t LEFT JOIN last n ON n.id = t.id UNION ALL SELECT * FROM last WHERE id NOT IN (SELECT id FROM target))""")
def load_partial_upsert(spark, sf_dir):
    """Known rows take the named columns only."""
    return _merged(spark, sf_dir, PARTIAL)


@query(_SIDES + _OUT + """(
  SELECT t.id, t.tenant, t.clicks + coalesce(n.clicks, 0) AS clicks, t.spend + coalesce(n.spend, 0) AS spend, t.day, coalesce(n.load_date, t.load_date) AS load_date
  FROM target t LEFT JOIN last n ON n.id = t.id UNION ALL SELECT * FROM last WHERE id NOT IN (SELECT id FROM target))""")
def load_increment(spark, sf_dir):
    """K6: metrics add up, load dates are replaced, the rest stays."""
    return _merged(spark, sf_dir, INCREMENT)


@query(_SIDES + """
, c AS (SELECT (SELECT count(*) FROM batch) AS api, (SELECT count(*) FROM last) AS usable, (SELECT count(*) FROM last WHERE id IN (SELECT id FROM target)) AS known)
SELECT 'append' AS mode, api AS rows_from_api, usable - known AS rows_inserted, 0 AS rows_updated, known AS rows_skipped, api - usable AS rows_filtered, usable - known AS rows_written FROM c UNION ALL
SELECT 'replace', api, usable, 0, 0, api - usable, usable FROM c UNION ALL
SELECT 'upsert', api, usable - known, known, 0, api - usable, usable FROM c UNION ALL
SELECT 'increment', api, usable - known, known, 0, api - usable, usable FROM c
""")
def load_counts(spark, sf_dir):
    """Exact counters of the four modes."""
    batch, target = _batch(spark, sf_dir), _target(spark, sf_dir)
    out = None
    for spec in (APPEND, REPLACE, UPSERT, INCREMENT):
        one = merge.load_counts(batch, target, spec).withColumn("mode", F.lit(spec.mode))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate >= DATE '2001-06-30' - INTERVAL 90 DAY")
def load_retention(spark, sf_dir):
    """K11."""
    o = tab(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return merge.apply_retention(o, "day", date(2001, 6, 30), 90).withColumn("day", day_text(F.col("day")))


@query("SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def key_repeats(spark, sf_dir):
    """The check of a guessed key."""
    return merge.key_repeats(tab(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_TABLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tenant", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("spend", T.DecimalType(18, 2)),
        T.StructField("day", T.TimestampNTZType()),
        T.StructField("load_date", T.DateType()),
    ]
)


@query(_UPSERT_SQL)
def load_snapshot(spark, sf_dir):
    """K1: two real loads into the shared folder, the second repeated; read back."""
    table = SnapshotTable(spark, scratch_path(spark, "snapshot"), _TABLE)
    table.load(_target(spark, sf_dir), REPLACE, "base")
    table.load(_batch(spark, sf_dir), UPSERT, "batch")
    table.load(_batch(spark, sf_dir), UPSERT, "batch")
    return _shown(table.read())


@query(_SIDES + _OUT + """(
  SELECT t.id, t.tenant, t.clicks + coalesce(n.clicks, 0) AS clicks, t.spend + coalesce(n.spend, 0) AS spend, t.day, coalesce(n.load_date, t.load_date) AS load_date
  FROM target t LEFT JOIN last n ON n.id = t.id AND n.id % 3 = 0 UNION ALL SELECT * FROM last WHERE id % 3 = 0 AND id NOT IN (SELECT id FROM target))""")
def load_buckets(spark, sf_dir):
    """K1, K6: an increment on a table in buckets of its key; buckets without a key of the batch are neither read nor rewritten."""
    table = SnapshotTable(spark, scratch_path(spark, "buckets"), _TABLE, buckets=32, bucket_keys=("id",))
    table.load(_target(spark, sf_dir), REPLACE, "base")
    lines = _batch(spark, sf_dir).filter("id % 3 = 0 OR id IS NULL")
    table.load(lines, INCREMENT, "batch")
    table.load(lines, INCREMENT, "batch")
    return _shown(table.read())


@query(_SIDES + _OUT + "(SELECT * FROM target WHERE day >= DATE '1999-01-01' AND id NOT IN (SELECT id FROM last) UNION ALL SELECT * FROM last)")
def load_after_expiry(spark, sf_dir):
    """Rows older than a day leave once; older ones that a later load brings stay."""
    table = SnapshotTable(spark, scratch_path(spark, "expiry"), _TABLE)
    table.load(_target(spark, sf_dir), REPLACE, "base")
    table.expire("day", date(1999, 1, 31), 30, "expire")
    table.load(_batch(spark, sf_dir), UPSERT, "batch")
    return _shown(table.read())


@query("""
WITH target AS (SELECT o_custkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS clicks FROM orders GROUP BY 1, 2),
batch AS (SELECT l_suppkey AS id, CAST(year(l_shipdate) AS VARCHAR) AS year, count(*) AS clicks FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1, 2)
SELECT coalesce(t.id, b.id) AS id, coalesce(t.year, b.year) AS year, coalesce(t.clicks, 0) + coalesce(b.clicks, 0) AS clicks
FROM target t FULL JOIN batch b ON t.id = b.id AND t.year = b.year WHERE coalesce(t.year, b.year) <> '1996'
""")
def load_partitioned(spark, sf_dir):
    """K1, K6, K13 on a partitioned table: an increment rewrites the touched years only; one year is dropped."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("year", T.StringType()), T.StructField("clicks", T.LongType())])
    table = SnapshotTable(spark, scratch_path(spark, "partitioned"), schema, "year")
    spec = LoadSpec("t", ("id", "year"), "increment", increment=("clicks",), partition_by="year")

    def counts(df, key, day):
        grouped = df.groupBy(ref(key).alias("id"), F.year(day).cast("string").alias("year"))
        return grouped.agg(F.count(F.lit(1)).alias("clicks"))

    table.load(counts(tab(spark, sf_dir, "orders"), "o_custkey", "o_orderdate"), spec, "base")
    recent = tab(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.lit(date(2000, 1, 1)))
    table.load(counts(recent, "l_suppkey", "l_shipdate"), spec, "batch")
    table.drop_partitions(["1996"], "drop")
    return table.read()


class _Interrupted(SnapshotTable):
    """A writer that is lost when its rows are staged and moved but not committed."""

    def _log(self, version, state, *rest):
        if state == "committed":
            raise InterruptedError(state)
        super()._log(version, state, *rest)


@query("""
WITH target AS (SELECT o_custkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS clicks FROM orders GROUP BY 1, 2),
batch AS (SELECT l_suppkey AS id, CAST(year(l_shipdate) AS VARCHAR) AS year, count(*) AS clicks FROM lineitem GROUP BY 1, 2)
SELECT coalesce(t.id, b.id) AS id, coalesce(t.year, b.year) AS year, coalesce(t.clicks, 0) + 2 * coalesce(b.clicks, 0) AS clicks
FROM target t FULL JOIN batch b ON t.id = b.id AND t.year = b.year
""")
def load_after_crash(spark, sf_dir):
    """K1, K6: an increment breaks before its commit, another batch loads, the broken one is repeated; each counts once."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("year", T.StringType()), T.StructField("clicks", T.LongType())])
    table = SnapshotTable(spark, scratch_path(spark, "crashed"), schema, "year")
    spec = LoadSpec("t", ("id", "year"), "increment", increment=("clicks",), partition_by="year")

    def counts(name, key, day):
        grouped = tab(spark, sf_dir, name).groupBy(ref(key).alias("id"), F.year(day).cast("string").alias("year"))
        return grouped.agg(F.count(F.lit(1)).alias("clicks"))

    lines = counts("lineitem", "l_suppkey", "l_shipdate")
    table.load(counts("orders", "o_custkey", "o_orderdate"), spec, "base")
    with suppress(InterruptedError):
        _Interrupted(spark, table.path, schema, "year").load(lines, spec, "first")
    table.load(lines, spec, "second")
    table.load(lines, spec, "first")
    return table.read()


@query("""
SELECT o_orderstatus AS "PartitionKey", CAST(o_orderkey AS VARCHAR) AS "RowKey", o_orderstatus AS status, CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'late' ELSE o_orderpriority END AS priority
FROM orders WHERE o_orderstatus <> 'P'
""")
def kv_table(spark, sf_dir):
    """Keyed writes, a second write on some keys, a dropped partition, a filtered read."""
    o = tab(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority")
    )
    kv = KeyValueTable(spark, scratch_path(spark, "kv"), ["status", "id", "priority"])
    kv.write(to_entities(o, "status", ["id"]), "first")
    late = o.filter("priority = '5-LOW'").withColumn("priority", F.lit("late"))
    kv.write(to_entities(late, "status", ["id"]), "second")
    kv.delete_partition("P", "drop")
    return kv.read("RowKey is not null")


_TENANTS = LoadSpec("ads", ("id", "tenant"), "upsert", order=("clicks",))


def _tenant_lines(spark, sf_dir):
    """Lines by supplier group as tenant; those of T3 have bad rows, the target holds every other number once."""
    lines = tab(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("T"), (F.col("l_suppkey") % 7).cast("string")).alias("tenant"),
        F.when((F.col("l_suppkey") % 7 != 3) | (F.col("l_linenumber") != 7), F.col("l_linenumber")).cast("bigint").alias("clicks"),
    )
    return lines, lines.filter("id % 2 = 0").select("id", "tenant").distinct().withColumn("clicks", F.lit(0).cast("bigint"))


_TENANT_SQL = """
WITH lines AS (SELECT l_orderkey * 10 + l_linenumber AS id, 'T' || (l_suppkey % 7) AS tenant, CASE WHEN l_suppkey % 7 <> 3 OR l_linenumber <> 7 THEN l_linenumber END AS clicks FROM lineitem),
bad AS (SELECT DISTINCT tenant FROM lines WHERE clicks IS NULL)
"""


@query(_TENANT_SQL + """
SELECT tenant, CAST(count(*) AS BIGINT) AS rows_from_api,
       CASE WHEN tenant IN (FROM bad) THEN 0 ELSE count(DISTINCT id) FILTER (id % 2 <> 0) END AS rows_inserted,
       CASE WHEN tenant IN (FROM bad) THEN 0 ELSE count(DISTINCT id) FILTER (id % 2 = 0) END AS rows_updated,
       CAST(count_if(clicks IS NULL) AS BIGINT) AS failed_rows, CASE WHEN tenant IN (FROM bad) THEN 'failed' ELSE 'success' END AS status
FROM lines GROUP BY tenant
""")
def tenant_load_counts(spark, sf_dir):
    """One load of all tenants; counters and status of each, a tenant with bad rows fails alone."""
    batch, target = _tenant_lines(spark, sf_dir)
    counts = merge.tenant_counts(batch, target, _TENANTS, "tenant", F.col("clicks").isNotNull())
    return counts.select("tenant", "rows_from_api", "rows_inserted", "rows_updated", "failed_rows", "status")


@query(_TENANT_SQL + """
SELECT id, tenant, clicks FROM lines WHERE id % 3 <> 0 AND tenant NOT IN (FROM bad)
UNION ALL SELECT DISTINCT id, tenant, 0 FROM lines WHERE id % 2 = 0 AND tenant IN (FROM bad)
""")
def tenant_replace(spark, sf_dir):
    """Each sound tenant of the batch is replaced; a failed one keeps what it had."""
    lines, target = _tenant_lines(spark, sf_dir)
    kept, _ = merge.sound_tenants(lines.filter("id % 3 <> 0 OR clicks IS NULL"), "tenant", F.col("clicks").isNotNull())
    return merge.replace_tenants(kept, target, "tenant")
