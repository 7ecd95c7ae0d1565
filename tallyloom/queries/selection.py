"""Filters, unions, ranges and hierarchies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyloom.operators import filters
from tallyloom.queries.registry import AS_OF, day_text, query, tab
from tallyloom.sources import chunks, hierarchy, records


@query("""
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id, 'C' || o_custkey AS name FROM orders
WHERE o_orderstatus = 'O'
   OR (o_orderstatus = 'P' AND (o_orderpriority = '5-LOW' OR o_orderdate >= TIMESTAMP '2001-04-01'))
""")
def eligible_campaigns(spark, sf_dir):
    """F10."""
    status = F.when(F.col("o_orderstatus") == "O", "ACTIVE").when(F.col("o_orderstatus") == "P", "COMPLETED").otherwise("ARCHIVED")
    c = tab(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("name"),
        status.alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("end_date"),
    )
    return filters.eligible_campaigns(c, AS_OF, 90)


@query("""
SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderdate >= TIMESTAMP '2001-04-01'
""")
def recent_ids(spark, sf_dir):
    """a literal date bound that reaches the scan."""
    return filters.recent_ids(tab(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", AS_OF, 90)


@query("""
SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-31' AND o_orderdate < TIMESTAMP '2001-07-01'
""")
def lookback_window(spark, sf_dir):
    """S10."""
    return filters.lookback(tab(spark, sf_dir, "orders"), "o_orderdate", AS_OF, 150).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 2001 - 2")
def year_window(spark, sf_dir):
    """F17 as a range."""
    return filters.year_window(tab(spark, sf_dir, "orders"), "o_orderdate", AS_OF, 2).select("o_orderkey")


_DOC_REASONS = """
SELECT doc_id, trim(CASE WHEN n_chars > 1000 THEN 'too long ' ELSE '' END || CASE WHEN lang IN ('en', 'de') THEN '' ELSE 'language ' END
       || CASE WHEN regexp_matches(text, '[^\\s]') THEN '' ELSE 'blank' END) AS reasons
FROM documents
"""


@query(f"SELECT doc_id, replace(reasons, 'too long', 'too_long') AS reasons FROM ({_DOC_REASONS})")
def constraint_split(spark, sf_dir):
    """rules with reasons; valid rows carry none."""
    d = tab(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    rules = {
        "too_long": F.col("n_chars") <= 1000,
        "language": F.col("lang").isin("en", "de"),
        "blank": filters.has_content(F.col("text")),
    }
    return filters.tag_violations(d, rules).select("doc_id", F.concat_ws(" ", "reject_reasons").alias("reasons"))


@query("""
SELECT c_custkey AS id FROM customer WHERE NOT (c_acctbal < 0) AND c_mktsegment <> 'BUILDING'
""")
def client_accounts(spark, sf_dir):
    """F13."""
    c = tab(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") < 0).alias("manager"),
        F.when(F.col("c_mktsegment") == "BUILDING", "CANCELED").otherwise("ENABLED").alias("status"),
    )
    return filters.client_accounts(c).select("id")


@query("""
SELECT o_orderkey AS ad_id, CASE o_orderstatus WHEN 'F' THEN 'DISAPPROVED' ELSE 'AREA_OF_INTEREST_ONLY' END AS approval_status
FROM orders WHERE o_orderstatus IN ('F', 'P')
""")
def policy_violations(spark, sf_dir):
    """F16."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "DISAPPROVED").when(F.col("o_orderstatus") == "P", "AREA_OF_INTEREST_ONLY").otherwise("APPROVED")
    )
    return filters.policy_violations(tab(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ad_id"), status.alias("approval_status")))


@query("""
SELECT 'orders' AS table_name, 'o_orderkey,o_custkey' AS columns_searched, CAST(count_if(o_orderkey = 77 OR o_custkey = 77) AS BIGINT) AS matches FROM orders UNION ALL
SELECT 'lineitem', 'l_orderkey,l_partkey,l_suppkey', CAST(count_if(l_orderkey = 77 OR l_partkey = 77 OR l_suppkey = 77) AS BIGINT) FROM lineitem UNION ALL
SELECT 'customer', 'c_custkey', CAST(count_if(c_custkey = 77) AS BIGINT) FROM customer
""")
def find_id_across_tables(spark, sf_dir):
    """F18, S15."""
    tables = {n: tab(spark, sf_dir, n) for n in ("orders", "lineitem", "customer")}
    names = ["o_orderkey", "o_custkey", "l_orderkey", "l_partkey", "l_suppkey", "c_custkey"]
    return filters.find_id(tables, names, "77")


@query("""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P') OR o_orderpriority = '1-URGENT'
""")
def union_status_split(spark, sf_dir):
    """Overlapping predicate reads in one scan, one row per key."""
    o = tab(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    preds = ["o_orderstatus = 'F'", "o_orderstatus = 'P'", "o_orderpriority = '1-URGENT'"]
    return records.union_splits(o, preds, ["o_orderkey"], ["o_orderstatus"]).drop("o_orderpriority")


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def union_wide(spark, sf_dir):
    """Columns one side lacks are null."""
    c = tab(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = tab(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return records.union_wide(c, s)


@query("""
WITH s AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
g AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 120 DAY)) AS DATE) AS since, hi FROM s)
SELECT strftime(since, '%Y-%m-%d') AS since, strftime(least(CAST(since + INTERVAL 119 DAY AS DATE), hi), '%Y-%m-%d') AS until FROM g
""")
def date_chunks(spark, sf_dir):
    """120-day ranges over the span of the orders, end day included (trap T13)."""
    day = F.col("o_orderdate").cast("date")
    span = tab(spark, sf_dir, "orders").agg(F.min(day).alias("s"), F.max(day).alias("e"))
    out = span.select(F.inline(chunks.chunk_ranges(F.col("s"), F.col("e"), 120)))
    return out.select(day_text(F.col("since")).alias("since"), day_text(F.col("until")).alias("until"))


@query("""
WITH c AS (
  SELECT r_regionkey AS manager_id, 100 + n_nationkey AS id, TRUE AS manager FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL
  SELECT 100 + s_nationkey, 1000 + s_suppkey, s_acctbal < 0 FROM supplier),
d AS (SELECT * FROM c WHERE manager_id IN (0, 1, 2)),
m AS (SELECT DISTINCT id FROM d WHERE manager AND id NOT IN (0, 1, 2))
SELECT manager_id, id, manager FROM d UNION ALL
SELECT manager_id, id, manager FROM c WHERE NOT manager AND manager_id IN (SELECT id FROM m)
""")
def hierarchy_expand(spark, sf_dir):
    """Region is seed, nation is manager, supplier is client."""
    seeds = tab(spark, sf_dir, "region").filter(F.col("r_regionkey").isin(0, 1, 2)).select(F.col("r_regionkey").cast("bigint").alias("id"))
    return hierarchy.expand_accounts(_clients(spark, sf_dir), seeds)


def _clients(spark, sf_dir):
    n, s = tab(spark, sf_dir, "nation"), tab(spark, sf_dir, "supplier")
    top = n.select(
        F.col("n_regionkey").cast("bigint").alias("manager_id"), (F.col("n_nationkey") + 100).cast("bigint").alias("id"), F.lit(True).alias("manager")
    )
    leaf = s.select(
        (F.col("s_nationkey") + 100).cast("bigint").alias("manager_id"), (F.col("s_suppkey") + 1000).alias("id"), (F.col("s_acctbal") < 0).alias("manager")
    )
    return top.unionByName(leaf)


@query("""
WITH RECURSIVE c AS (
  SELECT CAST(n_regionkey AS BIGINT) AS manager_id, CAST(100 + n_nationkey AS BIGINT) AS id, TRUE AS manager FROM nation UNION ALL
  SELECT 100 + s_nationkey, 1000 + s_suppkey, s_acctbal < 0 FROM supplier),
t AS (
  SELECT id, manager_id, manager, 1 AS depth FROM c WHERE manager_id = 1 UNION ALL
  SELECT c.id, c.manager_id, c.manager, t.depth + 1 FROM t JOIN c ON c.manager_id = t.id WHERE t.manager)
SELECT id, manager_id AS via_manager, depth, manager FROM t
""")
def account_tree(spark, sf_dir):
    """Everything under one seed, breadth first."""
    return hierarchy.account_tree(_clients(spark, sf_dir), 1)
