"""Joins and lookups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyloom.operators import lookup
from tallyloom.operators.filters import year_window
from tallyloom.plans import newsletter
from tallyloom.queries.registry import AS_OF, query, tab


@query("""
SELECT l_orderkey, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
""")
def anti_existing(spark, sf_dir):
    """J1, J11, U2b."""
    done = tab(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return lookup.anti_existing(tab(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), done, ["l_orderkey"], unique=True)


@query("""
WITH n AS (SELECT o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2000-01-01')
SELECT o_custkey, o_orderdate FROM n
WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_custkey = n.o_custkey AND t.o_orderdate = n.o_orderdate)
""")
def anti_existing_dated(spark, sf_dir):
    """J1 with the date in the key: the target scan is cut to the days of the batch."""
    o = tab(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    new = o.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= F.lit(date(2000, 1, 1)))).drop("o_orderstatus")
    old = o.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    return lookup.anti_existing(new, old, ["o_custkey", "o_orderdate"], "o_orderdate")


@query("""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, (o.o_orderkey IS NOT NULL) AS is_existing
FROM lineitem l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') o ON o.o_orderkey = l.l_orderkey
""")
def new_vs_existing(spark, sf_dir):
    """Both halves from one plan."""
    known = tab(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return lookup.mark_existing(tab(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), known, ["l_orderkey"], unique=True)


@query("""
SELECT CAST(hour(e.ts) AS BIGINT) AS message, e.user_id AS external, max(e.event_id) AS contact_id
FROM events e JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_nationkey < 20) c ON c.c_custkey = e.user_id
WHERE e.event_type = 'signup' GROUP BY 1, 2
""")
def render_campaigns(spark, sf_dir):
    """The log is grouped before it meets the campaigns."""
    log = tab(spark, sf_dir, "events").filter("event_type = 'signup'")
    log = log.select(F.hour("ts").cast("bigint").alias("message"), F.col("user_id").alias("external"), F.col("event_id").alias("contact"))
    campaigns = tab(spark, sf_dir, "customer").filter("c_nationkey < 20")
    return lookup.render_campaigns(log, campaigns, "message", "external", "contact", "c_custkey")


@query("""
WITH m AS (SELECT o_custkey || '.' || o_orderpriority AS code, CAST(o_custkey AS VARCHAR) AS head, o_orderstatus AS body,
                  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS planned, o_orderdate AS actual FROM orders)
SELECT DISTINCT c.c_nationkey AS company_id, m.code AS newsletter_id, m.body AS html
FROM m JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = m.head
WHERE (CASE WHEN planned IS NOT NULL THEN year(planned) - 1 ELSE year(actual) - 1 END) >= 2001 - 2 AND c.c_acctbal >= 0
""")
def split_key_join(spark, sf_dir):
    """E-mails to companies over the head of a composite code."""
    o, c = tab(spark, sf_dir, "orders"), tab(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    mails = o.select(
        F.concat_ws(".", F.col("o_custkey").cast("string"), "o_orderpriority").alias("CAMPAIGNACTIVITY_CODE"),
        F.col("o_orderstatus").alias("PREVIEWHTML"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("PROPOSEDSTART"),
        F.col("o_orderdate").alias("ACTUALSTART"),
    )
    campaigns = c.select(F.col("c_custkey").cast("string").alias("CODE"))
    companies = c.select(F.col("c_custkey").cast("string").alias("CAMPAIGNID"), F.col("c_nationkey").alias("COMPANYID"))
    return newsletter.dynamics_newsletters(mails, campaigns, companies, AS_OF, 2)


@query("""
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
""")
def semi_recent(spark, sf_dir):
    """J5."""
    o = year_window(tab(spark, sf_dir, "orders"), "o_orderdate", AS_OF, 2).select("o_orderkey", "o_custkey")
    links = tab(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return lookup.semi_recent(o, links, "o_orderkey")


@query("""
WITH s AS (SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT 'urn:li:share:' || c_custkey AS id, coalesce(event_id, 0) AS impression_count, 0::BIGINT AS unique_impression_count,
       coalesce(CAST(length(event_type) AS BIGINT), 0) AS click_count, 0::BIGINT AS like_count, 0::BIGINT AS comment_count, 0::BIGINT AS share_count,
       coalesce(value, 0) AS engagement, 0::BIGINT AS video_views, 0::BIGINT AS video_view_time_ms
FROM customer LEFT JOIN s ON s.user_id = c_custkey
""")
def post_insights(spark, sf_dir):
    """Statistics by share or user post, the last wins, missing counts are 0."""
    zero = F.lit(None).cast("bigint")
    urn = F.concat(F.lit("urn:li:share:"), F.col("user_id").cast("string"))
    click = F.col("event_type") == "click"
    counts = F.struct(
        F.col("event_id").alias("impressionCount"),
        zero.alias("uniqueImpressionsCount"),
        F.length("event_type").cast("bigint").alias("clickCount"),
        zero.alias("likeCount"),
        zero.alias("commentCount"),
        zero.alias("shareCount"),
        F.col("value").alias("engagement"),
    )
    stats = tab(spark, sf_dir, "events").select(
        F.when(~click, urn).alias("share"), F.when(click, urn).alias("ugcPost"), F.col("event_id").alias("seq"), counts.alias("totalShareStatistics")
    )
    posts = tab(spark, sf_dir, "customer").select(F.concat(F.lit("urn:li:share:"), F.col("c_custkey").cast("string")).alias("id"))
    return lookup.post_insights(posts, stats, "seq")


@query("""
SELECT c_custkey, CASE WHEN n_name IS NOT NULL THEN 50 + n_nationkey ELSE 1 END AS companyid
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_nationkey = c_nationkey
""")
def company_lookup(spark, sf_dir):
    """Prefixed and bare accounts, default company."""
    dim = tab(spark, sf_dir, "nation").filter("n_regionkey <> 2")
    companies = dim.select(F.col("n_nationkey").cast("string").alias("account_id"), (F.col("n_nationkey") + 50).alias("company_id"))
    account = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey").cast("string")).otherwise(
        F.concat(F.lit("act_"), F.col("c_nationkey").cast("string"))
    )
    c = tab(spark, sf_dir, "customer").select("c_custkey", account.alias("account"))
    return lookup.add_company(c, companies, "account").drop("account")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN NULL ELSE coalesce(s_name, 'Organization ' || l_suppkey) END AS organization_name
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 1000) ON s_suppkey = l_suppkey
""")
def name_lookup(spark, sf_dir):
    """Name, placeholder, or null for a null id."""
    names = tab(spark, sf_dir, "supplier").filter("s_acctbal >= 1000").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    li = tab(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("organization_id")
    )
    return lookup.lookup_names(li, names, "organization_id", "organization_name", "Organization").drop("organization_id")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, s_name AS supplier_name FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
""")
def salted_name_lookup(spark, sf_dir):
    """J8/J12 with hot keys spread over salts; the hot list comes from a count with a threshold."""
    li = tab(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    hot = lookup.hot_keys(li, "l_suppkey", share=0.005)
    dim = tab(spark, sf_dir, "supplier")
    return lookup.salted_lookup(li, dim, "l_suppkey", "s_suppkey", "s_name", "supplier_name", salts=8, hot=hot).drop("l_suppkey")


_SENIORITY = "['Unpaid','Training','Entry level','Senior','Manager','Director','VP','CXO','Partner','Owner']"


@query(f"SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN ({_SENIORITY})[p_size] END AS seniority_name FROM part")
def seniority_names(spark, sf_dir):
    """Bare codes and URNs."""
    code = F.col("p_size").cast("string")
    urn = F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("urn:li:seniority:"), code)).otherwise(code)
    return tab(spark, sf_dir, "part").select("p_partkey", lookup.seniority_name(urn).alias("seniority_name"))


@query("SELECT DISTINCT CAST(p_size AS VARCHAR) AS code FROM part WHERE p_size > 10")
def seniority_unmapped(spark, sf_dir):
    """Codes without a name."""
    return lookup.unmapped_codes(tab(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("code")), "code")


_TRIES = """
WITH c AS (SELECT user_id, event_type, min(event_id) AS rank_id FROM events GROUP BY 1, 2),
p AS (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY 1, 2 HAVING max(value) > 200)
"""


def _tries(spark, sf_dir):
    e = tab(spark, sf_dir, "events")
    candidates = e.groupBy("user_id", "event_type").agg(F.min("event_id").alias("rank_id"))
    previews = e.groupBy("user_id", "event_type").agg(F.max("value").alias("v")).filter("v > 200")
    return candidates, previews


@query(_TRIES + """
SELECT user_id, event_type, rank_id, v FROM (
  SELECT c.user_id, c.event_type, c.rank_id, p.v, row_number() OVER (PARTITION BY c.user_id ORDER BY c.rank_id) AS rn
  FROM c JOIN p ON p.user_id = c.user_id AND p.event_type = c.event_type) WHERE rn = 1
""")
def first_success(spark, sf_dir):
    """First candidate by rank that has a preview."""
    candidates, previews = _tries(spark, sf_dir)
    return lookup.first_success(candidates, previews, ["user_id", "event_type"], "user_id", "rank_id")


@query(_TRIES + """
SELECT user_id, event_type, rank_id, v, FALSE AS failed FROM (
  SELECT c.user_id, c.event_type, c.rank_id, p.v, row_number() OVER (PARTITION BY c.user_id ORDER BY c.rank_id) AS rn
  FROM c JOIN p ON p.user_id = c.user_id AND p.event_type = c.event_type) WHERE rn = 1 AND event_type <> 'error'
""")
def first_success_or_stop(spark, sf_dir):
    """A failure other than not-found ends the search of its group."""
    candidates, previews = _tries(spark, sf_dir)
    marked = previews.withColumn("failed", F.col("event_type") == "error")
    return lookup.first_success(candidates, marked, ["user_id", "event_type"], "user_id", "rank_id", "failed")


@query(_TRIES + """
SELECT user_id, event_type, rank_id FROM (
  SELECT c.user_id, c.event_type, c.rank_id, row_number() OVER (PARTITION BY c.event_type ORDER BY c.rank_id) AS rn
  FROM c JOIN p ON p.user_id = c.user_id AND p.event_type = c.event_type) WHERE rn = 1
""")
def probe_in_order(spark, sf_dir):
    """Owners are probed in order until one has the item."""
    candidates, previews = _tries(spark, sf_dir)
    joined = candidates.join(previews, ["user_id", "event_type"], "left")
    return lookup.first_success_ranked(joined, "event_type", "rank_id", F.col("v").isNotNull()).drop("v")


@query("""
SELECT o_orderkey, coalesce(c_name, o_orderpriority) AS label, coalesce(c_acctbal, o_totalprice) AS amount
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey
""")
def enrich_or_keep(spark, sf_dir):
    """Found values, else the row's own."""
    found = tab(spark, sf_dir, "customer").filter("c_acctbal > 0")
    found = found.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("label"), F.col("c_acctbal").alias("amount"))
    o = tab(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("label"), F.col("o_totalprice").alias("amount")
    )
    return lookup.enrich_or_keep(o, found, ["k"], ["label", "amount"]).drop("k")
