"""Roll-ups, dedupe, top-k and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import aggregate, dedupe, profile
from tallyloom.operators.columns import ref
from tallyloom.queries.registry import day_text, money, query, r4, tab


@query("""
WITH one AS (
  SELECT * FROM (
    SELECT l_suppkey, l_partkey, l_quantity, l_extendedprice,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC,
                              l_partkey DESC, l_quantity DESC, l_suppkey DESC) AS rn
    FROM lineitem) WHERE rn = 1),
ent AS (
  SELECT l_suppkey AS id, l_partkey AS placement, count(*) AS impressions,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS clicks,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS cost_micros
  FROM one GROUP BY 1, 2),
top AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY impressions DESC, placement) AS rn FROM ent)
SELECT id, placement, impressions, clicks, cost_micros,
       CASE WHEN clicks > 0 THEN floor(cost_micros / clicks * 10000 + 0.5) / 10000 ELSE 0 END AS averagecpc,
       floor(cost_micros / impressions * 1000 * 10000 + 0.5) / 10000 AS averagecpm,
       floor(clicks / impressions * 100 * 10000 + 0.5) / 10000 AS ctr
FROM top WHERE rn <= 25
""")
def flagship_topk_entities(spark, sf_dir):
    """Last row per key, entity sums, ratios from sums, top 25 per group."""
    rows = tab(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    one = dedupe.deduplicate(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"], "last")
    fact = one.select(
        F.col("l_suppkey").alias("id"),
        F.col("l_partkey").alias("placement"),
        F.lit(1).cast("bigint").alias("impressions"),
        money(F.col("l_quantity")).alias("clicks"),
        money(F.col("l_extendedprice")).alias("cost_micros"),
    )
    sums = aggregate.entity_rollup(fact, ["id", "placement"], ["impressions", "clicks", "cost_micros"])
    sums = sums.withColumns({c: ref(c).cast("double") for c in ("clicks", "cost_micros")})
    top = aggregate.add_ratios(dedupe.limit_placements(sums))
    rounded = {c: r4(ref(c)) for c in ("averagecpc", "averagecpm", "ctr")}
    return top.withColumns(rounded).drop("averagecost")


@query("""
SELECT user_id AS creative_id, count(*) AS impressions, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend
FROM events GROUP BY 1
""")
def entity_rollup(spark, sf_dir):
    """A1 with detected group and metrics."""
    e = tab(spark, sf_dir, "events")
    daily = e.select(
        F.col("user_id").alias("creative_id"),
        F.col("ts").alias("date"),
        F.lit(1).cast("bigint").alias("impressions"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).cast("bigint").alias("clicks"),
        money(F.col("value")).alias("spend"),
        "event_type",
    )
    return aggregate.entity_rollup(daily).withColumn("spend", F.col("spend").cast("double"))


@query("""
SELECT user_id AS account_id, event_type, count(value) AS n, min(value) AS low, max(value) AS high,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY 1, 2
""")
def entity_rollup_methods(spark, sf_dir):
    """One method per metric, explicit group."""
    v = F.col("value")
    e = tab(spark, sf_dir, "events").select(
        F.col("user_id").alias("account_id"), "event_type", v.alias("n"), v.alias("low"), v.alias("high"), money(v).alias("total")
    )
    how = {"n": "count", "low": "min", "high": "max", "total": "sum"}
    out = aggregate.entity_rollup(e, ["account_id", "event_type"], list(how), how)
    return out.withColumn("total", F.col("total").cast("double"))


_ADS = """
WITH ads AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity,
                               l_extendedprice, l_suppkey) AS rn FROM lineitem)
"""


def _ads(spark, sf_dir):
    li = tab(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("ad_id"),
        F.col("l_returnflag").alias("device"),
        F.col("l_extendedprice").alias("cost_micros"),
        F.col("l_quantity").alias("clicks"),
        (F.col("l_linenumber") - 1).alias("impressions"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_shipdate").alias("o1"),
        F.col("l_orderkey").alias("o2"),
        F.col("l_linenumber").alias("o3"),
    )


_ADS_ORDER = ["o1", "o2", "o3", "clicks", "cost_micros", "customer_id"]


@query(_ADS + """
SELECT l_partkey AS ad_id, l_returnflag AS device, l_extendedprice AS cost_micros, l_quantity AS clicks,
       CAST(l_linenumber - 1 AS DOUBLE) AS impressions, l_suppkey AS customer_id,
       CASE WHEN l_quantity > 0 THEN floor(l_extendedprice / l_quantity * 10000 + 0.5) / 10000 ELSE 0 END AS averagecpc,
       CASE WHEN l_linenumber > 1 THEN floor(l_extendedprice / (l_linenumber - 1) * 1000 * 10000 + 0.5) / 10000 ELSE 0 END AS averagecpm,
       l_extendedprice AS averagecost,
       CASE WHEN l_linenumber > 1 THEN floor(l_quantity / (l_linenumber - 1) * 100 * 10000 + 0.5) / 10000 ELSE 0 END AS ctr
FROM ads WHERE rn = 1
""")
def rollup_ratios(spark, sf_dir):
    """A2: first row per key, sums, first customer, guarded ratios."""
    out = aggregate.aggregate_by_keys(_ads(spark, sf_dir), ["ad_id", "device"], _ADS_ORDER)
    return out.withColumns({c: r4(ref(c)) for c in ("averagecpc", "averagecpm", "ctr")})


@query(_ADS + """
SELECT l_partkey AS ad_id, l_returnflag AS device, l_extendedprice AS cost_micros, l_quantity AS clicks, l_suppkey AS customer_id
FROM ads WHERE rn = 1
""")
def device_rollup(spark, sf_dir):
    """A3."""
    return aggregate.aggregate_by_device(_ads(spark, sf_dir), _ADS_ORDER)


@query("""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1, 2),
g AS (
  SELECT user_id, 'day' AS grain, day AS period, events, v FROM d UNION ALL
  SELECT user_id, 'week', CAST(date_trunc('week', day) AS DATE), events, v FROM d UNION ALL
  SELECT user_id, 'month', CAST(date_trunc('month', day) AS DATE), events, v FROM d UNION ALL
  SELECT user_id, 'summary', NULL, events, v FROM d)
SELECT user_id, grain, coalesce(strftime(period, '%Y-%m-%d'), 'all') AS period, CAST(sum(events) AS BIGINT) AS events,
       CAST(sum(v) AS DOUBLE) AS value
FROM g GROUP BY 1, 2, 3
""")
def lifetime_rollup(spark, sf_dir):
    """Day, week, month and lifetime totals in one scan."""
    e = tab(spark, sf_dir, "events").select("user_id", "ts", F.lit(1).alias("events"), money(F.col("value")).alias("value"))
    out = aggregate.grain_rollups(e, ["user_id"], "ts", ["events", "value"], ["day", "week", "month", "summary"])
    period = F.coalesce(day_text(F.col("period")), F.lit("all"))
    return out.withColumns({"period": period, "value": F.col("value").cast("double")})


@query("SELECT user_id, event_type, max(ts) AS last_ts FROM events GROUP BY 1, 2")
def last_event_per_user(spark, sf_dir):
    """A6."""
    return aggregate.last_per(tab(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "last_ts")


@query("""
SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def latest_load_rows(spark, sf_dir):
    """W6 overall: scalar maximum."""
    e = tab(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("load"))
    return dedupe.latest_load(e, "load").drop("load")


@query("""
SELECT e.event_id, e.user_id FROM events e
JOIN (SELECT user_id, max(CAST(ts AS DATE)) AS d FROM events GROUP BY 1) m ON e.user_id = m.user_id AND CAST(e.ts AS DATE) = m.d
""")
def latest_load_per_user(spark, sf_dir):
    """W6 per source."""
    e = tab(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("load"))
    return dedupe.latest_load(e, "load", ["user_id"]).select("event_id", "user_id")


_RANKED = """
WITH r AS (SELECT event_type AS newsletter, CAST(hour(ts) AS BIGINT) AS message, user_id AS contact, max(ts) AS last_render
           FROM events GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY newsletter ORDER BY last_render DESC, contact, message) AS rn FROM r)
"""


def _ranked(spark, sf_dir):
    e = tab(spark, sf_dir, "events").select(
        F.col("event_type").alias("newsletter"), F.hour("ts").cast("bigint").alias("message"), F.col("user_id").alias("contact"), "ts"
    )
    return aggregate.ranked_contacts(e, "newsletter", "message", "contact", "ts", 10)


@query(_RANKED + "SELECT newsletter, message, contact, last_render, rn FROM k WHERE rn <= 10")
def contacts_top10(spark, sf_dir):
    """W2."""
    return _ranked(spark, sf_dir)


@query(_RANKED + """
, f AS (SELECT newsletter, contact, min(rn) AS first_rn FROM k WHERE rn <= 10 GROUP BY 1, 2)
SELECT f.newsletter, string_agg(CAST(contact AS VARCHAR), ',' ORDER BY first_rn) AS contact_ids,
       (SELECT message FROM k WHERE k.newsletter = f.newsletter AND rn = 1) AS message_id
FROM f GROUP BY 1
""")
def contacts_collected(spark, sf_dir):
    """A12."""
    out = aggregate.contacts_per_newsletter(_ranked(spark, sf_dir), "newsletter", "message", "contact")
    return out.withColumn("contact_ids", F.concat_ws(",", F.transform("contact_ids", lambda c: c.cast("string"))))


@query("""
SELECT items, count(*) AS keys FROM (SELECT o_custkey, count(DISTINCT o_orderkey) AS items FROM orders GROUP BY 1) GROUP BY 1
""")
def count_of_counts(spark, sf_dir):
    """A9."""
    return aggregate.count_of_counts(tab(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")


@query("SELECT o_custkey, count(*) AS rows, max(o_orderdate) AS last_load FROM orders GROUP BY 1")
def freshness(spark, sf_dir):
    """A10 per account."""
    return aggregate.freshness(tab(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query("""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS load_day, count(*) AS rows FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 10
""")
def load_days_last10(spark, sf_dir):
    """A10, O1-O3: the last ten load days; the limit is the report."""
    out = aggregate.rows_per_load_day(tab(spark, sf_dir, "events"), "ts", 10)
    return out.withColumn("load_day", day_text(F.col("load_day")))


_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in _NAMES))
def table_row_counts(spark, sf_dir):
    """A11."""
    return aggregate.table_counts({n: tab(spark, sf_dir, n) for n in _NAMES})


_DTYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    "WITH o AS (SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority, nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls, "
        f"floor((count(*) - count({c})) / count(*) * 100 * 10000 + 0.5) / 10000 AS null_pct FROM o"
        for c, t in _DTYPES.items()
    )
)
def profile_columns(spark, sf_dir):
    """A13/P13."""
    o = tab(spark, sf_dir, "orders").withColumns(
        {
            "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
            "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("P")),
        }
    )
    return profile.profile_columns(o).withColumn("null_pct", r4(F.col("null_pct")))


@query("""
SELECT count(*) AS groups, CAST(sum(c) AS BIGINT) AS rows, floor(CAST(sum(c) AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 AS rows_per_group
FROM (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
""")
def group_profile(spark, sf_dir):
    """Groups and mean size."""
    return profile.group_profile(tab(spark, sf_dir, "lineitem"), "l_orderkey").withColumn("rows_per_group", r4(F.col("rows_per_group")))


@query("""
SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS rows_after,
       floor(CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS DOUBLE) / count(*) * 100
             * 10000 + 0.5) / 10000 AS lost_pct
FROM lineitem
""")
def step_loss(spark, sf_dir):
    """Share of rows a dedupe step removes."""
    li = tab(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    after = dedupe.deduplicate(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return profile.loss(li, after).withColumn("lost_pct", r4(F.col("lost_pct")))


@query("SELECT nullif(o_orderpriority, '5-LOW') AS value, count(*) AS rows FROM orders GROUP BY 1")
def value_counts(spark, sf_dir):
    """Null is a value."""
    o = tab(spark, sf_dir, "orders").select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"))
    return aggregate.value_counts(o, "p")


@query("SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_groups(spark, sf_dir):
    """The ten largest groups; the limit is the report."""
    return aggregate.top_groups(tab(spark, sf_dir, "orders"), ["o_custkey"], 10)


@query("""
SELECT p_brand, p_size AS level, p_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part) WHERE rn = 1
""")
def highest_level(spark, sf_dir):
    """W3 on levels stored as text."""
    p = tab(spark, sf_dir, "part").select("p_brand", F.col("p_size").cast("string").alias("level"), "p_partkey")
    return dedupe.keep_highest_level(p, "p_brand").withColumn("level", F.col("level").cast("int"))


def _dedupe_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("l_shipdate", "l_partkey", "l_suppkey"))
    return f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"""


def _keyed_lines(spark, sf_dir):
    return tab(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


@query(_dedupe_sql("ASC"))
def dedupe_first(spark, sf_dir):
    """W4/W5 keep first."""
    return dedupe.deduplicate(_keyed_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], ["l_shipdate"], "first")


@query(_dedupe_sql("DESC"))
def dedupe_last(spark, sf_dir):
    """W4/W5 keep last."""
    return dedupe.deduplicate(_keyed_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], ["l_shipdate"], "last")


@query("""
SELECT l_orderkey, l_linenumber, any_value(l_shipdate) AS l_shipdate, any_value(l_partkey) AS l_partkey, any_value(l_suppkey) AS l_suppkey
FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1
""")
def dedupe_unrepeated(spark, sf_dir):
    """W4 keep none."""
    return dedupe.deduplicate(_keyed_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], keep=False)


@query("SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem")
def dedupe_whole_rows(spark, sf_dir):
    """W4/U2 on all columns."""
    return dedupe.deduplicate(tab(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus"))


@query("""
SELECT l_returnflag AS campaign, 'A' || l_partkey AS activity, CAST(max(l_linenumber) + 1 AS BIGINT) AS next_number FROM lineitem GROUP BY 1, 2
""")
def next_number(spark, sf_dir):
    """Next free number per campaign and activity."""
    return dedupe.next_number(_stored(tab(spark, sf_dir, "lineitem")), ["campaign", "activity"], "file_name")


def _stored(li):
    activity = F.concat(F.lit("A"), F.col("l_partkey").cast("string"))
    name = F.concat(activity, F.lit("_"), F.col("l_linenumber").cast("string"), F.lit(".png"))
    return li.select(F.col("l_returnflag").alias("campaign"), activity.alias("activity"), name.alias("file_name"))


@query("""
WITH old AS (SELECT l_returnflag AS c, l_partkey AS a, max(l_linenumber) + 1 AS nxt FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2),
inc AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity,
                                     l_extendedprice) AS k
        FROM lineitem WHERE l_linestatus = 'F'),
num AS (SELECT inc.*, CASE WHEN nxt IS NOT NULL THEN nxt + k - 1 ELSE k - 1 END AS n
        FROM inc LEFT JOIN old ON old.c = inc.l_returnflag AND old.a = inc.l_partkey)
SELECT l_orderkey, l_linenumber, l_shipdate,
       'A' || l_partkey || CASE WHEN n = 0 THEN '' ELSE '_' || n END || '.png' AS target_name
FROM num
""")
def name_incoming(spark, sf_dir):
    """W7 for a batch: numbers go on in arrival order, counted day by day so that no key is one task."""
    li = tab(spark, sf_dir, "lineitem")
    existing = _stored(li.filter("l_linestatus = 'O'"))
    incoming = li.filter("l_linestatus = 'F'").select(
        F.col("l_returnflag").alias("campaign"),
        F.concat(F.lit("A"), F.col("l_partkey").cast("string")).alias("activity"),
        F.lit("png").alias("ext"),
        "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice",
    )
    order = [F.col(c).asc() for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")]
    chunk = F.date_trunc("day", F.col("l_shipdate"))
    out = dedupe.name_incoming(incoming, existing, "campaign", "activity", "file_name", "ext", chunk, order)
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "target_name")


@query("""
SELECT user_id, count(*) AS total, CAST(count_if(event_type = 'purchase') AS BIGINT) AS success,
       floor(count_if(event_type = 'purchase') / count(*) * 100 * 10000 + 0.5) / 10000 AS success_rate
FROM events GROUP BY 1
""")
def success_rates(spark, sf_dir):
    """A15."""
    e = tab(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("event_type") == "purchase").alias("success")
    )
    return e.withColumn("success_rate", r4(aggregate.success_rate(F.col("success"), F.col("total"))))
