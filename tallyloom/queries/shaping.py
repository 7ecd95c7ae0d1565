"""Projection, schema and null handling."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import numbers, text
from tallyloom.operators import columns, nested, nulls
from tallyloom.operators.columns import ref
from tallyloom.plans.steps import Context
from tallyloom.plans.tables import GOOGLE_TABLES, google_table
from tallyloom.queries.registry import RUN_TS, day_text, query, r4, tab
from tallyloom.session import scratch_path
from tallyloom.sources import report_csv
from tallyloom.sources.files import list_files


# Rows of a narrow table that one task makes into wide ones.
_TASK_ROWS = 250_000


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k, event_type AS meta_kind, user_id AS meta_owner_id FROM events
""")
def flatten_props(spark, sf_dir):
    """JSON text and nested structs to one column per leaf."""
    e = tab(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k int").alias("props"),
        F.struct(F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("id")).alias("owner")).alias("meta"),
    )
    return nested.flatten_struct(e, "_")


@query("""
SELECT o_orderkey AS id, o_orderstatus AS budget_currency, CAST(o_totalprice AS VARCHAR) AS budget_limits_daily,
       o_orderpriority AS tier_name, o_custkey AS tier_value, o_orderdate AS start, o_custkey AS owner, o_orderpriority AS labels
FROM orders
""")
def flatten_nested_orders(spark, sf_dir):
    """S3: prefixed and unprefixed structs, first list items, first struct of a nested list; rows stay aligned."""
    tier = F.struct(F.col("o_orderpriority").alias("tier_name"), F.col("o_custkey").alias("tier_value"))
    other = F.struct(F.lit("other").alias("tier_name"), F.lit(0).cast("bigint").alias("tier_value"))
    limits = F.struct(F.col("o_totalprice").cast("string").alias("daily"), F.array(tier, other).alias("tiers"))
    records = tab(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("currency"), limits.alias("limits")).alias("budget"),
        F.struct(F.col("o_orderdate").alias("start"), F.array(F.col("o_custkey"), F.lit(0)).alias("owner")).alias("schedule"),
        F.array(F.col("o_orderpriority"), F.lit("x")).alias("labels"),
    )
    flat = nested.flatten_nested(records, ["budget"])
    return flat.withColumn("budget_limits_daily", F.col("budget_limits_daily").cast("double").cast("string"))


@query("""
SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS total_price, o_orderstatus AS status, o_orderdate AS order_date FROM orders
""")
def rename_prefix_snake(spark, sf_dir):
    """Prefixes off, resource columns out, alias table, snake case."""
    o = tab(spark, sf_dir, "orders")
    dotted = o.select(
        F.col("o_orderkey").alias("adGroup.id"),
        F.col("o_orderkey").alias("campaign.resourceName"),
        F.col("o_custkey").alias("customer.id"),
        F.col("o_totalprice").alias("metrics.total.price"),
        F.col("o_orderstatus").alias("campaign.status"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("o_orderpriority").alias("junk"),
    )
    short = columns.shorten_columns(dotted.withColumnRenamed("OrderDate", "x.OrderDate"))
    named = columns.rename_columns(short, {"orderdate": "OrderDate", "adgroup_id": "id", "absent": "never"})
    return columns.drop_columns(columns.snake_columns(named), ["junk", "absent"])


@query("""
SELECT o_orderkey AS id, coalesce(nullif(o_orderpriority, '5-LOW'), o_orderstatus) AS cost, o_custkey AS extra FROM orders
""")
def map_spellings(spark, sf_dir):
    """Two spellings of one target are coalesced in listed order (trap T14)."""
    o = tab(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("campaign.id"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("metrics.costMicros"),
        F.col("o_orderstatus").alias("metrics.cost_micros"),
        F.col("o_custkey").alias("extra"),
    )
    mapping = {"campaign.id": "id", "metrics.costMicros": "cost", "metrics.cost_micros": "cost"}
    return columns.map_columns(o, mapping)


def _report_landing(spark, sf_dir):
    li = tab(spark, sf_dir, "lineitem")

    def txt(c):
        return F.col(c).cast("string")

    micros = (F.col("l_extendedprice").cast("decimal(18,2)") * 1000000).cast("bigint").cast("string")
    return li.select(
        F.struct(txt("l_suppkey").alias("id")).alias("customer"),
        F.struct(txt("l_orderkey").alias("id")).alias("campaign"),
        F.struct(txt("l_partkey").alias("id")).alias("adGroup"),
        F.struct(F.struct(txt("l_linenumber").alias("id")).alias("ad")).alias("adGroupAd"),
        F.struct(day_text(F.col("l_shipdate")).alias("date")).alias("segments"),
        F.struct(
            F.col("l_quantity").alias("clicks"),
            F.lit(100).alias("impressions"),
            F.lit(1.0).alias("conversions"),
            micros.alias("costMicros"),
            (F.col("l_quantity") / 100).alias("ctr"),
            micros.alias("averageCpc"),
            F.lit("bad").alias("averageCpm"),
            F.lit(None).cast("string").alias("averageCost"),
        ).alias("metrics"),
    )


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS campaign_id, CAST(l_partkey AS VARCHAR) AS adgroup_id, CAST(l_linenumber AS VARCHAR) AS ad_id,
       strftime(l_shipdate, '%Y-%m-%d') AS date, l_quantity AS clicks, 100 AS impressions, 1.0::DOUBLE AS conversions,
       floor(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) * 10000 + 0.5) / 10000 AS costmicros, CAST(NULL AS DOUBLE) AS averagecpm,
       floor(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) * 10000 + 0.5) / 10000 AS averagecpc, CAST(NULL AS DOUBLE) AS averagecost,
       l_quantity / 100 AS ctr, CAST(l_suppkey AS VARCHAR) AS customer_id_google
FROM lineitem
""")
def google_report_rows(spark, sf_dir):
    """Nested report records to the report table: map, costs, select."""
    flat = nested.flatten_struct(_report_landing(spark, sf_dir))
    out = google_table(flat, "google_ads_report", Context(RUN_TS))
    return out.withColumns({c: r4(ref(c)) for c in ("costmicros", "averagecpc")})


@query("""
WITH p AS (SELECT l_suppkey AS g, l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, 'p' || k) AS rn FROM p)
SELECT CAST(g AS VARCHAR) AS id, 'p' || k AS placement, 'site' AS placement_type, 'caf ' || k || 'x' AS display_name,
       'https://x/' || k AS target_url, CAST(n AS VARCHAR) AS impressions, CAST(NULL AS DOUBLE) AS active_view_ctr, 'c' AS customer_id_google,
       '2024-02-01' AS load_date
FROM r WHERE rn <= 25
""")
def google_placement_rows(spark, sf_dir):
    """X2 with cleaning and post steps: placement labels and the top 25 per ad group."""
    lines = tab(spark, sf_dir, "lineitem")
    # A bounded number of rows a task: they get wide behind this and are sorted there. A group lies in a few tasks, which cut it to its top rows.
    tasks = lines.count() // _TASK_ROWS + 1
    counted = lines.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    p = counted.repartition(tasks, "l_suppkey", F.pmod(F.xxhash64("l_partkey"), F.lit(8)))
    part = F.col("l_partkey").cast("string")
    view = F.struct(
        F.concat(F.lit("p"), part).alias("placement"),
        F.lit("site").alias("placementType"),
        F.concat(F.lit("café \U0001f600"), part, F.lit("|x")).alias("displayName"),
        F.concat(F.lit("https://x/"), part).alias("targetUrl"),
    )
    landing = p.select(
        F.struct(F.lit("c").alias("id")).alias("customer"),
        F.struct(F.col("l_suppkey").cast("string").alias("id")).alias("adGroup"),
        F.struct(F.col("n").cast("string").alias("impressions"), F.lit(None).cast("double").alias("activeViewCtr")).alias("metrics"),
        view.alias("groupPlacementView"),
    )
    out = GOOGLE_TABLES["google_ads_placement"].transform(landing, Context(RUN_TS))
    return out.withColumn("load_date", day_text(F.col("load_date")))


@query("""
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_custkey AS INTEGER) END AS clicks,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS spend,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, CAST(NULL AS VARCHAR) AS note,
       '2024-02-01' AS load_date
FROM orders
""")
def align_schema(spark, sf_dir):
    """Text columns to target types; bad text null, null integers 0 outside the key, added and dropped columns."""
    o = tab(spark, sf_dir, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("clicks"),
        F.when(F.col("o_orderpriority") == "5-LOW", "bad").otherwise(F.col("o_totalprice").cast("string")).alias("spend"),
        F.when(F.col("o_orderstatus") == "F", "soon").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"),
        F.lit("gone").alias("extra"),
    )
    target = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("clicks", T.IntegerType()),
            T.StructField("spend", T.DoubleType()),
            T.StructField("day", T.DateType()),
            T.StructField("note", T.StringType()),
            T.StructField("load_date", T.DateType()),
        ]
    )
    out = columns.align_to_schema(raw, target, ["id"], date(2024, 2, 1))
    return out.withColumns({c: day_text(ref(c)) for c in ("day", "load_date")})


@query("""
SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS ids, CAST(c_custkey AS VARCHAR) AS plain, 'Seg ' || c_mktsegment AS kept, CAST(c_custkey AS VARCHAR) AS digits,
       CAST(c_custkey AS VARCHAR) AS tail, CAST(c_custkey AS VARCHAR) AS account, CAST(c_custkey AS VARCHAR) AS part,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'ugcPost' WHEN 'MACHINERY' THEN 'share' ELSE 'unknown' END AS kind,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS resource,
       'urn:li:organization:' || c_custkey AS urn
FROM customer
""")
def ids_and_urns(spark, sf_dir):
    """P9, P11, C1-C7, C23."""
    c = tab(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")

    def urn(kind):
        return F.concat(F.lit(f"urn:li:{kind}:"), key)

    seg = F.col("c_mktsegment")
    kind = F.when(seg == "BUILDING", urn("ugcPost")).when(seg == "MACHINERY", urn("share")).otherwise(urn("post"))
    resource = (
        F.when(seg == "BUILDING", F.concat(F.lit("customers/c/groupPlacementViews/"), key, F.lit("~x")))
        .when(seg == "HOUSEHOLD", F.lit("customers/c/none"))
        .otherwise(F.concat(F.lit("customers/c/adGroups/"), key))
    )
    return c.select(
        "c_custkey",
        key.alias("ids"),
        columns.plain_id(F.concat(key, F.lit(".0"))).alias("plain"),
        columns.plain_id(F.concat(F.lit(" Seg "), seg, F.lit(" "))).alias("kept"),
        text.urn_digits(urn("title")).alias("digits"),
        text.urn_tail(urn("title")).alias("tail"),
        text.urn_account(urn("sponsoredAccount")).alias("account"),
        text.pivot_value(F.array(urn("organization"), F.lit("x")), "organization").alias("part"),
        text.urn_kind(kind).alias("kind"),
        text.resource_id(resource).alias("resource"),
        text.to_urn("organization", key).alias("urn"),
    )


@query("""
SELECT o_orderkey, '2024-02-01' AS load_date, TIMESTAMP '2024-02-01 03:30:00' AS row_loaded_date, '2024-02-01T03:30:00' AS "IngestionTimestamp"
FROM orders
""")
def load_metadata(spark, sf_dir):
    """One run clock."""
    out = columns.add_load_metadata(
        tab(spark, sf_dir, "orders").select("o_orderkey"), RUN_TS, ["load_date", "row_loaded_date", "IngestionTimestamp"]
    )
    return out.withColumn("load_date", day_text(F.col("load_date")))


@query("""
SELECT (SELECT count(*) FROM lineitem) AS n, column_name, nulls FROM (
  SELECT 'a' AS column_name, count(*) - count(nullif(l_linenumber, 7)) AS nulls FROM lineitem UNION ALL
  SELECT 'b', count(*) - count(nullif(l_returnflag, 'A')) FROM lineitem)
""")
def null_keys(spark, sf_dir):
    """P13."""
    li = tab(spark, sf_dir, "lineitem").select(
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("a"), F.nullif(F.col("l_returnflag"), F.lit("A")).alias("b")
    )
    return columns.null_key_report(li, ["a", "b"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE floor(o_totalprice * 10000 + 0.5) / 10000 END AS cost,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE floor(o_totalprice * 10000 + 0.5) / 10000 END AS legacy
FROM orders
""")
def micros_to_units(spark, sf_dir):
    """P15 in both forms (trap T30)."""
    micros = (F.col("o_totalprice").cast("decimal(18,2)") * 1000000).cast("bigint").cast("string")
    raw = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(micros)
    o = tab(spark, sf_dir, "orders").select("o_orderkey", raw.alias("cost"), raw.alias("legacy"))
    out = columns.convert_costs(columns.convert_costs(o, ["cost"]), ["legacy"], null_as_zero=True)
    return out.withColumns({"cost": r4(F.col("cost")), "legacy": r4(F.col("legacy"))})


def _holes(spark, sf_dir):
    return tab(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("a"),
        F.when(F.col("l_returnflag") == "A", F.lit("nan")).when(F.col("l_returnflag") == "N", F.lit("None")).otherwise("R").alias("b"),
        F.when(F.col("l_linestatus") == "F", F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("c"),
    )


_HOLES = """
WITH h AS (SELECT l_orderkey, nullif(l_linenumber, 7) AS a, nullif(nullif(l_returnflag, 'A'), 'N') AS b,
                  CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_quantity END AS c FROM lineitem)
"""


@query(_HOLES + "SELECT * FROM h WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL")
def null_rows_any(spark, sf_dir):
    """placeholders and NaN to null, then rows with any null out."""
    h = nulls.nan_to_null(nulls.null_words_to_null(_holes(spark, sf_dir)))
    return nulls.drop_null_rows(h)


@query(_HOLES + "SELECT l_orderkey, a, b, c FROM h WHERE a IS NOT NULL OR c IS NOT NULL")
def null_rows_all(spark, sf_dir):
    """only rows where all metrics are null go."""
    h = nulls.nan_to_null(nulls.null_words_to_null(_holes(spark, sf_dir)))
    return nulls.drop_all_null_rows(h, ["a", "c"])


@query(_HOLES + "SELECT l_orderkey, coalesce(a, 0) AS a, b, coalesce(c, 0) AS c FROM h")
def null_fill(spark, sf_dir):
    """nulls and NaN of all numeric columns to 0."""
    return nulls.fill_missing(nulls.null_words_to_null(_holes(spark, sf_dir)))


@query("""
SELECT doc_id, lang FROM documents
WHERE NOT (lower(source || ' ' || lang) LIKE '%src1 %' OR lower(source || ' ' || lang) LIKE '% es%')
""")
def footer_filter(spark, sf_dir):
    """F4."""
    d = tab(spark, sf_dir, "documents").select(F.concat_ws(" ", "source", "lang").alias("first"), "doc_id", "lang")
    return nulls.drop_footer_rows(d, ["SRC1 ", " Es"]).drop("first")


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS file, CAST(o_orderkey AS VARCHAR) AS "AdId", 'Acme, ' || o_orderpriority AS "AccountName",
       CAST(o_custkey AS DOUBLE) AS "Clicks", CASE WHEN year(o_orderdate) = 1997 THEN NULL ELSE o_totalprice END AS "Spend",
       5 / 100 AS "Ctr"
FROM orders
""")
def report_csv_rows(spark, sf_dir):
    """Reports with preamble and footer, one per month; 1997 has another header."""
    o = tab(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    old = F.year("o_orderdate") == 1997
    name = F.concat(F.lit('"Acme, '), F.col("o_orderpriority"), F.lit('"'))
    key, clicks = F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")), F.col("o_custkey").cast("string")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    line = F.when(old, F.concat_ws(",", name, key, clicks, F.lit("5%"))).otherwise(F.concat_ws(",", key, name, clicks, price, F.lit("5%")))
    data = o.select(month.alias("file"), F.lit(True).alias("in_head"), (F.col("o_orderkey") + 100).alias("line_no"), line.alias("value"))
    files = o.select(month.alias("file"), old.alias("old")).distinct()
    header = F.when(F.col("old"), "AccountName,AdId,Clicks,Ctr").otherwise("AdId,AccountName,Clicks,Spend,Ctr")
    frame = F.array(
        F.struct(F.lit(0).cast("bigint").alias("line_no"), F.lit("Report,Ads").alias("value")),
        F.struct(F.lit(1).cast("bigint").alias("line_no"), F.lit("").alias("value")),
        F.struct(F.lit(2).cast("bigint").alias("line_no"), header.alias("value")),
        F.struct(F.lit(1 << 60).alias("line_no"), F.lit('"© 2024 Microsoft Corporation. All rights reserved."').alias("value")),
    )
    edge = files.select("file", F.lit(True).alias("in_head"), F.inline(frame))
    parsed = report_csv.parse_report(data.unionByName(edge), "Clicks", ["AdId", "AccountName", "Clicks", "Spend", "Ctr"])
    return report_csv.clean_report(parsed)


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity,
       CAST(round(l_discount * 100) AS DOUBLE) / 100 AS fraction, CAST(l_quantity AS BIGINT) AS whole,
       CASE WHEN l_returnflag = 'A' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS safe,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS number,
       CASE WHEN l_linenumber > 1 THEN floor(l_extendedprice / (l_linenumber - 1) * 10000 + 0.5) / 10000 ELSE 0 END AS guarded
FROM lineitem
""")
def pct_and_ratio(spark, sf_dir):
    """M1-M5."""
    li = tab(spark, sf_dir, "lineitem")
    bad = F.col("l_returnflag") == "A"
    pct = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    return li.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity",
        numbers.percent_to_fraction(pct).alias("fraction"),
        numbers.safe_int(F.col("l_quantity").cast("string")).alias("whole"),
        numbers.safe_int(F.when(bad, "x").otherwise(F.col("l_quantity").cast("string"))).alias("safe"),
        numbers.to_number(F.when(bad, "NaN").otherwise(F.col("l_extendedprice").cast("string"))).alias("number"),
        r4(numbers.ratio(F.col("l_extendedprice"), F.col("l_linenumber") - 1)).alias("guarded"),
    )


# Rows of one written report file; splits in which the files of a report are read, at least where they are large, and a split's largest size.
_REPORT_ROWS = 500_000
_REPORT_SPLITS = 64
_REPORT_SPLIT_BYTES = 8 << 20


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def _write_reports(rows, path, header):
    """Report files, one for each ``file``, of rows (file, ord, line): a preamble with a line break, the header, rows, a footer with one."""
    files = rows.select("file").distinct()
    edges = F.array(
        F.struct(F.lit(-2).cast("bigint").alias("ord"), F.lit('"Report:\nall ads"').alias("line")),
        F.struct(F.lit(-1).cast("bigint").alias("ord"), F.lit(header).alias("line")),
        F.struct(F.lit(1 << 62).alias("ord"), F.lit('"© 2024\nMicrosoft Corporation",,7,7').alias("line")),
    )
    every = rows.unionByName(files.select("file", F.inline(edges)))
    every.repartition("file").sortWithinPartitions("file", "ord").select("file", "line").write.partitionBy("file").text(path)


_REPORT_LINES = """
SELECT 'Ad' AS report, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority || chr(10) || '"' || o_orderstatus || '", ' || CAST(o_custkey AS VARCHAR) AS name,
       CAST(o_custkey AS DOUBLE) AS clicks FROM orders
UNION ALL SELECT 'Campaign', CAST(l_orderkey AS VARCHAR), l_linestatus || chr(10) || chr(10) || l_returnflag, CAST(l_linenumber AS DOUBLE) FROM lineitem
UNION ALL SELECT 'PublisherUsage', CAST(user_id AS VARCHAR), props || chr(10) || event_type, CAST(event_id AS DOUBLE) FROM events
UNION ALL SELECT 'Geographic', CAST(c_custkey AS VARCHAR), c_mktsegment || chr(10) || 'area, ' || CAST(c_nationkey AS VARCHAR), CAST(c_nationkey AS DOUBLE) FROM customer
"""


@query(_REPORT_LINES)
def report_files(spark, sf_dir):
    """Written files of the four report types, line breaks, quotes and commas in their cells, read in many splits."""
    text = lambda c: F.col(c).cast("string")
    kinds = {
        "Ad": ("orders", "o_orderkey", F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('", '), text("o_custkey")), "o_custkey", "AdId", "CampaignName"),
        "Campaign": ("lineitem", "l_orderkey", F.concat("l_linestatus", F.lit("\n\n"), "l_returnflag"), "l_linenumber", "CampaignId", "CampaignName"),
        "PublisherUsage": ("events", "user_id", F.concat("props", F.lit("\n"), "event_type"), "event_id", "CampaignId", "PublisherUrl"),
        "Geographic": ("customer", "c_custkey", F.concat("c_mktsegment", F.lit("\narea, "), text("c_nationkey")), "c_nationkey", "CampaignId", "City"),
    }
    size = "spark.sql.files.maxPartitionBytes"
    usual, out = spark.conf.get(size), None
    for report, (table, key, name, clicks, key_name, name_name) in kinds.items():
        given = tab(spark, sf_dir, table)
        # Files of a bounded number of rows, four at least; hot keys are dealt too.
        more = given.count() // (4 * _REPORT_ROWS)
        deal = [F.lit("-"), F.pmod(F.xxhash64(key, clicks), F.lit(more + 1)).cast("string")] if more else []
        rows = given.select(
            F.concat(F.lit("part"), (F.col(key) % 4).cast("string"), *deal).alias("file"),
            F.col(clicks).cast("bigint").alias("ord"),
            F.concat_ws(",", _quoted(name), F.lit("2024-01-01"), F.concat(text(key), F.lit(".0")), text(clicks)).alias("line"),
        )
        path = scratch_path(spark, f"report-{report}")
        _write_reports(rows, path, f"{name_name},TimePeriod,{key_name},Clicks")
        # Splits that cut cells, also in small files; lines are read once, here, and a task has few enough to hold.
        total = list_files(spark, path, pattern="*.txt").agg(F.sum("length")).first()[0]
        spark.conf.set(size, str(min(_REPORT_SPLIT_BYTES, max(256 << 10, (total or 0) // _REPORT_SPLITS))))
        try:
            read = report_csv.read_report(spark, path, report)
        finally:
            spark.conf.set(size, usual)
        one = read.select(F.lit(report).alias("report"), F.col(key_name).alias("id"), F.col(name_name).alias("name"), F.col("Clicks").alias("clicks"))
        out = one if out is None else out.unionByName(one)
    return out
