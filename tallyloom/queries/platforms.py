"""Platform runs end to end: landing JSON written from the given tables, read by schema, transformed, loaded, targets read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.plans.compiled import compile_tables, load_config, planned
from tallyloom.plans.runner import run_platform, snapshot_targets
from tallyloom.plans.steps import Context
from tallyloom.plans.tables import FACEBOOK_TABLES, GOOGLE_TABLES, LINKEDIN_TABLES, ORGANIC_TABLES
from tallyloom.queries.registry import RUN_TS, day_text, query, tab
from tallyloom.session import scratch_path
from tallyloom.sinks.spec import target_name
from tallyloom.sources.files import Inbox
from tallyloom.sources.records import account_join, read_records, union_wide
from tallyloom.sources.summaries import read_summaries, write_summaries


def _run(spark, platform, tables, landings, only, dims=None):
    """One run for each landing, all on the same targets: the results and the open targets."""
    targets, opened, results = snapshot_targets(spark, scratch_path(spark, platform)), {}, []

    def target(name, rows, table):
        opened[name] = targets(name, rows, table)
        return opened[name]

    for number, frames in enumerate(landings):
        paths = {name: scratch_path(spark, name) for name in frames}
        for name, df in frames.items():
            df.write.json(paths[name])

        def read(table, paths=paths):
            return read_records(spark, paths[table.landing], table.landing)

        results.append(run_platform(platform, tables, read, target, Context(RUN_TS, dims or {}), f"run-{number}", only))
    return results, opened


def _fb_campaigns(spark, sf_dir, status):
    day = F.lpad((F.col("o_orderkey") % 28 + 1).cast("string"), 2, "0")
    return tab(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        status.alias("status"),
        F.concat(F.lit("2024-01-"), day, F.lit("T10:30:00+0000")).alias("created_time"),
        F.col("o_orderpriority").alias("objective"),
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS campaign_id, CASE WHEN o_orderstatus = 'F' THEN 'ENDED' ELSE 'ACTIVE' END AS status, o_orderpriority AS objective,
       '2024-01-' || lpad(CAST(o_orderkey % 28 + 1 AS VARCHAR), 2, '0') || ' 11:30' AS created, '2024-02-01' AS row_loaded_date
FROM orders
""")
def platform_campaigns(spark, sf_dir):
    """Campaigns land as JSON twice; the second run updates those that have ended."""
    ended = _fb_campaigns(spark, sf_dir, F.when(F.col("o_orderstatus") == "F", "ENDED")).filter("status IS NOT NULL")
    landings = [{"fb_campaign": _fb_campaigns(spark, sf_dir, F.lit("ACTIVE"))}, {"fb_campaign": ended}]
    _, targets = _run(spark, "facebook", FACEBOOK_TABLES, landings, ["fb_ads_campaign"])
    return targets["fb_ads_campaign"].read().select(
        "campaign_id", "status", "objective", F.date_format("created_time", "yyyy-MM-dd HH:mm").alias("created"), day_text(F.col("row_loaded_date")).alias("row_loaded_date")
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS campaign_id, CASE WHEN o_orderstatus = 'F' THEN 'ACTIVE' ELSE 'PAUSED' END AS status, o_orderpriority AS objective
FROM orders
""")
def platform_arrival(spark, sf_dir):
    """Of a key's repeats within one batch the last to arrive counts, here one whose value sorts before the first's."""
    path, targets = scratch_path(spark, "arrival"), snapshot_targets(spark, scratch_path(spark, "arrival-targets"))
    _fb_campaigns(spark, sf_dir, F.lit("PAUSED")).write.json(path)
    later = _fb_campaigns(spark, sf_dir, F.when(F.col("o_orderstatus") == "F", "ACTIVE")).filter("status IS NOT NULL")
    later.write.mode("append").json(path)
    opened = {}

    def target(name, rows, table):
        return opened.setdefault(name, targets(name, rows, table))

    run_platform("facebook", FACEBOOK_TABLES, lambda table: read_records(spark, path, table.landing), target, Context(RUN_TS), "arrival", ["fb_ads_campaign"])
    return opened["fb_ads_campaign"].read().select("campaign_id", "status", "objective")


@query("""
SELECT 'fb_ads_campaign' AS name, TRUE AS success, count(*) AS rows_from_api, count(*) AS rows_inserted, 'partial_success' AS status FROM orders
UNION ALL SELECT 'fb_ads_ad_set', FALSE, 0, 0, 'partial_success'
""")
def platform_run_counts(spark, sf_dir):
    """A run in which one table has no landing: the other loads, the run is a partial success."""
    landing = {"fb_campaign": _fb_campaigns(spark, sf_dir, F.lit("ACTIVE"))}
    (result,), _ = _run(spark, "facebook", FACEBOOK_TABLES, [landing], ["fb_ads_campaign", "fb_ads_ad_set"])
    path = scratch_path(spark, "platform-summaries")
    write_summaries(result.summary(spark, RUN_TS), path)
    return read_summaries(spark, path, RUN_TS.date()).select("status", F.explode("tables").alias("t")).select("t.name", "t.success", "t.rows_from_api", "t.rows_inserted", "status")


_CONFIG = """
tables:
  daily_spend:
    processing:
      - drop_null_rows: {columns: [campaign_id]}
    upsert: {enabled: true}
  click_totals:
    landing: daily_spend
    increment: {pk_columns: [campaign_id, date], increment_columns: [clicks]}
    after: [daily_spend]
  spend_alerts:
    landing: daily_spend
    avoid_insert_data: true
  mixed_days:
    upsert: {enabled: true}
"""


@query("""
WITH days AS (SELECT o_custkey AS campaign_id, o_orderdate AS day, count(*) AS clicks FROM orders GROUP BY 1, 2)
SELECT 'daily_spend_TEST' AS name, 'upsert' AS mode, 'campaign_id,date' AS keys, 'loaded' AS state, count(*) AS rows, CAST(sum(clicks) AS BIGINT) AS clicks FROM days WHERE campaign_id % 10 <> 0
UNION ALL SELECT 'click_totals_TEST', 'increment', 'campaign_id,date', 'loaded', count(*), 2 * CAST(sum(clicks) AS BIGINT) FROM days WHERE campaign_id % 10 <> 0
UNION ALL SELECT 'spend_alerts', 'append', '', 'alert', 2 * count(*), 2 * CAST(sum(clicks) AS BIGINT) FROM days
UNION ALL SELECT 'mixed_days', 'upsert', 'campaign_id,date', 'failed', 0, 0
""")
def config_run(spark, sf_dir):
    """A written config is compiled and run twice on test tables: modes from its sections, keys from column names, proved; one table's guess is wrong and fails alone."""
    path, root = scratch_path(spark, "config"), scratch_path(spark, "config-tables")
    spark.createDataFrame([(_CONFIG,)], "value string").coalesce(1).write.text(path)
    tables = compile_tables(load_config(spark, path))
    days = tab(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("campaign_id"), day_text(F.col("o_orderdate")).alias("date")).agg(F.count(F.lit(1)).alias("clicks"))
    named = days.withColumn("campaign_id", F.when(F.col("campaign_id") % 10 != 0, F.col("campaign_id").cast("string")))
    same_day = days.select(F.lit("1").alias("campaign_id"), F.lit("2024-01-01").alias("date"), F.col("campaign_id").alias("clicks"))
    paths = {"daily_spend": scratch_path(spark, "daily-spend"), "mixed_days": scratch_path(spark, "mixed-days")}
    named.write.json(paths["daily_spend"])
    same_day.write.json(paths["mixed_days"])
    landed = {k: spark.read.schema("campaign_id string, date string, clicks bigint").json(p) for k, p in paths.items()}
    targets, opened = snapshot_targets(spark, root), {}

    def target(name, rows, table):
        return opened.setdefault(name, targets(name, rows, table))

    for number in (1, 2):
        result = run_platform("config", tables, lambda table: landed[table.landing], target, Context(RUN_TS), f"config-{number}", alerts=root, test=True)
    shown = []
    for name, mode, keys in planned(tables, landed, Context(RUN_TS)):
        alert = tables[name].load.alert_only
        state = "failed" if name in result.failed else "alert" if alert else "loaded"
        test_name = target_name(name, True)
        rows = spark.read.parquet(f"{root}/alerts/{name}") if alert else opened[test_name].read() if state == "loaded" else landed[tables[name].landing].limit(0)
        totals = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"))
        shown.append(totals.select(F.lit(test_name if state == "loaded" else name).alias("name"), F.lit(mode).alias("mode"), F.lit(keys).alias("keys"), F.lit(state).alias("state"), "rows", "clicks"))
    return union_wide(*shown)


@query("""
SELECT CAST(l_partkey AS VARCHAR) AS ad_id, l_returnflag AS device, CAST(min(l_linenumber) AS BIGINT) AS clicks, CAST(min(l_linenumber) AS DOUBLE) * 2 AS cost,
       CAST(l_partkey % 5 AS VARCHAR) AS customer_id_google
FROM lineitem GROUP BY l_partkey, l_returnflag
""")
def platform_device_costs(spark, sf_dir):
    """Nested records land as JSON, are flattened, priced, cut to the first row by ad and device and replace the target."""
    number = F.col("l_linenumber")
    landing = tab(spark, sf_dir, "lineitem").select(
        F.struct((F.col("l_partkey") % 5).cast("string").alias("id")).alias("customer"),
        F.struct(F.struct(F.col("l_partkey").cast("string").alias("id")).alias("ad")).alias("adGroupAd"),
        F.struct(F.col("l_returnflag").alias("device")).alias("segments"),
        F.struct(number.cast("string").alias("clicks"), (number * 2_000_000).cast("string").alias("costMicros")).alias("metrics"),
    )
    _, targets = _run(spark, "google", GOOGLE_TABLES, [{"google_cost_by_device": landing}], ["google_ads_cost_by_device"])
    return targets["google_ads_cost_by_device"].read().select(
        "ad_id", "device", F.col("clicks").cast("bigint").alias("clicks"), F.col("cost_micros").cast("double").alias("cost"), "customer_id_google"
    )


@query("""
SELECT CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS run, o_orderpriority AS objective, count(*) AS rows FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2
""")
def inbox_runs(spark, sf_dir):
    """Files arrive before the first and the second run; each run reads the new ones, a third finds none."""
    root, state = scratch_path(spark, "inbox"), scratch_path(spark, "inbox-state")
    inbox, runs = Inbox(spark, root, state, "orders"), []
    for run, status in ((1, "F"), (2, "O"), (3, None)):
        if status:
            _fb_campaigns(spark, sf_dir, F.col("o_orderstatus")).filter(F.col("status") == status).write.mode("append").json(root)
        files = inbox.new_files("*.json")
        rows = inbox.rows(files, "id string, status string, objective string")
        runs.append(rows.groupBy("objective").agg(F.count(F.lit(1)).alias("rows")).withColumn("run", F.lit(run)))
        inbox.done(files, f"run-{run}")
    return union_wide(*runs).select("run", "objective", "rows")


@query("""
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'urn:li:sponsoredAccount:' ELSE '' END || c_custkey AS id, c_name AS name, c_mktsegment AS type,
       CAST(CASE WHEN c_custkey % 5 = 0 AND c_custkey % 2 <> 0 THEN c_nationkey + 100 ELSE 1 END AS INT) AS companyid
FROM customer WHERE c_custkey % 3 = 0
""")
def linkedin_accounts(spark, sf_dir):
    """Accounts land by id or URN and are asked for by id or URN; the company is known for every fifth, by the id alone."""
    customers = tab(spark, sf_dir, "customer")
    key, urn = F.col("c_custkey").cast("string"), F.concat(F.lit("urn:li:sponsoredAccount:"), F.col("c_custkey").cast("string"))
    landing = customers.select(F.when(F.col("c_custkey") % 2 == 0, urn).otherwise(key).alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("type"))
    wanted = customers.filter("c_custkey % 3 = 0").select(F.when(F.col("c_custkey") % 4 == 0, urn).otherwise(key).alias("account"))
    companies = customers.filter("c_custkey % 5 = 0").select(key.alias("account_id"), (F.col("c_nationkey") + 100).cast("int").alias("company_id"))
    landed = account_join(landing, wanted)
    _, targets = _run(spark, "linkedin_ads", LINKEDIN_TABLES, [{"linkedin_account": landed}], ["linkedin_ads_account"], {"companies": companies})
    return targets["linkedin_ads_account"].read().select("id", "name", "type", F.col("companyid").cast("int").alias("companyid"))


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS organization_id, strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS organic_follower_gain,
       CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS paid_follower_gain, CAST(count(*) + count_if(o_orderstatus = 'F') AS BIGINT) AS net_follower_change
FROM orders GROUP BY 1, 2
""")
def organic_followers(spark, sf_dir):
    """Follower gains land as nested JSON by organization and day and are upserted."""
    days = tab(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderdate").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("paid"))
    start = F.unix_millis(F.to_utc_timestamp(F.col("o_orderdate").cast("timestamp"), F.current_timezone()))
    landing = days.select(
        F.col("o_custkey").cast("string").alias("_organization_id"),
        F.struct(start.alias("start"), (start + 86_400_000).alias("end")).alias("timeRange"),
        F.struct(F.col("n").alias("organicFollowerGain"), F.when(F.col("paid") > 0, F.col("paid")).alias("paidFollowerGain")).alias("followerGains"),
    )
    _, targets = _run(spark, "linkedin_posts", ORGANIC_TABLES, [{"organic_followers": landing}], ["linkedin_organic_followers"])
    gains = ["organic_follower_gain", "paid_follower_gain", "net_follower_change"]
    return targets["linkedin_organic_followers"].read().select("organization_id", day_text(F.col("date")).alias("date"), *[F.col(c).cast("bigint").alias(c) for c in gains])


@query("""
SELECT CAST(user_id AS VARCHAR) AS organization_id, strftime(max(ts), '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS all_page_views,
       CAST(count(DISTINCT event_type) AS BIGINT) AS unique_page_views, CAST(count_if(event_type = 'click') AS BIGINT) AS jobs_page_views, CAST(0 AS BIGINT) AS careers_page_views
FROM events GROUP BY user_id
""")
def organic_page_stats(spark, sf_dir):
    """Nested page statistics land with some counts left out, which are 0."""
    users = tab(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max(F.col("ts").cast("timestamp")).alias("last"), F.count(F.lit(1)).alias("n"), F.count_distinct("event_type").alias("kinds"), F.count_if(F.col("event_type") == "click").alias("clicks")
    )
    views = lambda c: F.struct(F.col(c).alias("pageViews"))
    start = F.unix_millis("last")
    landing = users.select(
        F.col("user_id").cast("string").alias("_organization_id"),
        F.struct(F.struct(views("n").alias("allPageViews"), views("kinds").alias("uniquePageViews"), views("clicks").alias("jobsPageViews")).alias("views")).alias("totalPageStatistics"),
        F.struct(start.alias("start"), start.alias("end")).alias("timeRange"),
    )
    _, targets = _run(spark, "linkedin_posts", ORGANIC_TABLES, [{"organic_page_stats": landing}], ["linkedin_organic_page_stats"])
    counts = ["all_page_views", "unique_page_views", "jobs_page_views", "careers_page_views"]
    return targets["linkedin_organic_page_stats"].read().select("organization_id", day_text(F.col("date")).alias("date"), *[F.col(c).cast("bigint").alias(c) for c in counts])
