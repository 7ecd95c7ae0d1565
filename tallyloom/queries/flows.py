"""The SMS, newsletter and monitoring flows on derived inputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyloom.plans import monitoring, newsletter, sms
from tallyloom.queries.registry import day_text, query, r4, tab
from tallyloom.schemas import SUMMARY
from tallyloom.session import scratch_path, staged
from tallyloom.sources.summaries import read_summaries, write_summaries

_DAY = date(2024, 2, 1)


def _renders(spark, sf_dir):
    e = tab(spark, sf_dir, "events")
    return e.select(
        (F.col("user_id") + 1).alias("MESSAGE_ID"),
        F.concat(F.lit("ACT"), F.col("user_id").cast("string")).alias("MESSAGE_EXTERNALID"),
        F.col("event_id").alias("USER_ID"),
        F.col("ts").alias("RENDER_TIMESTAMP"),
        F.when(F.col("event_type").isin("click", "view", "purchase"), "SMS").otherwise("MAIL").alias("SENTTOMTA_SENDOUTCHANNEL"),
    )


def _campaigns(spark, sf_dir):
    return tab(spark, sf_dir, "customer").select(
        F.concat(F.lit("ACT"), F.col("c_custkey").cast("string")).alias("NEWSLETTERID"), F.col("c_nationkey").alias("COMPANYID")
    )


def _statistics(spark, sf_dir):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")

    def pair(name, value):
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    rate = F.when(nation < 5, "12.345").when(nation < 10, "NaN")
    stats = F.array(pair("majorSent", key * 10), pair("accepted", key * 10 - nation), pair("bounces", nation), pair("acceptedRate", rate))
    start = F.lit(1704067200000) + key * 3600000
    return tab(spark, sf_dir, "customer").select((key + 1).alias("message_id"), start.alias("sendoutStartDate"), stats.alias("statisticValues"))


def _contents(spark, sf_dir):
    link = F.concat(F.lit(" https://bit.ly/n"), F.col("c_nationkey").cast("string"), F.lit(" https://bit.ly/s"), F.substring("c_mktsegment", 1, 1))
    return tab(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("message_id"),
        F.concat(F.lit("Hi "), F.col("c_name"), link).alias("sms_text"),
        F.col("c_mktsegment").alias("campaign_name"),
    )


def _sms(spark, sf_dir):
    messages = sms.sms_messages(_renders(spark, sf_dir), _campaigns(spark, sf_dir), _DAY)
    return sms.sms_campaigns(messages, _statistics(spark, sf_dir), _contents(spark, sf_dir), _DAY)[0]


_SMS = """
WITH m AS (SELECT user_id + 1 AS message_id, 'ACT' || user_id AS activity_id, user_id FROM events
           WHERE event_type IN ('click', 'view', 'purchase') AND ts >= TIMESTAMP '2023-01-01' GROUP BY ALL),
c AS (SELECT m.message_id, m.activity_id, c_mktsegment AS campaign_name, c_nationkey AS company_id,
             'Hi ' || c_name || ' https://bit.ly/n' || c_nationkey || ' https://bit.ly/s' || left(c_mktsegment, 1) AS sms_text,
             TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * c_custkey AS sendout_date, c_custkey * 10 AS sent_count,
             c_custkey * 10 - c_nationkey AS delivered_count, CAST(c_nationkey AS BIGINT) AS bounced_count, c_custkey, c_nationkey, c_mktsegment
      FROM m JOIN customer ON c_custkey = m.user_id)
"""


@query(_SMS + """
SELECT message_id, activity_id, campaign_name, company_id, sms_text, sendout_date, sent_count, delivered_count, bounced_count,
       CASE WHEN c_nationkey < 5 THEN 12.34::DOUBLE WHEN sent_count > 0 THEN CAST(round_even(CAST(CAST((delivered_count / sent_count * 100) AS VARCHAR) AS DECIMAL(18,10)), 2) AS DOUBLE) END AS acceptance_rate,
       '2024-02-01' AS load_date
FROM c
""")
def sms_campaign_rows(spark, sf_dir):
    """Campaign rows of all companies in one job."""
    out = _sms(spark, sf_dir)
    return out.withColumns({"acceptance_rate": F.col("acceptance_rate").cast("double"), "load_date": day_text(F.col("load_date"))})


def _clicks(spark, sf_dir, plus=0):
    n = tab(spark, sf_dir, "nation").filter("n_regionkey <> 2")
    return n.select(
        F.concat(F.lit("bit.ly/n"), F.col("n_nationkey").cast("string")).alias("bitlink_id"),
        F.concat(F.lit("https://long/"), "n_name").alias("bitly_long_url"),
        (F.col("n_nationkey") + 100 + plus).cast("bigint").alias("total_clicks"),
    )


_LINKS = _SMS + """
, k AS (SELECT message_id, activity_id, 'https://bit.ly/n' || c_nationkey AS bitly_short_url, c_nationkey, TRUE AS nat, sendout_date FROM c UNION ALL
        SELECT message_id, activity_id, 'https://bit.ly/s' || left(c_mktsegment, 1), c_nationkey, FALSE, sendout_date FROM c),
l AS (SELECT k.message_id, k.activity_id, bitly_short_url, CASE WHEN nat THEN 'https://long/' || n_name END AS bitly_long_url,
             CASE WHEN nat AND n_name IS NOT NULL THEN 100 + n_nationkey ELSE 0 END AS total_clicks, nat AND n_name IS NOT NULL AS found, sendout_date
      FROM k LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_nationkey = k.c_nationkey)
"""


@query(_LINKS + "SELECT message_id, activity_id, bitly_short_url, bitly_long_url, CAST(total_clicks AS BIGINT) AS total_clicks, '2024-02-01' AS load_date FROM l")
def sms_link_rows(spark, sf_dir):
    """One row per link, click data where known."""
    out, _ = sms.sms_links(_sms(spark, sf_dir), _clicks(spark, sf_dir), _DAY)
    return out.withColumn("load_date", day_text(F.col("load_date")))


@query(_SMS + """
SELECT 'campaign' AS kind, 'sms_text too long' AS reason, count(*) AS n FROM c WHERE (c_custkey + 1) % 7 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'link', 'clicks negative', count(*) FROM c JOIN nation ON n_nationkey = c_nationkey
WHERE n_regionkey <> 2 AND n_nationkey < 3 AND (c_custkey + 1) % 7 <> 0 HAVING count(*) > 0
""")
def sms_rejects(spark, sf_dir):
    """Rejected campaigns and links of a run, counted by reason."""
    long = F.when(F.col("message_id") % 7 == 0, F.repeat("sms_text", 60)).otherwise(F.col("sms_text"))
    messages = sms.sms_messages(_renders(spark, sf_dir), _campaigns(spark, sf_dir), _DAY)
    campaigns, bad = sms.sms_campaigns(messages, _statistics(spark, sf_dir), _contents(spark, sf_dir).withColumn("sms_text", long), _DAY)
    _, bad_links = sms.sms_links(campaigns, _clicks(spark, sf_dir, -103), _DAY)
    both = [df.select(F.lit(kind).alias("kind"), F.explode("reject_reasons").alias("reason")) for kind, df in (("campaign", bad), ("link", bad_links))]
    return both[0].unionByName(both[1]).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


def _loaded_sms(spark, sf_dir):
    """Campaigns and links as tables, which they are by the time of a refresh."""
    campaigns = staged(_sms(spark, sf_dir), "sms-campaigns")
    return campaigns, staged(sms.sms_links(campaigns, _clicks(spark, sf_dir), _DAY)[0], "sms-links")


@query(_LINKS + """
SELECT message_id, activity_id, bitly_short_url, bitly_long_url, CAST(CASE WHEN sendout_date >= TIMESTAMP '2024-01-03' AND found THEN total_clicks + 7 ELSE total_clicks END AS BIGINT) AS total_clicks,
       CASE WHEN sendout_date >= TIMESTAMP '2024-01-03' THEN '2024-02-02' ELSE '2024-02-01' END AS load_date
FROM l
""")
def sms_click_refresh(spark, sf_dir):
    """Links of recent campaigns take new counts, older ones stay."""
    campaigns, links = _loaded_sms(spark, sf_dir)
    after, _ = sms.refresh_clicks(campaigns, links, _clicks(spark, sf_dir, 7), date(2024, 2, 2), 30)
    return after.withColumn("load_date", day_text(F.col("load_date")))


@query(_LINKS + """
SELECT count(*) AS rows_from_api, 0::BIGINT AS rows_inserted, count(*) AS rows_updated, 0::BIGINT AS rows_skipped, 0::BIGINT AS rows_filtered, count(*) AS rows_written
FROM l WHERE sendout_date >= TIMESTAMP '2024-01-03'
""")
def sms_refresh_counts(spark, sf_dir):
    """Counters of the refresh."""
    campaigns, links = _loaded_sms(spark, sf_dir)
    return sms.refresh_clicks(campaigns, links, _clicks(spark, sf_dir, 7), date(2024, 2, 2), 30)[1]


_CANDIDATES = """
WITH r AS (SELECT 'ACT' || (user_id // 10) AS newsletter_id, user_id // 10 AS nl, user_id + 1 AS message_id, event_id // 3 AS contact_id, max(ts) AS last_render
           FROM events WHERE ts >= TIMESTAMP '2023-01-01' GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY newsletter_id ORDER BY last_render DESC, contact_id, message_id) AS rn FROM r),
c AS (SELECT newsletter_id, message_id, contact_id, rn, c_nationkey AS company_id FROM k JOIN customer ON c_custkey = nl WHERE rn <= 10)
"""


def _candidates(spark, sf_dir):
    e = tab(spark, sf_dir, "events").select(
        (F.col("user_id") + 1).alias("MESSAGE_ID"),
        F.concat(F.lit("ACT"), F.expr("user_id div 10").cast("string")).alias("MESSAGE_EXTERNALID"),
        F.expr("event_id div 3").alias("USER_ID"),
        F.col("ts").alias("RENDER_TIMESTAMP"),
    )
    return newsletter.mapp_candidates(e, _campaigns(spark, sf_dir), _DAY)


@query(_CANDIDATES + "SELECT * FROM c")
def newsletter_candidates(spark, sf_dir):
    """Ten latest readers per newsletter with their company."""
    return _candidates(spark, sf_dir).drop("last_render")


@query(_CANDIDATES + """
, lead AS (SELECT newsletter_id, message_id FROM c WHERE rn = 1),
t AS (SELECT c.newsletter_id, lead.message_id, c.contact_id, c.rn, c.company_id FROM c JOIN lead USING (newsletter_id)),
p AS (SELECT e.event_id // 3 AS contact_id, max(d.doc_id) AS doc_id FROM events e JOIN documents d ON d.doc_id = e.user_id WHERE event_type = 'click' GROUP BY 1),
h AS (SELECT t.*, p.doc_id, row_number() OVER (PARTITION BY newsletter_id ORDER BY rn) AS try FROM t JOIN p ON p.contact_id = t.contact_id)
SELECT newsletter_id, company_id, contact_id, rn, newsletter_id || '.png' AS image_name, CAST(doc_id AS BIGINT) AS doc_id FROM h
WHERE try = 1 AND newsletter_id || '.png' NOT IN (SELECT 'ACT' || n_nationkey || '.png' FROM nation WHERE n_regionkey = 2)
""")
def newsletter_images(spark, sf_dir):
    """First preview that exists, cleaned, images still to make."""
    e, d = tab(spark, sf_dir, "events"), tab(spark, sf_dir, "documents")
    clicked = e.filter("event_type = 'click'").join(d.select("doc_id"), F.col("doc_id") == F.col("user_id"))
    found = clicked.groupBy(F.expr("event_id div 3").alias("contact_id")).agg(F.max("doc_id").alias("doc_id"))
    candidates = _candidates(spark, sf_dir)
    lead = candidates.groupBy("newsletter_id").agg(F.min_by("message_id", "rn").alias("message_id"))
    body = F.concat(F.lit("<p>{{x}}"), F.col("doc_id").cast("string"), F.lit("</p>"))
    # A preview belongs to (message, contact); here every lead message has one per contact that clicked.
    pairs = candidates.select("newsletter_id", "contact_id").join(lead, "newsletter_id").join(found, "contact_id")
    previews = pairs.select("message_id", "contact_id", "doc_id", body.alias("html"), F.lit(None).cast("string").alias("external_id")).distinct()
    first = newsletter.first_previews(candidates, previews)
    done = tab(spark, sf_dir, "nation").filter("n_regionkey = 2")
    existing = done.select(F.concat(F.lit("ACT"), F.col("n_nationkey").cast("string"), F.lit(".png")).alias("name"))
    out = newsletter.images_to_make(newsletter.clean_bodies(first, repair=False), existing)
    number = F.regexp_extract("html", r"^<p>(\d+)</p>$", 1).cast("bigint")
    return out.select("newsletter_id", "company_id", "contact_id", "rn", "image_name", number.alias("doc_id"))


_RUNS = """
WITH t AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS platform, hour(ts) AS part, count(*) AS n, max(value) > 300 AS bad FROM events GROUP BY ALL),
x AS (SELECT day, platform, CAST(sum(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS api, count(*) AS tables_count, CAST(count_if(NOT bad) AS BIGINT) AS ok, CAST(count_if(bad) AS BIGINT) AS failed FROM t GROUP BY ALL),
s AS (SELECT *, CASE WHEN failed = 0 THEN 'success' WHEN ok = 0 THEN 'failed' ELSE 'partial_success' END AS status FROM x)
"""


def _run_tables(spark, sf_dir):
    e = tab(spark, sf_dir, "events")
    parts = e.groupBy(day_text(F.col("ts")).alias("execution_id"), F.col("event_type").alias("platform"), F.hour("ts").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("value") > 300).alias("bad")
    )
    zero = F.lit(0).cast("bigint")
    n = F.col("n")
    return parts.select(
        "execution_id", "platform", F.col("part").cast("string").alias("name"), (~F.col("bad")).alias("success"), n.alias("rows_from_api"),
        n.alias("rows_written"), n.alias("rows_inserted"), zero.alias("rows_updated"), zero.alias("rows_skipped"), zero.alias("rows_filtered"),
        F.lit(None).cast("string").alias("error"),
    )


@query(_RUNS + "SELECT day AS execution_id, platform, api AS total_rows_from_api, api AS total_rows_inserted, tables_count, ok AS tables_succeeded, failed AS tables_failed, status FROM s")
def run_totals(spark, sf_dir):
    """A7."""
    out = monitoring.run_totals(_run_tables(spark, sf_dir))
    return out.drop("total_rows_written", "total_rows_updated", "total_rows_skipped", "total_rows_filtered")


@query(_RUNS + """
SELECT day AS date, count(*) AS total_platforms, CAST(count_if(status = 'success') AS BIGINT) AS platforms_success, CAST(count_if(status = 'failed') AS BIGINT) AS platforms_failed,
       CAST(count_if(status = 'partial_success') AS BIGINT) AS platforms_partial, CAST(sum(api) AS BIGINT) AS rows_written,
       CASE WHEN count_if(status = 'failed') > 0 THEN 'error' WHEN count_if(status = 'partial_success') > 0 THEN 'warning' ELSE 'success' END AS overall
FROM s GROUP BY 1
""")
def run_report(spark, sf_dir):
    """Summaries written as JSON per platform and date, read back, rolled up."""
    tables = _run_tables(spark, sf_dir)
    totals = monitoring.run_totals(tables)
    stamp = F.concat("execution_id", F.lit("T03:30:00"))
    # A run has one entry per table: here at most one per hour.
    names = [f.name for f in SUMMARY["tables"].dataType.elementType.fields]
    details = tables.groupBy("execution_id", "platform").agg(F.collect_list(F.struct(*names)).alias("tables"))
    rows = totals.join(details, ["execution_id", "platform"]).withColumns({"start_time": stamp, "end_time": stamp})
    have = set(rows.columns)
    summaries = rows.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in SUMMARY.fields]
    )
    root = scratch_path(spark, "summaries")
    write_summaries(summaries.repartition("platform", "execution_id"), root)
    return monitoring.nightly_report(read_summaries(spark, root)).withColumn("date", day_text(F.col("date")))


@query("""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS found, CAST(count_if(event_type <> 'error') AS BIGINT) AS extracted,
       floor(count_if(event_type <> 'error') / count(*) * 100 * 10000 + 0.5) / 10000 AS success_rate
FROM events GROUP BY 1
""")
def stage_counters(spark, sf_dir):
    """Counters of the extraction stages in one pass."""
    from tallyloom.operators.aggregate import success_rate

    e = tab(spark, sf_dir, "events").groupBy(day_text(F.col("ts")).alias("day")).agg(
        F.count(F.lit(1)).alias("found"), F.count_if(F.col("event_type") != "error").alias("extracted")
    )
    return e.withColumn("success_rate", r4(success_rate(F.col("extracted"), F.col("found"))))
