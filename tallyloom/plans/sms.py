"""SMS flow (X7, K16, K17): campaigns from the render log, statistics, links, loads, click refresh."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.dates import millis_to_ts
from tallyloom.functions.numbers import acceptance_rate, safe_int
from tallyloom.operators.filters import check_constraints, has_content, year_window
from tallyloom.operators.lookup import anti_existing, enrich_or_keep, semi_recent
from tallyloom.operators.nested import stat_value
from tallyloom.session import staged
from tallyloom.sinks.merge import load_counts, merge_rows, prepare_batch
from tallyloom.sinks.snapshot import SnapshotTable
from tallyloom.sinks.spec import LoadSpec
from tallyloom.sinks.stats import LoadStats

# --- Fixed values -----------------------------------------------------------
CHANNEL = "SMS"
STAT_NAMES = {"sent": "majorSent", "delivered": "accepted", "bounced": "bounces", "rate": "acceptedRate"}
MAX_TEXT = 1000
MAX_CODE = 50
# ----------------------------------------------------------------------------

CAMPAIGNS = LoadSpec("sms_campaign", ("message_id",), "append", order=("sendout_date",))
LINKS = LoadSpec("sms_link", ("message_id", "bitly_short_url"), "upsert", update=("total_clicks", "load_date"))
LINKS_INSERT_ONLY = LoadSpec("sms_link", ("message_id", "bitly_short_url"), "append")


def sms_messages(renders: DataFrame, campaigns: DataFrame, as_of: date, years: int = 1, channel: str = CHANNEL) -> DataFrame:
    """J3/A5 for all companies at once: message, activity, greatest contact and company.

    The log is cut by a range on its time, grouped, and only then joined.
    """
    log = year_window(renders, "RENDER_TIMESTAMP", as_of, years).filter(F.col("SENTTOMTA_SENDOUTCHANNEL") == channel)
    per_message = log.groupBy(F.col("MESSAGE_ID").alias("message_id"), F.col("MESSAGE_EXTERNALID").alias("activity_id")).agg(
        F.max("USER_ID").alias("contact_id")
    )
    owners = campaigns.select(F.col("NEWSLETTERID").alias("activity_id"), F.col("COMPANYID").alias("company_id"))
    joined = per_message.join(owners, "activity_id")
    return joined.select("message_id", "activity_id", "contact_id", "company_id").distinct()


def sms_statistics(statistics: DataFrame) -> DataFrame:
    """Statistic arrays to typed columns."""
    stats = F.col("statisticValues")
    sent = safe_int(stat_value(stats, STAT_NAMES["sent"]))
    delivered = safe_int(stat_value(stats, STAT_NAMES["delivered"]))
    return statistics.select(
        "message_id",
        millis_to_ts(F.col("sendoutStartDate")).alias("sendout_date"),
        sent.alias("sent_count"),
        delivered.alias("delivered_count"),
        safe_int(stat_value(stats, STAT_NAMES["bounced"])).alias("bounced_count"),
        acceptance_rate(stat_value(stats, STAT_NAMES["rate"]), delivered, sent).alias("acceptance_rate"),
    )


def campaign_rules() -> Mapping[str, F.Column]:
    """F11 for campaigns."""
    return {
        "activity_id empty": has_content(F.col("activity_id")),
        "message_id not positive": F.col("message_id") > 0,
        "sms_text too long": F.coalesce(F.length("sms_text"), F.lit(0)) <= MAX_TEXT,
        "activity_id too long": F.coalesce(F.length("activity_id"), F.lit(0)) <= MAX_CODE,
    }


def link_rules() -> Mapping[str, F.Column]:
    """F11 for links."""
    return {
        "url invalid": F.col("bitly_short_url").rlike("^https?://"),
        "message_id not positive": F.col("message_id") > 0,
        "clicks negative": F.coalesce(F.col("total_clicks"), F.lit(0)) >= 0,
    }


def sms_campaigns(messages: DataFrame, statistics: DataFrame, contents: DataFrame, run_date: date) -> tuple[DataFrame, DataFrame]:
    """Campaign rows and the rejected ones with their reasons.

    ``contents`` holds message_id, sms_text, campaign_name (``nested.sms_message``).
    """
    joined = messages.join(sms_statistics(statistics), "message_id").join(contents, "message_id", "left")
    rows = joined.select(
        "message_id", "activity_id", "campaign_name", F.col("company_id").cast("int").alias("company_id"), "sms_text", "sendout_date",
        "sent_count", "delivered_count", "bounced_count", "acceptance_rate", F.lit(run_date).alias("load_date"),
    )
    return check_constraints(rows, campaign_rules())


def sms_links(campaigns: DataFrame, clicks: DataFrame | None, run_date: date) -> tuple[DataFrame, DataFrame]:
    """One row per distinct link of a text, click data where the lookup has it; and the rejected links with their reasons.

    ``clicks`` holds bitlink_id, bitly_long_url and total_clicks.
    """
    exploded = campaigns.select("message_id", "activity_id", F.explode(text.short_links(F.col("sms_text"))).alias("bitly_short_url"))
    rows = exploded.select(
        "*",
        F.lit(None).cast("string").alias("bitly_long_url"),
        F.lit(0).cast("bigint").alias("total_clicks"),
        F.lit(run_date).alias("load_date"),
    )
    if clicks is not None:
        keyed = rows.withColumn("bitlink_id", text.link_id(F.col("bitly_short_url")))
        rows = enrich_or_keep(keyed, clicks, ["bitlink_id"], ["bitly_long_url", "total_clicks"]).drop("bitlink_id")
    return check_constraints(rows, link_rules())


def run_sms(
    campaigns: DataFrame, clicks: DataFrame | None, campaign_table: SnapshotTable, link_table: SnapshotTable, batch_id: str, run_date: date
) -> dict[str, LoadStats]:
    """New campaigns are inserted, their links upserted; known campaigns keep their links until a refresh.

    Rejected links count as filtered.
    """
    fresh = anti_existing(campaigns, campaign_table.read(), ["message_id"])
    links, rejected = sms_links(staged(fresh, "sms-fresh"), clicks, run_date)
    refused = rejected.count()
    # Links go first: both read the campaigns known before this run.
    link_stats = link_table.load(links, LINKS, batch_id, run_date) + LoadStats(rows_from_api=refused, rows_filtered=refused)
    return {"sms_campaign": campaign_table.load(campaigns, CAMPAIGNS, batch_id, run_date), "sms_link": link_stats}


def refreshed_links(campaigns: DataFrame, links: DataFrame, clicks: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Links of recent campaigns with new click counts; a link the lookup lacks keeps its own."""
    recent = campaigns.filter(F.col("sendout_date") >= F.lit(as_of - timedelta(days=days)))
    active = semi_recent(recent, links, "message_id").select("message_id", F.col("activity_id").alias("__activity"))
    known = links.join(active, "message_id").withColumn("activity_id", F.col("__activity")).drop("__activity")
    keyed = known.withColumn("bitlink_id", text.link_id(F.col("bitly_short_url")))
    found = enrich_or_keep(keyed, clicks, ["bitlink_id"], ["bitly_long_url", "total_clicks"]).drop("bitlink_id")
    return found.withColumn("load_date", F.lit(as_of)).select(*links.columns)


def refresh_clicks(campaigns: DataFrame, links: DataFrame, clicks: DataFrame, as_of: date, days: int = 90) -> tuple[DataFrame, DataFrame]:
    """K17 as plans: (links after the refresh, its counters). The batch is staged, so that both read it."""
    batch = staged(refreshed_links(campaigns, links, clicks, as_of, days), "sms-refresh")
    return merge_rows(prepare_batch(batch, LINKS), links, LINKS), load_counts(batch, links, LINKS)
