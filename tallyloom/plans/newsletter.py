"""Newsletter flow (X7): rank contacts, first preview that exists, clean HTML, skip finished images."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import html, text
from tallyloom.functions.dates import years_back_start
from tallyloom.operators.aggregate import ranked_contacts
from tallyloom.operators.filters import has_content, year_window
from tallyloom.operators.lookup import first_success, split_key_join


def mapp_candidates(renders: DataFrame, campaigns: DataFrame, as_of: date, years: int = 1, k: int = 10) -> DataFrame:
    """Up to ``k`` contacts per newsletter, the latest reader first, for all companies at once.

    Renders are grouped to one row per reader before they meet the campaigns.
    """
    log = year_window(renders, "RENDER_TIMESTAMP", as_of, years)
    owners = campaigns.select(F.col("NEWSLETTERID").alias("newsletter_id"), F.col("COMPANYID").alias("company_id")).distinct()
    readers = log.groupBy(
        F.col("MESSAGE_EXTERNALID").alias("newsletter_id"), F.col("MESSAGE_ID").alias("message_id"), F.col("USER_ID").alias("contact_id")
    ).agg(F.max("RENDER_TIMESTAMP").alias("last_render"))
    ranked = ranked_contacts(readers, "newsletter_id", "message_id", "contact_id", "last_render", k)
    return ranked.join(owners, "newsletter_id")


def first_previews(candidates: DataFrame, previews: DataFrame) -> DataFrame:
    """Per newsletter the first ranked contact whose preview exists.

    All calls use the message of the newsletter's first candidate, so it is
    attached to every candidate before the join.
    """
    # At most k candidates per newsletter, already together after the ranking.
    group = Window.partitionBy("newsletter_id")
    tries = candidates.withColumn("message_id", F.min_by("message_id", "rn").over(group)).drop("last_render")
    return first_success(tries, previews, ["message_id", "contact_id"], "newsletter_id", "rn")


def dynamics_newsletters(mails: DataFrame, campaigns: DataFrame, companies: DataFrame, as_of: date, years: int = 1) -> DataFrame:
    """E-mails with content, start year (planned, else actual) minus one within the window."""
    start = F.coalesce(F.col("PROPOSEDSTART"), F.col("ACTUALSTART"))
    recent = mails.filter((start >= years_back_start(as_of, years - 1)) & F.col("PREVIEWHTML").isNotNull())
    joined = split_key_join(recent, campaigns, companies, "CAMPAIGNACTIVITY_CODE", "CODE", "CAMPAIGNID")
    return joined.select(
        F.col("COMPANYID").alias("company_id"), F.col("CAMPAIGNACTIVITY_CODE").alias("newsletter_id"), F.col("PREVIEWHTML").alias("html")
    ).distinct()


def clean_bodies(df: DataFrame, html_col: str = "html", patterns: list[str] | None = None, repair: bool = True) -> DataFrame:
    """Newsletters with content, placeholders removed, structure repaired."""
    stripped = df.filter(has_content(F.col(html_col))).withColumn(html_col, html.strip_placeholders(F.col(html_col), patterns))
    return stripped.withColumn(html_col, html.repair_markup(F.col(html_col))) if repair else stripped


def images_to_make(df: DataFrame, existing: DataFrame, external: str = "external_id", newsletter: str = "newsletter_id") -> DataFrame:
    """Image names not in the store yet; ``existing`` holds name."""
    named = df.withColumn("image_name", text.image_name(F.col(external), F.col(newsletter)))
    return named.join(existing.select(F.col("name").alias("image_name")), "image_name", "left_anti")


def run_newsletters(
    renders: DataFrame, campaigns: DataFrame, previews: DataFrame, existing: DataFrame, as_of: date, years: int = 1
) -> DataFrame:
    """The whole flow up to the images still to make."""
    candidates = mapp_candidates(renders, campaigns, as_of, years)
    return images_to_make(clean_bodies(first_previews(candidates, previews)), existing)
