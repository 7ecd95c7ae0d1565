"""Nested records: flattening S2-S4 and S8, arrays, maps and JSON N1-N13, J15.

All row-aligned (trap T1): a field missing in one record is null in that row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import text
from tallyloom.functions.dates import millis_to_ts, range_day
from tallyloom.operators.columns import ref

# --- Fixed values -----------------------------------------------------------
AUDIENCE_FACETS = (
    "urn:li:adTargetingFacet:audienceMatchingSegments",
    "urn:li:adTargetingFacet:dynamicSegments",
)
SEGMENT_URN = "urn:li:adSegment:"
CREATIVE_TYPES = {
    "follow": "FOLLOW_COMPANY_V2",
    "reference": "SPONSORED_STATUS_UPDATE",
    "spotlight": "SPOTLIGHT_AD",
    "jobs": "JOBS_AD",
    "documentAd": "DOCUMENT_AD",
    "thirdPartyVastTagVideoAd": "THIRD_PARTY_VIDEO_AD",
}
PAGE_VIEWS = {
    "allPageViews": "all_page_views",
    "uniquePageViews": "unique_page_views",
    "allDesktopPageViews": "all_desktop_page_views",
    "allMobilePageViews": "all_mobile_page_views",
    "overviewPageViews": "overview_page_views",
    "careersPageViews": "careers_page_views",
    "jobsPageViews": "jobs_page_views",
    "lifeAtPageViews": "life_at_page_views",
}
DEMOGRAPHICS = [
    ("followerCountsByFunction", "FUNCTION", "function"),
    ("followerCountsByIndustry", "INDUSTRY", "industry"),
    ("followerCountsBySeniority", "SENIORITY", "seniority"),
    ("followerCountsByGeoCountry", "GEO_COUNTRY", "geo"),
    ("followerCountsByStaffCountRange", "STAFF_COUNT", "staffCountRange"),
]
# ----------------------------------------------------------------------------


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, here)
        else:
            out.append(here)
    return out


def _at(path: Sequence[str]) -> Column:
    col = ref(path[0])
    for name in path[1:]:
        col = col.getField(name)
    return col


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """One column per struct leaf, named by its path."""
    return df.select(*[_at(p).alias(sep.join(p)) for p in _leaves(df.schema)])


def flatten_nested(df: DataFrame, nested: Sequence[str]) -> DataFrame:
    """S3: structs named in ``nested`` keep a prefix ``key_sub[_subsub]``, other structs lose theirs;
    arrays give their first item; an array of structs two levels down gives its first struct's fields.

    Equal output names are coalesced in schema order.
    """
    out: dict[str, list[Column]] = {}

    def put(name: str, col: Column) -> None:
        out.setdefault(name, []).append(col)

    def first(col: Column, dtype: T.DataType) -> Column:
        return F.get(col, F.lit(0)) if isinstance(dtype, T.ArrayType) else col

    for field in df.schema.fields:
        col, key = ref(field.name), field.name
        if not isinstance(field.dataType, T.StructType):
            put(key, first(col, field.dataType))
            continue
        for sub in field.dataType.fields:
            sub_col = col.getField(sub.name)
            if key not in nested:
                put(sub.name, first(sub_col, sub.dataType))
            elif not isinstance(sub.dataType, T.StructType):
                put(f"{key}_{sub.name}", sub_col)
            else:
                for leaf in sub.dataType.fields:
                    leaf_col = sub_col.getField(leaf.name)
                    if isinstance(leaf.dataType, T.ArrayType) and isinstance(leaf.dataType.elementType, T.StructType):
                        for inner in leaf.dataType.elementType.fields:
                            put(inner.name, F.get(leaf_col, F.lit(0)).getField(inner.name))
                    else:
                        put(f"{key}_{sub.name}_{leaf.name}", first(leaf_col, leaf.dataType))
    return df.select(*[(F.coalesce(*cols) if len(cols) > 1 else cols[0]).alias(n) for n, cols in out.items()])


def last_where(items: Column, name_field: str, name: Column, value_field: str) -> Column:
    """Value of the last item with that name, read from the end; null when there is none."""
    at = F.array_position(F.reverse(items[name_field]), name).cast("int")
    return F.get(F.reverse(items[value_field]), at - 1)


def stat_map(df: DataFrame, stats: str, out: str) -> DataFrame:
    """Adds a map from an array of (name, value); null names dropped, the last value of a name wins.

    The reversed lists are columns of their own, so the inner function reads
    them instead of building them again for each name.
    """
    named = df.withColumn("__named", F.filter(ref(stats), lambda s: s["name"].isNotNull()))
    lists = named.withColumns({"__names": F.reverse("__named.name"), "__values": F.reverse("__named.value")})
    keyed = lists.withColumn("__keys", F.array_distinct("__names"))

    def last(key: Column) -> Column:
        return F.get("__values", F.array_position("__names", key).cast("int") - 1)

    made = keyed.withColumn(out, F.map_from_arrays("__keys", F.transform("__keys", last)))
    return made.drop("__named", "__names", "__values", "__keys")


def stat_value(stats: Column, name: str) -> Column:
    """One entry of an (name, value) array without building the map; null when absent."""
    return last_where(stats, "name", F.lit(name), "value")


# ------------------------------------------------------------------ actions
def action_columns(df: DataFrame, actions: str, types: Sequence[str], prefix: str = "action_") -> DataFrame:
    """One column per declared action type; last value wins, a missing value is 0, a missing type null.

    Types are declared, so no pivot and no shuffle: each row reads its own array.
    """

    def value(kind: str) -> Column:
        found = F.array_contains(ref(actions)["action_type"], kind)
        last = last_where(ref(actions), "action_type", F.lit(kind), "value")
        return F.when(found, F.coalesce(last.try_cast("double"), F.lit(0.0)))

    return df.withColumns({f"{prefix}{t}": value(t) for t in types})


def action_remainder(df: DataFrame, actions: str, types: Sequence[str], out: str = "other_actions") -> DataFrame:
    """The action types that have no column, as a map; last value wins, a missing value is 0, no actions give an empty map.

    With ``action_columns`` no type is lost, and still each row reads its own array only.
    """
    rest = F.filter(ref(actions), lambda a: a["action_type"].isNotNull() & ~a["action_type"].isin(list(types)))
    listed = df.withColumn("__rest", F.coalesce(rest, F.slice(ref(actions), 1, 0)))
    keyed = listed.withColumn("__kinds", F.coalesce(F.array_distinct("__rest.action_type"), F.array().cast("array<string>")))

    def last(kind: Column) -> Column:
        return F.coalesce(last_where(F.col("__rest"), "action_type", kind, "value").try_cast("double"), F.lit(0.0))

    return keyed.withColumn(out, F.map_from_arrays("__kinds", F.transform("__kinds", last))).drop("__rest", "__kinds")


def actions_long(df: DataFrame, id_col: str, actions: str) -> DataFrame:
    """One row per action; rows without actions keep one empty row; no such column gives no rows."""
    if actions not in df.columns:
        schema = f"{id_col} string, action_type string, action_target_id string, value string"
        return df.sparkSession.createDataFrame([], schema)
    item = df.schema[actions].dataType.elementType
    names = [f.name for f in item.fields]
    exploded = df.select(ref(id_col), F.explode_outer(ref(actions)).alias("__a"))
    cols = [
        (F.col("__a").getField(n) if n in names else F.lit(None).cast("string")).alias(n)
        for n in ("action_type", "action_target_id", "value")
    ]
    return exploded.select(ref(id_col), *cols)


# ---------------------------------------------------------------- targeting
def targeting_audiences(df: DataFrame, targeting: str = "targeting", adset: str = "id", campaign: str = "campaign_id") -> DataFrame:
    """One row per custom audience of an ad set; ad sets and audiences without ids give none."""
    rows = df.select(
        ref(campaign).alias("campaign_id"), ref(adset).alias("adset_id"), F.explode(ref(targeting)["custom_audiences"]).alias("__a")
    )
    out = rows.select("campaign_id", "adset_id", F.col("__a.id").alias("audience_id"), F.col("__a.name").alias("audience_name"))
    return out.filter(F.col("adset_id").isNotNull() & F.col("audience_id").isNotNull())


def targeting_segments(df: DataFrame, criteria: str, id_col: str = "id", keep_empty: bool = False, facets: Sequence[str] = AUDIENCE_FACETS) -> DataFrame:
    """Distinct segment ids in order, one row per (campaign, segment).

    ``criteria`` is ``include.and[].or`` with a map of facet to URNs. Campaigns
    without segments give no row unless kept (trap T26).
    """
    clauses = ref(criteria)["include"]["and"]
    empty = F.array().cast("array<string>")

    def urns(clause: Column) -> Column:
        found = [F.coalesce(F.try_element_at(clause["or"], F.lit(f)), empty) for f in facets]
        return F.concat(*found)

    all_urns = F.flatten(F.transform(clauses, lambda c: F.coalesce(urns(c), empty)))
    marked = F.filter(all_urns, lambda u: u.contains(SEGMENT_URN))
    ids = F.array_distinct(F.transform(marked, lambda u: F.get(F.split(u, SEGMENT_URN), F.lit(1))))
    gen = F.explode_outer(ids) if keep_empty else F.explode(ids)
    return df.select(ref(id_col).alias("id"), gen.alias("audience_id"))


def pixel_rule(df: DataFrame, rule: str = "rule") -> DataFrame:
    """Event and trigger of a conversion rule; bad JSON gives nulls."""
    c = ref(rule)
    return df.withColumns(
        {
            "pixel_rule": F.get_json_object(c, "$.and[0].event.eq"),
            "pixel_trigger": F.get_json_object(c, "$.and[1].or"),
        }
    )


# ------------------------------------------------------------------- content
def creative_type(df: DataFrame, out: str = "type") -> DataFrame:
    """The first content kind present, in fixed order."""
    col = F.lit(None).cast("string")
    for name, kind in reversed(list(CREATIVE_TYPES.items())):
        if name in df.columns:
            col = F.when(ref(name).isNotNull(), F.lit(kind)).otherwise(col)
    return df.withColumn(out, col)


def post_content_type(content: Column) -> Column:
    """Kind of a post from the content keys; media by its id."""
    media = F.lower(F.coalesce(content["media"]["id"], F.lit("")))
    kind = (
        F.when(media.contains("video"), "VIDEO")
        .when(media.contains("image"), "IMAGE")
        .when(media.contains("document"), "DOCUMENT")
        .otherwise("MEDIA")
    )
    return (
        F.when(content["multiImage"].isNotNull(), "MULTI_IMAGE")
        .when(content["media"].isNotNull(), kind)
        .when(content["article"].isNotNull(), "ARTICLE")
        .when(content["poll"].isNotNull(), "POLL")
        .otherwise("NO_CONTENT")
    )


def _blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def posts_table(df: DataFrame) -> DataFrame:
    """Post records to flat rows; schema as ``schemas.POST``."""
    content, reshare = F.col("content"), F.col("reshareContext")
    organization = F.coalesce(F.nullif(F.col("_organization_id"), F.lit("")), text.urn_tail(F.col("author")))
    original = F.coalesce(F.nullif(reshare["root"], F.lit("")), reshare["parent"])
    media_url = F.when(content["article"].isNotNull(), _blank(content["article"]["source"])).otherwise(_blank(content["media"]["id"]))
    media_title = F.when(content["article"].isNotNull(), _blank(content["article"]["title"])).otherwise(_blank(content["media"]["title"]))
    return df.select(
        text.urn_tail(F.col("id")).alias("post_id"),
        organization.alias("organization_id"),
        text.clean_post_text(F.col("commentary")).alias("commentary"),
        _blank(F.col("visibility")).alias("visibility"),
        _blank(F.col("lifecycleState")).alias("lifecycle_state"),
        post_content_type(content).alias("content_type"),
        media_url.alias("media_url"),
        text.clean_post_text(media_title).alias("media_title"),
        text.post_url(F.col("id")).alias("post_url"),
        reshare.isNotNull().alias("is_reshare"),
        F.nullif(text.urn_tail(original), F.lit("")).alias("original_post_id"),
        millis_to_ts(F.col("createdAt")).alias("created_at"),
        millis_to_ts(F.col("publishedAt")).alias("published_at"),
        millis_to_ts(F.col("lastModifiedAt")).alias("last_modified_at"),
    )


def page_statistics(df: DataFrame, run_date: date) -> DataFrame:
    """Page view counts of nested statistics, 0 where absent."""
    views = F.col("totalPageStatistics")["views"]
    counts = [F.coalesce(views[src]["pageViews"], F.lit(0)).alias(dst) for src, dst in PAGE_VIEWS.items()]
    zeros = [F.lit(0).cast("bigint").alias(n) for n in ("desktop_custom_button_clicks", "mobile_custom_button_clicks")]
    day = range_day(F.col("timeRange")["start"], run_date).alias("date")
    return df.select(F.col("_organization_id").alias("organization_id"), day, *counts, *zeros)


def follower_gains(df: DataFrame) -> DataFrame:
    """A17 on follower records."""
    gains = F.col("followerGains")
    organic = F.coalesce(gains["organicFollowerGain"], F.lit(0))
    paid = F.coalesce(gains["paidFollowerGain"], F.lit(0))
    return df.select(
        F.col("_organization_id").alias("organization_id"),
        millis_to_ts(F.col("timeRange")["start"]).cast("date").alias("date"),
        F.lit(None).cast("bigint").alias("total_followers"),
        organic.alias("organic_follower_gain"),
        paid.alias("paid_follower_gain"),
        (organic + paid).alias("net_follower_change"),
    )


def follower_demographics(df: DataFrame) -> DataFrame:
    """Five arrays to long rows, in one pass and without a union of scans."""
    empty = F.array().cast("array<struct<kind:string,urn:string,organic:bigint,paid:bigint>>")

    def entries(array: str, kind: str, value: str) -> Column:
        def row(e: Column) -> Column:
            counts = e["followerCounts"]
            return F.struct(
                F.lit(kind).alias("kind"),
                _blank(e[value]).alias("urn"),
                F.coalesce(counts["organicFollowerCount"].cast("bigint"), F.lit(0).cast("bigint")).alias("organic"),
                F.coalesce(counts["paidFollowerCount"].cast("bigint"), F.lit(0).cast("bigint")).alias("paid"),
            )

        return F.coalesce(F.transform(ref(array), row), empty)

    parts = [entries(*d) for d in DEMOGRAPHICS if d[0] in df.columns]
    rows = df.select(F.col("_organization_id").alias("organization_id"), F.explode(F.concat(*parts)).alias("e"))
    return rows.select(
        "organization_id",
        F.col("e.kind").alias("demographic_type"),
        text.urn_tail(F.col("e.urn")).alias("demographic_value"),
        F.col("e.urn").alias("demographic_urn"),
        F.col("e.organic").alias("organic_follower_count"),
        F.col("e.paid").alias("paid_follower_count"),
    )


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns to JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[(F.to_json(ref(f.name)) if isinstance(f.dataType, nested) else ref(f.name)).alias(f.name) for f in df.schema.fields])


def sms_message(df: DataFrame, *more: Column) -> DataFrame:
    """Nested SMS text, the name else the subject, and further columns of the record."""
    return df.select(
        "message_id",
        F.col("message")["smsText"].alias("sms_text"),
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("subject")).alias("campaign_name"),
        *more,
    )


def preview_table(df: DataFrame) -> DataFrame:
    """Nested preview body and external id to flat columns; an empty body counts as missing."""
    body = F.nullif(F.col("type")["emailBodyHtml"], F.lit(""))
    return df.select("message_id", "contact_id", body.alias("html"), F.col("externalId").alias("external_id"))
