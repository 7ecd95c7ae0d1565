"""Nested records: arrays, maps, JSON and content shapes, built per row so that no group is collected."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.numbers import acceptance_rate, safe_int
from tallyloom.operators import nested
from tallyloom.plans.steps import Context, Step, run_steps
from tallyloom.plans.tables import FACEBOOK_TABLES, LINKEDIN_TABLES
from tallyloom.queries.registry import RUN_TS, day_text, query, r4, tab


def _pair(name, value):
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_linenumber * 10 AS BIGINT) AS sent, CAST(l_linenumber * 10 - l_linenumber AS BIGINT) AS delivered,
       CASE WHEN l_returnflag = 'A' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS bounced,
       CAST(CASE WHEN l_returnflag = 'N' THEN 12.34 ELSE 90.00 END AS DOUBLE) AS acceptance, 3 AS names
FROM lineitem
""")
def stat_array_map(spark, sf_dir):
    """(name, value) arrays to a map; the last value of a name wins, null names drop."""
    flag = F.col("l_returnflag")
    stats = F.array(
        _pair("majorSent", F.lit("1")),
        _pair("accepted", F.col("l_linenumber") * 9),
        _pair("bounces", F.when(flag != "A", F.col("l_quantity"))),
        _pair("majorSent", F.col("l_linenumber") * 10),
        _pair(None, F.lit("lost")),
    )
    rate = F.when(flag == "N", "12.345").when(flag == "A", "NaN")
    li = tab(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", stats.alias("stats"), rate.alias("rate"))
    li = nested.stat_map(li, "stats", "m")
    sent, delivered = safe_int(F.col("m")["majorSent"]), safe_int(F.col("m")["accepted"])
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sent.alias("sent"), delivered.alias("delivered"),
        safe_int(F.col("m")["bounces"]).alias("bounced"),
        acceptance_rate(F.col("rate"), delivered, sent).cast("double").alias("acceptance"), F.size("m").alias("names"),
    )


def _with_actions(spark, sf_dir):
    e = tab(spark, sf_dir, "events")

    def action(kind, value):
        return F.struct(kind.alias("action_type"), value.cast("string").alias("value"))

    custom = F.concat(F.lit("offsite_conversion.custom."), (F.col("user_id") + 1000).cast("string"))
    value = F.col("value").cast("decimal(18,2)")
    acts = F.array(
        action(F.col("event_type"), F.lit(1)), action(F.col("event_type"), value), action(custom, F.when(F.col("user_id") > 50, F.lit(2)))
    )
    return e.select("event_id", "user_id", F.when(F.col("event_type") != "error", acts).alias("actions"))


@query("""
SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS action_click, CASE WHEN event_type = 'purchase' THEN value END AS action_purchase,
       CASE WHEN event_type <> 'error' AND user_id = 7 THEN 0.0::DOUBLE END AS "action_offsite_conversion.custom.1007"
FROM events
""")
def actions_wide(spark, sf_dir):
    """Declared action types as columns; last value, missing value 0."""
    out = nested.action_columns(_with_actions(spark, sf_dir), "actions", ["click", "purchase", "offsite_conversion.custom.1007"])
    return out.drop("user_id", "actions")


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 + CAST(event_type <> 'click' AS INT) END AS kinds,
       CASE WHEN event_type = 'error' THEN 0.0 ELSE CASE WHEN event_type <> 'click' THEN value ELSE 0 END + CASE WHEN user_id > 50 THEN 2 ELSE 0 END END AS total
FROM events
""")
def actions_remainder(spark, sf_dir):
    """The types without a column of their own stay, in a map."""
    out = nested.action_remainder(_with_actions(spark, sf_dir), "actions", ["click"])
    total = F.aggregate(F.map_values("other_actions"), F.lit(0.0), lambda sum_, v: sum_ + v)
    return out.select("event_id", F.size("other_actions").alias("kinds"), total.alias("total"))


@query("""
SELECT event_id AS ad_id, CAST(NULL AS VARCHAR) AS action_type, CAST(NULL AS VARCHAR) AS action_target_id, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS conversion_id
FROM events WHERE event_type = 'error' UNION ALL
SELECT event_id, event_type, NULL, 1, NULL FROM events WHERE event_type <> 'error' UNION ALL
SELECT event_id, event_type, NULL, value, NULL FROM events WHERE event_type <> 'error' UNION ALL
SELECT event_id, 'offsite_conversion.custom.' || (user_id + 1000), NULL, CASE WHEN user_id > 50 THEN 2 END, CAST(user_id + 1000 AS VARCHAR)
FROM events WHERE event_type <> 'error'
""")
def actions_long(spark, sf_dir):
    """N2, C8."""
    rows = nested.actions_long(_with_actions(spark, sf_dir).withColumnRenamed("event_id", "ad_id"), "ad_id", "actions")
    return rows.withColumns({"value": F.col("value").cast("double"), "conversion_id": text.custom_conversion_id(F.col("action_type"))})


@query("""
SELECT CAST(user_id AS VARCHAR) AS ad_id, event_type AS action_type, CAST(sum(CAST(value AS DECIMAL(18,2)) + 1) AS DOUBLE) AS value
FROM events WHERE event_type <> 'error' GROUP BY 1, 2 UNION ALL
SELECT CAST(user_id AS VARCHAR), 'offsite_conversion.custom.' || (user_id + 1000), CAST(sum(CASE WHEN user_id > 50 THEN 2 ELSE 0 END) AS DOUBLE)
FROM events WHERE event_type <> 'error' GROUP BY 1, 2
""")
def fb_insight_actions_rows(spark, sf_dir):
    """The configured steps of the actions table, from arrays to one row per ad and type."""
    raw = _with_actions(spark, sf_dir).select(F.col("user_id").cast("string").alias("ad_id"), "actions")
    out = FACEBOOK_TABLES["fb_ads_insight_actions"].transform(raw, Context(RUN_TS))
    return out.drop("row_loaded_date").withColumn("value", F.floor(F.col("value") * 100 + 0.5) / 100)


@query("""
SELECT CAST(user_id AS VARCHAR) AS campaign_id, event_type AS publisher_platform, CAST(count(*) * 100 AS DOUBLE) AS impressions, CAST(sum(event_id) AS DOUBLE) AS spend,
       CAST(count(*) AS DOUBLE) AS clicks, 1.0::DOUBLE AS ctr, floor(CAST(sum(event_id) AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 AS cpc,
       floor(CAST(sum(event_id) AS DOUBLE) / (count(*) * 100) * 1000 * 10000 + 0.5) / 10000 AS cpm
FROM events GROUP BY 1, 2
""")
def fb_insight_placement_rows(spark, sf_dir):
    """Text metrics are summed as numbers, ratios recomputed from the sums."""
    raw = tab(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("campaign_id"),
        F.col("event_type").alias("publisher_platform"),
        F.lit("100").alias("impressions"),
        F.col("event_id").cast("string").alias("spend"),
        F.lit("1").alias("clicks"),
        F.lit("0.01").alias("ctr"),
        F.lit("9").alias("cpc"),
        F.lit("9").alias("cpm"),
        day_text(F.col("ts")).alias("date_start"),
    )
    out = FACEBOOK_TABLES["fb_ads_insight_placement"].transform(raw, Context(RUN_TS)).drop("row_loaded_date")
    return out.withColumns({c: r4(F.col(c)) for c in ("ctr", "cpc", "cpm")})


@query("""
WITH u AS (SELECT o_orderkey AS id, unnest(CASE WHEN o_orderstatus = 'F' THEN [o_orderpriority, o_orderstatus] WHEN o_orderstatus = 'O' THEN [o_orderpriority] ELSE [] END)
           AS audience_id FROM orders)
SELECT id, audience_id FROM u
""")
def targeting_segments(spark, sf_dir):
    """Nested targeting to distinct (campaign, segment) pairs; campaigns without segments give none."""
    first, second = nested.AUDIENCE_FACETS

    def seg(col):
        return F.concat(F.lit("urn:li:adSegment:"), col)

    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")

    def clause(*pairs):
        return F.struct(F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[F.array(*v) for _, v in pairs])).alias("or"))

    rich = F.array(
        clause((first, [seg(pri), F.lit("urn:li:other:1")])), clause((second, [seg(st), seg(pri)]), ("urn:li:adTargetingFacet:titles", [seg(F.lit("no"))]))
    )
    poor = F.array(clause((second, [seg(pri)])))
    ands = F.when(st == "F", rich).when(st == "O", poor)
    o = tab(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.struct(F.struct(ands.alias("and")).alias("include")).alias("targetingCriteria")
    )
    return nested.targeting_segments(o, "targetingCriteria")


@query("""
SELECT o_custkey AS campaign_id, o_orderkey AS adset_id, 'a' || o_orderpriority AS audience_id, o_orderpriority AS audience_name FROM orders
WHERE o_orderstatus <> 'P' UNION ALL
SELECT o_custkey, o_orderkey, 'b', 'all' FROM orders WHERE o_orderstatus = 'F'
""")
def targeting_audiences(spark, sf_dir):
    """N3, J15."""

    def audience(key, name):
        return F.struct(key.alias("id"), name.alias("name"))

    pri = F.col("o_orderpriority")
    one = audience(F.concat(F.lit("a"), pri), pri)
    lists = (
        F.when(F.col("o_orderstatus") == "F", F.array(one, audience(F.lit("b"), F.lit("all"))))
        .when(F.col("o_orderstatus") == "O", F.array(one, audience(F.lit(None).cast("string"), F.lit("gone"))))
    )
    o = tab(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("campaign_id"), F.struct(lists.alias("custom_audiences")).alias("targeting")
    )
    return nested.targeting_audiences(o)


@query("""
SELECT o_orderkey AS conversion_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS pixel_rule,
       CASE WHEN o_orderstatus = 'F' THEN '["' || o_orderstatus || '"]' END AS pixel_trigger
FROM orders
""")
def pixel_rules(spark, sf_dir):
    """JSON rules; bad JSON gives nulls."""
    event = F.concat(F.lit('{"and":[{"event":{"eq":"'), F.col("o_orderpriority"), F.lit('"}}'))
    full = F.concat(event, F.lit(',{"or":["'), F.col("o_orderstatus"), F.lit('"]}]}'))
    rule = F.when(F.col("o_orderstatus") == "F", full).when(F.col("o_orderstatus") == "O", F.concat(event, F.lit("]}"))).otherwise("{broken")
    o = tab(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("conversion_id"), rule.alias("rule"))
    return nested.pixel_rule(o).drop("rule")


@query("""
SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'FOLLOW_COMPANY_V2' WHEN 'view' THEN 'SPONSORED_STATUS_UPDATE' WHEN 'signup' THEN 'JOBS_AD'
       WHEN 'purchase' THEN 'THIRD_PARTY_VIDEO_AD' END AS type, 'c' || user_id AS status
FROM events
""")
def creative_types(spark, sf_dir):
    """N6 through the configured creative steps."""
    kind, marked = F.col("event_type"), F.lit("x")
    content = F.struct(
        F.when(kind == "click", marked).alias("follow"),
        F.when(kind.isin("view", "click"), marked).alias("reference"),
        F.lit(None).cast("string").alias("spotlight"),
        F.when(kind == "signup", marked).alias("jobs"),
        F.lit(None).cast("string").alias("documentAd"),
        F.when(kind == "purchase", marked).alias("thirdPartyVastTagVideoAd"),
    )

    def urn(what, col):
        return F.concat(F.lit(f"urn:li:{what}:"), col.cast("string"))

    raw = tab(spark, sf_dir, "events").select(
        urn("sponsoredCreative", F.col("event_id")).alias("id"),
        urn("sponsoredCampaign", F.col("user_id")).alias("campaign"),
        urn("sponsoredAccount", F.lit(5)).alias("account"),
        F.lit("old").alias("status"),
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("intendedStatus"),
        F.array(F.lit("hold")).alias("servingHoldReasons"),
        content.alias("content"),
    )
    out = LINKEDIN_TABLES["linkedin_ads_creative"].transform(raw, Context(RUN_TS))
    return out.select(F.col("id").cast("bigint").alias("id"), "type", "status")


@query("""
SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS date, CAST(user_id AS VARCHAR) AS creative_id, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS cost
FROM events
""")
def linkedin_insight_rows(spark, sf_dir):
    """Dates from parts, creative from the first pivot URN, missing cost 0."""
    e = tab(spark, sf_dir, "events")
    day = F.struct(F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))
    urn = F.concat(F.lit("urn:li:sponsoredCreative:"), F.col("user_id").cast("string"))
    raw = e.select(
        F.col("event_id").alias("id"),
        F.struct(day.alias("start"), day.alias("end")).alias("dateRange"),
        F.array(urn).alias("pivotValues"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("costInLocalCurrency"),
    )
    out = LINKEDIN_TABLES["linkedin_ads_insights"].transform(raw, Context(RUN_TS))
    return out.select("id", day_text(F.col("date")).alias("date"), "creative_id", F.col("costInLocalCurrency").alias("cost"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS post_id, source AS organization_id, md5(replace(replace(replace(replace(text, chr(13) || chr(10), ' '), chr(10), ' '), chr(13), ' '), '|', '-')) AS commentary,
       CASE lang WHEN 'en' THEN 'ARTICLE' WHEN 'de' THEN 'VIDEO' WHEN 'fr' THEN 'POLL' ELSE 'NO_CONTENT' END AS content_type,
       CASE lang WHEN 'en' THEN 'https://a/' || doc_id WHEN 'de' THEN 'urn:li:video:' || doc_id ELSE '' END AS media_url,
       CASE lang WHEN 'en' THEN 'T-x' ELSE '' END AS media_title, 'https://www.linkedin.com/feed/update/urn:li:share:' || doc_id AS post_url,
       (lang = 'es') AS is_reshare, CASE WHEN lang = 'es' THEN CAST(doc_id + 1 AS VARCHAR) END AS original_post_id,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 SECOND * doc_id AS created_at
FROM documents
""")
def posts_rows(spark, sf_dir):
    """Post records over whole texts."""
    doc, lang = F.col("doc_id").cast("string"), F.col("lang")
    null = F.lit(None).cast("string")
    content = F.struct(
        F.when(lang == "en", F.struct(F.concat(F.lit("https://a/"), doc).alias("source"), F.lit("T|x").alias("title"))).alias("article"),
        F.when(lang == "de", F.struct(F.concat(F.lit("urn:li:video:"), doc).alias("id"), null.alias("title"))).alias("media"),
        F.when(lang == "xx", F.struct(null.alias("altText"))).alias("multiImage"),
        F.when(lang == "fr", F.struct(F.lit("q").alias("question"))).alias("poll"),
    )
    root = F.concat(F.lit("urn:li:share:"), (F.col("doc_id") + 1).cast("string"))
    millis = (F.lit(1704067200) + F.col("doc_id")) * 1000
    d = tab(spark, sf_dir, "documents").select(
        F.concat(F.lit("urn:li:share:"), doc).alias("id"),
        F.concat(F.lit("urn:li:organization:"), "source").alias("author"),
        null.alias("_organization_id"),
        F.col("text").alias("commentary"),
        null.alias("visibility"),
        F.lit("PUBLISHED").alias("lifecycleState"),
        content.alias("content"),
        F.when(lang == "es", F.struct(F.lit("").alias("root"), root.alias("parent"))).alias("reshareContext"),
        millis.alias("createdAt"),
        millis.alias("publishedAt"),
        F.lit(None).cast("bigint").alias("lastModifiedAt"),
    )
    out = nested.posts_table(d).drop("visibility", "lifecycle_state", "published_at", "last_modified_at")
    return out.withColumn("commentary", F.md5("commentary"))


@query("""
SELECT c_custkey AS organization_id, CASE WHEN c_nationkey < 5 THEN '2024-02-01' ELSE '2024-01-02' END AS date, c_custkey AS all_page_views,
       CASE WHEN c_nationkey < 10 THEN 0 ELSE c_nationkey END AS unique_page_views, 0 AS jobs_page_views
FROM customer
""")
def page_statistics(spark, sf_dir):
    """N8, D9."""
    c = tab(spark, sf_dir, "customer")
    zero = F.struct(F.lit(None).cast("bigint").alias("pageViews"))

    def views(name):
        if name == "allPageViews":
            return F.struct(F.col("c_custkey").alias("pageViews"))
        if name == "uniquePageViews":
            return F.when(F.col("c_nationkey") >= 10, F.struct(F.col("c_nationkey").cast("bigint").alias("pageViews")))
        return zero

    stats = F.struct(F.struct(*[views(n).alias(n) for n in nested.PAGE_VIEWS]).alias("views"))
    start = F.when(F.col("c_nationkey") >= 5, F.lit(1704153600000))
    raw = c.select(
        F.col("c_custkey").alias("_organization_id"), stats.alias("totalPageStatistics"), F.struct(start.alias("start")).alias("timeRange")
    )
    out = nested.page_statistics(raw, date(2024, 2, 1))
    return out.select(
        "organization_id", day_text(F.col("date")).alias("date"), "all_page_views", "unique_page_views", "jobs_page_views"
    )


@query("""
SELECT user_id AS organization_id, strftime(ts, '%Y-%m-%d') AS date, event_id AS organic_follower_gain, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS paid_follower_gain,
       event_id + CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS net_follower_change
FROM events
""")
def follower_gains(spark, sf_dir):
    """A17."""
    millis = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") * 1000
    gains = F.struct(
        F.col("event_id").alias("organicFollowerGain"), F.when(F.col("event_type") != "click", F.lit(1)).cast("bigint").alias("paidFollowerGain")
    )
    raw = tab(spark, sf_dir, "events").select(
        F.col("user_id").alias("_organization_id"), F.struct(millis.alias("start")).alias("timeRange"), gains.alias("followerGains")
    )
    return nested.follower_gains(raw).drop("total_followers").withColumn("date", day_text(F.col("date")))


@query("""
SELECT c_custkey AS organization_id, 'FUNCTION' AS demographic_type, CAST(c_nationkey AS VARCHAR) AS demographic_value, 'urn:li:function:' || c_nationkey AS demographic_urn,
       c_custkey AS organic_follower_count, CAST(0 AS BIGINT) AS paid_follower_count FROM customer UNION ALL
SELECT c_custkey, 'INDUSTRY', c_mktsegment, 'urn:li:industry:' || c_mktsegment, c_custkey, 0 FROM customer UNION ALL
SELECT c_custkey, 'GEO_COUNTRY', '', '', c_custkey, 0 FROM customer WHERE c_nationkey < 10
""")
def demographics_long(spark, sf_dir):
    """Arrays to long rows in one pass."""
    counts = F.struct(F.col("c_custkey").alias("organicFollowerCount"), F.lit(None).cast("bigint").alias("paidFollowerCount"))

    def entry(key, col):
        return F.array(F.struct(col.alias(key), counts.alias("followerCounts")))

    nation = F.concat(F.lit("urn:li:function:"), F.col("c_nationkey").cast("string"))
    raw = tab(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_organization_id"),
        entry("function", nation).alias("followerCountsByFunction"),
        entry("industry", F.concat(F.lit("urn:li:industry:"), "c_mktsegment")).alias("followerCountsByIndustry"),
        F.when(F.col("c_nationkey") < 10, entry("geo", F.lit(None).cast("string"))).alias("followerCountsByGeoCountry"),
    )
    return nested.follower_demographics(raw)


@query("""
SELECT c_custkey, '{"n":' || c_nationkey || ',"s":"' || c_mktsegment || '"}' AS owner, '["' || c_mktsegment || '"]' AS tags FROM customer
""")
def nested_to_json(spark, sf_dir):
    """N10."""
    c = tab(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("s")).alias("owner"), F.array("c_mktsegment").alias("tags")
    )
    return nested.nested_to_json(c)


@query("""
SELECT c_custkey AS message_id, 'Hi ' || c_name AS sms_text, CASE WHEN c_nationkey < 12 THEN c_mktsegment ELSE 'subject' END AS campaign_name,
       CASE WHEN c_nationkey < 12 THEN 'EN ' || c_nationkey ELSE 'IT ' || c_nationkey END AS local_name
FROM customer
""")
def message_contents(spark, sf_dir):
    """Nested text, name else subject, localized name else the first."""
    from tallyloom.operators.lookup import localized_name

    nation = F.col("c_nationkey")
    english = F.create_map(
        F.lit("it_IT"), F.concat(F.lit("IT "), nation.cast("string")), F.lit("en_US"), F.concat(F.lit("EN "), nation.cast("string"))
    )
    italian = F.create_map(F.lit("it_IT"), F.concat(F.lit("IT "), nation.cast("string")), F.lit("de_DE"), F.lit("DE"))
    raw = tab(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("message_id"),
        F.struct(F.concat(F.lit("Hi "), "c_name").alias("smsText")).alias("message"),
        F.when(nation < 12, F.col("c_mktsegment")).otherwise("").alias("name"),
        F.lit("subject").alias("subject"),
        F.when(nation < 12, english).otherwise(italian).alias("names"),
    )
    return nested.sms_message(raw, localized_name(F.col("names")).alias("local_name"))


@query("""
SELECT page_id AS message_id, page_id AS contact_id, md5(html) AS html, url AS external_id FROM pages
""")
def previews_flat(spark, sf_dir):
    """N13."""
    raw = tab(spark, sf_dir, "pages").select(
        F.col("page_id").alias("message_id"), F.col("page_id").alias("contact_id"), F.struct(F.col("html").alias("emailBodyHtml")).alias("type"), F.col("url").alias("externalId")
    )
    return nested.preview_table(raw).withColumn("html", F.md5("html"))


@query("""
SELECT o_orderkey AS campaign_id, 'name ' || o_custkey AS campaign_name, CAST(o_custkey AS VARCHAR) AS company_id,
       coalesce(c_name, 'Organization ' || o_custkey) AS company_name, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS cost_in_local_currency
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey
""")
def demographics_company_rows(spark, sf_dir):
    """The configured demographics steps: rename, pivot id, names with placeholders, missing cost 0."""
    o = tab(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("campaign_id"),
        F.concat(F.lit("name "), F.col("o_custkey").cast("string")).alias("campaign_name"),
        F.array(F.concat(F.lit("urn:li:organization:"), F.col("o_custkey").cast("string"))).alias("pivotValues"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("costInLocalCurrency"),
    )
    names = tab(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    ctx = Context(RUN_TS, {"organizations": names})
    return LINKEDIN_TABLES["linkedin_ads_demographics_company"].transform(o, ctx).drop("row_loaded_date")


@query("""
SELECT p_partkey AS id, regexp_replace(p_name, 'e', '', 'g') AS name, CASE WHEN p_size > 10 THEN p_retailprice ELSE 0 END AS price FROM part
WHERE p_brand <> 'Brand#1'
""")
def step_chain(spark, sf_dir):
    """A chain of named steps from a config."""
    raw = tab(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PartKey"),
        F.regexp_replace("p_name", "e", "\U0001f600").alias("Name"),
        F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("price"),
        "p_brand",
    )
    steps = [
        Step("filter_rows", {"condition": "p_brand <> 'Brand#1'"}),
        Step("normalize_column_names"),
        Step("rename_columns", {"mapping": {"part_key": "id"}}),
        Step("remove_emoji", {"columns": ["name"]}),
        Step("replace_nan_with_zero", {"columns": ["price"]}),
        Step("drop_columns", {"cols": ["p_brand"]}),
    ]
    return run_steps(raw, steps, Context(RUN_TS))
