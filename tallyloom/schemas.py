"""Explicit schemas of the landing records (S17-S20), summaries and load targets.

Landing records are JSON lines as the platforms deliver them; names are theirs.
"""

from __future__ import annotations

from pyspark.sql import types as T

_SIMPLE = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "rate": T.DecimalType(18, 2),
}


def struct(**fields) -> T.StructType:
    """``struct(id="string", inner=struct(...), items=array("string"))``."""
    return T.StructType([T.StructField(n, _SIMPLE[t] if isinstance(t, str) else t) for n, t in fields.items()])


def array(item) -> T.ArrayType:
    return T.ArrayType(_SIMPLE[item] if isinstance(item, str) else item)


def mapping(value) -> T.MapType:
    return T.MapType(T.StringType(), _SIMPLE[value] if isinstance(value, str) else value)


def columns(*names: str, **types: str) -> T.StructType:
    """Named columns, text unless typed."""
    return struct(**{n: types.get(n, "string") for n in names})


_customer = struct(id="string", resourceName="string")
_ad_group = struct(id="string", resourceName="string")
_ad = struct(ad=struct(id="string", name="string", type="string", resourceName="string"), resourceName="string")
_metrics = struct(
    clicks="string", impressions="string", conversions="double", costMicros="string", ctr="double",
    averageCpc="double", averageCpm="double", averageCost="double", activeViewCtr="double",
)

_views = struct(
    **{
        n: struct(pageViews="long")
        # Names in the API's answers.
        for n in (
            "allPageViews", "uniquePageViews", "allDesktopPageViews", "allMobilePageViews",
            "overviewPageViews", "careersPageViews", "jobsPageViews", "lifeAtPageViews",
        )
    }
)
_range = struct(start="long", end="long")
_counts = struct(organicFollowerCount="long", paidFollowerCount="long")
_day = struct(year="int", month="int", day="int")
_money = struct(currencyCode="string", amount="string")


def _followers(key: str) -> T.ArrayType:
    return array(struct(**{key: "string", "followerCounts": _counts}))


POST = struct(
    id="string", author="string", _organization_id="string", commentary="string", visibility="string", lifecycleState="string",
    content=struct(
        article=struct(source="string", title="string"), media=struct(id="string", title="string"),
        multiImage=struct(altText="string"), poll=struct(question="string"),
    ),
    reshareContext=struct(root="string", parent="string"), createdAt="long", publishedAt="long", lastModifiedAt="long",
)

LANDING: dict[str, T.StructType] = {
    # Google
    "google_account": columns("id", "descriptiveName", "manager", "status", "currencyCode", "timeZone", "level", "clientCustomer", "managerId", manager="bool"
    ),
    "google_campaign": struct(
        customer=_customer,
        campaign=struct(
            id="string", name="string", status="string", servingStatus="string", startDateTime="string", endDateTime="string",
            resourceName="string",
        ),
    ),
    "google_report": struct(
        customer=_customer, campaign=struct(id="string"), adGroup=_ad_group, adGroupAd=_ad, segments=struct(date="string"), metrics=_metrics
    ),
    "google_ad_creatives": struct(customer=_customer, adGroup=_ad_group, adGroupAd=_ad),
    "google_placement": struct(
        customer=_customer, adGroup=_ad_group, metrics=_metrics,
        groupPlacementView=struct(placement="string", placementType="string", displayName="string", targetUrl="string", resourceName="string"),
    ),
    "google_audience": struct(customer=_customer, adGroup=_ad_group, adGroupCriterion=struct(displayName="string", criterionId="string")),
    "google_cost_by_device": struct(customer=_customer, adGroupAd=_ad, segments=struct(device="string"), metrics=_metrics),
    "google_violation": struct(
        customer=_customer, campaign=struct(id="string", status="string"),
        adGroupAd=struct(ad=struct(id="string"), policySummary=struct(approvalStatus="string", reviewStatus="string")),
    ),
    # Facebook: metrics arrive as text
    "fb_campaign": columns("id", "status", "configured_status", "effective_status", "created_time", "objective"),
    "fb_ad_set": columns("id", "campaign_id", "start_time", "end_time", "destination_type"),
    "fb_audience_adset": struct(
        id="string", campaign_id="string", targeting=struct(custom_audiences=array(struct(id="string", name="string")))
    ),
    "fb_custom_conversion": columns("id", "custom_event_type", "rule"),
    "fb_insight": columns("account_id", "campaign_id", "adset_id", "ad_id", "ad_name", "spend", "impressions", "reach", "inline_link_clicks", "inline_link_click_ctr", "clicks", "ctr", "cpc", "cpm", "date_start", "date_stop"),
    "fb_insight_actions": struct(
        ad_id="string", actions=array(struct(action_type="string", action_target_id="string", value="string"))
    ),
    "fb_insight_placement": columns("campaign_id", "publisher_platform", "impressions", "spend", "clicks", "ctr", "cpc", "cpm", "date_start", "date_stop"),
    "fb_insight_demographics": columns("campaign_id", "age", "gender", "impressions", "spend", "clicks", "ctr", "cpc", "cpm", "date_start", "date_stop"),
    # LinkedIn ads
    "linkedin_account": columns("id", "name", "currency", "status", "type"),
    "linkedin_campaign": struct(
        id="string", name="string", account="string", status="string", totalBudget=_money, dailyBudget=_money, unitCost=_money,
        runSchedule=struct(start="long", end="long"),
    ),
    "linkedin_campaign_audience": struct(
        id="string", targetingCriteria=struct(include=struct(**{"and": array(struct(**{"or": mapping(array("string"))}))}))
    ),
    "linkedin_creative": struct(
        id="string", campaign="string", account="string", status="string", intendedStatus="string", servingHoldReasons=array("string"),
        content=struct(
            follow="string", reference="string", spotlight="string", jobs="string", documentAd="string", thirdPartyVastTagVideoAd="string"
        ),
    ),
    "linkedin_audience": columns("id", "name", "account", "status", "type"),
    "linkedin_insights": struct(
        dateRange=struct(start=_day, end=_day), pivotValues=array("string"), clicks="long", impressions="long", likes="long",
        comments="long", shares="long", reactions="long", actionClicks="long", adUnitClicks="long", landingPageClicks="long",
        totalEngagements="long", externalWebsiteConversions="long", costInLocalCurrency="string", conversionValueInLocalCurrency="string",
    ),
    "linkedin_demographics": struct(
        campaign_id="string", campaign_name="string", pivotValues=array("string"), impressions="long", clicks="long",
        costInLocalCurrency="string", landingPageClicks="long", externalWebsiteConversions="long",
    ),
    # LinkedIn organic
    "organic_posts": POST,
    "organic_share_statistics": struct(
        share="string", ugcPost="string",
        totalShareStatistics=struct(
            impressionCount="long", uniqueImpressionsCount="long", clickCount="long", likeCount="long", commentCount="long",
            shareCount="long", engagement="double",
        ),
    ),
    "organic_page_stats": struct(_organization_id="string", totalPageStatistics=struct(views=_views), timeRange=_range),
    "organic_followers": struct(
        _organization_id="string", timeRange=_range, followerGains=struct(organicFollowerGain="long", paidFollowerGain="long")
    ),
    "organic_follower_demographics": struct(
        _organization_id="string",
        followerCountsByFunction=_followers("function"), followerCountsByIndustry=_followers("industry"),
        followerCountsBySeniority=_followers("seniority"), followerCountsByGeoCountry=_followers("geo"),
        followerCountsByStaffCountRange=_followers("staffCountRange"),
    ),
    # SMS and newsletter
    "render_log": columns("MESSAGE_ID", "MESSAGE_EXTERNALID", "USER_ID", "RENDER_TIMESTAMP", "SENTTOMTA_SENDOUTCHANNEL", MESSAGE_ID="long", USER_ID="long", RENDER_TIMESTAMP="ts",
    ),
    "sms_statistics": struct(
        message_id="long", sendoutStartDate="long", statisticValues=array(struct(name="string", value="string"))
    ),
    "sms_message": struct(message_id="long", name="string", subject="string", message=struct(smsText="string")),
    "newsletter_preview": struct(message_id="long", contact_id="long", type=struct(emailBodyHtml="string"), externalId="string"),
}

_table_stats = struct(
    name="string", success="bool", rows_from_api="long", rows_written="long", rows_inserted="long", rows_updated="long",
    rows_skipped="long", rows_filtered="long", error="string",
)

SUMMARY = struct(
    execution_id="string", platform="string", status="string", start_time="string", end_time="string", duration_seconds="double",
    tables=array(_table_stats), tables_count="int", tables_succeeded="int", tables_failed="int", total_rows_from_api="long",
    total_rows_written="long", total_rows_inserted="long", total_rows_updated="long", total_rows_skipped="long",
    total_rows_filtered="long", exit_code="int", errors=array(mapping("string")), metadata=mapping("string"),
)
TABLE_STATS = _table_stats

SMS_CAMPAIGN = columns("message_id", "activity_id", "campaign_name", "company_id", "sms_text", "sendout_date", "sent_count", "delivered_count", "bounced_count", "acceptance_rate", "load_date", message_id="long", company_id="int", sendout_date="ts", sent_count="long", delivered_count="long", bounced_count="long",
    acceptance_rate="rate", load_date="date",
)
SMS_LINK = columns("message_id", "activity_id", "bitly_short_url", "bitly_long_url", "total_clicks", "load_date", message_id="long", total_clicks="long", load_date="date",
)
