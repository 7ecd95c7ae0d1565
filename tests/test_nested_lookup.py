"""Nested records and lookups on literal tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tallyloom.operators import lookup, nested, skew
from tallyloom.schemas import LANDING, POST
from tallyloom.sources.hierarchy import account_tree, expand_accounts


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def from_json(spark, lines, schema):
    df = spark.createDataFrame([(x,) for x in lines], "j string")
    return df.select(F.from_json("j", schema).alias("r")).select("r.*")


def test_rows_stay_aligned(spark):
    df = from_json(spark, ['{"a":1}', '{"a":2,"b":9}'], "a int, b int")
    assert rows(nested.flatten_nested(df, [])) == [(1, None), (2, 9)]


def test_budget_example(spark):
    df = from_json(spark, ['{"dailyBudget":{"currencyCode":"EUR","amount":10}}'], "dailyBudget struct<currencyCode:string,amount:int>")
    out = nested.flatten_nested(df, ["dailyBudget"])
    assert out.columns == ["dailyBudget_currencyCode", "dailyBudget_amount"] and rows(out) == [("EUR", 10)]


def test_flatten_empty_lists(spark):
    df = from_json(spark, ['{"t":[],"s":{"l":[]},"n":{"m":{"x":[]}}}'], "t array<int>, s struct<l:array<int>>, n struct<m:struct<x:array<struct<y:int>>>>")
    out = nested.flatten_nested(df, ["n"])
    assert out.columns == ["t", "l", "y"] and rows(out) == [(None, None, None)]


def test_stat_map(spark):
    df = from_json(spark, ['{"s":[{"name":"a","value":"1"},{"name":null,"value":"9"},{"name":"a","value":"2"}]}', '{"s":[]}', "{}"], "s array<struct<name:string,value:string>>")
    got = [r.m for r in nested.stat_map(df, "s", "m").collect()]
    assert got == [{"a": "2"}, {}, None]
    assert [r[0] for r in df.select(nested.stat_value(F.col("s"), "a")).collect()] == ["2", None, None]


def test_actions(spark):
    raw = ['{"ad_id":"1","actions":[{"action_type":"a","value":"1"},{"action_type":"a","value":"3"},{"action_type":"b"}]}', '{"ad_id":"2"}', '{"ad_id":"3","actions":[]}']
    df = from_json(spark, raw, LANDING["fb_insight_actions"])
    wide = nested.action_columns(df, "actions", ["a", "b", "c"]).drop("actions")
    assert rows(wide) == [("1", 3.0, 0.0, None), ("2", None, None, None), ("3", None, None, None)]
    long = nested.actions_long(df, "ad_id", "actions")
    assert rows(long) == [("1", "a", None, "1"), ("1", "a", None, "3"), ("1", "b", None, None), ("2", None, None, None), ("3", None, None, None)]
    empty = nested.actions_long(df.drop("actions"), "ad_id", "actions")
    assert empty.columns == ["ad_id", "action_type", "action_target_id", "value"] and empty.count() == 0


def test_targeting(spark):
    a, b = nested.AUDIENCE_FACETS
    raw = [
        '{"id":"1","targetingCriteria":{"include":{"and":[{"or":{"%s":["urn:li:adSegment:7","urn:li:x:1"],"%s":["urn:li:adSegment:8","urn:li:adSegment:7"]}},{"or":{"z":["urn:li:adSegment:9"]}}]}}}'
        % (a, b),
        '{"id":"2"}',
        '{"id":"3","targetingCriteria":{"include":{"and":[{}]}}}',
    ]
    df = from_json(spark, raw, LANDING["linkedin_campaign_audience"])
    assert rows(nested.targeting_segments(df, "targetingCriteria")) == [("1", "7"), ("1", "8")]
    kept = nested.targeting_segments(df, "targetingCriteria", keep_empty=True)
    assert rows(kept) == [("1", "7"), ("1", "8"), ("2", None), ("3", None)]


def test_pixel_rule(spark):
    df = spark.createDataFrame([('{"and":[{"event":{"eq":"Buy"}},{"or":[{"u":1}]}]}',), ("bad",), (None,)], "rule string")
    assert [tuple(r)[1:] for r in nested.pixel_rule(df).collect()] == [("Buy", '[{"u":1}]'), (None, None), (None, None)]


def test_posts(spark):
    raw = [
        '{"id":"urn:li:share:1","author":"urn:li:organization:5","commentary":"a|b","content":{"media":{"id":"urn:li:IMAGE:9","title":"t"}},"createdAt":1704067200000}',
        '{"id":"urn:li:share:2","_organization_id":"6","reshareContext":{"parent":"urn:li:share:1"}}',
        '{"id":"urn:li:share:3","_organization_id":"6","content":{"multiImage":{"altText":"x"},"media":{"id":"v"}}}',
    ]
    out = {r.post_id: r for r in nested.posts_table(from_json(spark, raw, POST)).collect()}
    assert (out["1"].organization_id, out["1"].content_type, out["1"].media_url, out["1"].commentary) == ("5", "IMAGE", "urn:li:IMAGE:9", "a-b")
    assert (out["2"].is_reshare, out["2"].original_post_id, out["2"].content_type, out["2"].commentary) == (True, "1", "NO_CONTENT", "")
    assert out["3"].content_type == "MULTI_IMAGE" and not out["3"].is_reshare


def test_page_and_followers(spark):
    df = from_json(spark, ['{"_organization_id":"1","totalPageStatistics":{"views":{"allPageViews":{"pageViews":4}}}}'], LANDING["organic_page_stats"])
    row = nested.page_statistics(df, date(2024, 2, 1)).first()
    assert (row.date, row.all_page_views, row.jobs_page_views) == (date(2024, 2, 1), 4, 0)
    gains = from_json(spark, ['{"_organization_id":"1","followerGains":{"organicFollowerGain":3}}'], LANDING["organic_followers"])
    assert tuple(nested.follower_gains(gains).first()) == ("1", None, None, 3, 0, 3)
    demo = from_json(
        spark,
        ['{"_organization_id":"1","followerCountsByFunction":[{"function":"urn:li:function:8","followerCounts":{"organicFollowerCount":2}}],"followerCountsBySeniority":[]}'],
        LANDING["organic_follower_demographics"],
    )
    assert rows(nested.follower_demographics(demo)) == [("1", "FUNCTION", "8", "urn:li:function:8", 2, 0)]


def test_creative_order(spark):
    df = spark.createDataFrame([("x", "y"), (None, "y"), (None, None)], "follow string, reference string")
    assert [r.type for r in nested.creative_type(df).collect()] == ["FOLLOW_COMPANY_V2", "SPONSORED_STATUS_UPDATE", None]


def test_preview(spark):
    df = from_json(spark, ['{"message_id":1,"contact_id":2,"type":{"emailBodyHtml":"<p>"},"externalId":"e"}', '{"message_id":1,"contact_id":3,"type":{"emailBodyHtml":""}}'], LANDING["newsletter_preview"])
    assert rows(nested.preview_table(df)) == [(1, 2, "<p>", "e"), (1, 3, None, None)]


def test_company(spark):
    dim = spark.createDataFrame([("5", 50), ("act_6", 60)], "account_id string, company_id int")
    df = spark.createDataFrame([("act_5",), ("5",), ("act_6",), ("9",), (None,)], "account string")
    assert rows(lookup.add_company(df, dim, "account")) == [("5", 50), ("9", 1), ("act_5", 50), ("act_6", 60), (None, 1)]


def test_names_and_seniority(spark):
    names = spark.createDataFrame([("1", "One")], "id string, name string")
    df = spark.createDataFrame([("1",), ("2",), (None,)], "cid string")
    assert rows(lookup.lookup_names(df, names, "cid", "cname", "Organization")) == [("1", "One"), ("2", "Organization 2"), (None, None)]
    codes = spark.createDataFrame([("urn:li:seniority:10",), ("3",), ("99",), (None,)], "c string")
    assert [r[0] for r in codes.select(lookup.seniority_name(F.col("c"))).collect()] == ["Owner", "Entry level", None, None]
    assert rows(lookup.unmapped_codes(codes, "c")) == [("99",)]


def test_anti_existing_one_and_two_keys(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, j string")
    old = spark.createDataFrame([(1, "z"), (2, "b"), (None, "c")], "k int, j string")
    assert rows(lookup.anti_existing(new, old, ["k"])) == []
    assert rows(lookup.anti_existing(new, old, ["k", "j"])) == [(1, "a")]
    assert rows(lookup.mark_existing(new, old, ["k", "j"])) == [(1, "a", False), (2, "b", True), (None, "c", True)]
    assert rows(lookup.anti_existing(new, new.filter("k = 1"), ["k"])) == [(2, "b"), (None, "c")]


def test_anti_existing_date_range_needs_key(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1))], "k int, date date")
    with pytest.raises(ValueError):
        lookup.anti_existing(df, df, ["k"], "date")


def test_first_success_stops_on_failure(spark):
    tries = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1), ("b", 4, 2)], "g string, c int, rn int")
    seen = spark.createDataFrame([(2, "x", False), (3, None, True), (4, "y", False)], "c int, html string, failed boolean")
    assert rows(lookup.first_success(tries, seen, ["c"], "g", "rn", "failed").select("g", "c", "html")) == [("a", 2, "x")]
    assert rows(lookup.first_success(tries, seen.filter("not failed"), ["c"], "g", "rn").select("g", "c")) == [("a", 2), ("b", 4)]


def test_post_insights_last_wins(spark):
    stats = from_json(
        spark,
        ['{"share":"s1","totalShareStatistics":{"clickCount":1},"seq":1}', '{"share":"s1","totalShareStatistics":{"clickCount":2},"seq":2}', '{"ugcPost":"u1","totalShareStatistics":{"likeCount":5},"seq":3}'],
        T.StructType([*LANDING["organic_share_statistics"].fields, T.StructField("seq", T.IntegerType())]),
    )
    posts = spark.createDataFrame([("s1",), ("u1",), ("none",)], "id string")
    out = lookup.post_insights(posts, stats, "seq").select("id", "click_count", "like_count", "engagement")
    assert rows(out) == [("none", 0, 0, 0.0), ("s1", 2, 0, 0.0), ("u1", 0, 5, 0.0)]


def test_salted_lookup_equals_plain(spark):
    df = spark.range(300).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id") % 9).alias("k"), "id")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "d bigint, name string")
    hot = lookup.hot_keys(df, "k", 0.3)
    assert hot == [1]
    got = lookup.salted_lookup(df, dim, "k", "d", "name", "out", 4, hot)
    want = lookup.lookup(df, dim, {"k": "d"}, "name", "out")
    assert rows(got.select("k", "id", "out")) == rows(want.select("k", "id", "out"))


def test_spread_join_splits_a_hot_key(spark):
    """By Spark, from sizes it measured: no row is multiplied by a fixed number of salts."""
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in tight}
    try:
        for k, v in tight.items():
            spark.conf.set(k, v)
        left = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 4 != 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
        right = left.groupBy("k").agg(F.max("id").alias("top"))
        got = skew.spread_join(left, right, ["k"])
        assert len(got.collect()) == 40000
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "Generate" not in plan
        assert rows(got.filter("id < 40").select("id", "k", "top")) == rows(left.filter("id < 40").join(right, "k").select("id", "k", "top"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hierarchy(spark):
    edges = spark.createDataFrame(
        [("s", "m1", True), ("s", "c1", False), ("m1", "c2", False), ("m1", "m2", True), ("m2", "c3", False), ("m2", "m1", True)],
        "manager_id string, id string, manager boolean",
    )
    seeds = spark.createDataFrame([("s",)], "id string")
    assert rows(expand_accounts(edges, seeds)) == [("m1", "c2", False), ("s", "c1", False), ("s", "m1", True)]
    tree = account_tree(edges, "s")
    assert {(r.id, r.depth) for r in tree.collect()} == {("m1", 1), ("c1", 1), ("c2", 2), ("m2", 2), ("c3", 3)}


def test_landing_schemas_parse(spark):
    for name, schema in LANDING.items():
        assert spark.createDataFrame([], schema).columns, name
    with pytest.raises(AnalysisException):
        spark.read.schema(POST).json("/nonexistent/path")
