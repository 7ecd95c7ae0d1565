"""Sources on files the test writes, configured tables, runs and flows."""

import json
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import monitoring
from tallyloom.plans.runner import RunResult, run_order, run_platform, run_tenants, snapshot_targets, tenant_totals
from tallyloom.plans.steps import Context, Step, run_steps
from tallyloom.plans.tables import FACEBOOK_TABLES, GOOGLE_TABLES, LINKEDIN_TABLES, MICROSOFT_TABLES, ORGANIC_TABLES, PLATFORMS
from tallyloom.schemas import LANDING
from tallyloom.session import scratch_path
from tallyloom.sinks.stats import LoadStats
from tallyloom.sources import files, records, report_csv, sql
from tallyloom.sources.chunks import date_chunks
from tallyloom.sources.config import read_config, table_from_config
from tallyloom.sources.keyvalue import KeyValueTable, to_entities
from tallyloom.sources.summaries import read_summaries, write_summaries

CTX = Context(datetime(2024, 2, 1, 3))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


REPORT = (
    '﻿"Report Name: ads"\n\nsome,preamble\n"TimePeriod","AccountId","CampaignId","AdGroupId","PublisherUrl","Impressions","Clicks","Ctr","Spend","Conversions"\n'
    '2024-01-01,1,10.0,100,"a,""b"".com",100,5,5.00%,1.5,0\r\n2024-01-02,1,10,100,,50,1,2%,0.5,\n2024-01-03,1,10,100,c.com,,,,,\n\n'
    '"© 2024 Microsoft Corporation. All rights reserved. "\n'
)
SWAPPED = "x\nCampaignId,TimePeriod,PublisherUrl,Clicks,AccountId,AdGroupId\n11,2024-01-05,d.com,3,2,7\n"


@pytest.fixture
def report_dir(tmp_path):
    (tmp_path / "a.csv").write_text(REPORT, encoding="utf-8")
    (tmp_path / "b.csv").write_text(SWAPPED, encoding="utf-8")
    return tmp_path


def test_report_files(spark, report_dir):
    out = report_csv.read_report(spark, str(report_dir), "PublisherUsage", header_identifier="PublisherUrl")
    got = rows(out.select("TimePeriod", "AccountId", "CampaignId", "PublisherUrl", "Clicks", "Ctr", "Spend", "Country" if "Country" in out.columns else "City" if "City" in out.columns else "AdDistribution"))
    assert got == [
        ("2024-01-01", "1", "10", 'a,"b".com', 5.0, 0.05, 1.5, None),
        ("2024-01-02", "1", "10", None, 1.0, 0.02, 0.5, None),
        ("2024-01-05", "2", "11", "d.com", 3.0, None, None, None),
    ]


def test_report_split_over_tasks(spark, tmp_path):
    lines = ["pre", "TimePeriod,Clicks"] + [f"2024-01-01,{i}" for i in range(5000)]
    (tmp_path / "big.csv").write_text("\n".join(lines))
    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(size), spark.conf.get(cost)
    spark.conf.set(size, "8192")
    spark.conf.set(cost, "0")
    try:
        parsed = report_csv.parse_report(report_csv.read_report_lines(spark, str(tmp_path)), "TimePeriod", ["TimePeriod", "Clicks"])
        assert report_csv.read_report_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 3
        assert parsed.agg(F.count("*"), F.sum(F.col("Clicks").cast("int"))).first()[:] == (5000, sum(range(5000)))
    finally:
        spark.conf.set(size, before[0])
        spark.conf.set(cost, before[1])


def test_report_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="no header"):
        report_csv.parse_report(report_csv.read_report_lines(spark, str(tmp_path)), "TimePeriod", ["a"]).collect()
    (tmp_path / "a.csv").write_text("\n" * 40 + "TimePeriod\n1\n")
    with pytest.raises(Exception, match="no header"):
        report_csv.parse_report(report_csv.read_report_lines(spark, str(tmp_path)), "TimePeriod", ["TimePeriod"]).collect()
    with pytest.raises(ValueError):
        report_csv.read_report(spark, str(tmp_path), "Other")


def test_microsoft_table(spark, report_dir):
    raw = report_csv.read_report(spark, str(report_dir), "PublisherUsage", header_identifier="PublisherUrl")
    out = MICROSOFT_TABLES["microsoft_ads_publisher_usage"].transform(raw, CTX)
    assert {"campaign_id", "publisher_url", "time_period", "row_loaded_date", "IngestionTimestamp"} <= set(out.columns)
    assert rows(out.select("campaign_id", "publisher_url")) == [("10", 'a,"b".com'), ("11", "d.com")]


def test_date_chunks(spark):
    got = [tuple(map(str, r)) for r in date_chunks(spark, date(2024, 1, 1), date(2024, 1, 11), 5).collect()]
    assert got == [("2024-01-01", "2024-01-05"), ("2024-01-06", "2024-01-10"), ("2024-01-11", "2024-01-11")]
    assert date_chunks(spark, date(2024, 1, 2), date(2024, 1, 1), 5).count() == 0


def test_records(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.json").write_text(json.dumps({"id": f"urn:li:sponsoredAccount:{i}", "name": "n"}) + "\n")
    df = records.read_records(spark, [str(tmp_path / "0.json"), str(tmp_path / "1.json")], "linkedin_account")
    assert df.count() == 2 and rows(records.account_match(df, ["1"]).select("id")) == [("urn:li:sponsoredAccount:1",)]


def test_file_listing_and_copy(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    (src / "x").mkdir(parents=True)
    dst.mkdir()
    (src / "x" / "new.png").write_bytes(b"n")
    (src / "old.png").write_bytes(b"o")
    os.utime(src / "old.png", (time.time() - 90 * 86400,) * 2)
    since = datetime.fromtimestamp(time.time() - 30 * 86400)
    assert rows(files.list_files(spark, str(src), since).select("name")) == [("x/new.png",)]
    assert rows(files.file_names(spark, str(src), ".png")) == [("new.png",), ("old.png",)]
    done = files.copy_recent(spark, str(src), str(dst), since)
    assert rows(done) == [("old.png", "skipped"), ("x/new.png", "migrated")]
    assert (dst / "x" / "new.png").read_bytes() == b"n" and not (dst / "old.png").exists()
    assert rows(files.copy_counts(done)) == [("migrated", 1), ("skipped", 1)]
    files.dump_csv(spark.range(2), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_sql_and_catalog(spark):
    spark.range(5).createOrReplaceTempView("loom_numbers")
    assert sql.query(spark, "select id from loom_numbers where id >= :low", low=3).count() == 2
    assert sql.query(spark, "select :x as x", x="'; drop table t").first().x == "'; drop table t"
    assert sql.table_exists(spark, "loom_numbers") and not sql.table_exists(spark, "absent")
    assert sql.matching_tables(spark, "loom_*") == ["loom_numbers"]
    assert sql.column_names(spark, "loom_numbers") == ["id"]


def test_key_value(spark):
    df = spark.createDataFrame([("2024-01-15", 1, None, [1]), ("2024-01-16", 2, "x", [2])], "date string, a int, b string, l array<int>")
    ent = to_entities(df, "date", ["a", "b"])
    assert rows(ent) == [("20240115", "1", "2024-01-15", "1", None, "[1]"), ("20240116", "2_x", "2024-01-16", "2", "x", "[2]")]
    kv = KeyValueTable(spark, scratch_path(spark, "kv"), ["date", "a", "b", "l"])
    assert kv.write(ent, "a").rows_inserted == 2
    assert kv.write(ent.withColumn("a", F.lit("9")), "b").rows_updated == 2
    assert rows(kv.read("PartitionKey = '20240115'", ["a"])) == [("9",)]
    assert kv.count("20240116").first()[0] == 1
    with pytest.raises(ValueError):
        kv.write(ent, "c", "fail")
    kv.delete_partition("20240115", "d")
    assert kv.read().count() == 1
    kv.write(ent, "e", "replace")
    assert kv.read().count() == 2


def test_step_errors(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        run_steps(df, [Step("no_such_step")], CTX)
    with pytest.raises(TypeError):
        run_steps(df, [Step("add_load_date", {"wrong": 1})], CTX)
    skipped = []
    out = run_steps(df, [Step("no_such_step"), Step("add_load_date")], CTX, "skip", skipped)
    assert out.columns == ["id", "load_date"] and [s[0] for s in skipped] == ["no_such_step"]


def test_config(tmp_path):
    config = {
        "t": {
            "processing": ["normalize_column_names", {"drop_null_rows": {"columns": ["publisher_url"]}}],
            "load_mode": "upsert",
            "query": {"column_name": ["CampaignId"]},
        },
        "u": {"processing": {"rename_columns": {"renaming": {"a": "b"}}, "add_row_loaded_date": {"params": "None"}}, "append": {"pk_columns": ["b"]}},
    }
    path = tmp_path / "c.json"
    path.write_text(json.dumps(config))
    loaded = read_config(str(path))
    steps, spec = table_from_config("t", loaded["t"])
    assert steps == [Step("normalize_column_names"), Step("drop_null_rows", {"columns": ["publisher_url"]})]
    assert (spec.mode, spec.keys) == ("upsert", ("CampaignId",))
    steps, spec = table_from_config("u", loaded["u"])
    assert steps[1] == Step("add_row_loaded_date") and (spec.mode, spec.keys) == ("append", ("b",))


def landing(spark, name, *records_):
    df = spark.createDataFrame([(json.dumps(r),) for r in records_], "j string")
    return df.select(F.from_json("j", LANDING[name]).alias("r")).select("r.*")


def test_every_table_plans(spark):
    dims = {
        "companies": spark.createDataFrame([], "account_id string, company_id int"),
        "organizations": spark.createDataFrame([], "id string, name string"),
        "titles": spark.createDataFrame([], "id string, name string"),
        "share_statistics": spark.createDataFrame([], LANDING["organic_share_statistics"]).withColumn("seq", F.lit(1)),
    }
    ctx = Context(CTX.run_ts, dims)
    for platform, tables in PLATFORMS.items():
        for name, table in tables.items():
            if platform == "microsoft":
                schema = ", ".join(f"{c} string" for c in report_csv.default_columns(table.landing))
            else:
                schema = LANDING[table.landing]
            out = table.transform(spark.createDataFrame([], schema), ctx)
            assert set(table.load.keys) <= set(out.columns), name
            assert out.collect() == []


def test_google_account_and_violation(spark):
    acc = landing(spark, "google_account", {"id": "1", "level": "9", "manager": False}, {"id": "1", "level": "10", "manager": False})
    assert rows(GOOGLE_TABLES["google_ads_account"].transform(acc, CTX).select("id", "level")) == [("1", "10")]
    vio = landing(
        spark, "google_violation",
        {"adGroupAd": {"ad": {"id": "1"}, "policySummary": {"approvalStatus": "DISAPPROVED"}}},
        {"adGroupAd": {"ad": {"id": "2"}, "policySummary": {"approvalStatus": "APPROVED"}}},
    )
    assert rows(GOOGLE_TABLES["google_ads_violation"].transform(vio, CTX).select("ad_id")) == [("1",)]


def test_google_campaign_dates(spark):
    raw = landing(spark, "google_campaign", {"campaign": {"id": "1", "name": "a!b", "startDateTime": "20240115", "endDateTime": "2024-02-01 10:00:00"}})
    row = GOOGLE_TABLES["google_ads_campaign"].transform(raw, CTX).first()
    assert (row.name, row.start_date, row.end_date) == ("ab", datetime(2024, 1, 15), datetime(2024, 2, 1, 10))


def test_facebook_tables(spark):
    raw = landing(
        spark, "fb_insight",
        {"ad_id": "1", "campaign_id": "c", "account_id": "a", "spend": "1.5", "impressions": "100", "clicks": "2", "cpc": "9", "date_start": "d"},
        {"ad_id": "1", "campaign_id": "c", "account_id": "a", "spend": "2.5", "impressions": "100", "clicks": "2", "cpc": "9"},
    )
    row = FACEBOOK_TABLES["fb_ads_insight"].transform(raw, CTX).first()
    assert (row.spend, row.impressions, row.clicks, row.cpc, row.ctr) == (4.0, 200.0, 4.0, 1.0, 2.0)
    sets = landing(spark, "fb_ad_set", {"id": "1", "start_time": "2024-01-15T10:30:00+0100", "end_time": "1704067200"})
    row = FACEBOOK_TABLES["fb_ads_ad_set"].transform(sets, CTX).first()
    assert (row.start_time, row.end_time) == (datetime(2024, 1, 15, 9, 30), datetime(2024, 1, 1))


def test_linkedin_campaign(spark):
    raw = landing(
        spark, "linkedin_campaign",
        {"id": "7", "name": "a|\U0001f600", "account": "urn:li:sponsoredAccount:5", "dailyBudget": {"currencyCode": "EUR", "amount": "10"}, "runSchedule": {"start": 1704067200000}},
    )
    row = LINKEDIN_TABLES["linkedin_ads_campaign"].transform(raw, CTX).first()
    assert (row.id, row.name, row.account, row.dailyBudget_amount, row.start_date, row.end_date) == (7, "a-", "5", "10", datetime(2024, 1, 1), None)


def test_run_order():
    order = run_order(LINKEDIN_TABLES)
    assert order.index("linkedin_ads_campaign") < order.index("linkedin_ads_insights")
    assert order.index("linkedin_ads_audience") < order.index("linkedin_ads_campaign_audience")
    assert set(run_order(LINKEDIN_TABLES, ["linkedin_ads_insights"])) == {"linkedin_ads_insights"}


def test_run_platform_isolates_failures(spark):
    raw = landing(spark, "fb_campaign", {"id": "1", "created_time": "2024-01-15T10:30:00+0000"}, {"id": "1", "created_time": "2024-01-15T10:30:00+0000"})

    def read(table):
        if table.landing == "fb_campaign":
            return raw
        raise RuntimeError("no data")

    root = scratch_path(spark, "run")
    only = ["fb_ads_campaign", "fb_ads_ad_set"]
    result = run_platform("facebook", FACEBOOK_TABLES, read, snapshot_targets(spark, root), CTX, "e1", only, test=True)
    assert result.status == "partial_success" and result.exit_code == 3
    assert result.loaded["fb_ads_campaign"] == LoadStats(2, 1, 0, 0, 1) and "no data" in result.failed["fb_ads_ad_set"]
    assert os.path.isdir(f"{root}/fb_ads_campaign_TEST")
    dry = run_platform("facebook", FACEBOOK_TABLES, lambda t: raw, snapshot_targets(spark, root), CTX, "e2", ["fb_ads_campaign"], dry_run=True)
    assert dry.loaded["fb_ads_campaign"] == LoadStats() and dry.status == "success"
    summaries = scratch_path(spark, "summaries")
    write_summaries(result.summary(spark, datetime(2024, 2, 1, 4)), summaries)
    write_summaries(RunResult("google", "e3", CTX.run_ts, {"t": LoadStats(1, 1)}).summary(spark, datetime(2024, 2, 1, 4)), summaries)
    back = read_summaries(spark, summaries, date(2024, 2, 1))
    assert rows(back.select("platform", "status", "total_rows_written", "tables_failed")) == [("facebook", "partial_success", 1, 1), ("google", "success", 1, 0)]
    totals = monitoring.run_totals(monitoring.summary_tables(back))
    assert rows(totals.select("platform", "total_rows_from_api", "status")) == [("facebook", 2, "partial_success"), ("google", 1, "success")]
    report = monitoring.nightly_report(back).first()
    assert (report.total_platforms, report.platforms_partial, report.overall) == (2, 1, "warning")


def test_scoped_tenants(spark):
    def tenant_rows(tenant, n):
        recs = [{"customer": {"id": tenant}, "adGroupAd": {"ad": {"id": f"{tenant}{i}"}}, "segments": {"device": "M"}, "metrics": {"clicks": "1", "costMicros": "1000000"}} for i in range(n)]
        return landing(spark, "google_cost_by_device", *recs)

    targets = snapshot_targets(spark, scratch_path(spark, "tenants"))

    def run(tenant, n, run_id):
        scope = ("customer_id_google", [tenant])
        return run_platform("google", GOOGLE_TABLES, lambda t: tenant_rows(tenant, n), targets, CTX, run_id, ["google_ads_cost_by_device"], scope)

    runs = run_tenants(["A", "B"], lambda t: run(t, 3, f"{t}1"))
    assert tenant_totals(runs, "google", "x").loaded["A.google_ads_cost_by_device"].rows_inserted == 3
    lost = RunResult("google", "C1", CTX.run_ts, failed={"google_ads_cost_by_device": "OSError: lost"})
    total = tenant_totals({**runs, "C": lost}, "google", "x")
    assert total.status == "partial_success" and set(total.failed) == {"C.google_ads_cost_by_device"} and total.totals.rows_inserted == 6
    run("A", 1, "A2")
    some = GOOGLE_TABLES["google_ads_cost_by_device"].transform(tenant_rows("A", 1), CTX)
    sink = targets("google_ads_cost_by_device", some, GOOGLE_TABLES["google_ads_cost_by_device"])
    assert rows(sink.read().groupBy("customer_id_google").count()) == [("A", 1), ("B", 3)]


def test_organic_insights(spark):
    stats = landing(spark, "organic_share_statistics", {"share": "urn:li:share:1", "totalShareStatistics": {"clickCount": 4}}).withColumn("seq", F.lit(1))
    posts = landing(spark, "organic_posts", {"id": "urn:li:share:1", "_organization_id": "5"}, {"id": "urn:li:share:2", "author": "urn:li:organization:6"})
    out = ORGANIC_TABLES["linkedin_organic_posts_insights"].transform(posts, Context(CTX.run_ts, {"share_statistics": stats}))
    assert rows(out.select("post_id", "organization_id", "click_count")) == [("1", "5", 4), ("2", "6", 0)]


def test_send_batches(spark, tmp_path):
    from tallyloom.sinks.batches import send_batches

    folder = str(tmp_path)

    def send(rows_):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(",".join(str(r.id) for r in rows_))

    send_batches(spark.range(0, 95, 1, 2), 20, send)
    parts = [p.read_text().split(",") for p in tmp_path.iterdir()]
    assert max(map(len, parts)) == 20 and sorted(int(x) for p in parts for x in p) == list(range(95))


def test_observed_rows(spark):
    from tallyloom.operators.profile import observed

    df, seen = observed(spark.range(7), "in")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}


def test_streams_read_folders(spark, tmp_path):
    from tallyloom.queries import QUERIES
    from tallyloom.queries.registry import tab

    src = "/root/testdata/sf0.001"
    tab(spark, src, "events").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    assert rows(QUERIES["stream_dedupe"](spark, str(tmp_path))) == rows(QUERIES["stream_dedupe"](spark, src))
