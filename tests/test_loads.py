"""Load modes: exact rows, exact counters, repeats and recovery."""

import contextlib
import io
import re
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import scratch_path
from tallyloom.sinks import merge
from tallyloom.sinks.snapshot import SnapshotTable, load_table, write_alerts
from tallyloom.sinks.spec import LoadSpec, choose_mode, detect_keys, target_name
from tallyloom.sinks.stats import LoadStats

SCHEMA = T.StructType(
    [T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("n", T.LongType()), T.StructField("load_date", T.DateType())]
)
OLD, NEW = date(2024, 1, 1), date(2024, 2, 1)


def frame(spark, rows, day=NEW):
    return spark.createDataFrame([(*r, day) for r in rows], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def open_table(spark, schema=SCHEMA, part=None):
    return SnapshotTable(spark, scratch_path(spark, "t"), schema, part)


def spec(mode, keys=("k",), **kw):
    return LoadSpec("t", keys, mode, order=("n",), **kw)


@pytest.fixture
def table(spark):
    t = open_table(spark)
    t.load(frame(spark, [(1, "a", 10), (2, "b", 20)], OLD), spec("replace"), "base")
    return t


BATCH = [(2, "b", 5), (2, "b", 7), (3, "a", 1), (None, "a", 9)]


def test_append(spark, table):
    stats = table.load(frame(spark, BATCH), spec("append"), "x")
    assert rows(table.read()) == [(1, "a", 10, OLD), (2, "b", 20, OLD), (3, "a", 1, NEW)]
    assert stats == LoadStats(4, 1, 0, 1, 2) and stats.rows_written == 1
    again = table.load(frame(spark, BATCH), spec("append"), "y")
    assert again == LoadStats(4, 0, 0, 2, 2) and table.read().count() == 3


def test_upsert_one_key(spark, table):
    stats = table.load(frame(spark, BATCH), spec("upsert"), "x")
    assert rows(table.read()) == [(1, "a", 10, OLD), (2, "b", 7, NEW), (3, "a", 1, NEW)]
    assert stats == LoadStats(4, 1, 1, 0, 2)
    before = rows(table.read())
    table.load(frame(spark, BATCH), spec("upsert"), "y")
    assert rows(table.read()) == before


def test_upsert_two_keys(spark, table):
    stats = table.load(frame(spark, BATCH), spec("upsert", ("k", "s")), "x")
    assert stats == LoadStats(4, 1, 1, 0, 2)


def test_partial_upsert(spark, table):
    table.load(frame(spark, [(2, "z", 7)]), spec("upsert", update=("n", "load_date")), "x")
    assert rows(table.read()) == [(1, "a", 10, OLD), (2, "b", 7, NEW)]


def test_increment_adds_once_per_batch(spark, table):
    inc = spec("increment", increment=("n",))
    first = table.load(frame(spark, BATCH), inc, "x")
    assert first == LoadStats(4, 1, 1, 0, 2)
    want = [(1, "a", 10, OLD), (2, "b", 27, NEW), (3, "a", 1, NEW)]
    assert rows(table.read()) == want
    assert table.load(frame(spark, BATCH), inc, "x") == first
    assert rows(table.read()) == want


def test_increment_example(spark):
    t = open_table(spark)
    inc = spec("increment", increment=("n",))
    t.load(frame(spark, [(1, "a", 1000)], OLD), inc, "a")
    t.load(frame(spark, [(1, "a", 200)]), inc, "b")
    assert rows(t.read()) == [(1, "a", 1200, NEW)]


def test_scoped_replace(spark, table):
    stats = table.load(frame(spark, [(9, "b", 1)]), spec("replace", scope={"absent": [1], "s": ["b", None]}), "x")
    assert rows(table.read()) == [(1, "a", 10, OLD), (9, "b", 1, NEW)] and stats.rows_inserted == 1
    with pytest.raises(ValueError):
        table.load(frame(spark, [(9, "b", 1)]), spec("replace", scope={"s": [None]}), "y")
    assert table.read().count() == 2


def test_empty_batch(spark, table):
    empty = frame(spark, [])
    assert table.load(empty, spec("replace"), "x") == LoadStats()
    assert table.read().count() == 2
    table.load(empty, spec("replace", allow_empty=True), "y")
    assert table.read().count() == 0


def test_no_key_means_all_columns(spark, table):
    rows_in = [(1, "a", 10), (1, "a", 10), (None, "q", 1)]
    stats = table.load(frame(spark, rows_in), LoadSpec("t", (), "append"), "x")
    assert stats == LoadStats(3, 1, 0, 1, 1)


@pytest.mark.parametrize("mode", ["append", "upsert", "replace", "increment"])
def test_counters_add_up(spark, mode):
    batch = frame(spark, [(i % 17 if i % 5 else None, "s", i) for i in range(100)])
    target = frame(spark, [(i, "s", 0) for i in range(0, 30, 3)])
    sp = spec(mode, increment=("n",) if mode == "increment" else ())
    c = merge.load_counts(batch, target, sp).first()
    assert c.rows_inserted + c.rows_updated + c.rows_skipped + c.rows_filtered == c.rows_from_api == 100
    out = merge.merge_rows(merge.prepare_batch(batch, sp), target, sp)
    base = 0 if mode == "replace" else target.count()
    assert out.count() == base + c.rows_inserted


PART = T.StructType([T.StructField("d", T.DateType()), T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])


def part_frame(spark, rows_in):
    return spark.createDataFrame([(date(2024, 1, d), k, n) for d, k, n in rows_in], PART)


def test_partitioned_loads(spark):
    t = open_table(spark, PART, "d")
    sp = LoadSpec("t", ("d", "k"), "increment", increment=("n",), partition_by="d")
    t.load(part_frame(spark, [(1, 1, 1), (2, 1, 1), (3, 1, 1)]), sp, "a")
    t.load(part_frame(spark, [(2, 1, 5), (2, 2, 7)]), sp, "b")
    want = [(date(2024, 1, 1), 1, 1), (date(2024, 1, 2), 1, 6), (date(2024, 1, 2), 2, 7), (date(2024, 1, 3), 1, 1)]
    assert rows(t.read()) == want
    t.drop_partitions([date(2024, 1, 2)], "drop")
    assert t.read().count() == 2
    t.load(part_frame(spark, [(2, 9, 9)]), sp, "c")
    assert rows(t.read().filter("d = '2024-01-02'")) == [(date(2024, 1, 2), 9, 9)]
    t.expire("d", date(2024, 1, 4), 2, "expire")
    assert rows(t.read().select("d").distinct()) == [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    t.load(part_frame(spark, [(3, 5, 5)]), LoadSpec("t", ("d", "k"), "replace", partition_by="d"), "full")
    t.load(part_frame(spark, [(4, 5, 5)]), sp, "after")
    assert rows(t.read()) == [(date(2024, 1, 3), 5, 5), (date(2024, 1, 4), 5, 5)]


def test_staged_batch_is_finished(spark, monkeypatch):
    t = open_table(spark, PART, "d")
    sp = LoadSpec("t", ("d", "k"), "increment", increment=("n",), partition_by="d")
    t.load(part_frame(spark, [(1, 1, 1)]), sp, "a")
    move = SnapshotTable._overwrite_partitions

    def move_then_die(self, *args):
        monkeypatch.setattr(SnapshotTable, "_log", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        move(self, *args)

    log = SnapshotTable._log
    monkeypatch.setattr(SnapshotTable, "_overwrite_partitions", move_then_die)
    with pytest.raises(OSError):
        t.load(part_frame(spark, [(1, 1, 5)]), sp, "b")
    monkeypatch.setattr(SnapshotTable, "_overwrite_partitions", move)
    monkeypatch.setattr(SnapshotTable, "_log", log)
    stats = t.load(part_frame(spark, [(1, 1, 5)]), sp, "b")
    assert rows(t.read()) == [(date(2024, 1, 1), 1, 6)] and stats.rows_updated == 1


def test_retention_unpartitioned(spark, table):
    table.load(frame(spark, [(5, "n", 1)]), spec("append"), "x")
    table.expire("load_date", date(2024, 2, 10), 30, "e")
    assert rows(table.read()) == [(5, "n", 1, NEW)]


def test_alignment_on_load(spark, table):
    raw = spark.createDataFrame([("7", "x", "bad", "extra")], "k string, s string, n string, zzz string")
    table.load(raw, spec("append"), "x", date(2024, 3, 1))
    assert rows(table.read().filter("k = 7")) == [(7, "x", 0, date(2024, 3, 1))]


def test_alerts_are_not_loaded(spark, table):
    alert = spec("append", alert_only=True)
    with pytest.raises(ValueError):
        load_table(table, frame(spark, BATCH), alert, "x")
    root = scratch_path(spark, "alerts")
    assert spark.read.parquet(write_alerts(frame(spark, BATCH), root, "violations")).count() == 4


def test_spec_checks():
    with pytest.raises(ValueError):
        LoadSpec("t", mode="merge")
    with pytest.raises(ValueError):
        LoadSpec("t", ("k",), "increment")
    with pytest.raises(ValueError):
        LoadSpec("t", ("k",), partition_by="d")
    assert target_name("t", True) == "t_TEST" and target_name("t") == "t"


@pytest.mark.parametrize(
    "config, want",
    [
        ({"increment": {"pk_columns": ["a"], "increment_columns": ["n"]}, "upsert": {}}, ("increment", ("a",), ("n",))),
        ({"upsert": {"pk_columns": ["a"]}, "truncate": True}, ("upsert", ("a",), ())),
        ({"truncate": True, "dedupe_columns": ["a", "b"], "append": {"pk_columns": ["z"]}}, ("replace", ("a", "b"), ())),
        ({"merge": {"fields_id": ["a"]}, "append": {}}, ("upsert", ("a",), ())),
        ({"append": {"pk_columns": ["a"]}}, ("append", ("a",), ())),
        ({"query": {"column_name": ["q"]}}, ("append", ("q",), ())),
    ],
)
def test_choose_mode(config, want):
    assert choose_mode(config) == want


@pytest.mark.parametrize(
    "cols, want",
    [
        ("id date ad_id", ["id"]),
        ("CampaignId PublisherUrl TimePeriod x", ["CampaignId", "PublisherUrl", "TimePeriod"]),
        ("campaign_id country state city", ["campaign_id", "country", "state", "city"]),
        ("campaign_id ad_id date", ["ad_id", "date"]),
        ("organization_id date", ["organization_id", "date"]),
        ("audience_id adset_id name", ["audience_id", "adset_id"]),
        ("ad_id action_type value", ["ad_id", "action_type"]),
        ("ad_id device clicks", ["ad_id", "device"]),
        ("campaign_id adgroup_id ad_id", ["campaign_id", "adgroup_id", "ad_id"]),
        ("x y load_date", ["x", "y"]),
    ],
)
def test_detect_keys(cols, want):
    assert detect_keys(cols.split()) == want


def test_detect_keys_without_date():
    assert detect_keys(["campaign_id", "date", "clicks"], exclude_date=True) == ["campaign_id"]


def test_key_repeats(spark):
    assert rows(merge.key_repeats(frame(spark, BATCH), ["k"])) == [(2, 2)]


def test_stats_sum():
    assert sum([LoadStats(1, 1), LoadStats(2, 0, 2)], LoadStats()).to_dict()["rows_written"] == 3


def test_load_dates_replaced_on_increment(spark, table):
    table.load(frame(spark, [(1, "other", 1)]), spec("increment", increment=("n",)), "x")
    assert rows(table.read().filter(F.col("k") == 1)) == [(1, "a", 11, NEW)]


def test_merge_into_needs_a_capable_table(spark):
    spark.sql("create or replace temp view merge_target as select 1L k, 's' s, 1L n, date'2024-01-01' load_date")
    with pytest.raises(Exception):
        merge.merge_into(frame(spark, BATCH), "merge_target", spec("upsert"))


def test_load_after_expiry_stays(spark, tmp_path):
    """Retention is a delete at one moment: older days that are loaded later are read."""
    from datetime import date

    from pyspark.sql import types as T

    from tallyloom.sinks.snapshot import SnapshotTable
    from tallyloom.sinks.spec import LoadSpec

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.DateType())])
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, partition_by="day")
    spec = LoadSpec("t", ["id", "day"], "upsert", partition_by="day")
    table.load(spark.createDataFrame([("a", date(2024, 1, 1)), ("b", date(2024, 6, 1))], schema), spec, "one")
    table.expire("day", date(2024, 6, 30), 90, "expire")
    assert {r["id"] for r in table.read().collect()} == {"b"}
    assert table.load(spark.createDataFrame([("c", date(2024, 1, 1))], schema), spec, "two").rows_inserted == 1
    assert {r["id"] for r in table.read().collect()} == {"b", "c"}


def test_keys_with_one_start_stay_apart(spark, tmp_path):
    from tallyloom.sources.keyvalue import KeyValueTable, to_entities

    rows = spark.createDataFrame([("campaign_a", "1"), ("campaign_b", "1"), ("campaign_b", None), ("o'b", None)], "p string, r string")
    table = KeyValueTable(spark, str(tmp_path / "kv"), ["p", "r"])
    table.write(to_entities(rows, "p", ["r"]), "one")
    assert table.read().count() == 4 and table.count("o'b").first()["rows"] == 1
    table.delete_partition("campaign_a", "drop")
    assert table.read().count() == 3


@pytest.mark.parametrize("listed", [1000, 0])
def test_broken_load_counts_once(spark, monkeypatch, listed):
    """A load is whole from its staging on: other batches build on it, readers see it moved or not."""
    from tallyloom.sinks import snapshot

    monkeypatch.setattr(snapshot, "LISTED_PARTITIONS", listed)
    t = open_table(spark, PART, "d")
    sp = LoadSpec("t", ("d", "k"), "increment", increment=("n",), partition_by="d")
    t.load(part_frame(spark, [(1, 1, 100), (2, 1, 7)]), sp, "base")
    move = SnapshotTable._overwrite_partitions
    for moved, name in ((False, "a"), (True, "b")):
        with monkeypatch.context() as m:

            def die(self, *args, moved=moved):
                if moved:
                    m.setattr(SnapshotTable, "_log", lambda *a, **k: None)
                    move(self, *args)
                raise OSError("lost")

            m.setattr(SnapshotTable, "_overwrite_partitions", die)
            with pytest.raises(OSError):
                t.load(part_frame(spark, [(1, 1, 10)]), sp, name)
        want = 110 if name == "a" else 121
        assert rows(t.read()) == [(date(2024, 1, 1), 1, want), (date(2024, 1, 2), 1, 7)]
        t.load(part_frame(spark, [(1, 1, 1)]), sp, f"other-{name}")
        assert t.load(part_frame(spark, [(1, 1, 10)]), sp, name).rows_updated == 1
    assert rows(t.read()) == [(date(2024, 1, 1), 1, 122), (date(2024, 1, 2), 1, 7)]


def test_batch_is_evaluated_once(spark, table):
    """Counters and rows come from one evaluation of the batch."""
    keys = (F.rand() * 400 + 3).cast("long").alias("k")
    batch = spark.range(1000).select(keys, F.lit("z").alias("s"), F.lit(1).cast("long").alias("n"), F.lit(NEW).alias("load_date"))
    stats = table.load(batch, spec("upsert"), "x")
    assert stats.rows_inserted == table.read().count() - 2 and stats.rows_inserted + stats.rows_filtered == 1000


def _bucketed(spark, schema=SCHEMA):
    return SnapshotTable(spark, scratch_path(spark, "buckets"), schema, buckets=16, bucket_keys=("k",))


@pytest.mark.parametrize("mode", ["append", "upsert", "increment"])
def test_buckets_load_as_plain_tables(spark, mode):
    plain, cut = open_table(spark), _bucketed(spark)
    extra = {"increment": ("n",)} if mode == "increment" else {}
    for number in range(3):
        batch = frame(spark, [(k * (number + 1) % 50, "a", k) for k in range(60)] + [(None, "a", 1)])
        assert plain.load(batch, spec(mode, **extra), f"b{number}") == cut.load(batch, spec(mode, **extra), f"b{number}")
        assert rows(plain.read()) == rows(cut.read())
    assert cut.load(frame(spark, []), spec(mode, **extra), "empty") == LoadStats()
    cut.load(frame(spark, [(7, "b", 1)]), spec("replace", scope={"s": ["b"]}), "scoped")
    assert sorted({r[1] for r in rows(cut.read())}) == ["a", "b"]
    cut.expire("load_date", date(2024, 6, 1), 10, "expire")
    assert cut.read().count() == 0


def test_one_key_rewrites_one_bucket(spark):
    cut = _bucketed(spark)
    cut.load(frame(spark, [(k, "a", k) for k in range(500)], OLD), spec("replace"), "base")
    before = set(cut.current().locations)
    assert len(before) == 16
    cut.load(frame(spark, [(123, "b", 9)]), spec("upsert"), "x")
    after = set(cut.current().locations)
    assert len(after) == 16 and len(after - before) == 1
    (new,) = after - before
    (gone,) = before - after
    assert new.rsplit("/", 1)[1] == gone.rsplit("/", 1)[1] and spark.read.parquet(new).filter("k = 123").first()["s"] == "b"


def test_bucket_checks(spark):
    with pytest.raises(ValueError, match="buckets"):
        SnapshotTable(spark, "x", SCHEMA, "s", 4, ("k",))
    with pytest.raises(ValueError, match="lacks"):
        _bucketed(spark).load(frame(spark, [(1, "a", 1)]), spec("upsert", ("s",)), "x")


def test_log_is_compacted(spark, monkeypatch):
    from tallyloom.sinks import snapshot

    monkeypatch.setattr(snapshot, "SEGMENT", 3)
    t = open_table(spark)
    first = t.load(frame(spark, [(0, "a", 0)]), spec("append"), "b0")
    for n in range(1, 8):
        t.load(frame(spark, [(n, "a", n)]), spec("append"), f"b{n}")
    assert t._checkpoint() == 1 and t.commits().count() == 8
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        t.commits().explain("formatted")
    # Folders that the scans leave out: segments up to 1, checkpoints before 1.
    assert re.search(r"PartitionFilters: \[isnotnull\(segment#\d+\), \(segment#\d+ > 1\)", text.getvalue())
    assert re.search(r"PartitionFilters: \[isnotnull\(upto#\d+\), \(upto#\d+ > 0\)", text.getvalue())
    assert t.load(frame(spark, [(0, "a", 0)]), spec("append"), "b0") == first
    assert len(rows(t.read())) == 8 and t.commits().filter("version < 5 AND size(locations) > 0").count() == 0


def test_first_load_is_not_matched(spark, tmp_path, monkeypatch):
    """A target without files knows no key: the batch is written as it is; later loads count new and known rows."""
    from tallyloom.sinks import snapshot

    table = snapshot.SnapshotTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "k string, v bigint").schema)
    spec = LoadSpec("t", ("k",), "upsert")
    with monkeypatch.context() as m:
        m.setattr(snapshot, "changed_rows", None)
        first = table.load(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v bigint"), spec, "1")
    assert (first.rows_inserted, first.rows_updated, first.rows_filtered) == (2, 0, 1)
    second = table.load(spark.createDataFrame([("b", 5), ("c", 6)], "k string, v bigint"), spec, "2")
    assert (second.rows_inserted, second.rows_updated) == (1, 1)
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 5), ("c", 6)]


def test_differing_keys_in_one_aggregate(spark):
    """Equal rows of a key prove it, also nulls; a null beside a value doesn't."""
    from tallyloom.plans.compiled import differing_keys

    rows = [("a", 1, 0.5), ("a", 1, 0.5), ("b", None, 1.0), ("b", None, 1.0), ("c", 1, 1.0), ("c", None, 1.0), ("d", 1, 1.0), ("d", 2, 1.0), (None, 1, 1.0), (None, 2, 1.0)]
    df = spark.createDataFrame(rows, "k string, n bigint, x double")
    assert {r.k for r in differing_keys(df, ["k"]).collect()} == {"c", "d", None}
    plan = differing_keys(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
    texts = df.withColumn("n", F.col("n").cast("string"))
    assert {r.k for r in differing_keys(texts, ["k"]).collect()} == {"c", "d", None}
