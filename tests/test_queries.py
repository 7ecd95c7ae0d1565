"""Every registered query against its SQL on the small tables, and the shape of the plans."""

import contextlib
import io

import pytest
from check_oracles import compare, connect

from tallyloom.queries import ORACLES, QUERIES

# Python is needed for structure repair only.
PYTHON_QUERIES = {"html_repair"}
# Scalar subqueries over one row, single small series and the commit log aside, plans join by key.
EAGER = {"load_snapshot", "load_partitioned", "load_buckets", "load_after_expiry", "report_files", "kv_table", "run_report", "account_tree"} | {n for n in QUERIES if n.startswith("stream_")}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) == ""


def test_registry():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == PYTHON_QUERIES


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan_shape(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_QUERIES:
        assert "Python" not in plan


@pytest.mark.parametrize(
    "name, parts",
    [
        ("flagship_topk_entities", ["WindowGroupLimit", "ReadSchema: struct<l_orderkey:bigint"]),
        ("contacts_top10", ["WindowGroupLimit"]),
        ("recent_ids", ["PushedFilters: [IsNotNull(o_orderdate)", "GreaterThanOrEqual(o_orderdate"]),
        ("lookback_window", ["LessThan(o_orderdate", "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"]),
        ("year_window", ["GreaterThanOrEqual(o_orderdate"]),
        ("load_upsert", ["LeftAnti"]),
    ],
)
def test_plan_parts(spark, sf_dir, name, parts):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for part in parts:
        assert part in plan, plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_types_are_plain(con, name):
    """Wide integers, decimals and dates come out differently per engine; queries give bigint, double and text."""
    types = {r[0]: r[1] for r in con.execute("describe " + ORACLES[name]).fetchall()}
    assert not {c: t for c, t in types.items() if t == "HUGEINT" or t == "DATE" or t.startswith("DECIMAL")}


def test_placements_bound_the_rows_of_a_task(spark, sf_dir, monkeypatch):
    """The tasks that make narrow rows wide and sort them grow in number with the input."""
    from tallyloom.queries import shaping

    usual = shaping.google_placement_rows(spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    monkeypatch.setattr(shaping, "_TASK_ROWS", 100)
    many = shaping.google_placement_rows(spark, sf_dir)
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert f", {rows // 100 + 1}" in plan and "RepartitionByExpression" in plan
    assert many.exceptAll(usual).count() == 0 and usual.exceptAll(many).count() == 0
