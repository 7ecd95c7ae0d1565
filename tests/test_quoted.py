"""Quoted line breaks across splits against the csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import quoted, report_csv
from tallyloom.sources.quoted import broken_spans, with_quote_state


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _cell(rng):
    body = "".join(rng.choice(["a", "b", ",", "\n", '""', "x y", ""]) for _ in range(rng.randrange(7)))
    kind = rng.random()
    if kind < 0.45:
        return f'"{body}"'
    bare = body.replace("\n", "").replace(",", "").replace('""', "")
    return bare + ('"' if kind < 0.55 and bare else "")  # a quote inside a bare cell is text


def _records(spark, path):
    return sorted((r.file.rsplit("/", 1)[1], r.value) for r in report_csv.read_report_lines(spark, str(path)).collect() if r.value)


def _cells(texts):
    return sorted((name, tuple(row)) for name, text in texts for row in csv.reader(io.StringIO(text, newline="")) if row)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_csv_module(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    texts = {f"f{i}.csv": "".join(",".join(_cell(rng) for _ in range(3)) + "\n" for _ in range(rng.randrange(0, 120))) for i in range(6)}
    texts["long.csv"] = 'a,"' + "word, word\n" * 900 + '",b\nc,d,e\n'
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    assert _cells(_records(spark, tmp_path)) == _cells(texts.items())
    parsed = report_csv.with_cells(report_csv.read_report_lines(spark, str(tmp_path)).filter("file LIKE '%/long.csv'"), "value", "cells")
    assert sorted((len(r.cells), r.cells[0]) for r in parsed.collect()) == [(3, "a"), (3, "c")]


def test_crlf_inside_and_behind(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('h,"x\r\ny"\r\n"p""\r\nq",2\r\n'.encode())
    assert _records(spark, tmp_path) == [("a.csv", '"p""\r\nq",2'), ("a.csv", 'h,"x\r\ny"')]


def test_open_end_raises(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('a,b\n1,"2\n' + "3,4\n" * 60)
    with pytest.raises(Exception, match="not closed"):
        report_csv.read_report_lines(spark, str(tmp_path)).collect()


def test_lines_without_quotes_have_no_span(spark):
    lines = spark.range(1000).select(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("id").alias("line_no"), F.lit("a,b").alias("value"))
    assert broken_spans(with_quote_state(lines)).count() == 0


def test_report_with_breaks(spark, tmp_path, small_splits):
    name = '"Spring\nsale, ""big"""'
    body = "".join(f"{name},2024-01-{d:02d},7.0,{d},1\n" for d in range(1, 29))
    (tmp_path / "a.csv").write_text('"Report:\nads"\n\nCampaignName,TimePeriod,AdId,Clicks,Spend\n' + body + '"© 2024\nMicrosoft Corporation",,,1,1\n')
    got = report_csv.read_report(spark, str(tmp_path), "Ad").select("CampaignName", "TimePeriod", "AdId", "Clicks").collect()
    assert sorted(map(tuple, got)) == [('Spring\nsale, "big"', f"2024-01-{d:02d}", "7", float(d)) for d in range(1, 29)]


def test_records_are_put_together_once(spark, tmp_path, small_splits):
    """Every pass over the records reads them from storage, none windows the lines again."""
    (tmp_path / "a.csv").write_text("h,i\n" + 'a,"b\nc"\n' * 400)
    got = report_csv.read_report_lines(spark, str(tmp_path))
    assert got.inputFiles() and all("quoted-records" in f for f in got.inputFiles())
    assert _records(spark, tmp_path) == sorted([("a.csv", "h,i")] + [("a.csv", 'a,"b\nc"')] * 400)


def test_report_files_grow_in_number(spark, sf_dir, monkeypatch):
    """More rows make more report files, not larger ones, and the same result."""
    from tallyloom.queries import shaping

    written, write = [], shaping._write_reports
    monkeypatch.setattr(shaping, "_write_reports", lambda rows, path, header: (write(rows, path, header), written.append(rows.select("file").distinct().count())))
    few = shaping.report_files(spark, sf_dir)
    assert max(written) == 4
    written.clear()
    monkeypatch.setattr(shaping, "_REPORT_ROWS", 100)
    many = shaping.report_files(spark, sf_dir)
    assert max(written) > 4
    assert many.exceptAll(few).count() == 0 and few.exceptAll(many).count() == 0


def test_lines_are_stored_by_run(spark, tmp_path, monkeypatch):
    """What is stored, shuffled and composed before records are cut has a row for thousands of lines, not one a line."""
    (tmp_path / "a.csv").write_text("h,i\n" + 'a,"b\nc"\n' * 10_000)
    rows = {}

    def counted(stage):
        def run(df, label, *more):
            out = stage(df, label, *more)
            rows[label] = max(out.count(), rows.get(label, 0))
            return out

        return run

    for module in (quoted, report_csv):
        if hasattr(module, "staged"):
            monkeypatch.setattr(module, "staged", counted(module.staged))
    assert report_csv.read_report_lines(spark, str(tmp_path)).count() == 10_001
    assert rows["report-lines"] < 20 and rows["quoted-splits"] < 20


def test_rows_of_a_report_stay_where_they_are(spark, tmp_path):
    """Headers come to the records by a broadcast; no record is shuffled or sorted to meet its file's header."""
    (tmp_path / "a.csv").write_text("CampaignName,TimePeriod,AdId,Clicks\n" + "n,2024-01-01,7,1\n" * 100)
    read = report_csv.read_report(spark, str(tmp_path), "Ad")
    assert read.count() == 100
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("bits", [0, 2])
def test_runs_of_few_lines_gathered_by_a_sort(spark, tmp_path, small_splits, monkeypatch, bits):
    fallback = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(fallback)
    monkeypatch.setattr(quoted, "_RUN_BITS", bits)
    spark.conf.set(fallback, "1")
    try:
        rng = random.Random(3)
        texts = {f"f{i}.csv": "".join(",".join(_cell(rng) for _ in range(3)) + "\n" for _ in range(60)) for i in range(4)}
        for name, text in texts.items():
            (tmp_path / name).write_bytes(text.encode())
        assert _cells(_records(spark, tmp_path)) == _cells(texts.items())
    finally:
        spark.conf.set(fallback, before)


def test_line_numbers(spark, tmp_path, monkeypatch):
    """Records near the beginning have the numbers of their lines, later ones numbers that grow."""
    lines, at, n = [], [], 0
    for i in range(600):
        lines.append('"x\ny",' + str(i) if i % 3 == 0 else f"a,{i}")
        at.append(n)
        n += 1 + (i % 3 == 0)
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")

    def numbers():
        got = [(int(r.value.split(",")[1]), r.line_no) for r in report_csv.read_report_lines(spark, str(tmp_path)).collect()]
        return [no for _, no in sorted(got)]

    got = numbers()
    assert [no - got[0] for no in got] == at
    monkeypatch.setattr(quoted, "_EXACT_LINES", 8)
    got = numbers()
    assert [no - got[0] for no in got][:8] == at[:8] and all(a < b for a, b in zip(got, got[1:]))


def test_header_is_sought_in_lines(spark, tmp_path):
    """A preamble cell of many lines counts as many."""
    for breaks, found in ((20, True), (40, False)):
        path = tmp_path / str(breaks)
        path.mkdir()
        (path / "a.csv").write_text('"a' + "\n" * breaks + 'b"\n\nCampaignName,TimePeriod,AdId,Clicks\nn,2024-01-01,7,1\n')
        if found:
            assert report_csv.read_report(spark, str(path), "Ad").count() == 1
        else:
            with pytest.raises(Exception, match="no header"):
                report_csv.read_report(spark, str(path), "Ad").collect()


def test_plain_id_leaves_other_text(one):
    from tallyloom.operators.columns import plain_id

    texts = {"a": " 007.0 ", "b": "+5", "c": "-08.", "d": "", "e": "x7", "f": ",7", "g": "9a", "h": ":1", "i": "é1", "j": None, "k": ".5"}
    got = one(*[plain_id(F.col(k)) for k in texts], **texts)
    assert got == ("7", "5", "-8", "", "x7", ",7", "9a", ":1", "é1", None, ".5")
