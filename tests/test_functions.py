"""Column functions on literals: C, D, M and H identifiers."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import dates, html, numbers, text


@pytest.mark.parametrize(
    "fn, value, want",
    [
        (text.urn_digits, "urn:li:campaign:123", "123"),
        (text.urn_digits, "no number", "no number"),
        (text.urn_tail, "urn:li:title:9", "9"),
        (text.urn_tail, "", ""),
        (text.urn_tail, None, ""),
        (text.urn_account, "urn:li:sponsoredAccount:55", "55"),
        (text.urn_account, "55", "55"),
        (text.urn_kind, "urn:li:ugcPost:1", "ugcPost"),
        (text.urn_kind, "urn:li:share:1", "share"),
        (text.urn_kind, "urn:li:x:1", "unknown"),
        (text.resource_id, "customers/1/groupPlacementViews/77~a", "77"),
        (text.resource_id, "customers/1/adGroups/88", "88"),
        (text.resource_id, "customers/1", None),
        (text.custom_conversion_id, "offsite_conversion.custom.42", "42"),
        (text.custom_conversion_id, "offsite_conversionXcustomX42", None),
        (text.strip_emoji, "a\U0001f600b", "ab"),
        (text.strip_emoji, "漢字", ""),
        (text.swap_pipe, "a|b", "a-b"),
        (text.keep_latin, "Ab1é|ok!", "Ab1ok!"),
        (text.ascii_only, "é1", "1"),
        (text.audience_label, "a_b-c d!é", "a_b-c d"),
        (text.drop_vertical_prefix, "uservertical::x", "x"),
        (text.keep_word_chars, "é漢_1 -|!.", "é漢_1 -|"),
        (text.clean_post_text, "a\r\nb|c\x00\U0001d400", "a b-c"),
        (text.clean_post_text, None, ""),
        (text.count_short_links, "https://bit.ly/a and https://bit.ly/a", 1),
        (text.count_short_links, "https://bit.ly/a and HTTP://BIT.LY/b", 2),
        (text.count_short_links, None, 0),
        (text.has_short_link, "No links here", False),
        (text.has_short_link, None, False),
        (text.link_id, "https://bit.ly/abc", "bit.ly/abc"),
        (text.code_head, "A1.2", "A1"),
        (text.copy_field, "a\\b|c", "a\\\\b\\|c"),
        (text.copy_field, None, "None"),
        (text.partition_key, "2024-01-15", "20240115"),
        (text.partition_key, "ab/cd-efghijk", "ab/cd-efghijk"),
        (text.post_url, "urn:li:share:1", "https://www.linkedin.com/feed/update/urn:li:share:1"),
    ],
)
def test_text(one, fn, value, want):
    assert one(fn(F.lit(value).cast("string"))) == want


def test_emoji_only_keeps_scripts(one):
    assert one(text.strip_emoji(F.lit("漢字 \U0001f600 ok"), "emoji_only")) == "漢字  ok"


def test_label_profiles(one):
    value = F.lit("Ré|\U0001f600x")
    got = one(*[text.clean_label(value, p) for p in ("pipe", "emoji", "latin")])
    assert got == ("Ré-\U0001f600x", "Ré-x", "Rx")
    with pytest.raises(ValueError):
        text.clean_label(value, "other")


def test_find_between(one):
    assert one(text.find_between(F.lit("a[b\nc]d]"), "[", "]")) == "b\nc"
    assert one(text.find_between(F.lit("a[b"), "[", "]")) == ""


def test_short_links_order(one):
    links = one(text.short_links(F.lit("x https://bit.ly/z https://bit.ly/a https://bit.ly/z")))
    assert links == ["https://bit.ly/z", "https://bit.ly/a"]


def test_keys_and_names(one):
    assert one(text.row_key(F.lit(1), F.lit(None), F.lit("b"))) == "1_b"
    assert one(text.image_name(F.lit(None).cast("string"), F.lit("n"))) == "n.png"
    assert one(text.image_name(F.lit("e"), F.lit("n"))) == "e.png"
    assert one(text.to_urn("organization", F.lit(5))) == "urn:li:organization:5"
    assert one(text.to_urn("organization", F.lit("urn:li:x:5"))) == "urn:li:x:5"
    assert one(text.placeholder_name("Title", F.lit(None).cast("string"))) is None
    assert one(text.pivot_value(F.array(F.lit("urn:li:organization:7")), "organization")) == "7"
    assert one(text.pivot_value(F.array().cast("array<string>"), "organization")) is None


@pytest.mark.parametrize(
    "fn, value, want",
    [
        (dates.millis_to_ts, "1704067200123", datetime(2024, 1, 1, 0, 0, 0, 123000)),
        (dates.millis_to_ts, "bad", None),
        (dates.seconds_to_ts, "1704067200", datetime(2024, 1, 1)),
        (dates.iso_to_zone, "2024-01-15T10:30:00+0000", datetime(2024, 1, 15, 11, 30)),
        (dates.iso_to_zone, "2024-07-15T10:30:00+0000", datetime(2024, 7, 15, 12, 30)),
        (dates.iso_to_zone, "2024-07-15T10:30:00-0200", datetime(2024, 7, 15, 14, 30)),
        (dates.iso_to_zone, "2024-01-15", datetime(2024, 1, 15, 1, 0)),
        (dates.iso_to_zone, "soon", None),
        (dates.day_from_text, "2024-02-30", None),
        (dates.day_from_text, "2024-02-29", date(2024, 2, 29)),
        (dates.flexible_day, "20240115", datetime(2024, 1, 15)),
        (dates.flexible_day, "2024-01-15", datetime(2024, 1, 15)),
        (dates.flexible_day, "2024-01-15 10:00:00", datetime(2024, 1, 15, 10)),
        (dates.flexible_day, "x", None),
        (dates.to_timestamp_any, "1704067200", datetime(2024, 1, 1)),
        (dates.to_timestamp_any, "2024-01-01T02:00:00+0100", datetime(2024, 1, 1, 1)),
        (dates.to_timestamp_any, "bad", None),
    ],
)
def test_dates(one, fn, value, want):
    assert one(fn(F.lit(value))) == want


def test_dates_ignore_session_zone(spark, one):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(dates.millis_to_ts(F.lit(1704067200000))) == datetime(2024, 1, 1)
        assert one(dates.iso_to_zone(F.lit("2024-07-15T10:30:00+0000"))) == datetime(2024, 7, 15, 12, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_parts(one):
    lit = F.lit
    assert one(dates.date_from_parts(lit("2026.0"), lit("1.0"), lit("5.0"))) == date(2026, 1, 5)
    assert one(dates.date_from_parts(lit(2026), lit(13), lit(5))) is None
    assert one(dates.date_from_parts(lit(2026), lit(None).cast("int"), lit(5))) is None
    assert one(dates.range_day(lit(None).cast("bigint"), date(2024, 2, 1))) == date(2024, 2, 1)


@pytest.mark.parametrize(
    "fn, value, want",
    [
        (numbers.percent_to_fraction, "12.5%", 0.125),
        (numbers.percent_to_fraction, "x%", None),
        (numbers.safe_int, "12.9", 12),
        (numbers.safe_int, "x", 0),
        (numbers.safe_int, None, 0),
        (numbers.safe_decimal, "2.345", Decimal("2.34")),
        (numbers.safe_decimal, "2.355", Decimal("2.36")),
        (numbers.safe_decimal, "NaN", None),
        (numbers.safe_decimal, "bad", None),
        (numbers.to_number, "NaN", None),
        (numbers.to_number, "1e3", 1000.0),
        (numbers.micros, "1500000", 1.5),
        (numbers.micros, None, None),
    ],
)
def test_numbers(one, fn, value, want):
    assert one(fn(F.lit(value).cast("string"))) == want


def test_ratio_and_rate(one):
    assert one(numbers.ratio(F.lit(5), F.lit(0))) == 0.0
    assert one(numbers.ratio(F.lit(5), F.lit(10), 100)) == 50.0
    assert one(numbers.micros(F.lit(None).cast("string"), True)) == 0.0
    none = F.lit(None).cast("string")
    assert one(numbers.acceptance_rate(none, F.lit(3), F.lit(0))) is None
    assert one(numbers.acceptance_rate(F.lit("NaN"), F.lit(1), F.lit(3))) == Decimal("33.33")
    assert one(numbers.acceptance_rate(F.lit("98.765"), F.lit(1), F.lit(3))) == Decimal("98.76")


def test_html(one):
    raw = "<html><body>  <p>{{a\nb}}x [[y]]</p> <mj-raw>q\n</mj-raw> <p>z  w</p></body></html>"
    stripped = html.strip_placeholders(F.lit(raw))
    assert one(stripped) == "<html><body>  <p>x </p>  <p>z  w</p></body></html>"
    assert one(html.squeeze_whitespace(stripped)) == "<html><body><p>x </p><p>z w</p></body></html>"
    assert one(html.body_of(html.squeeze_whitespace(stripped))) == "<body><p>x </p><p>z w</p></body>"
    assert one(html.body_of(F.lit("plain"))) == "plain"
    assert one(html.strip_placeholders(F.lit(None).cast("string"))) == ""


def test_html_patterns_by_company(one):
    pats = {"it": [r"\{\{.*?\}\}"], "es": [r"<x>.*?</x>"]}
    body = F.lit("{{a}}<x>b</x>c")
    assert one(html.strip_placeholders_by(body, F.lit("it"), pats)) == "<x>b</x>c"
    assert one(html.strip_placeholders_by(body, F.lit("es"), pats)) == "{{a}}c"
    assert one(html.strip_placeholders_by(body, F.lit("zz"), pats)) == "<x>b</x>c"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("<p>a<b>c", "<p>a<b>c</b></p>"),
        ("<p>a</i></p>", "<p>a</p>"),
        ("<div><p>x</div>y", "<div><p>x</p></div>y"),
        ("a<br>b<img src=x>", 'a<br/>b<img src="x"/>'),
        ("<!-- c -->&amp;&#38;", "<!-- c -->&amp;&#38;"),
        ("", ""),
    ],
)
def test_balance(raw, want):
    assert html.balance_markup(raw) == want
    assert html.balance_markup(want) == want


def test_repair_udf(spark):
    df = spark.createDataFrame([("<p>a",), (None,)], "h string")
    assert [r[0] for r in df.select(html.repair_markup("h")).collect()] == ["<p>a</p>", None]


@pytest.mark.parametrize("blank", ["\u00a0", "\u2003", "\u3000", "\u0085", "\v"])
def test_blanks_beyond_ascii(spark, blank):
    """Cleaners keep them, links end at them, trims and blank tests take them."""
    from tallyloom.functions import html, text
    from tallyloom.operators.filters import has_content

    c, link = F.col("c"), F.col("l")
    df = spark.createDataFrame([(f"a{blank}b", f"https://bit.ly/x{blank}next", f"{blank}<p>{blank}<b>{blank}", blank)], "c string, l string, h string, e string")
    got = df.select(text.keep_latin(c), text.audience_label(c), text.keep_word_chars(c), text.short_links(link), html.squeeze_whitespace(F.col("h")), has_content(F.col("e")), has_content(c)).first()
    assert tuple(got) == (f"a{blank}b",) * 3 + (["https://bit.ly/x"], "<p><b>", False, True)
