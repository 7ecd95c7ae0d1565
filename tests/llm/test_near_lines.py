"""Line dedup: near lines against every pair, and rows that grow with the lines where many share a segment."""

import random

import pytest

from pyspark.sql import functions as F

from tallyloom.llm import line_dedup


def near(a, b, most):
    """Edit distance of at most ``most``."""
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= most


def want_gone(lines, most):
    gone = set()
    for i, line in enumerate(lines):
        for other in lines[:i]:
            if other == line or (min(len(other), len(line)) >= line_dedup.LEAST_CHARS and near(other, line, most)):
                gone.add(i)
                break
    return gone


def edited(rng, line):
    at = rng.randrange(len(line))
    return rng.choice([line[:at] + line[at + 1 :], line[:at] + rng.choice("aé0") + line[at:], line[:at] + rng.choice("bü1") + line[at + 1 :]])


def some_lines(seed):
    rng = random.Random(seed)
    heads = ["same long opening of a line, then number %03d", "%03d is the number in front of a long ending", "é" * 18 + "%03d"]
    lines = [rng.choice(heads) % rng.randrange(400) for _ in range(260)] + ["".join(rng.choices("abcdefg ", k=rng.randint(17, 40))).strip() or "x" for _ in range(60)]
    lines += [edited(rng, line) for line in rng.sample(lines, 120)] + ["aaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaa"]
    rng.shuffle(lines)
    return [line.strip() or "y" for line in lines]


@pytest.mark.parametrize("few, most, seed", [(64, 1, 1), (1, 1, 2), (10_000, 1, 3), (64, 2, 4)])
def test_near_lines(spark, monkeypatch, few, most, seed):
    """Pairs for all keys, omissions for all keys, and both."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    lines = some_lines(seed)
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string").repartition(4)
    got = {r["_id"] for r in line_dedup.repeated_lines(docs, threshold=most).collect()}
    assert got == want_gone(lines, most)
    assert len(got) > 50


def test_many_lines_of_one_segment(spark, monkeypatch):
    """Rows compared for lines of one opening grow with the lines."""
    made = []

    def counted(df, label):
        out = kept(df, label)
        made.append((label, out.count()))
        return out

    kept = line_dedup.common.stage
    monkeypatch.setattr(line_dedup.common, "stage", counted)
    sizes = {}
    for n in (1000, 4000):
        made.clear()
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.format_string("same long opening of a log line, then number %05d", "id").alias("text"))
        # Numbers are zero-padded: all but the first of ten that differ in one digit are near an earlier one.
        assert line_dedup.repeated_lines(docs).count() == n - 1
        sizes[n] = max(rows for _, rows in made)
    assert sizes[4000] <= 5 * sizes[1000]


def test_very_long_line_and_nulls(spark):
    long = ("x y " * 200_000).strip()
    docs = spark.createDataFrame([(1, long), (2, long + "z"), (3, None), (None, long), (4, ""), (4, ""), (5, "short"), (6, "shorz")], "doc_id long, text string")
    gone = {(r["_id"], r["_line"]) for r in line_dedup.repeated_lines(docs).collect()}
    assert gone == {(2, 0), (line_dedup.LAST_ID, 0)}


def test_many_long_lines_of_one_segment(spark):
    """Lines of 20,000 characters that differ at their ends."""
    head = "abcdefghij" * 2_000
    docs = spark.createDataFrame([(i, f"{head} {i:03d}") for i in range(80)] + [(100, head + " 0010"), (101, "z" + head[1:] + " 077")], "doc_id long, text string")
    assert {r["_id"] for r in line_dedup.repeated_lines(docs).collect()} == {*range(1, 80), 100, 101}
