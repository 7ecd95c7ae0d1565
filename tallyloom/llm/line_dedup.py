"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

A line is split into threshold + 1 segments. Two lines within the threshold agree
on one segment exactly, at a place that their lengths and the threshold bound. So each line
is indexed by its segments (with their number and its length) and probes the
substrings at those places for every length it may match. Candidates of a rare segment are
verified pair by pair; many lines of one segment are compared by what is left when one character goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common

THRESHOLD = 1
# Shorter lines are compared exactly only: an edit of few characters is another line.
LEAST_CHARS = 20
LAST_ID = (1 << 63) - 1
# Bits of the filters in front of shuffles.
FILTER_BITS = 20
# Lines of one key that are compared pair by pair.
FEW = 64
_BLANK = " \t\r"


def _segment(length: Column, i: int, threshold: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment i (from 1) of a line: even segments, the last ones longer by one where it does not divide."""
    count = threshold + 1
    longer = F.pmod(length, F.lit(count))
    size = ((length - longer) / count).cast("int")
    start = size * (i - 1) + F.greatest(F.lit(0), longer + (i - 1 - count))
    return start, size + F.when(longer + i > count, 1).otherwise(0)


def _key(line: Column, i: int, length: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(i), length, F.substring(line, start + 1, size))


def segment_places(length: Column, threshold: int = THRESHOLD) -> list[tuple[int, Column, Column, Column, bool]]:
    """Segment number, length of the indexed line, start and size of every substring that keys a line, and whether it only probes.

    A line is indexed by its own segments and probes the places where a segment of a line up to
    ``threshold`` shorter may stand. Probes at its own segments' places are its index keys and
    are not repeated. Of two lines the longer probes.
    """
    out = []
    for shorter in range(threshold + 1):
        other = length - shorter
        for i in range(1, threshold + 2):
            start, size = _segment(other, i, threshold)
            rest = threshold + 1 - i
            for shift in range(max(1 - i, shorter - rest), min(i - 1, shorter + rest) + 1):
                out.append((i, other, start + shift, size, bool(shorter or shift)))
    return out


def segment_keys(line: Column, length: Column, threshold: int = THRESHOLD) -> list[Column]:
    """Keys of a line in the order of segment_places(); null where a place is outside the line."""
    out = []
    for i, other, start, size, probe in segment_places(length, threshold):
        key = _key(line, i, other, start, size)
        out.append(F.when((start >= 0) & (start + size <= length), key) if probe else key)
    return out


def lines_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """_id, _row, _line (from 0), line: the lines of every text without blanks at their ends; empty ones are left out.

    _row tells documents of the same id apart: repeated rows of one id and text are one document.
    """
    whole = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"), F.xxhash64(F.col(text)).alias("_row"), F.posexplode(whole).alias("_line", "line"))
    return keyed.withColumn("line", F.btrim("line", F.lit(_BLANK))).where("line != ''")


def _hashed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_h", F.xxhash64("line")).withColumn("_g", F.xxhash64(F.lit(1), "line"))


def _within(a: str, b: str, threshold: int) -> Column:
    """Whether two different lines are within the threshold.

    For 1, what follows their common beginning decides, which is found by halving steps: linear work,
    where Spark's banded ``levenshtein`` walks each line once per character.
    """
    if threshold != 1:
        return F.levenshtein(a, b, threshold) >= 0
    common_chars = (
        f"aggregate(transform(sequence(0, 30), k -> shiftleft(1, 30 - k)), 0, (at, step) -> if(at + step <= least(length({a}), length({b}))"
        f" and substring({a}, at + 1, step) = substring({b}, at + 1, step), at + step, at))"
    )
    rest = "substring({}, p + {}, length({}))".format
    same = " or ".join(f"{rest(a, i, a)} = {rest(b, j, b)}" for i, j in ((2, 2), (1, 2), (2, 1)))
    return F.expr(f"transform(array({common_chars}), p -> {same})[0]")


def _slot(value: Column) -> tuple[Column, Column]:
    """Word and bit of a 64-bit hash in a bitmap."""
    slot = value.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    return F.shiftright(slot, 6), slot.bitwiseAND(F.lit(63)).cast("int")


def _bitmap(members: DataFrame, column: str) -> Column:
    """The hashes in ``column`` as a bitmap of 128 KB, which is a scalar subquery; a full one only filters less."""
    word, bit = _slot(F.col(column))
    marked = members.groupBy(word.alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("b"))
    every = members.sparkSession.range(1 << (FILTER_BITS - 6)).join(marked, "id", "left")
    dense = F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0)).alias("b")))), lambda w: w["b"])
    return common.stage(every.agg(dense.alias("bits")), "bitmap").scalar()


def _may_be_in(value: Column, bitmap: Column) -> Column:
    """False: the hash is not marked."""
    word, bit = _slot(value)
    return F.call_function("shiftright", F.element_at(bitmap, (word + 1).cast("int")), bit).bitwiseAND(F.lit(1)) == 1


def _member_keys(lines: DataFrame, threshold: int, least: int) -> DataFrame:
    """(_h, _g, key, at): the keys of every different line; ``at`` is their number in segment_places(). Copies are dropped before the shuffle."""
    long_enough = lines.select("_h", "_g", "line", F.length("line").alias("_n")).where(F.col("_n") >= max(least, threshold + 1))
    made = segment_keys(F.col("line"), F.col("_n"), threshold)
    # Keys are computed as columns, with their common parts once, and only then become rows.
    wide = long_enough.select("_h", "_g", *[key.alias(f"_k{at}") for at, key in enumerate(made)])
    rows = F.explode(F.array(*[F.struct(F.col(f"_k{at}").alias("key"), F.lit(at).cast("tinyint").alias("at")) for at in range(len(made))]))
    return wide.select("_h", "_g", rows.alias("k")).select("_h", "_g", "k.key", "k.at").where("key is not null").distinct()


def _later_of_pairs(keys: DataFrame, texts: DataFrame, probes: list[int], threshold: int) -> DataFrame:
    """Lines that an earlier one of the same key is near, compared pair by pair: for keys of few members."""
    probe = F.col("at").isin(probes)
    one, two = (keys.select("key", F.struct("_h", "_g").alias(side), probe.alias(f"_{side}")) for side in "ab")
    meeting = one.join(two.where("not _b").drop("_b"), "key").where("if(_a, a != b, a < b)")
    pairs = common.stage(meeting.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    first, second = (texts.select(F.struct("_h", "_g").alias(side), F.col("line").alias(f"x{side}"), F.col("first").alias(f"f{side}")) for side in "ab")
    near = pairs.join(first, "a").join(second, "b").where(_within("xa", "xb", threshold))
    return near.select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("l")).select("l._h", "l._g")


def _later_of_omissions(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines that an earlier one of the same key is one edit from, without pairs: for keys of many members, threshold 1.

    Lines of a key agree on its segment, so the edit is outside. Each member is written with one
    character left out, for every place outside. Members of one length whose
    omissions are equal at one place are one replacement apart; a probing member (longer by
    one) whose omission equals another whole member is one insertion apart. So a group of equal texts
    needs its least places only: of omissions at one place, and of whole lines against
    omissions. Groups are bounded by the alphabet, rows by members times their length.

    A line of n characters is cut into blocks of about their square root, and an omission is
    hashed as its block between the hashes of the blocks around it: n^1.5 work in all.
    """
    places = segment_places(F.length("line"), 1)
    taken = [F.struct(start.alias("lo"), (start + size).alias("hi"), F.lit(not probe).alias("whole"), (F.length("line") - int(probe)).alias("n")) for _, _, start, size, probe in places]
    held = keys.join(texts, ["_h", "_g"]).withColumn("_s", F.element_at(F.array(*taken), F.col("at").cast("int") + 1))
    # n: length without the character that a longer member leaves out; blocks behind it stand one place later there.
    cut = held.select("_h", "_g", "first", "line", "_s.*").withColumn("late", F.expr("if(whole, 0, 1)")).withColumn("size", F.expr("cast(ceil(sqrt(n)) as int)")).withColumn("blocks", F.expr("cast(ceil(n / size) as int)"))
    # The hashes of all blocks are bound to a name, so that they are made once a member.
    parts = """transform(array(struct(
        transform(sequence(0, blocks - 1), b -> md5(cast(substring(line, b * size + 1, size) as binary))) as unmoved,
        transform(sequence(0, blocks - 1), b -> if(whole, '', md5(cast(substring(line, b * size + 2, size) as binary)))) as moved)), h ->
        transform(sequence(0, blocks - 1), b -> struct(b, substring(line, b * size + 1, size + late) as text,
            md5(cast(array_join(slice(h.unmoved, 1, b), '') as binary)) as before,
            md5(cast(array_join(slice(if(whole, h.unmoved, h.moved), b + 2, blocks), '') as binary)) as behind)))"""
    block = F.expr(f"explode(flatten({parts}))")
    by_block = cut.select("_h", "_g", "first", "whole", "lo", "hi", "size", "blocks", F.expr("n + late").alias("length"), block.alias("k")).select("*", "k.*").drop("k")
    # place: where a member of the key's own length leaves a character out; below 0, by block: insertions.
    left_out = """transform(
        filter(sequence(b * size, if(b + 1 = blocks, length, (b + 1) * size) - 1), p -> p < lo or p >= hi),
        p -> struct(if(whole, p, -1 - b) as place, concat(substring(text, 1, p - b * size), substring(text, p - b * size + 2, size)) as text))"""
    itself = "if(whole, array(struct(-1 - b as place, text)), cast(array() as array<struct<place:int,text:string>>))"
    rows = by_block.select("_h", "_g", "first", "whole", "before", "behind", F.expr(f"explode(concat({left_out}, {itself}))").alias("o"))
    marked = rows.select("_h", "_g", "first", "whole", "o.place", F.xxhash64("before", "o.text", "behind").alias("_x"), F.xxhash64(F.lit(1), "before", "o.text", "behind").alias("_y"))
    group = Window.partitionBy("place", "_x", "_y")
    least_whole, least_longer = (F.min(F.when(side, F.col("first"))).over(group) for side in (F.col("whole"), ~F.col("whole")))
    opposite = F.when((F.col("place") >= 0) | ~F.col("whole"), F.col("_w")).otherwise(F.col("_l"))
    return marked.withColumns({"_w": least_whole, "_l": least_longer}).where(opposite < F.col("first")).select("_h", "_g")


def later_lines(lines: DataFrame, firsts: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_CHARS) -> DataFrame:
    """(_h, _g) of the lines that differ from an earlier line by 1 to ``threshold`` edits.

    Keys that one line has are dropped. Those of up to FEW lines give pairs; those of more are
    compared by omissions, so rows grow with the lines and not with their square. (A threshold
    over 1 has pairs for all keys.)
    """
    keys = common.stage(_member_keys(lines, threshold, least), "keys")
    probes = [at for at, place in enumerate(segment_places(F.lit(0), threshold)) if place[-1]]
    members = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_members"), F.count_if(~F.col("at").isin(probes)).alias("_own"))
    shared = common.stage(members.where("_members > 1 and _own > 0").drop("_own"), "shared")
    # Few keys have two lines: the rest of the keys, and then of the lines, go before the shuffles.
    met = common.stage(keys.where(_may_be_in(F.col("key"), _bitmap(shared, "key"))).join(shared, "key"), "met")
    wanted = common.stage(met.select("_h", "_g").distinct(), "wanted")
    may_be = _may_be_in(F.col("_h"), _bitmap(wanted, "_h"))
    likely = lines.select("_h", "_g", "line").where(may_be)
    found = likely.join(wanted, ["_h", "_g"], "left_semi").dropDuplicates(["_h", "_g"])
    texts = common.stage(found.join(firsts.where(may_be), ["_h", "_g"]), "texts")
    few = F.lit(True) if threshold != 1 else F.col("_members") <= FEW
    later = _later_of_pairs(met.where(few), texts, probes, threshold)
    if threshold == 1:
        later = later.unionByName(_later_of_omissions(met.where(~few), texts))
    return later.distinct()


def repeated_lines(docs: DataFrame, text: str = "text", threshold: int = THRESHOLD, least: int = LEAST_CHARS) -> DataFrame:
    """(_id, _row, _line) of every line that an earlier line (by doc_id, then place) equals or is within the threshold of.

    Lines are judged on the input: a removed line still repeats later ones. A row
    without doc_id counts as the last. Blanks at a line's ends do not count; empty lines
    are never repeats.
    """
    lines = lines_of(docs, text)
    hashed = _hashed(lines)
    place = F.struct("_id", "_row", "_line")
    firsts = common.stage(hashed.groupBy("_h", "_g").agg(F.min(place).alias("first")), "firsts")
    later = common.stage(later_lines(hashed, firsts, threshold, least), "near").withColumn("near", F.lit(True))
    known = firsts.join(later, ["_h", "_g"], "left").select("_h", "_g", "first", F.coalesce("near", F.lit(False)).alias("near"))
    placed = hashed.select("_id", "_row", "_line", "_h", "_g").join(known, ["_h", "_g"])
    return placed.where((F.struct("_id", "_row", "_line") > F.col("first")) | F.col("near")).select("_id", "_row", "_line")


def remove_lines(docs: DataFrame, text: str = "text", threshold: int = THRESHOLD, least: int = LEAST_CHARS) -> DataFrame:
    """The columns of ``docs``, repeated lines cut from ``text``, with ``n_lines`` and ``n_removed``.

    A text without repeats is returned as it is, a null text as null with 0 lines.
    Columns with the names of the new ones are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = repeated_lines(docs, text, threshold, least).groupBy("_id", "_row").agg(F.sort_array(F.collect_set("_line")).alias("_gone"))
    keyed = docs.select(*names, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"), F.xxhash64(F.col(text)).alias("_row"))
    joined = keyed.join(common.stage(gone, "gone"), ["_id", "_row"], "left")
    parts = F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(parts, lambda line, i: ~F.array_contains("_gone", i)), "\n")
    out = {n: F.col(n) for n in names} | {text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept)}
    count = F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long")
    return joined.select(*[c.alias(n) for n, c in out.items()], count.alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))


ORACLE = f"""
with lines as (
  select doc_id, generate_subscripts(parts, 1) - 1 as line_no, trim(unnest(parts), ' \t\r') as line
  from (select doc_id, string_split(text, chr(10)) as parts from documents where text is not null)),
full_lines as (select * from lines where line != ''),
firsts as (select line, min((doc_id, line_no)) as first, length(line) as n from full_lines group by line),
near as (
  select distinct case when a.first < b.first then b.line else a.line end as line
  from firsts a join firsts b on b.n between a.n and a.n + {THRESHOLD} and a.line != b.line
  where a.n >= {LEAST_CHARS} and levenshtein(a.line, b.line) <= {THRESHOLD}),
gone as (
  select l.doc_id, l.line_no from full_lines l join firsts f on l.line = f.line
  where (l.doc_id, l.line_no) > f.first or l.line in (select line from near)),
counted as (select doc_id, count(*) as n_removed, string_agg(line_no::varchar, ',' order by line_no) as removed from gone group by doc_id)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines, coalesce(c.n_removed, 0)::bigint as n_removed, coalesce(c.removed, '') as removed
from documents d left join counted c using (doc_id)
"""


@common.query(ORACLE)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines of all documents: how many, and which by number."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = repeated_lines(docs).groupBy("_id", "_row").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_set("_line")), lambda i: i.cast("string")), ",").alias("removed"))
    counted = docs.select("doc_id", F.xxhash64("text").alias("_row"), F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    keyed = counted.withColumn("_id", F.coalesce("doc_id", F.lit(LAST_ID)))
    return keyed.join(gone, ["_id", "_row"], "left").select("doc_id", "n_lines", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", F.lit("")).alias("removed"))
