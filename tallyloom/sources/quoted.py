"""Records of delimited files whose quoted cells hold line breaks (S1), put together across the splits of a file.

Whether a line starts inside a quoted cell depends on all lines before it. Lines are gathered to runs of a bounded number, in the
tasks that read them, and runs are the rows from there on. Each run is a function of that one bit (it stays, is closed, is opened
or swaps); the runs of a file are composed by a window of a narrow row a run. Then a run's text is cut into its records by one
pattern, in place; records over several runs, two parts a run at most, meet by file. No line is shuffled or sorted by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import staged

# A cell is quoted where it starts with a quote; what follows its closing quote, and quotes in bare cells, are plain text.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_BARE = r'[^",\n][^,\n]*+|'
_CELLS = rf'(?:(?:"{_INSIDE}"[^,\n]*+|{_BARE})[,\n])*+'
_OPEN_AFTER_CLOSED = rf'^{_CELLS}"{_INSIDE}\z'
_OPEN_AFTER_OPEN = rf'^{_INSIDE}(?:\z|"[^,\n]*+[,\n]{_CELLS}"{_INSIDE}\z)'
# A record up to its line feed, or to the end of the text where a quoted cell stays open.
_CELL = rf'(?:"{_INSIDE}(?:"[^,\n]*+|\z)|{_BARE})'
_RECORD = rf'\G(?!\z)({_CELL}(?:,{_CELL})*+)(?:\n|\z)'
# A run has up to 2^13 lines; while it is gathered Spark keeps 128 at most in a task's memory and sorts the rest.
_RUN_BITS = 13
# Lines from the beginning of a file whose numbers are exact.
_EXACT_LINES = 1 << 10
# Texts of runs are long: row groups of 16 MB, looked at after each row. Stored once and read a few times: the fastest codec.
_STORED = {"compression": "lz4_raw"}
_LONG_ROWS = _STORED | {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}


def with_quote_state(lines: DataFrame, text: str = "value") -> DataFrame:
    """Adds whether a quoted cell is open behind the text, a line or several, if none (``open0``) or one (``open1``) was before it."""
    bare = ~F.col(text).contains('"')
    return lines.withColumns({"open0": ~bare & F.col(text).rlike(_OPEN_AFTER_CLOSED), "open1": bare | F.col(text).rlike(_OPEN_AFTER_OPEN)})


def _composed(rows: DataFrame, window: Window, fixed: Column, flips: Column) -> DataFrame:
    """Composes functions of one bit in window order: ``base`` (null: the bit before the first) and ``odd``, whether it is flipped.

    ``fixed`` is the result of a constant function, else null; ``flips`` says whether any other one negates.
    """
    turned = rows.withColumns({"__fixed": fixed, "__turns": F.sum(F.when(fixed.isNull() & flips, 1).otherwise(0)).over(window)})
    at_fixed = F.last(F.when(F.col("__fixed").isNotNull(), F.col("__turns")), ignorenulls=True).over(window)
    base = F.last("__fixed", ignorenulls=True).over(window)
    odd = (F.col("__turns") - F.coalesce(at_fixed, F.lit(0))) % 2 == 1
    return turned.withColumns({"base": base, "odd": odd}).drop("__fixed", "__turns")


def _open(base: Column, start: Column, odd: Column) -> Column:
    return F.coalesce(base, start) != odd


def _splits(lines: DataFrame) -> DataFrame:
    """One row a split: its last line (``hi``), whether a cell is open before it (``start``) and behind it (``ends_open``), and whether all lines are records (``plain``).

    A file that ends inside a quoted cell raises.
    """
    key, files = ["file", "block"], Window.partitionBy("file").orderBy("block")
    constant, no = F.col("open0") == F.col("open1"), F.col("line_no")
    marks = lines.groupBy(*key).agg(
        F.max("line_no").alias("hi"),
        F.max(F.when(constant & F.col("open0"), no)).alias("opened"),
        F.max(F.when(constant & ~F.col("open0"), no)).alias("closed"),
        F.count_if(F.col("open0")).alias("opening"),
    ).withColumn("at", F.greatest("opened", "closed"))
    swaps = lines.filter("open0 AND NOT open1").select(*key, "line_no").join(marks.select(*key, "at"), key)
    swaps = swaps.filter(F.col("at").isNull() | (no > F.col("at"))).groupBy(*key).agg(F.count(F.lit(1)).alias("swaps"))
    own = F.when(F.col("at").isNotNull(), F.col("at").eqNullSafe(F.col("opened")))
    odd = F.coalesce(F.col("swaps"), F.lit(0)) % 2 == 1
    ends = _composed(marks.join(swaps, key, "left").withColumns({"own": own, "swapped": odd}), files, F.when(F.col("own").isNotNull(), F.col("own") != F.col("swapped")), F.col("swapped"))
    ends = ends.withColumn("ends_open", _open(F.col("base"), F.lit(False), F.col("odd")))
    unclosed = F.raise_error(F.concat(F.lit("a quoted cell is not closed in "), F.col("file")))
    start = F.when(F.lead("block").over(files).isNull() & F.col("ends_open"), unclosed.cast("boolean")).otherwise(F.lag("ends_open", 1, False).over(files))
    whole = ends.withColumn("start", start)
    return whole.select(*key, "hi", "start", "ends_open", (~F.col("start") & (F.col("opening") == 0)).alias("plain"))


def _with_record(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Adds ``rec``, the first line of a line's record in its split; null where the record starts in an earlier split."""
    here = Window.partitionBy("file", "block").orderBy("line_no")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.when(F.col("open0") & ~F.col("open1"), 1).otherwise(0)
    turned = lines.join(splits.filter("NOT plain").drop("plain"), ["file", "block"]).withColumn("odd", F.coalesce(F.sum(swap).over(before), F.lit(0)) % 2 == 1)
    # A constant line's result, less the swaps before it.
    fixed = F.when(F.col("open0") == F.col("open1"), F.col("open0") != F.col("odd"))
    base = F.last(fixed, ignorenulls=True).over(before)
    inside = turned.withColumn("inside", _open(base, F.col("start"), F.col("odd")))
    return inside.withColumn("rec", F.last(F.when(~F.col("inside"), F.col("line_no")), ignorenulls=True).over(here))


def _parts(placed: DataFrame, *more: Column) -> DataFrame:
    """One row a record and split: its lines ``first`` to ``last``; ``broken`` where other splits hold more of it."""
    key = ["file", "block", "rec"]
    parts = placed.groupBy(*key).agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"), F.max((F.col("line_no") == F.col("hi")) & F.col("ends_open")).alias("goes_on"), *more)
    return parts.withColumn("broken", F.col("rec").isNull() | F.col("goes_on")).drop("goes_on")


def _with_start(parts: DataFrame) -> DataFrame:
    """Adds the place of a broken part's first line (rec_block, rec_line). A file has two such parts a split at most."""
    files = Window.partitionBy("file").orderBy("block", "first")
    opener = F.when(F.col("rec").isNotNull(), F.struct(F.col("block").alias("b"), F.col("rec").alias("l")))
    places = parts.select("file", "block", "first", "rec").withColumn("__at", F.last(opener, ignorenulls=True).over(files))
    return parts.join(places.select("file", "block", "first", F.col("__at.b").alias("rec_block"), F.col("__at.l").alias("rec_line")), ["file", "block", "first"])


def broken_spans(lines: DataFrame) -> DataFrame:
    """Line ranges (file, block, first, last) that belong to one record, with the place of its first line (rec_block, rec_line).

    ``lines`` has file, block (start of the split), line_no (growing inside a split), open0 and open1. A
    file that ends inside a quoted cell raises.
    """
    names = ["file", "block", "first", "last", "rec_block", "rec_line"]
    parts = _parts(_with_record(lines.select("file", "block", "line_no", "open0", "open1"), _splits(lines)))
    inner = parts.filter("NOT broken AND last > first").withColumns({"rec_block": F.col("block"), "rec_line": F.col("rec")})
    return inner.select(*names).unionByName(_with_start(parts.filter("broken")).select(*names))


def _runs(lines: DataFrame) -> DataFrame:
    """One row a run of consecutive lines of a split: its first line's place, its lines joined by line feeds, their number."""
    runs = lines.groupBy("file", "block", F.shiftright("line_no", _RUN_BITS).alias("__run")).agg(F.collect_list("line_no").alias("nos"), F.collect_list("value").alias("values"))
    # Both lists have one order, that of the file but where Spark sorted by key.
    in_order = F.when(F.col("nos") == F.sort_array("nos"), F.col("values")).otherwise(F.sort_array(F.arrays_zip("nos", "values"))["values"])
    # A path as _metadata.file_path has it.
    path = F.regexp_replace("file", "^file:///", "file:/").alias("file")
    runs = runs.select(path, "block", F.array_min("nos").alias("line_no"), F.size("nos").alias("lines"), F.array_join(in_order, "\n").alias("text"))
    return with_quote_state(runs, "text").withColumn("run", F.monotonically_increasing_id())


def _run_states(runs: DataFrame) -> DataFrame:
    """By run: whether a cell is open before (``start``) and behind it (``ends_open``), whether it is ``near`` the beginning of its file, a number of the file.

    A file that ends inside a quoted cell raises.
    """
    files = Window.partitionBy("file").orderBy("block", "line_no")
    ends = _composed(runs.select("file", "block", "line_no", "run", "open0", "open1"), files, F.when(F.col("open0") == F.col("open1"), F.col("open0")), F.col("open0"))
    near = (F.first("block").over(files) == F.col("block")) & (F.col("line_no") - F.first("line_no").over(files) < _EXACT_LINES)
    ends = ends.withColumns({"ends_open": _open(F.col("base"), F.lit(False), F.col("odd")), "near": near, "file_no": F.first("run").over(files)})
    unclosed = F.raise_error(F.concat(F.lit("a quoted cell is not closed in "), F.col("file")))
    start = F.when(F.lead("block").over(files).isNull() & F.col("ends_open"), unclosed.cast("boolean")).otherwise(F.lag("ends_open", 1, False).over(files))
    return ends.withColumn("start", start).select("run", "start", "ends_open", "near", "file_no", F.when(F.col("run") == F.col("file_no"), F.col("file")).alias("path"))


def _cut(runs: DataFrame, states: DataFrame) -> DataFrame:
    """One row a record or part of one: its place and text, whether other runs hold more of it (``broken``), whether it starts here (``opens``). ``file`` is a number."""
    # A run that starts inside a cell is read as if that cell started with it.
    text = F.concat(F.when(F.col("start"), '"').otherwise(""), "text", F.lit("\n"))
    cut = runs.drop("file").join(states.drop("path"), "run").withColumn("__cut", F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1)))
    # Lines before a record: exact near the beginning of a file, elsewhere it is enough that they grow.
    breaks = lambda t: F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    before = F.aggregate(F.slice("__cut", 1, _EXACT_LINES), F.array(F.lit(0)), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + breaks(t) + 1)))
    cut = cut.withColumns({"size": F.size("__cut"), "before": F.when(F.col("near") & (F.size("__cut") < F.col("lines")), before)})
    rows = cut.select("file_no", "block", "line_no", "start", "ends_open", "size", "before", F.posexplode("__cut").alias("at", "value"))
    lead, tail = F.col("start") & (F.col("at") == 0), F.col("ends_open") & (F.col("at") == F.col("size") - 1)
    beyond = F.element_at("before", -1) + F.col("at") - F.size("before") + 1
    first = F.col("line_no") + F.when(F.col("before").isNull(), F.col("at")).otherwise(F.coalesce(F.get("before", F.col("at")), beyond))
    skipped = F.when(lead, 1).otherwise(0)
    value = F.col("value").substr(skipped + 1, F.length("value") - skipped - F.when(tail, 1).otherwise(0))
    return rows.select(F.col("file_no").alias("file"), "block", first.alias("first"), (~lead).alias("opens"), (lead | tail).alias("broken"), F.when(lead | tail, value).otherwise(F.col("value")).alias("value"))


def whole_records(lines: DataFrame) -> DataFrame:
    """One row a record, as (file, block, line_no, value): its first line's place, its lines joined by line feeds.

    ``lines`` has file, block (start of the split), line_no (growing inside a split) and value, and is read once: runs of lines and records
    are stored. ``line_no`` of a record is that of its first line within the first 1,024 lines of a file; further on it grows with the place.
    """
    runs = staged(_runs(lines), "report-lines", _LONG_ROWS)
    states = staged(_run_states(runs), "quoted-splits")
    files = staged(states.filter("path IS NOT NULL").select(F.col("file_no").alias("file"), "path"), "quoted-records-files")
    parts = staged(_cut(runs, states), "quoted-records", _STORED)
    single = parts.filter("NOT broken").select("file", "block", F.col("first").alias("line_no"), "value")
    pieces = parts.filter("broken").withColumn("rec", F.when(F.col("opens"), F.col("first")))
    text = F.array_join(F.sort_array(F.collect_list(F.struct("block", "first", "value")))["value"], "\n").alias("value")
    many = _with_start(pieces).groupBy("file", "rec_block", "rec_line").agg(text)
    many = staged(many.select("file", F.col("rec_block").alias("block"), F.col("rec_line").alias("line_no"), "value"), "quoted-records")
    return single.unionByName(many).join(files, "file").select(F.col("path").alias("file"), "block", "line_no", "value")
