"""Secret scans in DataFrame functions only: fixed patterns and a battery of randomness tests.

Fixed kinds are found by pattern. The kind ``random`` is found by tests: every
long run of key-like characters gets an inferred encoding, and three statistics
are held against what ordinary text of that length would show: the chi-squared
measure of a uniform alphabet (as index of coincidence), the number of runs of
one character class, and the serial correlation of neighbours. The combined
p-values of all runs of the corpus go through false-discovery control per length class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common

# The patterns of the base kinds, in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ["assign", "access", "hex", "random"]

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
FALSE_DISCOVERY = 0.01
# Smallest length of each class; a class has its own false-discovery control.
LENGTH_CLASSES = [20, 24, 32, 48, 64]
# Index of coincidence of natural text and the sum of its cubed letter shares (fixed values of the null model).
TEXT_IC, TEXT_CUBES = 0.065, 0.0055
# Share of neighbours of different class (lower, upper, digit, other) in ordinary names and words.
TEXT_CHANGES = 0.12
# Correlation of neighbouring letters' vowel marks in ordinary text.
TEXT_SERIAL, SERIAL_FLOOR = -0.35, 1e-9
GRID = 10  # cells per decade of p
DEEPEST = 300


def _none() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def match_spans(text: Column, pattern: str, kind: int, values: Column | None = None, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, kind, end>> in code points.

    ``split`` gives what lies between the matches, so the places are running sums of lengths.
    ``values``: only matches whose value at the same position has ``least`` characters are kept.
    Sums run in blocks of about the square root of the matches, then over blocks, as appending to one array copies it each time.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    sizes = F.zip_with(F.transform(F.slice(between, F.lit(1), F.size(found)), F.length), F.transform(found, F.length), lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))
    start = F.struct(F.lit(0).alias("at"), _none().alias("out"))
    blocks_start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,kind:int,end:int>>>").alias("out"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + piece["size"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def behind(state: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), s["kind"].alias("kind"), (s["end"] + state["at"]).alias("end")))
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

    def summed(pieces: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(pieces))).cast("int"), F.lit(1))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), width)
        blocks = F.transform(firsts, lambda first: F.aggregate(F.slice(pieces, first, width), start, step))
        return F.flatten(F.aggregate(blocks, blocks_start, behind, lambda x: x["out"]))

    # One-item array: the pieces are made once, not once a block.
    spans = F.get(F.transform(F.array(sizes), summed), F.lit(0))
    if values is None:
        return spans
    long_enough = F.zip_with(spans, values, lambda s, v: F.struct(s.alias("s"), F.length(v).alias("n")))
    return F.transform(F.filter(long_enough, lambda x: x["n"] >= least), lambda x: x["s"])


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the fixed kinds. A cheap necessary test spares most texts the pattern."""
    low = F.lower(text)
    hints = (F.contains(low, F.lit("passw")) | F.contains(low, F.lit("secret")) | F.contains(low, F.lit("token")) | F.contains(low, F.lit("api"))) & (F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")))
    assign = match_spans(text, ASSIGN, 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), LEAST_VALUE)
    return {
        "assign": F.when(hints, assign).otherwise(_none()),
        "access": F.when(F.contains(text, F.lit("AKIA")), match_spans(text, ACCESS, 1)).otherwise(_none()),
        "hex": F.when(text.rlike(HEX), match_spans(text, HEX, 2)).otherwise(_none()),
    }


def _phi(z: Column) -> Column:
    """Standard normal distribution function (logistic form, error below 2e-4 and monotone)."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.070566 * z * z * z)))


def encoding(run: Column) -> Column:
    """Number of symbols of the smallest encoding that has all of the run's characters; 0 where the run is of one letter case or of digits alone."""
    return (
        F.when(run.rlike("^[0-9]+$"), 0)
        .when(run.rlike("^[0-9a-f]+$") | run.rlike("^[0-9A-F]+$"), 16)
        .when(run.rlike("^([a-z_/-]+|[A-Z]?[a-z_/-]+|[A-Z_/-]+)$"), 0)
        .when(run.rlike("^[A-Z2-7]+$"), 32)
        .when(run.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), 36)
        .when(run.rlike("^[A-Za-z0-9]+$"), 62)
        .otherwise(64)
    )


def log_p(run: Column) -> Column:
    """-log10 of the combined p-value that ordinary text would look as random as this run; null where no encoding is inferred."""
    n = F.length(run).cast("double")
    symbols = encoding(run)
    chars = F.filter(F.split(run, ""), lambda c: c != "")
    squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda total, c: total + F.pow((F.length(run) - F.length(F.replace(run, c, F.lit("")))).cast("double"), F.lit(2.0)))
    ic = (squares - n) / (n * (n - 1))
    # Chi-squared over n is (symbols * sum of squared shares - 1): the same statistic on another scale.
    spread = F.sqrt(4 * (TEXT_CUBES - TEXT_IC**2) / n + 2 * TEXT_IC * (1 - TEXT_IC) / (n * (n - 1)))
    uniform = (F.lit(TEXT_IC) - ic) / spread
    classes = F.translate(run, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-", "a" * 26 + "A" * 26 + "0" * 10 + "++++")
    changes = F.length(F.regexp_replace(classes, r"(.)\1*", "$1")).cast("double") - 1
    mean = TEXT_CHANGES * (n - 1)
    runs = (changes - mean) / F.sqrt(mean * (1 - TEXT_CHANGES))
    vowels = F.transform(chars, lambda c: F.when(F.lower(c).isin("a", "e", "i", "o", "u", "y"), 1.0).otherwise(0.0))
    share = F.aggregate(vowels, F.lit(0.0), lambda t, v: t + v) / n
    pairs = F.zip_with(F.slice(vowels, F.lit(1), F.size(vowels) - 1), F.slice(vowels, F.lit(2), F.size(vowels) - 1), lambda a, b: (a - share) * (b - share))
    serial = F.aggregate(pairs, F.lit(0.0), lambda t, v: t + v) / F.greatest(share * (1 - share) * n, F.lit(SERIAL_FLOOR))
    order = (serial - TEXT_SERIAL) * F.sqrt(n) / 2
    z = (uniform + runs + 0.5 * F.least(order, F.lit(3.0))) / (2.25**0.5)
    value = -F.log10(F.greatest(_phi(-z), F.lit(10.0 ** (-DEEPEST / GRID))))
    return F.when(symbols > 0, value)


def candidates(text: Column) -> Column:
    """array<struct<start, kind, end, length class, cell>> of the runs that have an inferred encoding; cell: GRID times -log10 p, rounded down."""
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    spans = match_spans(text, CANDIDATE, 3)
    size_class = lambda n: sum((F.when(n >= least, 1).otherwise(0) for least in LENGTH_CLASSES[1:]), F.lit(0))
    tested = F.zip_with(
        spans,
        found,
        lambda s, run: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), size_class(F.length(run)).alias("size_class"), F.floor(log_p(run) * GRID).cast("int").alias("cell")),
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,size_class:int,cell:int>>")
    return F.when(text.rlike(CANDIDATE), F.filter(tested, lambda t: t["cell"].isNotNull())).otherwise(empty)


def discovery_cells(tested: DataFrame, rate: float = FALSE_DISCOVERY) -> dict[int, int]:
    """Lowest cell of each length class at which the step-up rule keeps the false-discovery rate.

    Runs are counted per class and cell first, so at most classes x cells rows are
    ranked, whatever the corpus holds; p-values are rounded up to their cell's
    border, which errs on the safe side.
    """
    cells = tested.select(F.explode("_tested").alias("t")).groupBy("t.size_class", "t.cell").agg(F.count("*").alias("n"))
    deeper = Window.partitionBy("size_class").orderBy(F.desc("cell"))
    ranked = cells.withColumn("beyond", F.sum("n").over(deeper)).withColumn("all", F.sum("n").over(Window.partitionBy("size_class")))
    kept = ranked.where(F.pow(F.lit(10.0), -F.col("cell") / GRID) * F.col("all") <= rate * F.col("beyond"))
    return {r["size_class"]: r["low"] for r in kept.groupBy("size_class").agg(F.min("cell").alias("low")).collect()}


def scan(docs: DataFrame, text: str = "text", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """The columns of ``docs`` with ``_assign``, ``_access``, ``_hex``, ``_random``: arrays of (start, kind, end) over each whole text.

    Null counts as empty. Base spans are never changed by the tests. Columns of those names are replaced.
    Two passes over the text, no shuffle of it: one counts p-values, one marks.
    """
    docs = docs.drop("_assign", "_access", "_hex", "_random", "_tested")
    whole = F.coalesce(F.col(text), F.lit(""))
    limits = discovery_cells(docs.select(candidates(whole).alias("_tested")), rate)
    if limits:
        levels = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        random = F.transform(
            F.filter(candidates(whole), lambda t: t["cell"] >= F.element_at(levels, t["size_class"])),
            lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")),
        )
    else:
        random = _none()
    return docs.select("*", *[c.alias(f"_{k}") for k, c in base_spans(whole).items()], random.alias("_random"))


def digest(*arrays: str) -> Column:
    """Spans as kind:start:end, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.concat(*arrays))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


@common.query()
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(digest("_assign", "_access", "_hex").cast("binary"), 256).alias("base_sha256"),
        digest("_assign", "_access", "_hex", "_random").alias("spans"),
    )
