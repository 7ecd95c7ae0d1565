"""Phrase collocation mining on sorted count streams.

Counts grow level by level: words, pairs of frequent words, triples of frequent
pairs are counted by hash, which rules out rare ones, and then the longest windows
left are counted as they are. No phrase is more frequent than its parts, and no
hash less than its phrases, so no frequent one is lost. They form one stream of counts. It is laid out twice, in prefix order (word by word from the left) and
in suffix order (from the right), each cut into ranges over tasks. In prefix order
the parts that a phrase starts with stand before it and its extensions to the
right behind it, so one pass in lockstep over the nested phrases, holding four
rows, finds the left counts and the most frequent extension; suffix order gives
the right counts and the extensions to the left. Nothing is looked up by hash.
Phrases that reach into a range from earlier ones are the prefixes of its first
phrase, at most three a range; their counts are handed to the range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyloom.llm import common, words
from tallyloom.llm.words import mix

LONGEST = 4
LEAST = 30
# A candidate goes if a longer one has this share of its count, as a fraction of whole numbers.
ABSORBED = (4, 5)
SCALE = 2_000_000
TOP = 2_000
NO_LANGUAGE = "und"
# Bytes of one text that are counted at a time.
STRETCH = 1 << 22
# Bits of a hash that is counted: fewer make smaller rows, and only rule out less where they coincide.
HASH_BITS = 32
_KEPT = np.uint64((1 << HASH_BITS) - 1)
# Bytes that end a piece, and those that end a word.
_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANKS = _BREAKS.copy()
_BLANKS[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
COUNTED = "lang string, phrase string, n long"


@dataclass
class Tokens:
    """Words of a few texts in reading order, lower-cased (A-Z)."""

    hashes: np.ndarray
    tongue: np.ndarray  # number of the language in ``names``
    names: pa.Array
    seeds: np.ndarray  # hash of the word's language
    joined: np.ndarray  # whether the next word is in the same piece of the same text
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    own: int  # words whose windows are counted here; the others begin the next stretch

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The words at these places."""
        sizes = self.ends[at] - self.starts[at]
        first = np.cumsum(sizes) - sizes
        letters = _LOWER[self.data[np.repeat(self.starts[at] - first, sizes) + np.arange(int(sizes.sum()))]]
        return common.binaries(letters, sizes).cast(pa.string())


def _stretches(data: np.ndarray, offsets: np.ndarray, spare: int) -> Iterator[tuple[np.ndarray, tuple, int]]:
    """Bytes, their words, and how many of these begin a window here. One long text comes in stretches that share ``spare`` words."""
    lo, size = 0, STRETCH if len(offsets) == 2 else len(data)
    while lo + size < len(data):
        blanks = np.flatnonzero(_BLANKS[data[lo + size : lo + 2 * size]])
        part = data[lo : lo + size + int(blanks[0])] if len(blanks) else data[:0]
        found = words.words(part, np.array([0, len(part)]), lower=True, blank=_BLANKS)
        if len(found[0]) <= spare:
            size *= 2
            continue
        own = len(found[0]) - spare
        yield part, found, own
        lo, size = lo + int(found[2][own]), STRETCH
    rest = data[lo:]
    found = words.words(rest, offsets if not lo else np.array([0, len(rest)]), lower=True, blank=_BLANKS)
    yield rest, found, len(found[0])


def tokens(text: pa.Array, lang: pa.Array, spare: int) -> Iterator[Tokens]:
    """Words of batches of texts; a word's hash depends on its bytes only."""
    names = pc.fill_null(lang, NO_LANGUAGE).cast(pa.string()).dictionary_encode()
    names_of = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    seeds = np.array([xxhash.xxh3_64_intdigest(name) for name in names.dictionary.to_pylist()], _U)
    for lo, hi, whole, offsets in words.pieces(text):
        for data, (hashes, counts, starts, ends), own in _stretches(whole, offsets, spare):
            owner = np.repeat(np.arange(hi - lo), counts)
            broken = np.cumsum(_BREAKS[data], dtype=np.int32)
            joined = np.zeros(len(hashes), bool)
            joined[:-1] = (owner[:-1] == owner[1:]) & (broken[ends[:-1] - 1] == broken[starts[1:]])
            tongue = names_of[lo:hi][owner]
            yield Tokens(hashes, tongue, names.dictionary, seeds[tongue], joined, starts, ends, data, own)


def chains(found: Tokens, filters: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per level 1, 2, ...: the hash of (language, words) of the window at each word, and whether it counts.

    ``filters`` mark the frequent hashes of the first levels; one level more is given. A window counts
    if it is marked, or on the last level if both its windows of the level before do.
    """
    h = found.hashes
    value, counts = mix(found.seeds + h), np.ones(len(h), bool)
    for level in range(len(filters) + 1):
        if level:
            counts = np.append(counts[:-1] & counts[1:] & found.joined[:-1], np.zeros(min(1, len(h)), bool))
            value = mix(value * _U(3) + np.append(h[level:], np.zeros(min(level, len(h)), _U)))
        if level < len(filters):
            counts = counts & common.bits_at(filters[level], value & _KEPT)
        yield value, counts


def _texts(batches: Iterator[pa.RecordBatch], filters: list[bytes]) -> Iterator[Tokens]:
    for batch in batches:
        yield from tokens(batch.column("text"), batch.column("lang"), len(filters))


def frequent_hashes(docs: DataFrame, least: int, filters: list[bytes]) -> bytes:
    """Bitmap of the hashes of the next level that occur ``least`` times. It has a fixed size; a full one prunes less and changes no result."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _texts(batches, sent.value):
            *_, (value, counts) = chains(found, sent.value)
            hashes, n = np.unique(value[: found.own][counts[: found.own]] & _KEPT, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["h", "n"])

    counted = docs.select("text", "lang").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return common.bitmap(counted.where(F.col("n") >= least), common.slot_of(F.col("h")))


def window_counts(docs: DataFrame, filters: list[bytes]) -> DataFrame:
    """(lang, phrase, n): the longest phrase that counts at each word, with its number; the empty phrase has the number of all words.

    Phrases are counted as text by Spark. Inside one batch of about half a MB, repeats of a phrase are
    first told by its 64-bit hash.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _texts(batches, sent.value):
            every = np.bincount(found.tongue[: found.own], minlength=len(found.names))
            yield pa.RecordBatch.from_arrays([found.names, pa.array([""] * len(found.names), pa.string()), pa.array(every)], ["lang", "phrase", "n"])
            length, last = np.zeros(len(found.hashes), np.int64), np.zeros(len(found.hashes), _U)
            for value, counts in chains(found, sent.value):
                length += counts
                last[counts] = value[counts]
            at = np.flatnonzero(length[: found.own])
            _, first, n = np.unique(last[at] + length[at].astype(_U), return_index=True, return_counts=True)
            at = at[first]
            for size in range(1, len(filters) + 2):
                some = length[at] == size
                parts = [found.spelled(at[some] + k) for k in range(size)]
                phrase = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
                yield pa.RecordBatch.from_arrays([found.names.take(pa.array(found.tongue[at[some]])), phrase, pa.array(n[some])], ["lang", "phrase", "n"])

    return docs.select("text", "lang").mapInArrow(count, COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of 1 to ``longest`` words that occur ``least`` times, and (lang, words), the number of all words."""
    filters: list[bytes] = []
    for _ in range(longest - 1):
        filters.append(frequent_hashes(docs, least, filters))
    windows = common.stage(window_counts(docs, filters), "windows")
    totals = windows.where("phrase = ''").select("lang", F.col("n").alias("words"))
    # A window counts for each phrase that it starts with.
    starts = F.expr("transform(sequence(1, size(split(phrase, ' '))), k -> substring_index(phrase, ' ', k))")
    counted = windows.where("phrase != ''").select("lang", F.explode(starts).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least), totals


def in_lockstep(stream: DataFrame, reverse: bool, parts: str, extension: str) -> DataFrame:
    """``stream`` with ``parts``, the counts of all phrases that each one starts with, shortest first, and ``extension``, the largest count of one that is a word longer.

    ``reverse``: read from the right, so that phrases end with their parts. (lang, phrase) is unique in ``stream``.
    """
    spark = stream.sparkSession
    names = ["lang", "phrase", "n", *[c for c in stream.columns if c not in ("lang", "phrase", "n")]]
    split = F.split("phrase", " ")
    ordered = stream.withColumn("_order", F.reverse(split) if reverse else split).repartitionByRange(common.partitions(spark), "lang", "_order")
    ranges = ordered.sortWithinPartitions("lang", "_order").select(*names, "_order", F.spark_partition_id().alias("_range"))
    # All may be null: rows of phrases from before a range hold no count.
    typed = [f"{n} {stream.schema[n].dataType.simpleString()}" for n in names]
    schema = StructType.fromDDL(", ".join([*typed, f"_range int, {parts} array<bigint>, {extension} bigint"]))
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Phrases that the current one starts with: [words, largest extension, row]. Those before the range have a row without a count.
        tongue, nested, out, fresh = None, [], [], True

        def close(key: tuple) -> None:
            while nested and key[: len(nested[-1][0])] != nested[-1][0]:
                _, largest, row = nested.pop()
                out.append([*row, largest])

        for batch in batches:
            rows = list(zip(*[batch.column(n).to_pylist() for n in names], strict=True))
            for row, key, at in zip(rows, map(tuple, batch.column("_order").to_pylist()), batch.column("_range").to_pylist(), strict=True):
                if fresh:
                    blank = [None] * (len(names) - 2)
                    nested += [[key[:k], 0, [row[0], " ".join(key[:k][::-1] if reverse else key[:k]), *blank, at, None]] for k in range(1, len(key))]
                elif row[0] != tongue:
                    close(())
                    nested.clear()
                tongue, fresh = row[0], False
                close(key)
                if nested and len(nested[-1][0]) == len(key) - 1:
                    nested[-1][1] = max(nested[-1][1], row[2])
                nested.append([key, 0, [*row, at, [entry[2][2] for entry in nested]]])
            yield _batch(out, arrow)
            out.clear()
        while nested:
            _, largest, row = nested.pop()
            out.append([*row, largest])
        yield _batch(out, arrow)

    scanned = common.stage(ranges.mapInArrow(scan, schema), "stream")
    # Beginnings of a range's first phrase that stand in earlier ranges: three rows a range at most.
    open_ = scanned.where("n is null").select("lang", "phrase", F.col("_range").alias("_at"), F.col(extension).alias("_more"))
    counts = scanned.where("n is not null").select("lang", "phrase", F.col("n").alias("_n")).join(F.broadcast(open_), ["lang", "phrase"])
    handed = common.stage(counts.select("lang", "phrase", "_at", "_n", "_more", (F.size(F.split("phrase", " ")) - 1).alias("_k")), "handed")
    by_range = handed.groupBy(F.col("_at").alias("_range")).agg(F.map_from_entries(F.collect_list(F.struct("_k", "_n"))).alias("_handed"))
    by_phrase = handed.groupBy("lang", "phrase").agg(F.max("_more").alias("_more"))
    whole = scanned.where("n is not null").join(F.broadcast(by_range), "_range", "left").join(F.broadcast(by_phrase), ["lang", "phrase"], "left")
    filled = F.transform(parts, lambda n, k: F.coalesce(n, F.try_element_at("_handed", k)))
    return whole.select(*names, filled.alias(parts), F.greatest(extension, F.coalesce("_more", F.lit(0))).alias(extension))


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate is a phrase of 2 to ``longest`` words in one piece of text that occurs
    ``least`` times, overlaps included. Its score is ``SCALE`` a / (l + r) for the cut where that is
    lowest (the first such). It goes if a longer candidate has four fifths of its count:
    as counts fall with length, one that is a word longer has them too. Null texts
    are empty, a null language counts as ``und``; repeated rows count each time; an empty table gives no rows.
    """
    if longest < 2:
        raise ValueError("phrases of two words at least")
    levels, totals = frequent_phrases(docs, least, longest)
    left = in_lockstep(levels, False, "left", "right_extension")
    both = in_lockstep(left, True, "right", "left_extension")
    kept = both.where(F.size(F.split("phrase", " ")) > 1).where(F.lit(ABSORBED[1]) * F.greatest("left_extension", "right_extension") < F.lit(ABSORBED[0]) * F.col("n"))
    # Cut k: the first k words and the rest; the products are exact decimals.
    cut = F.expr(
        f"transform(sequence(1, size(left)), k -> struct("
        f"cast({SCALE} as decimal(10,0)) * cast(n as decimal(20,0)) div cast(left[k - 1] + right[size(right) - k] as decimal(20,0)) as score, k, left[k - 1] as l, right[size(right) - k] as r))"
    )
    scored = kept.withColumn("_cut", F.array_min(cut)).select("lang", "phrase", F.col("n").alias("a"), F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("_cut.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each share first, so that no task ranks all phrases of a language.
    shares = common.partitions(docs.sparkSession)
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
    best = scored.withColumn("_n", F.row_number().over(share)).where(F.col("_n") <= top).drop("_n")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


ORACLE = f"""
with lowered as (select coalesce(lang, '{NO_LANGUAGE}') as lang, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from lowered),
worded as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w != '') as w from pieces),
placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from worded where len(w) > 0),
spans as (select lang, w, i, unnest(range(1, {LONGEST} + 1)) as k from placed),
counted as (
  select lang, w[i:i + k - 1] as p, count(*) as f from spans where i + k - 1 <= len(w) group by 1, 2),
totals as (select lang, sum(f)::bigint as n from counted where len(p) = 1 group by lang),
often as (select * from counted where f >= {LEAST}),
cuts as (select lang, p, f, unnest(range(1, len(p))) as k from often where len(p) > 1),
scored as (
  select c.lang, c.p, c.f as a, c.k, x.f as l, y.f as r, ({SCALE}::hugeint * c.f // (x.f + y.f))::bigint as score
  from cuts c join often x on x.lang = c.lang and x.p = c.p[1:c.k] join often y on y.lang = c.lang and y.p = c.p[c.k + 1:]),
lowest as (select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1),
inner_spans as (
  select lang, p, f, unnest(range(1, len(p) + 1)) as i from often where len(p) > 2),
inside as (
  select lang, p[i:i + k - 1] as q, max(f) as longer
  from (select *, unnest(range(2, len(p))) as k from inner_spans) where i + k - 1 <= len(p) group by 1, 2),
kept as (select s.* from lowest s left join inside i on i.lang = s.lang and i.q = s.p where i.longer is null or 100 * i.longer < 80 * s.a),
ranked as (
  select *, array_to_string(p, ' ') as phrase from kept)
select lang, rank, phrase, a, l, r, n, score from (
  select ranked.*, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from ranked) join totals using (lang)
where rank <= {TOP}
"""


@common.query(ORACLE)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to four words of each language of all documents."""
    common.small_batches(spark)
    return collocations(common.table(spark, sf_dir, "documents"))
