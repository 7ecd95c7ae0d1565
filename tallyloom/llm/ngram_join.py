"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its word shingles (64-bit tokens). Sets that link share
all but a quarter of their tokens, so if each side indexes enough of its first
tokens in one global order, a common signature is certain. The order is: tokens of one
document only, rare tokens, frequent tokens. The first can match nothing and are no signatures; a
document with enough of them is done. A rare token is a signature by itself. Frequent tokens are
dealt into small classes and only pairs of one class are signatures; the prefix is
extended for that: losing t tokens can spoil at most t tokens' worth, where a token of the
first kinds is worth one and the tokens of a class are worth their number less one.
Candidates that share a signature are verified exactly.

Equal sets collapse into one node first. Lists of nodes under a signature are worked
through components: each round verifies every member against one pivot, so a large group of
near copies costs its size, not its square; members whose components still differ
at the end are verified in blocks inside tasks where lists are long, and pair by pair
where they are short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common
from tallyloom.llm.graph import components
from tallyloom.llm.words import mix, pieces, shingle_sets

SHINGLE_WORDS = 5
# A token in at least so many documents is frequent; the choice moves work, never results.
FREQUENT = 24
# Bits of the two token bitmaps together with all partitions: 8 MB each, whatever the corpus. Slots that tokens share only move work.
TOKEN_BITS = 1 << 26
# Rounds of further pivots before the rest is verified.
PIVOT_ROUNDS = 1
# Open lists of so many members are compared in blocks of BLOCK sets inside tasks, without rows for pairs; shorter ones make at most 3 pairs a member.
HOT_LIST, BLOCK = 8, 256
_U = np.uint64


def node_ids(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64-bit id of each set; equal sets have equal ids, the empty set has 0."""
    out = np.zeros(len(counts), _U)
    full = np.flatnonzero(counts)
    if len(full):
        begins = (np.cumsum(counts) - counts)[full]
        out[full] = mix(np.add.reduceat(mix(tokens ^ _U(0xA0761D6478BD642F)), begins) + counts[full].astype(_U)) | _U(1)
    return out


def _level(n: int) -> int:
    """Floor of log4."""
    return (n.bit_length() - 1) // 2


def signatures(tokens: np.ndarray, shared: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Signatures of one set of ascending tokens (two at least) at three quarters' likeness.

    Sets of like size work in a common namespace: a power of four of the smaller
    set's size. The number of classes of a namespace is below three quarters of that power, which
    leaves every set enough worth (its size less the classes) for its prefix.
    """
    n = len(tokens)
    needed = n // 4 + 1 - int(n - shared.sum())
    if needed <= 0:
        return np.zeros(0, _U)
    rare, common_ones = tokens[shared & ~frequent], tokens[shared & frequent]
    out = []
    for level in range(_level(max(2, -(-3 * n // 4))), _level(n) + 1):
        salt = mix(np.array([level + 1], _U))[0]
        single = rare[:needed]
        out.append(mix(single ^ salt))
        missing = needed - len(single)
        if missing <= 0:
            continue
        classes = max(1, 4**level * 2 // 3)
        which = mix(common_ones ^ salt) % _U(classes)
        order = np.lexsort((common_ones, which))
        which, ordered = which[order], common_ones[order]
        worth = np.zeros(len(ordered), np.int64)
        worth[1:] = which[1:] == which[:-1]
        end = int(np.searchsorted(np.cumsum(worth), missing)) + 1
        which, ordered = which[:end], ordered[:end]
        begins = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
        sizes = np.diff(np.append(begins, len(which)))
        for size in np.unique(sizes[sizes > 1]):
            block = ordered[begins[sizes == size][:, None] + np.arange(size)]
            i, j = np.triu_indices(int(size), 1)
            out.append(mix(mix(block[:, i] ^ salt) + (block[:, j] ^ (salt >> _U(1)))).reshape(-1))
    return np.concatenate(out)


def _parts(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Partition of each key by its high bits, an order by partition, and the number of keys per partition."""
    part = ((keys >> _U(32)) % _U(parts)).astype(np.int64)
    return part, np.argsort(part, kind="stable"), np.bincount(part, minlength=parts)


class TokenClasses:
    """Whether tokens are shared (two documents have them) and frequent, as bitmaps that all partitions contribute their own stretch to."""

    def __init__(self, parts: int, shared: bytes, frequent: bytes):
        self.parts, self.shared, self.frequent = parts, shared, frequent

    @staticmethod
    def stretch(parts: int) -> int:
        return max(64, TOKEN_BITS // parts // 8 * 8)

    def of(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = _U(self.stretch(self.parts))
        slot = (tokens >> _U(32)) % _U(self.parts) * size + (tokens & _U(0xFFFFFFFF)) % size
        byte, bit = (slot >> _U(3)).astype(np.int64), (slot & _U(7)).astype(np.uint8)
        return tuple((np.frombuffer(b, np.uint8)[byte] >> bit) & 1 > 0 for b in (self.shared, self.frequent))


def token_classes(docs: DataFrame, frequent: int = FREQUENT, shingle: int = SHINGLE_WORDS) -> TokenClasses:
    """Classes of all tokens of the corpus.

    Tokens are counted per batch, dealt by hash as packed arrays, and counted over
    the whole corpus; each partition returns its stretch of the bitmaps.
    """
    spark = docs.sparkSession
    parts = common.partitions(spark)
    stretch = TokenClasses.stretch(parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                tokens, _ = shingle_sets(data, offsets, shingle)
                unique, times = np.unique(tokens, return_counts=True)
                _, order, sizes = _parts(unique, parts)
                some = np.flatnonzero(sizes)
                low, much = unique[order].astype(np.uint32), np.minimum(times[order], 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), common.binaries(low, sizes[some]), common.binaries(much, sizes[some])], ["part", "tokens", "times"])

    def bits(keys: np.ndarray) -> bytes:
        out = np.zeros(stretch, bool)
        out[keys % np.uint32(stretch)] = True
        return np.packbits(out, bitorder="little").tobytes()

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for part, low, times in zip(*[batch.column(c).to_pylist() for c in ("part", "tokens", "times")], strict=True):
                keys, much = met.setdefault(part, ([], []))
                keys.append(np.frombuffer(low, np.uint32))
                much.append(np.frombuffer(times, np.uint16))
        for part in list(met):
            keys, much = met.pop(part)
            key, times = np.concatenate(keys), np.concatenate(much)
            order = np.argsort(key)
            key, times = key[order], times[order].astype(np.int64)
            begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            total = np.add.reduceat(times, begins)
            found = [bits(key[begins][total >= least]) for least in (2, frequent)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([f], pa.binary()) for f in found]], ["part", "shared", "frequent"])

    counted = docs.select("text").mapInArrow(count, "part int, tokens binary, times binary")
    rows = counted.repartition(parts, "part").mapInArrow(often, "part int, shared binary, frequent binary").collect()
    maps = [bytearray(parts * stretch // 8) for _ in range(2)]
    for part, *found in rows:
        for whole, own in zip(maps, found, strict=True):
            whole[part * stretch // 8 : (part + 1) * stretch // 8] = own
    return TokenClasses(parts, *map(bytes, maps))


def shared_lists(docs: DataFrame, classes: TokenClasses, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(list, node): nodes that share a signature; of lists with the same members one is kept."""
    spark = docs.sparkSession
    parts = common.partitions(spark)
    sent = spark.sparkContext.broadcast(classes)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                tokens, counts = shingle_sets(data, offsets, shingle)
                nodes = node_ids(tokens, counts)
                shared, often = sent.value.of(tokens)
                begins = np.cumsum(counts) - counts
                _, fresh = np.unique(nodes, return_index=True)
                fresh = fresh[counts[fresh] > 1]
                if not len(fresh):
                    continue
                found = [signatures(tokens[b : b + c], shared[b : b + c], often[b : b + c]) for b, c in zip(begins[fresh].tolist(), counts[fresh].tolist(), strict=True)]
                keys, owner = np.concatenate(found), np.repeat(nodes[fresh], [len(f) for f in found])
                _, order, sizes = _parts(keys, parts)
                some = np.flatnonzero(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), common.binaries(keys[order].astype(np.uint32), sizes[some]), common.binaries(owner[order], sizes[some])], ["part", "keys", "nodes"]
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes = [], []
        for batch in batches:
            for part, low, owner in zip(*[batch.column(c).to_pylist() for c in ("part", "keys", "nodes")], strict=True):
                keys.append((_U(part) << _U(32)) | np.frombuffer(low, np.uint32))
                nodes.append(np.frombuffer(owner, _U))
        if not keys:
            return
        key, node = np.concatenate(keys), np.concatenate(nodes)
        del keys, nodes
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        fresh = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
        key, node = key[fresh], node[fresh]
        begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(begins, len(key)))
        begins, sizes = begins[sizes > 1], sizes[sizes > 1]
        if not len(begins):
            return
        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        members = node[at]
        name = mix(np.add.reduceat(mix(members), np.cumsum(sizes) - sizes) + sizes.astype(_U))
        _, one = np.unique(name, return_index=True)
        keep = np.zeros(len(name), bool)
        keep[one] = True
        rows = np.repeat(keep, sizes)
        names = np.repeat(name, sizes)[rows].view(np.int64)
        members = members[rows].view(np.int64)
        for lo in range(0, len(names), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(names[lo : lo + (1 << 18)]), pa.array(members[lo : lo + (1 << 18)])], ["list", "node"])

    signed = docs.select("text").mapInArrow(sign, "part int, keys binary, nodes binary")
    return signed.repartition(parts, "part").mapInArrow(gather, "list long, node long").dropDuplicates(["list", "node"])


def node_table(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, node, n) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column("text")):
                tokens, counts = shingle_sets(data, offsets, shingle)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(node_ids(tokens, counts).view(np.int64)), pa.array(counts)], ["doc_id", "node", "n"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, node long, n long")


def token_table(docs: DataFrame, bits: bytes, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(node, rep, tokens) of the rows whose node ^ doc_id has its bit set (a null doc_id counts as 0): representatives, and few others by chance."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for lo, hi, data, offsets in pieces(batch.column("text")):
                tokens, counts = shingle_sets(data, offsets, shingle)
                nodes = node_ids(tokens, counts).view(np.int64)
                use = common.bits_at(sent.value, nodes ^ ids[lo:hi]) & (counts > 0)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[use]), pa.array(ids[lo:hi][use]), common.binaries(tokens[np.repeat(use, counts)], counts[use])], ["node", "rep", "tokens"])

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), "text").mapInArrow(run, "node long, rep long, tokens binary")


def verified(pairs: DataFrame, tokens: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs with 100 * intersection >= percent * union; sizes are compared before token arrays move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (reps.select(F.col("node").alias(x), F.col("rep").alias(f"r_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    near = pairs.join(one, "a").join(two, "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    first = near.join(tokens.select(F.col("node").alias("a"), F.col("rep").alias("r_a"), F.col("tokens").alias("x")), ["a", "r_a"])
    both = first.join(tokens.select(F.col("node").alias("b"), F.col("rep").alias("r_b"), F.col("tokens").alias("y")), ["b", "r_b"])
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def block_links(sets: list[np.ndarray], side: np.ndarray, percent: int, stretch: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places whose sets link; ``side``: 0 and 1 where only pairs between two blocks count, all 2 within a block."""
    sizes = np.array([len(s) for s in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    met = times[which] > 1
    number = np.cumsum(times > 1) - 1
    which, owner = number[which[met]], owner[met]
    order = np.argsort(which, kind="stable")
    which, owner = which[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, stretch):
        part = slice(*np.searchsorted(which, [lo, lo + stretch]))
        has = np.zeros((len(sets), stretch), np.float32)
        has[owner[part], which[part] - lo] = 1
        both += has @ has.T
    exact = both.astype(np.int64)
    close = np.triu(100 * exact >= percent * (sizes[:, None] + sizes - exact), 1)
    return np.nonzero(close & ((side[:, None] == 2) | (side[:, None] != side)))


def cluster_links(clusters: DataFrame, tokens: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join what links within each cluster (node, cluster), a few rows per member.

    A cluster is cut into blocks of BLOCK sets; a task gets two blocks.
    """
    spark = clusters.sparkSession
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    placed = clusters.join(sizes, "cluster").join(reps.select("node", "rep"), "node").join(tokens, ["node", "rep"]).dropDuplicates(["node"])
    dealt = placed.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")).withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
    dealt = dealt.select("cluster", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", "node", "tokens")
    key = ["cluster", "_i", "_j"]

    def task(rows: list[tuple], i: int, j: int) -> pa.RecordBatch:
        nodes = np.array([r[0] for r in rows], np.int64)
        side = np.array([2 if i == j else int(r[1] == j) for r in rows])
        a, b = block_links([np.frombuffer(r[2], _U) for r in rows], side, percent)
        root = np.arange(len(nodes))
        while True:
            least, fresh = np.minimum(root[a], root[b]), root.copy()
            np.minimum.at(fresh, a, least)
            np.minimum.at(fresh, b, least)
            fresh = fresh[fresh]
            if (fresh == root).all():
                break
            root = fresh
        some = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[root[some]])], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key = [], None
        for batch in batches:
            for *now, own, node, blob in zip(*[batch.column(c).to_pylist() for c in (*key, "_own", "node", "tokens")], strict=True):
                if now != held_key:
                    if len(held) > 1:
                        yield task(held, *held_key[1:])
                    held, held_key = [], now
                held.append((node, own, blob))
        if len(held) > 1:
            yield task(held, *held_key[1:])

    return dealt.repartition(common.partitions(spark), *key).sortWithinPartitions(*key).mapInArrow(compare, "a long, b long")


def node_components(lists: DataFrame, tokens: DataFrame, reps: DataFrame, percent: int, rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """(node, component): components of the links among the lists' members.

    Lists whose members are all in one component are done and leave the work.
    """
    of_list = Window.partitionBy("list")
    pivots = lists.groupBy("list").agg(F.min("node").alias("pivot"))
    tried = common.stage(_pairs(lists.join(pivots, "list").select(F.col("pivot").alias("a"), F.col("node").alias("b"))), "pairs")
    reached = components(common.stage(verified(tried, tokens, reps, percent), "links"))

    def still_open(rows: DataFrame) -> DataFrame:
        placed = rows.join(reached, "node", "left").select("list", "node", F.coalesce("component", "node").alias("c"))
        return common.stage(placed.withColumn("_lo", F.min("c").over(of_list)).withColumn("_hi", F.max("c").over(of_list)).where("_lo < _hi").drop("_lo", "_hi"), "open")

    def joined(found: DataFrame) -> DataFrame:
        # Old links as stars of their components: as many rows as nodes.
        return components(reached.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(found))

    split = still_open(lists)
    for turn in range(1, rounds + 1):
        if split.isEmpty():
            return reached
        by = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node"), F.col("c"))
        pivots = split.groupBy("list").agg(F.min(by).alias("p")).select("list", F.col("p.node").alias("a"), F.col("p.c").alias("d"))
        fresh = split.join(pivots, "list").where("c != d").select("a", F.col("node").alias("b"))
        fresh = common.stage(_pairs(fresh).join(tried, ["a", "b"], "left_anti"), "pairs")
        reached, tried = joined(common.stage(verified(fresh, tokens, reps, percent), "links")), tried.unionAll(fresh)
        split = still_open(split)
    # Each member of long open lists goes to the longest one that it or a fellow member is in, and all pairs there are compared.
    long_lists = split.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_LIST)
    members = common.stage(split.join(long_lists, "list").select("list", "node", F.struct("n", "list").alias("m")), "members")
    for by in ("node", "list", "node"):
        longest = members.groupBy(by).agg(F.max("m").alias("best"))
        members = members.join(longest, by).select("list", "node", F.col("best").alias("m"))
    clusters = common.stage(members.select("node", F.col("m.list").alias("cluster")).distinct(), "clusters")
    if not clusters.isEmpty():
        reached = joined(common.stage(cluster_links(clusters, tokens, reps, percent), "links"))
        split = still_open(split)
    # Left: pairs of a list that no cluster has compared.
    rows = split.join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    other = rows.select("list", F.col("node").alias("b"), F.col("c").alias("d"), F.col("cluster").alias("other"))
    fresh = rows.join(other, "list").where("c < d and cluster != other").select(F.col("node").alias("a"), "b")
    fresh = common.stage(_pairs(fresh).join(tried, ["a", "b"], "left_anti"), "pairs")
    return joined(common.stage(verified(fresh, tokens, reps, percent), "links"))


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: documents link when 100 * intersection >= 75 * union of their shingle sets.

    Null, empty and wordless texts have the empty set and link with nothing; equal
    sets are linked. component_id is the least doc_id reachable; a row without doc_id never is
    the least unless it stands alone (then null). Repeated rows are documents like any
    other. Columns other than doc_id and text are ignored.
    """
    percent = 75
    common.small_batches(docs.sparkSession)
    rows = common.stage(node_table(docs, shingle), "sets")
    lists = common.stage(shared_lists(docs, token_classes(docs, shingle=shingle), shingle), "lists")
    met = rows.join(lists.select("node").distinct(), "node", "left_semi")
    reps = common.stage(met.groupBy("node").agg(F.min(F.coalesce("doc_id", F.lit(0))).alias("rep"), F.first("n").alias("n")), "reps")
    bits = common.bitmap(reps, common.slot_of(F.col("node").bitwiseXOR(F.col("rep"))))
    tokens = common.stage(token_table(docs, bits, shingle), "tokens")
    reached = node_components(lists, tokens, reps, percent)
    least = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    grouped = least.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    per_node = grouped.select("node", "component").join(names, "component").select("node", "component_id")
    named = rows.join(per_node, "node", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


@common.query()
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return jaccard_components(common.table(spark, sf_dir, "documents"))
