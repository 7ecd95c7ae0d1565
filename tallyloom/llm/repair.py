"""Conversation structure repair: the cheapest edits that make the turns of a conversation alternate.

Nodes are (rows read, what the repaired turns end with); arcs keep, rerole or delete a
row or insert an empty turn. A cost DP from the end gives every node its least cost to
the end, and with it the optimal arcs. Of all cheapest edit sequences the least text
(the audit) is wanted. An edit's initial leads from a node to one node only, so the least
audit of 2^k edits from a node ends in one node: ranks of audits of 1, 2, 4, ... edits and
pointers to their ends are doubled until no audit is longer, and the least path is
read off the doubled pointers, all places at once.

A conversation is cut into blocks of rows of a global sort. A block is a 4 x 4 matrix
of least costs between what the turns end with before and after it. Matrices of a long
conversation are multiplied (least sum) by pointer doubling over joins, which gives each
block its costs to the end; then each block finds its paths by itself, and their ends are
chained by doubling again. Only the final digest of a conversation reads it row by row, in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import common

BLOCK_ROWS = 4096
# Rows of several blocks that are solved at once in a task.
ROWS_AT_ONCE = 1 << 15
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# What the turns end with: nothing, system, user, assistant; behind an added turn; the cost of ending there.
_NEXT = np.array([2, 2, 3, 2])
_FAR = 1 << 50
_END = (0, 2 * INSERT, INSERT, 0)
# Codes of a row: initial 0 s, 1 u, 2 a, 3 other; fault 0 none, 1 truncated, 2 blank, 3 duplicate.
_BLANKS = " \t\n\x0b\x0c\r"


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with damage drawn by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its stops, 3 repeats it, 4 makes it the user's. Nulls are one space each, but for conv_id and turn, which stay."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(draw == 4, "user").otherwise(spaced("role"))
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(draw == 3, 2).when(draw == 0, 0).otherwise(1).alias("_times"))
    return hit.where("_times > 0").select("conv_id", "turn", "role", "text", F.explode(F.expr("sequence(1, _times)"))).drop("col")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with a key of the conversation that is never null, and two hashes of the text."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(conv.alias("_conv"), "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).withColumns({"_x": F.xxhash64("text"), "_y": F.xxhash64(F.lit(1), "text")})


_ROW = ["_conv", "turn", "role", "_x", "_y"]


def judged(keyed: DataFrame) -> DataFrame:
    """One row for equal rows of a turn, in order: the keys of _ROW, _no (order over all conversations), n (how many), initial, fault.

    Order is by turn, nulls first; different rows of one turn go by role, then by hash of the text. ``fault`` is that
    of the first of equal rows; the others are blank, or else duplicates.
    """
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    fault = F.when(trimmed == "", 2).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    one = keyed.select(*_ROW, code.cast("int").alias("initial"), fault.cast("int").alias("fault")).groupBy(*_ROW, "initial", "fault").agg(F.count(F.lit(1)).alias("n"))
    one = common.stage(one, "rows")
    place = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn"))
    firsts = common.stage(one.groupBy("_conv", "role", "_x", "_y").agg(F.min(place).alias("_first")), "firsts")
    marked = one.join(firsts, ["_conv", "role", "_x", "_y"]).withColumn("fault", F.when((F.col("fault") != 2) & (place > F.col("_first")), 3).otherwise(F.col("fault"))).drop("_first")
    order = ["_conv", "turn", "role", "_x", "_y"]
    ordered = marked.repartitionByRange(common.partitions(keyed.sparkSession), *order).sortWithinPartitions(*order)
    return common.stage(ordered.withColumn("_no", F.monotonically_increasing_id()), "ordered")


def _spread(offsets: np.ndarray) -> list[np.ndarray]:
    """For step 0, 1, ...: the blocks that have so many rows and more."""
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")
    return [order[: np.searchsorted(-sizes[order], -t, "left")] for t in range(int(sizes.max(initial=0)))]


def arcs(initial: np.ndarray, fault: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row and state: cost of keeping (far where it must not be), state behind it, cost of reroling."""
    state = np.arange(4)
    role = initial[:, None]
    fits = ((role == 0) & (state == 0)) | ((role == 1) & (state != 2)) | ((role == 2) & (state == 2))
    stays = (fault < 2)[:, None]
    extra = np.where(fault == 1, TRUNCATED, 0)[:, None]
    keep = np.where(fits & stays, KEEP + extra, _FAR)
    behind = np.where(role == 0, 1, _NEXT[None, :])
    return keep, behind, np.where(stays, REROLE + extra, _FAR) + np.zeros((1, 4), np.int64)


def costs_to_end(keep: np.ndarray, behind: np.ndarray, rerole: np.ndarray, n: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least cost from each node to the end. Nodes: the rows of all blocks and, behind each block's rows, its end, whose costs are given."""
    blocks = len(offsets) - 1
    base = offsets[:-1] + np.arange(blocks)
    cost = np.full((offsets[-1] + blocks, 4), _FAR, np.int64)
    cost[base + np.diff(offsets)] = ends
    steps = _spread(offsets)
    for t in range(len(steps) - 1, -1, -1):
        row, node = offsets[steps[t]] + t, base[steps[t]] + t
        ahead = cost[node + 1]
        best = np.minimum(DELETE + ahead, rerole[row] + ahead[:, _NEXT])
        best = np.minimum(best, keep[row] + np.take_along_axis(ahead, behind[row], 1))
        two, three = np.minimum(best[:, 2], INSERT + best[:, 3]), np.minimum(best[:, 3], INSERT + best[:, 2])
        best = np.column_stack([np.minimum(best[:, 0], INSERT + two), np.minimum(best[:, 1], INSERT + two), two, three])
        cost[node] = np.minimum(best + DELETE * (n[row] - 1)[:, None], _FAR)
    return cost


def least_paths(letter: np.ndarray, to: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of the path from each entry, number of its edits, and the rank of its audit among all nodes.

    ``letter``: a node's least edit, 0 at an end; ``to``: where it leads. Pointers and ranks are doubled.
    """
    rank, pointers, length = letter.astype(np.int64), [to], (letter > 0).astype(np.int64)
    while (letter[pointers[-1]] > 0).any():
        last = pointers[-1]
        length = length + length[last]
        _, rank = np.unique(rank * (rank.max() + 1) + rank[last], return_inverse=True)
        pointers.append(last[last])
    counts = length[entries]
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(entries, counts)
    for k, pointer in enumerate(pointers):
        jump = (step >> k & 1) > 0
        at[jump] = pointer[at[jump]]
    return at, counts, rank[entries]


def _flat(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets and the fields _no, initial, fault, n of an array column of rows."""
    flat = column.flatten()
    return np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]), [flat.field(k).to_numpy() for k in range(4)]


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(batch.column("rows").value_lengths().to_numpy())
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + ROWS_AT_ONCE, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def matrices(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``costs``, least cost from each state before (rows of 4) to each one behind the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _runs(batch):
                offsets, (_, initial, fault, n) = _flat(part.column("rows"))
                made = arcs(initial, fault)
                first = offsets[:-1] + np.arange(len(part))
                found = np.stack([costs_to_end(*made, n, offsets, np.where(np.arange(4) == e, 0, _FAR))[first] for e in range(4)], axis=2)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(found.reshape(len(part), 16)), pa.list_(pa.int64()))], [*part.schema.names, "costs"])

    return blocks.mapInArrow(run, f"{_ddl(blocks)}, costs array<bigint>")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


PATH = "struct<exit:int,cost:bigint,audit:string,edits:array<struct<no:bigint,before:string,edit:string,after:string>>>"


def solved(blocks: DataFrame) -> DataFrame:
    """_conv, block, paths: of each state before the block (the first block: of the first) the least path to the conversation's end, as far as the block goes.

    ``ahead`` are the costs to the end behind the block, ``last`` tells the conversation's last block.
    An edit of a row: roles inserted before it, its initial (with the new role's behind a rerole), roles inserted behind the last row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _runs(batch):
                offsets, (no, initial, fault, n) = _flat(part.column("rows"))
                last = np.asarray(part.column("last").to_pylist(), bool)
                ends = np.array(part.column("ahead").to_pylist(), np.int64).reshape(-1, 4)
                keep, behind, rerole = arcs(initial, fault)
                cost = costs_to_end(keep, behind, rerole, n, offsets, ends)
                nodes = len(cost)
                owner = np.repeat(np.arange(len(part)), np.diff(offsets) + 1)
                is_end = np.zeros(nodes, bool)
                is_end[offsets[1:] + np.arange(len(part))] = True
                row = np.minimum(np.arange(nodes) - owner, max(0, len(no) - 1))
                ahead = np.vstack([cost[1:], cost[-1:]]) + (DELETE * (n[row] - 1))[:, None]
                own = np.arange(nodes)[:, None] * 4 + np.arange(4)
                letter, to = np.zeros((nodes, 4), np.int64), own.copy()
                # From the last initial to the first, so that the least stays.
                inner = ~is_end[:, None]
                for code, possible, target in (
                    (4, inner & (cost == rerole[row] + ahead[:, _NEXT]), own + 4 - np.arange(4) + _NEXT),
                    (3, inner & (cost == keep[row] + np.take_along_axis(ahead, behind[row], 1)), own + 4 - np.arange(4) + behind[row]),
                    (2, (inner | last[owner][:, None]) & (cost == INSERT + cost[:, _NEXT]), own - np.arange(4) + _NEXT),
                    (1, inner & (cost == DELETE + ahead), own + 4),
                ):
                    possible = possible & (cost < _FAR)
                    letter[possible], to[possible] = code, target[possible]
                letter, to = letter.reshape(-1), to.reshape(-1)
                wanted = [(b, q) for b, begins in enumerate(part.column("block").to_pylist()) for q in range(4 if begins else 1) if cost[offsets[b] + b, q] < _FAR]
                entries = np.array([(offsets[b] + b) * 4 + q for b, q in wanted], np.int64)
                path, counts, _ = least_paths(letter, to, entries)
                out: list[list] = [[None] * 4 for _ in range(len(part))]
                lo = 0
                for (b, q), size in zip(wanted, counts.tolist(), strict=True):
                    out[b][q] = _path(path[lo : lo + size], letter, to, offsets[b] + b, offsets[b], no, n) | {"cost": int(cost[offsets[b] + b, q])}
                    if not size:
                        out[b][q]["exit"] = q
                    lo += size
                yield pa.RecordBatch.from_arrays([part.column("_conv"), part.column("block"), pa.array(out, _PATHS)], ["_conv", "block", "paths"])

    return blocks.select("_conv", "block", "rows", "ahead", "last").mapInArrow(run, f"_conv string, block int, paths array<{PATH}>")


_EDIT = pa.struct([("no", pa.int64()), ("before", pa.string()), ("edit", pa.string()), ("after", pa.string())])
_PATHS = pa.list_(pa.struct([("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("edits", pa.list_(_EDIT))]))


def _path(path: np.ndarray, letter: np.ndarray, to: np.ndarray, first_node: int, first_row: int, no: np.ndarray, n: np.ndarray) -> dict:
    """Audit, edits and exit state of one path. Copies of a row are deleted behind it."""
    audit, edits, waiting = [], [], ""
    for node, edit, target in zip(path.tolist(), letter[path].tolist(), to[path].tolist(), strict=True):
        initial = "_DIKR"[edit]
        audit.append(initial)
        role = "a" if target % 4 == 3 else "u"
        if initial == "I":
            waiting += role
            continue
        row = first_row + node // 4 - first_node
        audit.append("D" * (int(n[row]) - 1))
        edits.append({"no": int(no[row]), "before": waiting, "edit": initial + (role if initial == "R" else ""), "after": ""})
        waiting = ""
    if waiting and edits:
        edits[-1]["after"] = waiting
    return {"exit": int(to[path[-1]] % 4) if len(path) else None, "audit": "".join(audit), "edits": edits}


def _product(a: str, b: str) -> Column:
    """Least-sum product of two 4 x 4 matrices of costs."""
    return F.expr(f"transform(sequence(0, 15), k -> array_min(transform(sequence(0, 3), j -> least({_FAR}L, {a}[k div 4 * 4 + j] + {b}[j * 4 + k % 4]))))")


def _doubled(df: DataFrame, value: str, join: Column, longest: int, forward: bool, label: str) -> DataFrame:
    """``value`` of each block joined with that of the block 1, 2, 4, ... places ahead (or behind), so that it covers all of them in the end."""
    step = 1
    while step < longest:
        there = df.select("_conv", (F.col("block") + (-step if forward else step)).alias("block"), F.col(value).alias("_there"))
        df = common.stage(df.join(there, ["_conv", "block"], "left").withColumn(value, F.when(F.col("_there").isNull(), F.col(value)).otherwise(join)).drop("_there"), label)
        step *= 2
    return df


def repaired(keyed: DataFrame, ordered: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per conversation (_conv, cost, audit, illegal); the repaired turns (_conv, _no, part, role, text); and the blocks.

    ``_no`` and ``part`` order the turns of a conversation.
    """
    member = F.struct("_no", "initial", "fault", "n")
    grouped = ordered.groupBy("_conv", F.expr(f"_no div {BLOCK_ROWS}").alias("_at")).agg(F.sort_array(F.collect_list(member)).alias("rows"))
    # One row a block, BLOCK_ROWS rows of a long conversation.
    line, whole = Window.partitionBy("_conv").orderBy("_at"), Window.partitionBy("_conv")
    before = F.lag(F.element_at("rows", -1)["initial"]).over(line)
    placed = grouped.select("_conv", (F.row_number().over(line) - 1).alias("block"), F.count(F.lit(1)).over(whole).cast("int").alias("_blocks"), "rows", before.alias("_before"))
    blocks = common.stage(placed, "blocks")
    longest = blocks.agg(F.max("_blocks")).first()[0] or 0
    # Costs from behind a block to the end: the product of the matrices behind it, then of the end.
    costs = common.stage(matrices(blocks.where("_blocks > 1").select("_conv", "block", "rows")).drop("rows"), "costs")
    costs = _doubled(costs, "costs", _product("costs", "_there"), longest, True, "costs")
    ahead = costs.select("_conv", (F.col("block") - 1).alias("block"), F.expr(f"transform(sequence(0, 3), q -> array_min(transform(sequence(0, 3), j -> costs[q * 4 + j] + array{_END}[j])))").alias("_ahead"))
    ready = blocks.join(ahead, ["_conv", "block"], "left").select("_conv", "block", "rows", F.coalesce("_ahead", F.expr(f"transform(array{_END}, c -> cast(c as bigint))")).alias("ahead"), (F.col("block") + 1 == F.col("_blocks")).alias("last"))
    paths = common.stage(solved(ready), "paths")
    # Where the turns stand behind each block, for every state before the first one covered; the conversation begins in state 0.
    exits = paths.join(blocks.where("_blocks > 1").select("_conv", "block"), ["_conv", "block"]).select("_conv", "block", F.expr("transform(paths, p -> p.exit)").alias("exits"))
    chained = _doubled(common.stage(exits, "exits"), "exits", F.expr("transform(_there, q -> if(q is null, null, exits[q]))"), longest, False, "exits")
    entered = chained.select("_conv", (F.col("block") + 1).alias("block"), F.expr("exits[0]").alias("_entry"))
    taken = common.stage(paths.join(entered, ["_conv", "block"], "left").select("_conv", "block", F.expr("paths[coalesce(_entry, 0)]").alias("p")).select("_conv", "block", "p.*"), "taken")
    results = taken.groupBy("_conv").agg(F.min_by("cost", "block").alias("cost"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda a: a["audit"]), "").alias("audit"))
    pairs = F.expr(
        "aggregate(rows, struct(_before as r, 0L as bad), (s, x) -> struct(x.initial as r, s.bad + x.n - 1 +"
        " if(s.r is null or (s.r = 0 and x.initial = 1) or (s.r = 1 and x.initial = 2) or (s.r = 2 and x.initial = 1), 0, 1) as bad), s -> s.bad)"
    )
    illegal = blocks.groupBy("_conv").agg(F.sum(pairs).alias("illegal"))
    edits = common.stage(taken.select(F.explode("edits").alias("e")).select("e.*").where("before != '' or after != '' or edit != 'D'"), "edits")
    wanted = ordered.select("_no", *_ROW).join(edits.withColumnRenamed("no", "_no"), "_no")
    # Equal rows of a turn are one row here; the text meets its edit once.
    texts = keyed.select("_conv", F.col("turn").isNull().alias("_none"), F.coalesce("turn", F.lit(0)).alias("_turn"), "role", "_x", "_y", "text").dropDuplicates(["_conv", "_none", "_turn", "role", "_x", "_y"])
    wanted = wanted.withColumns({"_none": F.col("turn").isNull(), "_turn": F.coalesce("turn", F.lit(0))}).drop("turn")
    met = texts.join(common.stage(wanted, "wanted"), ["_conv", "_none", "_turn", "role", "_x", "_y"])
    named = lambda letters: F.expr(f"transform(filter(split({letters}, ''), r -> r != ''), r -> struct(if(r = 'u', 'user', 'assistant') as role, '' as text))")
    role = F.expr("case edit when 'Ru' then 'user' when 'Ra' then 'assistant' else role end")
    itself = F.when(F.col("edit") == "D", F.array().cast("array<struct<role:string,text:string>>")).otherwise(F.array(F.struct(role.alias("role"), F.col("text").alias("text"))))
    turns = met.select("_conv", "_no", F.posexplode(F.concat(named("before"), itself, named("after"))).alias("part", "t")).select("_conv", "_no", "part", "t.role", "t.text")
    return results.join(illegal, "_conv"), turns, blocks


def digests(turns: DataFrame) -> DataFrame:
    """(_conv, repaired_sha256) of ``role:text`` lines in order. A digest is one sequence of bytes, so a conversation streams through one task, a batch at a time, and nothing of it is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("_conv", "role", "text")), strict=True):
                if c != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield _pairs(done)
        yield _pairs([(conv, state.hexdigest())] if state is not None else [])

    ordered = turns.repartition("_conv").sortWithinPartitions("_conv", "_no", "part")
    return ordered.select("_conv", "role", "text").mapInArrow(run, "_conv string, repaired_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["_conv", "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """The repaired turns of all conversations: conv_id, row and part (which order them), role, text.

    Null roles and texts are one space. Conversations without a turn left have no rows.
    """
    keyed = common.stage(_keyed(rows), "keyed")
    _, turns, _ = repaired(keyed, judged(keyed))
    names = keyed.select("_conv", "conv_id").distinct()
    return turns.join(names, "_conv").select("conv_id", F.col("_no").alias("row"), "part", "role", "text")


def report(rows: DataFrame, all_ids: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conv_id in ``all_ids``; conversations without rows have zeros and the digest of nothing."""
    keyed = _keyed(rows)
    ordered = judged(keyed)
    results, turns, _ = repaired(keyed, ordered)
    count = lambda condition, value: F.sum(F.when(condition, value).otherwise(0))
    fault, n = F.col("fault"), F.col("n")
    counts = ordered.groupBy("_conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        count(fault == 2, n).alias("blank"),
        F.sum(F.when(fault == 3, n).when(fault == 2, 0).otherwise(n - 1)).alias("duplicate"),
        count(fault == 1, 1).alias("truncated"),
    )
    ids = all_ids.select("conv_id").distinct().withColumn("_conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")))
    found = ids.join(counts, "_conv", "left").join(results, "_conv", "left").join(digests(turns), "_conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


@common.query()
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of all damaged conversations. Null roles and texts are one space, a null conv_id is a conversation, null turns come first; rows of one turn go by role and hash of the text."""
    common.small_batches(spark)
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return report(damage(rows), rows)
