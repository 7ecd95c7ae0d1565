"""Conversation repair against a search of all cheapest edits in plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from tallyloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, fault string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def plain(rows):
    """Forward search: per state the cheapest and then least (cost, audit, turns) so far."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        ink = BLANK.findall(text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserts(states):
        for _ in range(4):
            for q, (cost, audit, turns) in list(states.items()):
                to = after[q]
                new = (cost + 5, audit + "I", (*turns, names[to] + ":"))
                if to not in states or new[:2] < states[to][:2]:
                    states[to] = new
        return states

    states = inserts({"": (0, "", ())})
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        new = {}

        def offer(q, value, new=new):
            if q not in new or value[:2] < new[q][:2]:
                new[q] = value

        for q, (cost, audit, turns) in states.items():
            offer(q, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            extra, to = 5 * (fault == "truncated"), after[q]
            offer(to, (cost + 1 + extra, audit + "R", (*turns, f"{names[to]}:{text}")))
            if role[:1] == to or (role[:1] == "s" and q == ""):
                offer(role[:1], (cost + extra, audit + "K", (*turns, f"{role}:{text}")))
        states = inserts(new)
    cost, audit, turns = min((states[q] for q in ("", "a") if q in states), key=lambda s: s[:2])
    turn = [t for _, t, _, _ in rows if t is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (
        max(turn) - min(turn) + 1 - len(set(turn)) if turn else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest(),
    )


def made(seed, conversations=150, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Well", "Why?", "", " \t\n", "Ends in blanks. \n", "é…", "Yes. ", None, *[f"Text {i}." for i in range(30)]]
    rows = []
    for conv in range(conversations):
        turn = rng.randrange(-3, 3)
        for _ in range(rng.randint(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "agent", None]), rng.choice(texts)))
            turn += rng.choice([1, 1, 1, 2, 5])
    rows += [(1000, None, "user", "Hi."), (1001, None, "system", "Only."), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    return rows


def compare(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.report(repair.damage(frame), frame).collect()}
    groups = {c: [] for c, *_ in rows}
    for row in damaged(rows):
        groups[row[0]].append(row)
    want = {c: plain(sorted(own, key=lambda r: (r[1] is not None, r[1] or 0))) for c, own in groups.items()}
    assert got == want
    return got


def test_report(spark):
    got = compare(spark, made(1))
    assert sum(r[5] > 0 for r in got.values()) > 50 and len({len(r[6]) for r in got.values()}) > 5


@pytest.mark.parametrize("block, at_once", [(1, 1 << 15), (3, 4), (4096, 1)])
def test_blocks_chain(spark, monkeypatch, block, at_once):
    """The same results however a conversation is cut."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    monkeypatch.setattr(repair, "ROWS_AT_ONCE", at_once)
    compare(spark, made(2, 25, 40))


def test_nothing_left_and_empty_table(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = compare(spark, [(dropped, 0, "user", "Gone.")])
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(repair.damage(none), none).count() == 0 and repair.repair(none).count() == 0


def test_equal_rows_and_long_texts(spark):
    frame = spark.createDataFrame([(1, 5, "user", "A " * 300_000 + ".", "x")] * 7 + [(1, 6, "assistant", "B.", "x"), (1, None, "user", "", "x")] * 2, SCHEMA)
    r = repair.report(frame, frame).first()
    assert (r["blank"], r["duplicate"], r["truncated"], r["cost"], r["audit"]) == (2, 7, 0, 18, "DDKDDDDDDKD")
    turns = sorted((t["row"], t["part"], t["role"], len(t["text"])) for t in repair.repair(frame).collect())
    assert [t[2:] for t in turns] == [("user", 600_001), ("assistant", 2)]
