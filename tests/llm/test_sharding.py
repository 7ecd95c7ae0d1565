"""Sharding against the published jump hash in plain Python, gapless slots, and growth."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyloom.llm import sharding

SCHEMA = "doc_id long, text string, shard string, slot string"


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def plain_key(doc_id):
    text = "-" if doc_id is None else f"{len(str(doc_id))}:{doc_id}"
    return int(hashlib.md5(text.encode()).hexdigest()[:16], 16)


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000])
def test_jump(shards):
    hashes = np.random.default_rng(1).integers(0, 1 << 64, 2000, np.uint64)
    assert sharding.jump(hashes, shards).tolist() == [plain_jump(int(h), shards) for h in hashes]
    assert len(sharding.jump(hashes[:0], shards)) == 0


def test_one_more_shard_takes_only():
    hashes = np.random.default_rng(2).integers(0, 1 << 64, 50_000, np.uint64)
    old, new = sharding.jump(hashes, 8), sharding.jump(hashes, 9)
    assert (new[old != new] == 8).all() and 0.1 < (old != new).mean() < 0.125
    assert np.bincount(old).min() > 50_000 / 8 * 0.95


def rows_of():
    texts = ["", None, "é" * 5, "same", "same", "x" * 300_000]
    rows = [(i * 7 - 20, texts[i % len(texts)], "a", None) for i in range(300)] + [(None, "n", "b", "c")] * 3 + [(5, "repeated", "b", "c")] * 4
    return rows


def test_summary_of_all_rows(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = sharding.summary(docs).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), plain_jump(plain_key(i), 8), plain_jump(plain_key(i), 9)) for i, t, _, _ in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "key"
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
    for found in slots.values():
        found.sort(key=lambda r: r[0])
        assert [s for s, _ in found] == list(range(len(found)))
        ids = [i for _, i in found if i is not None]
        assert ids == sorted(ids)
    assert sharding.summary(spark.createDataFrame([], SCHEMA)).count() == 0


def test_written_shards_and_growth(spark, tmp_path):
    docs = spark.createDataFrame(rows_of(), SCHEMA)
    stored = sharding.write_shards(docs, f"{tmp_path}/shards")
    assert sorted(map(str, (r["text"] for r in stored.collect()))) == sorted(map(str, (r[1] for r in rows_of())))
    moved = sharding.grow(spark, f"{tmp_path}/shards", f"{tmp_path}/more", 8).collect()
    ids = {r["doc_id"] for r in moved}
    for r in stored.collect():
        assert r["shard"] == plain_jump(plain_key(r["doc_id"]), 8)
        assert (r["doc_id"] in ids) == (plain_jump(plain_key(r["doc_id"]), 9) == 8)
    assert all(r["shard"] == 8 and r["left"] < 8 for r in moved)
