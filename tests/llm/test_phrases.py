"""Phrase mining against plain Python: nulls, overlaps, ranges of one row, long texts in stretches."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tallyloom.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 5):
                    if i + k <= len(words):
                        f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        for phrase, a in counts.items():
            if len(phrase) < 2 or a < least:
                continue
            if any(100 * c >= 80 * a and c >= least and len(p) > len(phrase) and any(p[i : i + len(phrase)] == phrase for i in range(len(p))) for p, c in counts.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (counts[phrase[:k]] + counts[phrase[k:]]), k, counts[phrase[:k]], counts[phrase[k:]]) for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), l, r))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -score) for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def made(seed):
    rng = random.Random(seed)
    words = ["The", "the", "été", "of", "a", "a", "ab", "\x01", "aé", "x\x02y", "new", "york", "City"]
    glue = [" "] * 12 + ["  ", "\t", ", ", "\n", "!", " . "]
    texts = ["".join(w + rng.choice(glue) for w in rng.choices(words, k=rng.randint(0, 60))) for _ in range(120)]
    rows = [(t, rng.choice(["en", "en", "fr", None, "und"])) for t in texts]
    return rows + [(None, "en"), ("", None), ("a a a a a a", "fr"), ("   ", "fr")] + [("new york city of the a", "en")] * 9


@pytest.mark.parametrize("ranges, stretch", [("8", 1 << 22), ("64", 50)])
def test_collocations(spark, monkeypatch, ranges, stretch):
    monkeypatch.setattr(phrases, "STRETCH", stretch)
    rows = made(1)
    docs = spark.createDataFrame([(i, t, g, "x") for i, (t, g) in enumerate(rows)], SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = sorted(map(tuple, phrases.collocations(docs, least=5, top=40).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain(rows, 5, 40) and len(got) > 80
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stretches_share_words():
    import pyarrow as pa

    text = pa.array([" ".join(random.Random(3).choices(["a", "b,", "cc", "d" * 70], k=300))])
    whole = list(phrases.tokens(text, pa.array(["en"]), 3))
    old, phrases.STRETCH = phrases.STRETCH, 40
    try:
        cut = list(phrases.tokens(text, pa.array(["en"]), 3))
    finally:
        phrases.STRETCH = old
    assert len(whole) == 1 and len(cut) > 5
    assert whole[0].hashes.tolist() == [h for c in cut for h in c.hashes[: c.own].tolist()]
    assert whole[0].spelled([0, 5]).to_pylist() == [cut[0].spelled([0])[0].as_py(), whole[0].spelled([5])[0].as_py()]


def test_counted_hashes_fit_four_bytes():
    """A wider hash adds a byte to each of the rows counted by hash, the most that are shuffled."""
    assert int(phrases._KEPT) < 1 << 32
