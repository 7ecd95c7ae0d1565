"""op6: base spans and digests against the re module, also of texts with very many matches."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import common, secret_scan

RULES = [("assign", secret_scan.ASSIGN, 2, 6), ("access", secret_scan.ACCESS, 0, 0), ("hex", secret_scan.HEX, 0, 0)]


def brute(text):
    spans = []
    for place, (kind, pattern, group, least) in enumerate(RULES):
        spans += [(m.start(), place, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return [(s, k, e) for s, _, e, k in sorted(spans)]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def _text(rng):
    key = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    parts = [
        "plain words ", "ünïcode 😀 ", "\n", f'password = "{key(rng.randrange(1, 12), "abcXYZ019+/_.=-")}" ', f"API_KEY:{key(8, 'aZ9')} ",
        f"AKIA{key(rng.randrange(10, 20), 'ABC0')} ", key(rng.randrange(20, 40), "0123456789abcdef") + " ", key(rng.randrange(15, 40), "abcdefXYZ0189+/") + " ",
    ]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(40)))


def test_query_equals_re(spark, tmp_path):
    rng = random.Random(5)
    texts = [_text(rng) for _ in range(150)] + [None, "", "token", "password=secret=tokentoken"] + [_text(rng)] * 2
    path = str(tmp_path)
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(2).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r for r in secret_scan.op6_secrets(spark, path).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = brute(text)
        assert [got[i][f"n_{k}"] for k, *_ in RULES] == [sum(k == s[1] for s in want) for k, *_ in RULES]
        assert got[i].base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert joined(want) == ",".join(s for s in got[i].spans.split(",") if not s.startswith("random"))
        assert all(re.fullmatch(secret_scan.CANDIDATE, text[int(a) : int(b)]) for k, a, b in (s.split(":") for s in got[i].spans.split(",") if s) if k == "random")


def test_registered():
    assert common.QUERIES["op6_secrets"] is secret_scan.op6_secrets


@pytest.mark.parametrize("n", [1, 2, 3, 10, 32_000])
def test_many_matches(spark, n):
    text = "".join(f"{i:024x}\n" for i in range(n))
    docs = spark.createDataFrame([(text,)], "text string")
    start = time.perf_counter()
    spans = docs.select(secret_scan.match_spans(F.col("text"), secret_scan.HEX, 2).alias("s")).first()["s"]
    assert time.perf_counter() - start < 8
    assert [tuple(s) for s in spans] == [(25 * i, 2, 25 * i + 24) for i in range(n)]
