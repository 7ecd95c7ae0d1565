"""Corpus operators against plain Python on small tables with nulls, empty and long texts, repeats and clashing columns."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tallyloom.llm import common, fingerprint, langid, line_dedup, mixing, ngram_join, packing, quality, secret_scan, substring, vectors

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_texts(seed=3, n=120):
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(60, 160))) for _ in range(n // 4)]
    out = []
    for i in range(n):
        parts = base[rng.randrange(len(base))].split()
        for _ in range(rng.randint(0, 6)):
            parts[rng.randrange(len(parts))] = rng.choice(words)
        text = " ".join(parts)
        out.append(text if i % 3 else text[: len(text) // 2] + "\n" + text[len(text) // 2 :])
    return out + [None, "", " \n\t", "One two", "one TWO", "three", "a b c d e", base[0], base[0], " ".join(rng.choices(words, k=20000))]


@pytest.fixture(scope="module")
def docs(spark):
    texts = make_texts()
    rows = [(3 * i + 1, t, ("en", "fr", None)[i % 3], "big" if i % 3 else None, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("score", __import__("pyspark").sql.functions.lit("x")).repartition(5).cache()


@pytest.fixture(scope="module")
def plain(docs):
    return sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_ngram_join(spark, docs, plain):
    sets = {i: shingles(t) for i, t in plain}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both > 0 and 100 * both >= 75 * len(sets[a] | sets[b])

    want = groups([i for i, _ in plain], linked)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i, _ in plain}
    assert len(set(want.values())) < len(want) - 20
    assert ngram_join.jaccard_components(empty(spark)).count() == 0


def test_signatures_always_meet():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(2, 200))
        pool = np.unique(rng.integers(0, 1 << 63, 3 * n).astype(np.uint64))
        x = np.sort(rng.choice(pool, n, replace=False))
        y = np.unique(np.concatenate([x[rng.random(n) > 0.1], rng.choice(pool, n // 8)]))
        both = len(np.intersect1d(x, y))
        if len(y) < 2 or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        level = {t: k for t, k in zip(pool.tolist(), rng.integers(1, 3, len(pool)), strict=True)}
        marks = lambda s, o: (np.array([t in set(o.tolist()) for t in s.tolist()]), np.array([level[t] == 2 for t in s.tolist()]))  # noqa: B023, E731
        assert np.intersect1d(ngram_join.signatures(x, *marks(x, y)), ngram_join.signatures(y, *marks(y, x))).size


def test_blocks_find_all_links():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(40)]
    a, b = ngram_join.block_links(sets, np.full(40, 2), 75, stretch=16)
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if 100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= 75 * (len(sets[i]) + len(sets[j]) - c)}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_fingerprints(spark, docs, plain):
    order = sorted(plain, reverse=True, key=lambda r: r[0])
    got = {r["doc_id"]: r for r in fingerprint.edited_fingerprints(docs).collect()}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own = fingerprint.decode(got[i]["fingerprint"])
        assert len(own) == min(128, len(shingles(text)))
        a, b = shingles(text), shingles(edited)
        likeness = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(got[i]["near_edited"] - likeness) < (1e-9 if len(a | b) <= 128 else 0.2)
    assert fingerprint.edited_fingerprints(empty(spark)).count() == 0
    one, two = (fingerprint.sketches(__import__("pyarrow").array([t]))[0] for t in (plain[0][1], plain[1][1]))
    assert (fingerprint.merge(one, two) == fingerprint.merge(two, one)).all() and fingerprint.containment(one, fingerprint.merge(one, two)) > 0.9
    marked = fingerprint.fingerprint(docs)
    merged = {r["source"]: r["_sketch"] for r in fingerprint.merge_by(marked, ["source"]).collect()}
    parts = {}
    for r in marked.collect():
        parts.setdefault(r["source"], [np.zeros(0, np.uint64)]).append(np.frombuffer(r["_sketch"], "<u8"))
    assert merged == {s: fingerprint.merge(*p).astype("<u8").tobytes() for s, p in parts.items()}


def test_quality_and_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, sf, "labels").collect()}
    rows = [r for r in quality.op3_quality(spark, sf).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    known = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in known]) > 0.93
    langs = {r["doc_id"]: r["lang"] for r in common.table(spark, sf, "documents").collect()}
    found = langid.op10_langid(spark, sf).collect()
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in found if r["held_out"]]) > 0.95
    codes = langid.codewords(9)
    assert min((codes[i] != codes[j]).sum() for i in range(9) for j in range(i)) >= 5


def test_odd_texts_are_scored(spark, docs):
    net = quality.train(["good text " * 30, "!!! ### " * 30] * 6, [1, 0] * 6, 0.5)
    scored = quality.score(docs, net, column="_s").collect()
    assert len(scored) == docs.count() and all(0 <= r["_s"] <= 1 and r["score"] == "x" for r in scored)
    assert quality.score(empty(spark), net).count() == 0
    assert quality.train([], [], 0.5).combine[-1] == 0
    model = langid.train(["the of and", "der die das", "le la les"] * 4, ["en", "de", "fr"] * 4)
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in found.values())
    assert langid.identify(empty(spark), langid.train([], [])).count() == 0


def test_quality_is_fitted_to_whole_long_texts(spark):
    """Ends and middle of all texts are alike; what tells them apart lies between."""
    rng = random.Random(8)
    say = lambda words, size: " ".join(rng.choices(words, k=size))[:size]
    shared, kinds = ["same", "text", "here"], (["good", "prose", "reads"], ["zzz", "###", "junk!"])
    text = lambda k, size: say(shared, 1300) + say(kinds[k], size) + say(shared, 1400) + say(kinds[k], size) + say(shared, 1300)
    rows = [(i, text(i % 2, rng.choice([3000, 6000, 40000])), 1 - i % 2) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    net = quality.fit(frame.select("doc_id", "text"), frame.select("doc_id", "quality"), fold=None)
    probability = quality.probabilities(net, __import__("pyarrow").array([t for _, t, _ in rows]))
    assert np.mean([(p >= 0.5) == y for p, (_, _, y) in zip(probability, rows, strict=True)]) > 0.95
    twin = quality.fit(frame.select("doc_id", "text").repartition(2), frame.select("doc_id", "quality"), fold=None)
    assert np.allclose(twin.combine, net.combine, atol=1e-3)


@pytest.mark.parametrize("name, module", [("op4_mixing", mixing), ("op9_line_dedup", line_dedup)])
def test_equals_sql(spark, docs, name, module):
    frame = docs.select(*[c.split()[0] for c in SCHEMA.split(",")]).toPandas()
    con = duckdb.connect()
    con.register("documents", frame)
    want = con.execute(module.ORACLE).df()
    sf = "/tmp/corpus-tests-" + hashlib.md5(str(random.random()).encode()).hexdigest()
    docs.drop("score").write.parquet(f"{sf}/documents.parquet")
    got = common.QUERIES[name](spark, sf).toPandas()[list(want.columns)]
    assert sorted(map(repr, want.astype(object).where(want.notna(), None).values.tolist())) == sorted(map(repr, got.astype(object).where(got.notna(), None).values.tolist()))


def test_mixing_weights(spark, docs):
    mixed = mixing.mix(docs, {"big": 1.0}, seed=1)
    assert {r["source"] for r in mixed.select("source").distinct().collect()} == {"big"} and "score" in mixed.columns
    assert mixing.mix(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"big": -1.0})


def test_near_lines_by_brute_force(spark):
    rng = random.Random(2)
    lines = ["".join(rng.choices("abcdé ", k=rng.randint(19, 24))).strip() + "x" for _ in range(12)]
    for line in list(lines):
        at = rng.randrange(len(line))
        lines += [line[:at] + "z" + line[at:], line[:at] + line[at + 1 :], line[:at] + "z" + line[at + 1 :]]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    for limit in (1, 2):

        def distance(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a, 1):
                row = [i] + [0] * len(b) if False else _next(row, i, x, b)
            return row[-1]

        def _next(row, i, x, b):
            out = [i]
            for j, y in enumerate(b, 1):
                out.append(min(out[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            return out

        want = {i for i, t in enumerate(lines) if any(t == u or (min(len(t), len(u)) >= 20 and distance(t, u) <= limit) for u in lines[:i])}
        got = {r["_id"] for r in line_dedup.repeated_lines(frame, threshold=limit).collect()}
        assert got == want


def test_line_removal_keeps_the_rest(spark, docs, plain):
    cut = {r["doc_id"]: r for r in line_dedup.remove_lines(docs).collect()}
    seen = set()
    for i, text in plain:
        lines = [] if text is None else text.split("\n")
        assert cut[i]["n_lines"] == len(lines) and cut[i]["score"] == "x"
        if cut[i]["n_removed"] == 0:
            assert cut[i]["text"] == text
        for line in lines:
            seen.add(line)
    assert sum(r["n_removed"] for r in cut.values()) > 0 and line_dedup.remove_lines(empty(spark)).count() == 0


def test_packing_round_trip(spark, docs, plain):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_path())
    rows = packing.pack_documents(docs, 64).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in plain:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["length"] for r in own[:-1]] == [64] * (len(own) - 1) and sum(r["length"] for r in own) == len(ids)
        assert all(zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in own)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]] and sum(n for _, n in parts) <= 64
    assert packing.pack_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("remembered", [1_000_000, 300])
def test_word_tokens_equal_the_tokenizer(monkeypatch, remembered):
    """Also where the memory is too small for the words of one text, and starts anew."""
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    words = packing.WordTokens(packing.default_path())
    rng = random.Random(5)
    odd = "ÀÉ Straße. x<|endoftext|>y Foo<|ENDOFTEXT|> don't it's'' a'm z!!'s ÿ÷× n\u0303a é. İI ſ K c\u3000d \t\x85q_q __ 12ab34 'll ABC$$$ É!! ≮ a≮\u0338"
    texts = [odd, "", " ", "\n\n", *(" ".join("".join(rng.choices("abÉ.,!'é1<|\n", k=rng.randint(0, 6))) for _ in range(rng.randint(0, 200))) for _ in range(60))]
    want = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for lo in range(0, len(texts), 8):
        assert [found.tolist() for found in words.batch(texts[lo : lo + 8])] == want[lo : lo + 8]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_keeps_every_capacity(rule):
    lengths = np.random.default_rng(1).integers(1, 60, 500)
    sequence, _ = packing.assign(lengths, (100, 4, 4000), (1.0, 0.1, 0.1), rule)
    for s in set(sequence.tolist()):
        own = lengths[sequence == s]
        assert own.sum() <= 100 and len(own) <= 4 and (own**2).sum() <= 4000
    with pytest.raises(ValueError):
        packing.assign(np.array([101]), (100, 4, 40000))


def test_secrets(spark):
    rng = random.Random(4)
    key = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=44))
    hexa = "".join(rng.choices("0123456789abcdef", k=40))
    texts = [None, "", f"x Password = 'abc123' é {hexa}", "secret: token: abcdefg", "AKIA" + "A" * 15, "é AKIA" + "B1" * 9, f"see {key} there", "internationalizationofmanywords and more", f"token:{hexa}"]
    frame = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, _hex string")
    base = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r in secret_scan.scan(frame).collect():
        text = r["text"] or ""
        assert [(s["start"], s["end"]) for s in r["_assign"]] == [m.span() for m in base.finditer(text) if len(m[1]) >= 6]
        assert [(s["start"], s["end"]) for s in r["_access"]] == [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        assert [(s["start"], s["end"]) for s in r["_hex"]] == [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert any(text[s["start"] : s["end"]] == key for s in r["_random"]) == (key in text)
        assert "internationalization" not in "".join(text[s["start"] : s["end"]] for s in r["_random"])
    assert secret_scan.scan(empty(spark)).count() == 0


def test_substring_dedup(spark, docs, plain):
    first, want = {}, {}
    for i, text in plain:
        words = (text or "").encode().split()
        stay = [True] * len(words)
        for k in range(len(words) - 49):
            if first.setdefault(tuple(words[k : k + 50]), i) < i:
                stay[k : k + 50] = [False] * 50
        want[i] = (len(words), stay.count(False), b" ".join(w for w, s in zip(words, stay, strict=True) if s).decode())
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring.remove_repeats(docs).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 500
    assert substring.remove_repeats(empty(spark)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + rng.normal(0, 0.04 * (i % 4), 16)).tolist(), i % 2) for i in range(150)]
    rows += [(200, None, 0), (201, [0.0] * 16, 0), (202, [float("nan")] * 16, 0), (203, [1.0, None], 0), (204, rows[0][1], None), (205, rows[0][1], 0), (206, rows[0][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "'a' as n_links")
    usable = {i: (np.array(v) / np.linalg.norm(v), c) for i, v, c in rows if c is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    linked = lambda a, b: a in usable and b in usable and usable[a][1] == usable[b][1] and len(usable[a][0]) == len(usable[b][0]) and usable[a][0] @ usable[b][0] >= 0.98
    ids = [r[0] for r in rows]
    want = groups(ids, linked)
    got = {r["vec_id"]: r for r in vectors.near_duplicates(frame).collect()}
    for i in ids:
        assert got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i)
        assert got[i]["n_links"] == sum(linked(i, j) for j in ids if j != i)
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_pipeline_stages(spark, docs):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert stage(spark, empty(spark), sf).count() == 0, name
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf).collect()}
    assert kept == {r["component_id"] for r in ngram_join.jaccard_components(docs).collect()}
    assert corpus_pipeline.run(spark, sf).count() > 100


def test_near_duplicates_with_null_and_repeated_ids(spark):
    """Linked rows are one group whatever their ids: without one, or with the id of another text."""
    rng = random.Random(12)
    text = lambda: " ".join(rng.choices([f"w{i}" for i in range(300)], k=80))
    near = lambda t: t + " " + " ".join(rng.choices("abc", k=4))
    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [(5, a), (None, near(a)), (None, b), (None, near(b)), (None, b), (7, c), (7, near(c)), (8, d), (9, near(d)), (9, e), (None, f), (10, f), (10, f), (None, None), (None, ""), (11, ""), (11, None), (12, " ")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(4)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, frame, "").collect()]
    sets = [shingles(t) for _, t in rows]
    root = groups(list(range(len(rows))), lambda x, y: len(sets[x] & sets[y]) > 0 and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]))
    whole = {}
    for k, row in enumerate(rows):
        whole.setdefault(root[k], set()).add(row)
    # Groups of each test text: {a}, {b}, {c}, {d}, {e}, {f}, and each text without words alone.
    assert len(whole) == 11 and len(kept) == len(set(kept)) == 11
    for members in whole.values():
        ids = [i for i, _ in members if i is not None]
        own = [row for row in kept if row in members]
        assert len(own) == 1 and own[0][0] == (min(ids) if ids else None)


def test_language_is_fitted_to_whole_long_texts(spark):
    """Ends and middle of all texts are alike; what tells the languages apart lies between."""
    rng = random.Random(9)
    say = lambda words, size: " ".join(rng.choices(words, k=size))[:size]
    shared, kinds = ["same", "text", "here"], {c: [c * 2, c * 3, c * 5] for c in "dkowz"}
    text = lambda lang: say(shared, 3100) + say(kinds[lang], 4000) + say(shared, 2200) + say(kinds[lang], 4000) + say(shared, 3100)
    rows = [(i, text(lang), lang) for i, lang in enumerate("dkowz" * 12)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), fold=None)
    fresh = [say(kinds[lang], 400) for _, _, lang in rows]
    found, _, _ = langid.decode(model, langid.margins(model, __import__("pyarrow").array(fresh)))
    assert np.mean([model.languages[k] == lang for k, (_, _, lang) in zip(found, rows, strict=True)]) > 0.95
