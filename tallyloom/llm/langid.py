"""Language identification with error-correcting output codes.

Every language has a codeword; one linear classifier over hashed byte n-grams
predicts each bit. A text's bit margins, averaged over all its n-grams, are
compared with every codeword: the loss of a codeword is the sum of its bits'
logistic losses, each weighted by how well that bit's classifier did on texts it
was not fitted to. The codeword of least loss wins; a near second flags ambiguity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import common
from tallyloom.llm.words import BLANK, pieces

TABLE_BITS = 13
# Documented bound of the training sample: texts per language, and of all languages together.
SAMPLE_TEXTS, SAMPLE_TOTAL = 600, 12_000
AMBIGUOUS_BELOW = 0.8
SCALE = 40.0
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[BLANK] = 32


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # n-gram table x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss


def gram_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table slots of the n-grams (1 to 3 bytes, blanks and A-Z folded) ending at each byte, text by text, and grams per text."""
    sizes = np.diff(offsets)
    b = _FOLD[data]
    first = np.zeros(len(b) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    one = np.empty_like(b)
    one[1:] = b[:-1]
    one[first] = 32
    two = np.empty_like(b)
    two[1:] = one[:-1]
    two[first] = 32
    shift = np.uint32(32 - TABLE_BITS)
    pair = ((one << np.uint32(8)) | b) * np.uint32(2654435761) ^ np.uint32(0x5BD1E995)
    triple = ((two << np.uint32(16)) | (one << np.uint32(8)) | b) * np.uint32(2246822519)
    return np.stack([triple >> shift, pair >> shift], axis=1).reshape(-1).astype(np.int32), 2 * sizes


def codewords(classes: int, seed: int = 11) -> np.ndarray:
    """One row of -1 and 1 per class. Up to five classes: every split of the classes once; beyond: of 300 random codes the one whose closest two rows differ most."""
    if classes <= 1:
        return np.ones((classes, 1), np.int8)
    if classes <= 5:
        return np.array([[1 if not c else 1 - 2 * (s >> (c - 1) & 1) for s in range(1, 1 << (classes - 1))] for c in range(classes)], np.int8)
    rng, bits, best, gap = np.random.default_rng(seed), 4 * int(np.ceil(np.log2(classes))) + 3, None, -1
    for _ in range(300):
        code = rng.choice(np.array([-1, 1], np.int8), (classes, bits))
        near = (code @ code.T.astype(np.int32) - 2 * bits * np.eye(classes, dtype=np.int32)).max()
        if (np.abs(code.sum(0)) < classes).all() and bits - near > gap:
            best, gap = code, bits - near
    return best if best is not None else code


def gram_shares(texts: pa.Array) -> list[tuple[bytes, bytes]]:
    """Table slots (2 bytes each) that the n-grams of each whole text fall into, and their scaled shares (4 bytes each)."""
    out = []
    for _, _, data, offsets in pieces(texts, 1 << 19):
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            ids, count = gram_ids(data[lo:hi], np.array([0, hi - lo]))
            found = np.bincount(ids, minlength=1 << TABLE_BITS)
            slots = np.flatnonzero(found)
            shares = found[slots].astype(np.float32) * (SCALE / max(1, int(count[0])))
            out.append((slots.astype("<u2").tobytes(), shares.astype("<f4").tobytes()))
    return out


def _features(shares: list[tuple[bytes, bytes]]) -> np.ndarray:
    x = np.zeros((len(shares), 1 << TABLE_BITS), np.float32)
    for row, (slots, values) in zip(x, shares, strict=True):
        row[np.frombuffer(slots, "<u2")] = np.frombuffer(values, "<f4")
    return x


def _stretches(rows: np.ndarray, size: int = 512) -> Iterator[np.ndarray]:
    """Row numbers, as many at a time as are laid out at once (16 MB)."""
    for lo in range(0, len(rows), size):
        yield rows[lo : lo + size]


def train(texts: list[str], languages: list[str], steps: int = 60) -> Model:
    """Model fitted to whole texts."""
    return train_shares(gram_shares(pa.array(texts, pa.string())), languages, steps)


def train_shares(shares: list[tuple[bytes, bytes]], languages: list[str], steps: int = 60) -> Model:
    """Logistic classifiers of all bits at once (full-batch Adam on mean n-gram counts); every third text is kept for the bits' trust."""
    known = sorted(set(languages))
    codes = codewords(len(known))
    at = np.array([known.index(x) for x in languages], np.int64)
    y = codes[at].astype(np.float32) if len(at) else np.zeros((0, codes.shape[1] if codes.size else 1), np.float32)
    bits = y.shape[1]
    w, b = np.zeros((1 << TABLE_BITS, bits), np.float32), np.zeros(bits, np.float32)
    held = np.arange(len(y)) % 3 == 2
    fitted = np.flatnonzero(~held)
    if len(known) > 1:
        counts = np.bincount(at[fitted], minlength=len(known)).astype(np.float32)
        weight = (1 / (len(known) * np.maximum(counts, 1)))[at][:, None]
        moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
        for step in range(1, steps + 1):
            grads = [1e-5 * w, np.zeros_like(b)]
            for rows in _stretches(fitted):
                x = _features([shares[i] for i in rows.tolist()])
                d = -y[rows] * weight[rows] / (1 + np.exp(np.clip(y[rows] * (x @ w + b), -30, 30)))
                grads[0] += x.T @ d
                grads[1] += d.sum(0)
            for k, (value, grad) in enumerate(zip((w, b), grads, strict=True)):
                m, v = moments[2 * k], moments[2 * k + 1]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                value -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    trust = np.ones(bits)
    if held.any() and len(known) > 1:
        agreed = sum(((_features([shares[i] for i in rows.tolist()]) @ w + b) * y[rows] > 0).sum(0) for rows in _stretches(np.flatnonzero(held)))
        right = np.clip(agreed / held.sum(), 0.5, 0.999)
        trust = np.log(right / (1 - right)) + 1e-3
        trust /= trust.sum() / bits
    return Model(known, codes, w, b, trust)


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the closest codeword (ties: the first language by name), its probability among all codewords, and the lead over the second."""
    if len(model.languages) <= 1:
        return np.zeros(len(margins), np.int64), np.ones(len(margins)), np.ones(len(margins))
    loss = (np.logaddexp(0, -np.clip(margins, -30, 30)[:, None, :] * model.codes[None]) * model.trust).sum(2)
    share = np.exp(loss.min(1, keepdims=True) - loss)
    share /= share.sum(1, keepdims=True)
    top = share.argmax(1)
    ranked = np.sort(share, axis=1)
    return top, share[np.arange(len(top)), top], ranked[:, -1] - ranked[:, -2]


def margins(model: Model, column: pa.Array) -> np.ndarray:
    """Bit margins of each text over all its n-grams."""
    out = [np.zeros((0, model.weights.shape[1]))]
    for _, _, data, offsets in pieces(column, 1 << 19):
        ids, counts = gram_ids(data, offsets)
        found = np.zeros((len(counts), model.weights.shape[1]))
        full = np.flatnonzero(counts)
        if len(full):
            begins = (np.cumsum(counts) - counts)[full]
            # Sums of single precision over short runs, then of double precision over the text.
            cuts = np.unique(np.concatenate([begins, np.arange(0, len(ids), 4096)]))
            runs = np.add.reduceat(model.weights[ids], cuts, axis=0).astype(np.float64)
            found[full] = np.add.reduceat(runs, np.searchsorted(cuts, begins), axis=0)
        out.append(found * (SCALE / np.maximum(counts, 1))[:, None] + model.bias)
    return np.concatenate(out)


def fit(docs: DataFrame, fold: tuple[int, int] | None = (3, 1), most: int = SAMPLE_TEXTS) -> Model:
    """Model of all languages in ``lang``, from at most ``most`` texts of each outside the held-out fold, chosen by a hash of the id.

    Of many languages there are fewer texts each, SAMPLE_TOTAL in all. An id that repeats gives one text a language.
    The n-grams of whole texts are counted in tasks; of a text at most 8,192 counts come to the driver.
    """
    common.small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = gram_shares(batch.column("text"))
            made = [pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), *made], ["doc_id", "lang", "slots", "shares"])

    known = docs.where("text is not null and lang is not null and doc_id is not null")
    if fold:
        known = known.where(common.bucket_of(F.col("doc_id"), fold[0]) != fold[1])
    languages = max(1, known.agg(F.countDistinct("lang")).first()[0])
    ids = common.sampled_ids(known, "lang", max(1, min(most, SAMPLE_TOTAL // languages)))
    chosen = common.sampled_texts(known.select("doc_id", "lang", "text"), ids)
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    rows = chosen.mapInArrow(count, f"doc_id {id_type}, lang string, slots binary, shares binary").collect()
    rows = sorted((r["doc_id"], r["lang"], bytes(r["slots"]), bytes(r["shares"])) for r in rows)
    return train_shares([r[2:] for r in rows], [r[1] for r in rows])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``lang_pred``, ``score`` and ``ambiguous``.

    Null texts and texts without a letter are ``und`` with score 0. Columns of
    ``docs`` that have the names of the new ones are replaced. A map-only pass over
    whole texts; the model (bits x 32 KB) travels as a broadcast variable.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    docs = docs.drop("lang_pred", "score", "ambiguous")
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    sent = spark.sparkContext.broadcast(model)
    marked = docs.withColumn("_letters", F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            top, share, lead = decode(own, margins(own, batch.column(text)))
            none = ~np.asarray(batch.column("_letters").to_pylist(), bool) | (not own.languages)
            top, share = np.where(none, len(own.languages), top), np.where(none, 0.0, share)
            found = [pa.array(names[top], pa.string()), pa.array(share, pa.float64()), pa.array(none | (lead < AMBIGUOUS_BELOW))]
            rest = [(c, n) for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "_letters"]
            yield pa.RecordBatch.from_arrays([*[c for c, _ in rest], *found], [*[n for _, n in rest], "lang_pred", "score", "ambiguous"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return marked.mapInArrow(add, f"{fields}, lang_pred string, score double, ambiguous boolean")


@common.query()
def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; languages outside the held-out fold are learned from. A row without doc_id is not held out; repeated rows are told alike."""
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", F.coalesce(common.bucket_of(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
