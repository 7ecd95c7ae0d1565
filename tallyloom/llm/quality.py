"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that together cover every byte. Each byte
has a learned embedding; learned filters look at 16 bytes at a time, every 8
bytes; their responses are max-pooled over the chunk and pass a small dense layer
to a chunk score. The scores of all chunks of a text (mean, lowest, highest) are
combined by a logistic layer into one probability. The network sees bytes only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import common
from tallyloom.llm.words import pieces

CHUNK, STEP, BLOCK, WIDTH = 512, 448, 8, 8
FILTERS, HIDDEN, PAD = 32, 16, 256
# Documented bound of the training sample: texts per label, and random chunks per text that the network is fitted to.
SAMPLE_TEXTS, SAMPLE_CHUNKS = 1500, 6
REJECT_BELOW = 0.3


@dataclass
class Network:
    embed: np.ndarray  # 257 x WIDTH, the last row (padding) is zero
    filters: np.ndarray  # 2 x (BLOCK * WIDTH) x FILTERS: first and second half of the 16 bytes
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    combine: np.ndarray  # weights of mean, lowest, highest chunk score, and the constant


def chunk_places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each chunk of all texts, the end of its text, and chunks per text."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - (CHUNK - STEP)) // STEP))
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(offsets[:-1], counts) + nth * STEP, np.repeat(offsets[1:], counts), counts


def codes_at(data: np.ndarray, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Byte codes of chunks, a row each, padded behind the text's end; an empty text is one chunk of padding."""
    at = firsts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    codes = np.full(at.shape, PAD, np.int16)
    codes[inside] = data[at[inside]]
    return codes


def chunked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all chunks of all texts, and chunks per text."""
    firsts, ends, counts = chunk_places(offsets)
    codes = np.empty((len(firsts), CHUNK), np.int16)
    for lo in range(0, len(firsts), 512):
        codes[lo : lo + 512] = codes_at(data, firsts[lo : lo + 512], ends[lo : lo + 512])
    return codes, counts


def _responses(net: Network, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(codes)
    blocks = net.embed[codes].reshape(n, CHUNK // BLOCK, BLOCK * WIDTH)
    pre = blocks[:, :-1] @ net.filters[0] + blocks[:, 1:] @ net.filters[1] + net.bias
    # A window that begins behind the text's end has no say.
    pre[codes[:, : CHUNK - BLOCK : BLOCK] == PAD] = -1.0
    return blocks, pre


def chunk_scores(net: Network, data: np.ndarray, offsets: np.ndarray, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Score of each chunk of all texts, and chunks per text; ``rows`` chunks are laid out at a time, however long a text is."""
    firsts, ends, counts = chunk_places(offsets)
    out = []
    for lo in range(0, len(firsts), rows):
        codes = codes_at(data, firsts[lo : lo + rows], ends[lo : lo + rows])
        pooled = np.maximum(_responses(net, codes)[1].max(axis=1), 0)
        hidden = np.maximum(pooled @ net.dense + net.dense_bias, 0)
        out.append(hidden @ net.out + net.out_bias[0])
    return np.concatenate(out) if out else np.zeros(0, np.float32), counts


def _summary(scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    s = scores.astype(np.float64)
    return np.stack([np.add.reduceat(s, starts) / counts, np.minimum.reduceat(s, starts), np.maximum.reduceat(s, starts), np.ones(len(counts))], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def summaries(net: Network, texts: pa.Array) -> np.ndarray:
    """Mean, lowest and highest chunk score and 1 of each text, over all its bytes."""
    out = [np.zeros((0, 4))]
    for _, _, data, offsets in pieces(texts, 1 << 20):
        out.append(_summary(*chunk_scores(net, data, offsets)))
    return np.concatenate(out)


def probabilities(net: Network, texts: pa.Array) -> np.ndarray:
    """One probability per text, over all its bytes."""
    return _sigmoid(summaries(net, texts) @ net.combine)


def drawn(texts: pa.Array) -> list[list[bytes]]:
    """Bytes of at most SAMPLE_CHUNKS chunks of each text, from all over the whole text; the text alone decides which."""
    out = []
    for _, _, data, offsets in pieces(texts, 1 << 20):
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            raw = data[lo:hi].tobytes()
            count = max(1, -(-(len(raw) - (CHUNK - STEP)) // STEP))
            pick = np.arange(count) if count <= SAMPLE_CHUNKS else np.sort(np.random.default_rng(zlib.crc32(raw)).choice(count, SAMPLE_CHUNKS, replace=False))
            out.append([raw[k * STEP : k * STEP + CHUNK] for k in pick.tolist()])
    return out


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.state = rate, 0, {}

    def update(self, name: str, value: np.ndarray, grad: np.ndarray) -> None:
        m, v = self.state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        value -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def train(texts: list[str], labels: list[int], prior: float, epochs: int = 8, seed: int = 7) -> Network:
    """Fit on whole-text labels: chunks of a text carry its label; then the combination of chunk scores is fitted to every third text, over all its chunks.

    ``prior``: share of label 1 among all labelled rows, to which the sample is weighted.
    """
    column, y = pa.array(texts, pa.string()), np.array(labels, np.float64)
    held = np.arange(len(y)) % 3 == 2
    net = train_chunks([c for c, h in zip(drawn(column), held, strict=True) if not h], y[~held], prior, epochs, seed)
    return combined(net, summaries(net, column)[held], y[held], prior)


def combined(net: Network, features: np.ndarray, y: np.ndarray, prior: float) -> Network:
    """The network with its combination fitted to the summaries of texts that its chunk scores were not fitted to; unchanged without both labels."""
    if len(set(y.tolist())) > 1:
        net.combine = _logistic(features, y, prior)
    return net


def train_chunks(chunks: list[list[bytes]], labels: np.ndarray, prior: float, epochs: int = 8, seed: int = 7) -> Network:
    """Network whose chunk scores are fitted to the chunks drawn from each text, with the text's label."""
    rng = np.random.default_rng(seed)
    net = Network(
        embed=rng.normal(0, 0.5, (257, WIDTH)).astype(np.float32),
        filters=rng.normal(0, (2 * BLOCK * WIDTH) ** -0.5, (2, BLOCK * WIDTH, FILTERS)).astype(np.float32),
        bias=np.zeros(FILTERS, np.float32),
        dense=rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32),
        dense_bias=np.zeros(HIDDEN, np.float32),
        out=rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
        out_bias=np.zeros(1, np.float32),
        combine=np.array([0.0, 0.0, 0.0, np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))]),
    )
    net.embed[PAD] = 0
    if len(set(labels.tolist())) < 2:
        return net
    flat = [c for own in chunks for c in own]
    # A drawn chunk is cut to one chunk again, by itself.
    x, _ = chunked(np.frombuffer(b"".join(flat), np.uint8), np.cumsum([0, *map(len, flat)]))
    target = np.repeat(labels, [len(own) for own in chunks]).astype(np.float32)
    rows = np.arange(len(x))
    share = max(1e-3, target.mean())
    weight = np.where(target > 0, 0.5 / share, 0.5 / max(1e-3, 1 - share)).astype(np.float32)
    adam = _Adam(0.004)
    for _ in range(epochs):
        rng.shuffle(rows)
        for lo in range(0, len(rows), 128):
            at = rows[lo : lo + 128]
            adam.step += 1
            c, n = x[at], len(at)
            blocks, pre = _responses(net, c)
            best = pre.argmax(axis=1)
            pooled_raw = np.take_along_axis(pre, best[:, None, :], 1)[:, 0]
            pooled = np.maximum(pooled_raw, 0)
            h_raw = pooled @ net.dense + net.dense_bias
            h = np.maximum(h_raw, 0)
            p = _sigmoid(h @ net.out + net.out_bias[0])
            d = ((p - target[at]) * weight[at] / n).astype(np.float32)
            dh = np.outer(d, net.out) * (h_raw > 0)
            dp = (dh @ net.dense.T) * (pooled_raw > 0)
            g_filters, g_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
            item = np.arange(n)[:, None]
            for half in (0, 1):
                seen = blocks[item, best + half]  # n x FILTERS x (BLOCK * WIDTH)
                g_filters[half] = np.einsum("nfk,nf->kf", seen, dp)
                back = dp[:, :, None] * net.filters[half].T[None]
                which = c.reshape(n, CHUNK // BLOCK, BLOCK)[item, best + half]
                np.add.at(g_embed, which.reshape(-1), back.reshape(-1, WIDTH))
            g_embed[PAD] = 0
            for name, grad in (("embed", g_embed), ("filters", g_filters), ("bias", dp.sum(0)), ("dense", pooled.T @ dh), ("dense_bias", dh.sum(0)), ("out", h.T @ d), ("out_bias", np.array([d.sum()]))):
                adam.update(name, getattr(net, name), grad.astype(np.float32))
    return net


def _logistic(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps, rows weighted to the prior."""
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w = np.where(y > 0, prior / share, (1 - prior) / (1 - share))
    beta, ridge = np.zeros(x.shape[1]), np.diag([0.5] * (x.shape[1] - 1) + [1e-3])
    for _ in range(30):
        p = _sigmoid(x @ beta)
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        beta += np.clip(np.linalg.solve(h, x.T @ (w * (y - p)) - ridge @ beta), -3, 3)
    return beta


def training_sample(docs: DataFrame, labels: DataFrame, label: str, fold: tuple[int, int] | None = (5, 0), most: int = SAMPLE_TEXTS) -> DataFrame:
    """(doc_id, text, _label, _held) of at most ``most`` rows per label value, chosen by a hash of the id; rows of the held-out fold are left out.

    An id that repeats gives one text a label; an id labelled 0 and 1 stands under both. Texts are whole. Every third row of a label is held from the chunk scores' fit, for that of their combination.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("_label")).where("doc_id is not null and _label in (0, 1)")
    if fold:
        known = known.where(common.bucket_of(F.col("doc_id"), fold[0]) != fold[1])
    chosen = common.sampled_ids(known, "_label", most)
    return common.sampled_texts(docs.select("doc_id", "text"), chosen).select("doc_id", "text", "_label", (F.col("_n") % 3 == 2).alias("_held"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: tuple[int, int] | None = (5, 0), most: int = SAMPLE_TEXTS) -> Network:
    """Network fitted on a bounded sample of labelled texts, which stay whole and in their tasks.

    To the driver come SAMPLE_CHUNKS chunks a text at most, from all over it, and of each
    held text the mean, lowest and highest score of all its chunks.
    """
    common.small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1))
    if fold:
        known = known.where(common.bucket_of(F.col("doc_id"), fold[0]) != fold[1])
    prior = known.agg(F.avg(F.col(label).cast("double"))).first()[0]
    prior = 0.5 if prior is None else prior
    sample = common.stage(training_sample(docs, labels, label, fold, most), "training")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(drawn(batch.column("text")), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_label"), found], ["doc_id", "_label", "chunks"])

    id_type = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.where("not _held").mapInArrow(draw, f"doc_id {id_type}, _label int, chunks array<binary>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["_label"], r["chunks"]))
    net = train_chunks([[bytes(c) for c in r["chunks"]] for r in rows], np.array([r["_label"] for r in rows], np.float64), prior)

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, low, high, _ = summaries(net, batch.column("text")).T
            yield pa.RecordBatch.from_arrays([batch.column("_label"), *map(pa.array, (mean, low, high))], ["_label", "mean", "low", "high"])

    def whole(texts: DataFrame) -> np.ndarray:
        seen = texts.mapInArrow(summarize, "_label int, mean double, low double, high double").collect()
        return np.array(sorted(map(tuple, seen)), np.float64).reshape(-1, 4)

    found = whole(sample.where("_held"))
    if len(set(found[:, 0])) < 2:
        # Too few texts to hold any back.
        found = whole(sample)
    return combined(net, np.column_stack([found[:, 1:], np.ones(len(found))]), found[:, 0], prior)


def score(docs: DataFrame, net: Network, text: str = "text", column: str = "score") -> DataFrame:
    """The columns of ``docs`` and the probability of label 1 of each whole text (null counts as empty).

    A map-only pass; the network (about 30 KB) travels with the task. A column of
    ``docs`` that has the name of the new one is replaced.
    """
    common.small_batches(docs.sparkSession)
    docs = docs.drop(column)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(probabilities(net, batch.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(add, f"{fields}, `{column}` double")


@common.query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; labels outside the held-out fold are learned from. A row without doc_id is not held out; repeated rows are scored alike."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(common.bucket_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= REJECT_BELOW, 1).otherwise(0).cast("int").alias("predicted"))
