"""Best-fit packing of token pieces into sequences under several capacities at once.

Pieces are token runs of documents. A sequence has three capacities: tokens,
number of pieces, and attention cost (sum of squared piece lengths). Pieces go in
descending size into the open sequence that fits all three and is left with the
smallest weighted residual norm (or has the largest weighted dot product of
demand and residual); where none fits, a new sequence opens.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import common

MAX_TOKENS = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Documents that one packing task handles; a task leaves at most a few sequences part-filled.
DOCS_PER_GROUP = 16_384
# Words remembered per worker; beyond, the memory starts anew.
REMEMBERED = 700_000

# Letters that no normal form changes, and the marks behind them, which are a part of their own.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_WORDS_AT_ONCE = 1 << 16


class WordTokens:
    """Token ids of texts, by words that are tokenized once and remembered.

    Exact for tokenizers that treat white space as a border and drop it: a text's
    ids are then those of its parts between plain spaces and line feeds. New words of
    Latin letters go to the same vocabulary and merges many at a time: such a tokenizer keeps
    a run of letters whole, lowers it, and marks the last id of a part as a word end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for part, i in vocabulary.items() if part.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.first = np.zeros(1 << 12, np.int64)  # where each word's ids begin
        self.ids = np.zeros(1 << 14, np.uint32)

    def _add(self, fresh: list[str]) -> None:
        """Any words, each by itself."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._append(fresh, sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())))

    def _add_letters(self, fresh: list[str]) -> None:
        """Words of Latin letters, as one text of lower-case words."""
        for lo in range(0, len(fresh), _WORDS_AT_ONCE):
            some = fresh[lo : lo + _WORDS_AT_ONCE]
            ids = np.array(self.letters.encode_batch_fast([" ".join(some).lower()], add_special_tokens=False)[0].ids, np.uint32)
            self._append(some, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1), ids)

    def _append(self, fresh: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        base = len(self.index)
        self.index.update(zip(fresh, range(base, base + len(fresh)), strict=True))
        begin = int(self.first[base])
        # Room is doubled, so that learning costs what is learned.
        while base + len(fresh) >= len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        while begin + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.first[base + 1 : base + 1 + len(fresh)] = begin + np.cumsum(sizes)
        self.ids[begin : begin + len(ids)] = ids

    def gather(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in order, and how many each has."""
        begin = self.first[word]
        size = self.first[word + 1] - begin
        return self.ids[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))], size

    def learn(self, fresh: list[str]) -> None:
        """Marks behind letters are a part of their own, so such a word is its stem and the marks."""
        known = self.index
        stems: dict[str, None] = {}
        whole: dict[str, None] = {}
        marked: list[tuple[str, str, str]] = []
        for word in fresh:
            if not (found := _PLAIN.fullmatch(word)):
                whole[word] = None
            elif not (marks := found[2]):
                stems[word] = None
            else:
                marked.append((word, stem := found[1], marks))
                if stem not in known:
                    stems[stem] = None
                if marks not in known:
                    whole[marks] = None
        if len(known) + len(stems) + len(whole) + len(marked) > REMEMBERED:
            raise OverflowError
        if stems:
            self._add_letters(list(stems))
        if whole:
            self._add(list(whole))
        if marked:
            ids, size = self.gather(np.array([i for _, stem, marks in marked for i in (known[stem], known[marks])], np.int64))
            self._append([row[0] for row in marked], size[0::2] + size[1::2], ids)

    def split(self, texts: list[str]) -> pa.ListArray:
        """Parts of each text. A-Z are lowered by the tokenizer anyway; a text that could spell a special token is left as it is."""
        found = pa.array(texts, pa.string())
        found = pc.if_else(pc.match_substring(found, "<|"), found, pc.ascii_lower(found))
        return pc.split_pattern(pc.replace_substring(found, "\n", " "), " ")

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        split = self.split(texts)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        at = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            try:
                self.learn([distinct[i] for i in missing])
            except OverflowError:
                self.reset()
                if len(texts) > 1:
                    half = len(texts) // 2
                    return self.batch(texts[:half]) + self.batch(texts[half:])
                if 3 * len(distinct) > REMEMBERED:
                    return [np.array(self.tokenizer.encode(texts[0], add_special_tokens=False).ids, np.uint32)]
                return self.batch(texts)
            at[missing] = [self.index[distinct[i]] for i in missing]
        word = at[words.indices.to_numpy()]
        return [self.gather(word[lo:hi])[0] for lo, hi in pairwise(split.offsets.to_pylist())]


_loaded: dict[str, WordTokens] = {}


def _tokens(path: str) -> WordTokens:
    """One per worker process and file."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def default_path() -> str:
    """The tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def cut(docs: DataFrame, most: int = MAX_TOKENS, path: Callable[[], str] = default_path) -> DataFrame:
    """Pieces of every document: its ids and the end id; documents over ``most`` tokens are cut into full pieces and a rest.

    Returns doc_id, piece, start, length, ids_crc32. ``path`` is called on the workers.
    A null text is empty: one piece with the end id alone. Map-only; no text leaves the task.
    """
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path())
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows: list[tuple] = []
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < 1 << 20):
                    size += len(texts[hi] or "")
                    hi += 1
                for doc_id, found in zip(ids[lo:hi], tokens.batch([t or "" for t in texts[lo:hi]]), strict=True):
                    whole = np.append(found, np.uint32(END_ID)).astype("<u4")
                    for piece, start in enumerate(range(0, len(whole), most)):
                        part = whole[start : start + most]
                        rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
                lo = hi
            columns = zip(*rows, strict=True) if rows else [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def assign(
    lengths: np.ndarray,
    capacity: tuple[int, int, int] = (MAX_TOKENS, MAX_TOKENS, MAX_TOKENS**2),
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; every sequence keeps all three capacities.

    Pieces of equal length go together: they are placed one by one, but the search
    looks at the open sequences' residual vectors as arrays. ``rule``: "norm" or "dot".
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    lengths = np.asarray(lengths, np.int64)
    demand = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1)
    limit = np.array(capacity, np.int64)
    if len(lengths) and (demand > limit).any():
        raise ValueError("a piece exceeds a capacity by itself")
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.empty((64, 3), np.int64)
    name = np.empty(64, np.int64)
    open_count = made = 0
    scale = np.array(weights) / limit.astype(float) ** 2
    smallest = int(lengths.min()) if len(lengths) else 0
    least = np.array([smallest, 1, smallest**2])
    for i in order:
        need = demand[i]
        residual = left[:open_count]
        fits = np.flatnonzero((residual >= need).all(axis=1))
        if len(fits):
            if rule == "norm":
                after = (residual[fits] - need).astype(float)
                at = fits[np.argmin((after * after) @ scale)]
            else:
                at = fits[np.argmax((residual[fits] * need).astype(float) @ scale)]
        else:
            if open_count == len(left):
                left, name = np.concatenate([left, np.empty_like(left)]), np.concatenate([name, np.empty_like(name)])
            at = open_count
            left[at], name[at] = limit, made
            open_count += 1
            made += 1
        sequence[i], offset[i] = name[at], limit[0] - left[at, 0]
        left[at] -= need
        if (left[at] < least).any():
            # Closed: no piece fits any more; the last open one takes its place.
            open_count -= 1
            left[at], name[at] = left[open_count], name[open_count]
    return sequence, offset


def pack(pieces: DataFrame, groups: int, capacity: tuple[int, int, int] = (MAX_TOKENS, MAX_TOKENS, MAX_TOKENS**2), weights=(1.0, 0.01, 0.01), rule: str = "norm") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.

    Pieces are dealt evenly, by a hash of the whole row and place, over ``groups``
    tasks that each pack what they get; full pieces are sequences of their own and are dealt likewise.
    """
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length", "start"), F.lit(groups)).cast("int"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        sequence, offset = assign(frame["length"].to_numpy(), capacity, weights, rule)
        frame = frame.drop(columns="_group")
        frame["sequence_id"] = int(key[0]) * (1 << 32) + sequence
        frame["offset"] = offset
        return frame

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("_group").applyInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, most: int = MAX_TOKENS, path: Callable[[], str] = default_path) -> DataFrame:
    """All documents packed into sequences of at most ``most`` tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    groups = max(1, round(docs.count() / DOCS_PER_GROUP))
    return pack(cut(docs, most, path), groups, (most, most, most**2))


@common.query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed."""
    return pack_documents(common.table(spark, sf_dir, "documents"))
