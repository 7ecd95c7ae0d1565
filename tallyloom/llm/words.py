"""Words, shingles and window hashes of Arrow text batches, computed with numpy over whole byte buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D, so words of
UTF-8 text are found without decoding. Hashes are 64 bits wide and depend on the
bytes only: every worker, batch size and partitioning gives the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finalizer)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_LOWERED = _BYTE.copy()
_LOWERED[65:91] = _BYTE[97:123]
# Bytes, and likewise words, that are hashed at a time: longer runs go through in stretches, so arrays and tables keep their size.
STRETCH = 1 << 17


def _powers(base: int, n: int) -> np.ndarray:
    """base^0..base^(n-1) modulo 2^64, by doubling."""
    table = np.ones(1, _U)
    while len(table) < n:
        table = np.concatenate([table, table * _U(pow(base, len(table), 1 << 64))])
    return table[:n]


_POWER, _UNPOWER = _powers(_BASE, STRETCH + 256), _powers(_INVERSE, STRETCH + 256)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, absolute) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:
        # Arrow allows bytes under a null; a null text has none here.
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
        return text_buffers(column)
    return data, offsets


def pieces(column: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows [lo, hi) of about ``most`` bytes at most (a longer text stands alone), with bytes and offsets from 0."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def _stretch(data: np.ndarray, breaks: np.ndarray, table: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unscrambled hash, first byte and end of the words of a stretch; no word crosses ``breaks``."""
    ink = ~blank[data]
    begin = ink.copy()
    begin[1:] &= ~ink[:-1]
    begin[breaks] = ink[breaks]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    before = breaks[breaks > 0] - 1
    last[before] = ink[before]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(table[data] * _POWER[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * _UNPOWER[starts], starts, ends


def word_stretches(data: np.ndarray, offsets: np.ndarray, lower: bool = False, blank: np.ndarray = BLANK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hash, first byte and end of the words of all texts, in stretches of STRETCH bytes.

    A word that goes on in the next stretch is held back and joined there.
    """
    table = _LOWERED if lower else _BYTE
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    held: tuple[_U, int, int] | None = None
    for lo in range(0, len(data), STRETCH):
        breaks = firsts[np.searchsorted(firsts, lo) : np.searchsorted(firsts, lo + STRETCH)] - lo
        part = data[lo : lo + STRETCH]
        value, starts, ends = _stretch(part, breaks, table, blank)
        starts, ends = starts + lo, ends + lo
        if held is not None:
            if len(starts) and starts[0] == held[2] and not (len(breaks) and breaks[0] == 0):
                joined = (int(held[0]) + int(value[0]) * pow(_BASE, int(starts[0]) - held[1], 1 << 64)) & _MASK
                value[0], starts[0] = _U(joined), held[1]
            else:
                value, starts, ends = np.append(_U(held[0]), value), np.append(held[1], starts), np.append(held[2], ends)
            held = None
        if len(ends) and ends[-1] == lo + len(part) and lo + len(part) < len(data):
            held = (value[-1], int(starts[-1]), int(ends[-1]))
            value, starts, ends = value[:-1], starts[:-1], ends[:-1]
        if len(starts):
            yield mix(value + (ends - starts).astype(_U)), starts, ends
    if held is not None:
        yield mix(np.array([held[0] + _U(held[2] - held[1])], _U)), np.array([held[1]]), np.array([held[2]])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes in reading order, words per text, first byte and end of each word."""
    found = list(word_stretches(data, offsets, lower, blank))
    none = np.zeros(0, np.int64)
    hashes, starts, ends = (np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0, _U), none, none)
    return hashes, np.diff(np.searchsorted(starts, offsets)), starts, ends


def windows(hashes: np.ndarray, counts: np.ndarray, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every k consecutive words of one text, its text and its first word's place in the text.

    ``short``: a text of 1 to k - 1 words gives one window of all its words, whose hash differs from those of full windows.
    """
    if k > 256:
        raise ValueError("windows of at most 256 words")
    made = np.maximum(0, counts - k + 1)
    if short:
        made[(counts > 0) & (counts < k)] = 1
    owner = np.repeat(np.arange(len(counts), dtype=np.int32), made)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made)
    at = np.repeat(np.cumsum(counts) - counts, made) + place
    width = np.minimum(counts, k)
    value = np.empty(len(at), _U)
    for lo in range(0, len(hashes), STRETCH):
        first, last = np.searchsorted(at, [lo, lo + STRETCH])
        part = hashes[lo : lo + STRETCH + k - 1]
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(part * _POWER[: len(part)], out=sums[1:])
        here, wide = at[first:last] - lo, width[owner[first:last]]
        value[first:last] = mix((sums[here + wide] - sums[here]) * _UNPOWER[here] + wide.astype(_U) * _U(0xD6E8FEB86659FD93))
    return value, owner, place


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the lower-cased (A-Z) words of each text, ascending per text, and how many each text has."""
    if len(offsets) == 2:
        value = _one_set(data, offsets, k)
        return value, np.array([len(value)], np.int64)
    hashes, counts, _, _ = words(data, offsets, lower=True)
    value, owner, _ = windows(hashes, counts, k, short=True)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.bincount(owner, minlength=len(counts)).astype(np.int64)


def _one_set(data: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Shingles of a single, perhaps very long text: only their hashes are kept, stretch after stretch."""
    rest, found = np.zeros(0, _U), []
    for hashes, _, _ in word_stretches(data, offsets, lower=True):
        run = np.concatenate([rest, hashes])
        found.append(np.unique(windows(run, np.array([len(run)]), k)[0]))
        rest = run[-(k - 1) :] if k > 1 else run[:0]
    if not sum(map(len, found)) and len(rest):
        return windows(rest, np.array([len(rest)]), k, short=True)[0]
    whole = np.concatenate(found) if found else rest
    found.clear()
    whole.sort()
    fresh = np.ones(len(whole), bool)
    fresh[1:] = whole[1:] != whole[:-1]
    return whole[fresh]
