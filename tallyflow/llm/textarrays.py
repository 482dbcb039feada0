"""Texts of an Arrow batch as numpy arrays: bytes, words, hashes.

Everything works on slices of about SLICE bytes, so the arrays of a batch
stay small; one longer text is cut at white space and hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once.
SLICE = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE = _BASE - (_BASE % 8) + 5  # 5 modulo 8: its powers have the longest period
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


#: A random value per byte, A-Z as a-z: words are hashed in lower case.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_BYTE[65:91] = _BYTE[97:123]

_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        p = np.full(max(n, SLICE + 1), base, np.uint64)
        p[0] = 1
        _powers[kind] = have = np.cumprod(p)
    return have


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of whole texts."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def _hashes(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[b]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(b))]
    first[edges] |= word[edges]
    last[edges - 1] |= word[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    sums = np.cumsum(_BYTE[b] * _power("up", _BASE, len(b) + 1)[: len(b)])
    before = np.where(start > 0, sums[start - 1], _U(0))
    h = (sums[end] - before) * _power("down", _INVERSE, len(b) + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * _U(_BASE)), np.searchsorted(start, offsets)


def word_hashes(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of
    a slice, and each text's first word's place in them."""
    if len(b) <= 2 * SLICE:
        return _hashes(b, offsets)
    parts, at = [], 0  # one text, longer than a slice
    while at < len(b):
        to = min(len(b), at + SLICE)
        if to < len(b):
            space = np.flatnonzero(_SPACE[b[to:]][:SLICE])
            to = to + int(space[0]) if len(space) else len(b)
        parts.append(_hashes(b[at:to], np.array([0, to - at]))[0])
        at = to
    h = np.concatenate(parts)
    return h, np.array([0, len(h)])


_STEP = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of each 5 consecutive words; all words when there are fewer."""
    k = min(5, len(words))
    if not k:
        return words
    n = len(words) - k + 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s += words[j : j + n] * _STEP[j]
    return mix(s)


def shingle_sets(b: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct 5-word shingle hashes of each text of a slice."""
    words, at = word_hashes(b, offsets)
    five = shingle_hashes(words) if len(words) >= 5 else None
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        s = np.sort(five[i : j - 4] if j - i >= 5 else shingle_hashes(words[i:j]))
        if len(s) > 1:
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        yield s


#: A random value per byte that tells A-Z from a-z.
EXACT = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
#: The same with A-Z as a-z.
FOLDED = _BYTE
WHITE = _SPACE


def tokens(
    b: np.ndarray, offsets: np.ndarray, byte: np.ndarray = EXACT, space: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the runs of bytes outside ``space`` of a slice, the
    byte where each begins, and each text's first word's place among them.
    ``byte`` has a random value for every byte."""
    if len(b) > 2 * SLICE and len(offsets) == 2:  # one text, longer than a slice
        hashes, starts, at = [], [], 0
        while at < len(b):
            to = min(len(b), at + SLICE)
            while to < len(b):
                gap = np.flatnonzero(space[b[to : to + SLICE]])
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(len(b), to + SLICE)
            h, start, _ = tokens(b[at:to], np.array([0, to - at, to - at]), byte, space)
            hashes.append(h)
            starts.append(start + at)
            at = to
        h = np.concatenate(hashes)
        return h, np.concatenate(starts), np.array([0, len(h)])
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~space[b]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(b))]
    first[edges] |= word[edges]
    last[edges - 1] |= word[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    sums = np.cumsum(byte[b] * _power("up", _BASE, len(b) + 1)[: len(b)])
    before = np.where(start > 0, sums[start - 1], _U(0))
    h = (sums[end] - before) * _power("down", _INVERSE, len(b) + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * _U(_BASE)), start, np.searchsorted(start, offsets)
