"""Word shingles of many texts at once, as 64-bit hashes in NumPy.

Words are maximal runs of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``), with
A-Z lower-cased. A text's set holds its distinct runs of ``SHINGLE`` words; a shorter text has
its whole word sequence as the only one, a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
# Texts are hashed in pieces of about this many bytes, which bounds a worker's memory.
PIECE_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_random = np.random.Generator(np.random.PCG64(20240607))
# One random 64-bit number per byte; upper case shares the number of lower case.
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_MIX = [int(x) | 1 for x in _random.integers(2**62, 2**63, 3 + SHINGLE)]
_BASE, _LENGTH, _COUNT = _MIX[:3]
_PLACE = np.array(_MIX[3:], np.uint64)
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(kind: str, base: int, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word; ``offsets`` has one entry more than there are texts."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data))[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * np.uint64(_LENGTH))
    return h, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    n = len(offsets) - 1
    words, text = word_hashes(data, offsets)
    first = np.searchsorted(text, np.arange(n + 1))
    count = np.diff(first)
    runs = np.zeros(0, np.uint64)
    if len(words) >= SHINGLE:
        m = len(words) - SHINGLE + 1
        runs = np.zeros(m, np.uint64)
        for j in range(SHINGLE):
            runs += words[j : j + m] * _PLACE[j]
        runs = mix(runs + np.uint64(SHINGLE * _COUNT % 2**64))
    out = []
    for i in range(n):
        a, k = first[i], int(count[i])
        if k >= SHINGLE:
            s = np.sort(runs[a : a + k - SHINGLE + 1])
            if len(s) > 1:
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif k:
            whole = np.array([(words[a : a + k] * _PLACE[:k]).sum(dtype=np.uint64)], np.uint64)
            s = mix(whole + np.uint64(k * _COUNT % 2**64))
        else:
            s = np.zeros(0, np.uint64)
        out.append(s)
    return out


def text_pieces(texts: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of pieces of a string column; null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + piece_bytes, side="right")) - 1)
        to = min(to, n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def column_sets(texts: pa.Array) -> list[np.ndarray]:
    """The shingle set of every text of a string column."""
    return [s for _, _, data, offsets in text_pieces(texts) for s in shingle_sets(data, offsets)]
