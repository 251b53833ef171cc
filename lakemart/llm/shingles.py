"""Word hashes and shingle sets of whole texts, in numpy over Arrow batches.

Words are runs of bytes other than space and 0x09 to 0x0D, A to Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; a longer text is cut at word ends, so this changes no result.
SLICE_BYTES = 1 << 18

_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(n: int, inverse: bool) -> np.ndarray:
    name = "down" if inverse else "up"
    if name not in _powers or len(_powers[name]) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps)
    return _powers[name]


def _hash_slice(buf: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one slice, and where each begins; ``begins``: offsets of texts."""
    gap = _BREAK[buf]
    first = ~gap
    new = first.copy()
    new[1:] &= gap[:-1]
    begins = begins[begins < len(buf)]
    new[begins] = first[begins]
    last = first.copy()
    last[:-1] &= gap[1:]
    ends_before = begins[begins > 0] - 1
    last[ends_before] = first[ends_before]
    start, stop = np.flatnonzero(new), np.flatnonzero(last) + 1
    total = np.concatenate([[np.uint64(0)], np.cumsum(_LOWER[buf] * _power(len(buf), False)[: len(buf)])])
    words = (total[stop] - total[start]) * _power(len(buf), True)[start]
    return mix(words + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, words, count per row)`` for runs of rows of at most about ``SLICE_BYTES``; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        upto = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        upto = max(row + 1, min(upto, len(texts)))
        low, high = int(offsets[row]), int(offsets[upto])
        if high - low <= 2 * SLICE_BYTES:
            begins = offsets[row:upto] - low
            words, start = _hash_slice(data[low:high], begins)
            counts = np.diff(np.searchsorted(start, np.append(begins, high - low)))
        else:  # one long text: cut after the last break of each slice
            parts = []
            while low < high:
                cut = min(low + SLICE_BYTES, high)
                while cut < high:
                    gaps = np.flatnonzero(_BREAK[data[low:cut]])
                    if len(gaps):
                        cut = low + int(gaps[-1]) + 1
                        break
                    cut = min(cut + SLICE_BYTES, high)
                parts.append(_hash_slice(data[low:cut], np.zeros(1, np.int64))[0])
                low = cut
            words = np.concatenate(parts)
            counts = np.array([len(words)])
        yield row, words, counts
        row = upto


def shingle_sets(texts: pa.Array, k: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, hashes, count per row)``: distinct k-word shingles of each row, sorted by hash within it.

    A text of fewer than k words is one shingle, its whole sequence; one
    without words has none.
    """
    for row, words, counts in word_hashes(texts):
        owner = np.repeat(np.arange(len(counts)), counts)
        made = np.zeros(0, np.uint64)
        whose = np.zeros(0, np.int64)
        if len(words) >= k:
            n = len(words) - k + 1
            made = words[:n].copy()
            for i in range(1, k):
                made = mix(made) * np.uint64(_BASE) + words[i : n + i]
            inside = owner[:n] == owner[k - 1 :]
            made, whose = mix(made[inside]), owner[:n][inside]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            begin = (np.cumsum(counts) - counts)[short]
            value = np.full(len(short), 0x51ED270B, np.uint64)
            for i in range(k - 1):
                more = counts[short] > i
                step = mix(value) * np.uint64(_BASE) + words[np.minimum(begin + i, len(words) - 1)]
                value = np.where(more, step, value)
            made, whose = np.concatenate([made, mix(value)]), np.concatenate([whose, short])
        order = np.lexsort((made, whose))
        made, whose = made[order], whose[order]
        if len(made):
            fresh = np.ones(len(made), bool)
            fresh[1:] = (made[1:] != made[:-1]) | (whose[1:] != whose[:-1])
            made, whose = made[fresh], whose[fresh]
        yield row, made, np.bincount(whose, minlength=len(counts))
