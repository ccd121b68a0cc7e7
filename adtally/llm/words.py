"""Vectorised word hashing.

A word is a maximal run of ASCII letters and digits and non-ASCII characters,
lower-cased; everything else separates words. Words of a whole batch are found
and hashed with numpy over the bytes, without a Python step per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from adtally.llm.common import text_bytes

_SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix64 on a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base & _MASK
    while len(out) < n:  # doubling: out is base**0 .. base**(len - 1)
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step & _MASK
    return out[:n]


_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept per worker up to one segment)."""
    if n <= _SEGMENT:
        if 0 not in _POWERS:
            _POWERS[0] = (_powers(_BASE, _SEGMENT + 1), _powers(pow(_BASE, -1, 1 << 64), _SEGMENT + 1))
        return _POWERS[0]
    return _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)


def _segment(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    is_word = np.zeros(len(raw) + 2, np.int8)
    is_word[1:-1] = _WORD[raw]
    edges = np.flatnonzero(np.diff(is_word))
    starts, ends = edges[::2], edges[1::2]
    fore, back = powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CODES[raw] * fore[:len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * back[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text with the total at the end)."""
    lowered = pc.utf8_lower(texts.fill_null("") if texts.null_count else texts)
    raw, offsets = text_bytes(lowered)
    # A separator between texts keeps words apart: word edges are also cut at
    # text borders by counting words per text below.
    starts, hashes = [], []
    joined = np.full(len(raw) + len(offsets) - 1, 32, np.uint8)
    place = np.arange(len(raw)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    joined[place] = raw
    begin = 0
    while begin < len(joined):
        end = min(begin + _SEGMENT, len(joined))
        if end < len(joined):
            gaps = np.flatnonzero(~_WORD[joined[begin:end]])
            if len(gaps):
                end = begin + int(gaps[-1]) + 1
            else:  # one word longer than a segment
                rest = np.flatnonzero(~_WORD[joined[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(joined)
        s, _, h = _segment(joined[begin:end])
        starts.append(s + begin)
        hashes.append(h)
        begin = end
    at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    bounds = offsets + np.arange(len(offsets))
    first = np.searchsorted(at, bounds)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle, first shingle of each text with the total).

    A text of 1 to k - 1 words has one shingle, all its words; a text without
    words has none.
    """
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(begin[-1]), np.uint64)
    if len(words) >= k:
        acc = words[: len(words) - k + 1].copy()
        for j in range(1, k):
            acc = acc * np.uint64(_BASE) + words[j: len(words) - k + 1 + j]
        acc = mix(acc)
        long = n >= k
        at = np.repeat(first[:-1][long], count[long]) + _within(count[long])
        to = np.repeat(begin[:-1][long], count[long]) + _within(count[long])
        out[to] = acc[at]
    for i in np.flatnonzero((n > 0) & (n < k)):
        value = 0
        for w in words[first[i]: first[i + 1]].tolist():
            value = (value * _BASE + w) & _MASK
        out[begin[i]] = mix(np.array([value ^ int(n[i])], np.uint64))[0]
    return out, begin


def _within(counts: np.ndarray) -> np.ndarray:
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) if total else np.zeros(0, np.int64)
