"""Token ids of whole texts by encoding each different piece once.

A text is cut before a single space, and on both sides of a single line feed,
between two characters that are no white space, and between a letter or digit
and ASCII punctuation other than the apostrophe (characters that the bytes do
not show to be of these kinds are not cut at). The pre-tokenizer's pattern
always starts a new match at such places and looks at nothing before them, so
the ids of a text are the ids of its pieces one after the other. Different pieces are found by Arrow's
dictionary encoding; ids of common pieces stay in a bounded cache per worker.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa

from adtally.llm.common import ranges, text_bytes

#: Pieces of each of the two generations that a worker keeps: when the young one
#: is full it becomes the old one, from which pieces in use move to a new young one.
CACHE_PIECES = 450_000

def _bytes(*values: int | range) -> np.ndarray:
    out = np.zeros(256, bool)
    for v in values:
        out[[v] if isinstance(v, int) else list(v)] = True
    return out


_ALNUM = _bytes(range(48, 58), range(65, 91), range(97, 123))
_PUNCT = _bytes(range(33, 39), range(40, 48), range(58, 65), range(91, 97), range(123, 127))
_INK = _bytes(range(33, 127))
#: First bytes of characters that are never white space (which is U+0085 and
#: U+00A0 after C2, U+1680 after E1, U+2000 and so on after E2, U+3000 after E3).
_LEAD2, _LEAD3, _LEAD4 = _bytes(range(0xC3, 0xE0)), _bytes(0xE0, range(0xE4, 0xF0)), _bytes(range(0xF0, 0xF5))
_STARTS = _INK | _LEAD2 | _LEAD3 | _LEAD4
_TAIL = _bytes(range(0x80, 0xC0))
#: Second bytes after C3 of letters (all of U+00C0 to U+00FF but the two signs).
_LATIN = _bytes(*[v for v in range(0x80, 0xC0) if v not in (0x97, 0xB7)])
#: All of a byte's classes, a bit each, looked up once for a byte.
_CLASSES = np.packbits([_INK, _LEAD2, _LEAD3, _STARTS, _ALNUM, _PUNCT, _TAIL, _LATIN], axis=0, bitorder="little").tobytes()


def cut_places(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending byte positions at which a new piece starts, text starts included."""
    cut = np.zeros(len(raw) + 1, np.uint8)
    if len(raw) > 2:
        ink, lead2, lead3, starts, alnum, punct, tail, latin = range(8)
        kind = np.frombuffer(raw.tobytes().translate(_CLASSES), np.uint8)  # only the least bit counts below
        ends = kind >> ink  # the last byte of a character that is no white space
        ends[1:] |= (kind[1:] >> tail) & (kind[:-1] >> lead2)
        ends[2:] |= (kind[2:] >> tail) & (kind[:-2] >> lead3)
        word = kind >> alnum  # the last byte of a letter or digit
        word[1:] |= (raw[:-1] == 0xC3) & (kind[1:] >> latin)
        feed = raw[1:-1] == 10
        alone = ends[:-2] & (kind[2:] >> starts)  # one byte between two such characters
        cut[1:-2] = ((raw[1:-1] == 32) | feed) & alone
        cut[2:-1] |= feed & alone
        cut[1:-1] |= (kind[1:] >> punct) & word[:-1] & 1
    cut[offsets] = 1
    cut[len(raw)] = 0
    return np.flatnonzero(cut.view(bool))


class _Generation:
    """Ids of pieces, one after the other in an array."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.flat, self.begin, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The places of pieces in the arrays, -1 for one that is not here."""
        return np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        ends = len(self.flat) + np.cumsum(lengths)
        self.flat, self.begin = np.concatenate([self.flat, flat]), np.concatenate([self.begin, ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])

    def shorten(self, n: int) -> None:
        """Keep the first ``n`` pieces."""
        if n < len(self.begin):
            self.flat, self.begin, self.lengths = self.flat[:self.begin[n]].copy(), self.begin[:n].copy(), self.lengths[:n].copy()


class PieceCoder:
    """Encodes batches of texts with ``encode``: pieces -> (ids of all, how many each has)."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.young, self.old = _Generation(), _Generation()

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin, with the end)."""
        raw, offsets = text_bytes(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = cut_places(raw, offsets)
        bounds = np.append(starts, len(raw)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(raw))
        coded = pieces.dictionary_encode()
        flat, begin, many = self._table(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        number = coded.indices.to_numpy()
        lengths = many[number]
        out = flat[ranges(begin[number], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return out, ends[np.searchsorted(starts, offsets)]

    def _table(self, different: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each piece's begin among them, how many it has)."""
        young = self.young
        number = young.numbers(different)
        missing = np.flatnonzero(number < 0)
        names = [different[i] for i in missing.tolist()]
        long = np.fromiter(map(len, names), np.int64, len(names)) >= 64
        if long.any():  # those come last, as they aren't kept
            order = np.argsort(long, kind="stable")
            missing, names = missing[order], [names[i] for i in order.tolist()]
        old = self.old.numbers(names)
        unknown = np.flatnonzero(old < 0).tolist()
        lots = [self.encode([names[i] for i in unknown[k: k + 20_000]]) for k in range(0, len(unknown), 20_000)]
        new = np.concatenate([np.zeros(0, np.int64), *[counts for _, counts in lots]]).astype(np.int64)
        ids = np.concatenate([self.old.flat, *[x.astype(np.uint32) for x, _ in lots]])
        begin, many = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
        many[unknown], begin[unknown] = new, len(self.old.flat) + np.cumsum(new) - new
        known = np.flatnonzero(old >= 0)
        many[known], begin[known] = self.old.lengths[old[known]], self.old.begin[old[known]]
        at, kept = len(young.begin), len(names) - int(long.sum())
        number[missing] = np.arange(at, at + len(names))
        young.extend(ids[ranges(begin, many)], many)
        out = young.flat, young.begin[number], young.lengths[number]
        young.shorten(at + kept)
        young.number.update(zip(names[:kept], range(at, at + kept)))
        if len(young.number) > CACHE_PIECES:
            self.young, self.old = _Generation(), young
        return out
