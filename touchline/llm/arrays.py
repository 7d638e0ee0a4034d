"""Texts of an Arrow batch as flat arrays: words, their places and their hashes.

Operators that look at every byte of every text work on these arrays, so that a
task spends its time in vectorised code. A batch is cut into chunks of whole texts
of about ``CHUNK_BYTES``; a longer text is a chunk of its own, so memory follows the
longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. n-1`` modulo 2**64, kept for the next chunk."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * CHUNK_BYTES:
            _POWERS[int(base)] = have
    return have[:n]


def _table(separators: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


#: Bytes of a word after A-Z are lowered; bytes of one UTF-8 character stay together.
ALNUM = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
NOT_SPACE = _table([(0x09, 0x0D), (0x20, 0x20)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Chunk:
    """Whole texts laid end to end. ``bounds[i]:bounds[i + 1]`` are the bytes of text ``i``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> np.ndarray:
        return _LOWER[self.data]


@dataclass
class Words:
    """Byte ranges of all words of a chunk; ``bounds[i]:bounds[i + 1]`` are the words of text ``i``."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of a string column; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, len(texts))
        yield Chunk(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def words(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> Words:
    """All maximal runs of word bytes; none crosses the end of its text."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(len(bounds), dtype=np.int64))
    inside = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, bounds))


def hashes(data: np.ndarray, found: Words) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes alone."""
    if not len(found):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * _powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[found.ends] - sums[found.starts]) * _powers(_INVERSE, len(data) + 1)[found.starts])


def grams(hashed: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words, by first word, text ends ignored."""
    n = len(hashed) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out += hashed[j : j + n] * np.uint64(pow(int(_BASE), j, 1 << 64))
    return mix(out)


def sliding(choose: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """``choose`` (minimum or maximum) over each run of ``size`` values, by doubling."""
    have = 1
    while have < size:
        step = min(have, size - have)
        values = choose(values[:-step], values[step:])
        have += step
    return values
