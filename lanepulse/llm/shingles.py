"""Words and word windows of Arrow text batches as numpy hashes.

Texts stay bytes: words are found and hashed for a whole slice of a batch at
once. A word's hash is a polynomial over its bytes, mixed to 64 bits; a window's
hash is a polynomial over its words' hashes. All arithmetic is modulo 2^64 and
the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
#: Odd multipliers and their inverses modulo 2^64.
_BYTE = 0x9E3779B97F4A7C15
_WORDS = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
#: Bytes of text handled at once; one longer text is handled alone.
SLICE = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U)


_cached: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    have = _cached.get((base, inverse))
    if have is None or len(have) < n:
        have = _powers(pow(base, -1, 1 << 64) if inverse else base, max(n, 1024))
        if n <= 2 * SLICE:
            _cached[base, inverse] = have
    return have[:n]


@dataclass
class Words:
    """Words of a slice: byte ranges in ``data``, text number, mixed hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text, and one more: where its words begin

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of a text array with about ``SLICE`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > SLICE:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(texts):
        yield begin, len(texts)


def split(texts: pa.Array, lower: bool = False) -> Words:
    """The words (runs without white space) of all texts; null has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    blank = _SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = blank[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = blank[1:]
    start = np.flatnonzero(~blank & (before | cut[:-1]))
    end = np.flatnonzero(~blank & (after | cut[1:])) + 1
    if lower:
        data = _LOWER[data]
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers(_BYTE, len(data)), out=sums[1:])
    hashes = (sums[end] - sums[start]) * powers(_BYTE, len(data) + 1, inverse=True)[start]
    hashes = mixed(hashes + (end - start).astype(_U) * _U(0x632BE59BD9B4E019))
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, start, end, text, hashes, first)


def windows(words: Words, length: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window that starts at each word, and whether it fits in the text.

    Windows that do not fit have a meaningless hash.
    """
    n = len(words.hash)
    base = _WORDS[salt]
    sums = np.zeros(n + 1, _U)
    np.cumsum(words.hash * powers(base, n), out=sums[1:])
    at = np.arange(n)
    end = np.minimum(at + length, n)
    value = mixed((sums[end] - sums[:-1]) * powers(base, n, inverse=True))
    return value, at + length <= words.first[1:][words.text] if n else np.zeros(0, bool)


def spans(words: Words, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of the words [start, end) for each pair of word numbers."""
    n = len(words.hash)
    base = _WORDS[salt]
    sums = np.zeros(n + 1, _U)
    np.cumsum(words.hash * powers(base, n), out=sums[1:])
    value = (sums[end] - sums[start]) * powers(base, n + 1, inverse=True)[start]
    return mixed(value + (end - start).astype(_U))
