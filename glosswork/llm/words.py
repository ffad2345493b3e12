"""Words of many texts at once, as arrays.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D`` in the UTF-8
text, with A-Z lower-cased; it never spans two texts. Words are known by a
64-bit digest, a polynomial over random byte values whose prefix sums give all
words of a chunk in a few passes. Texts are taken whole; chunks only group them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_ONE = np.uint64(1)

_random = np.random.default_rng(20240229)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _ONE
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_STEP = int(_random.integers(1 << 61, 1 << 62)) * 2 + 1
_BACK = pow(_STEP, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Separators for words without punctuation: all of ASCII but letters and digits.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[:128] = [not chr(c).isalnum() for c in range(128)]
_known: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _known.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), np.uint64(base), np.uint64)
        have[0] = 1
        have = _known[base] = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets (from 0) of runs of rows of about ``size`` bytes."""
    data, offsets = buffers(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        last = min(max(last, row + 1), rows)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def find(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    word = ~separators[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]  # starts of texts that are not empty
    first[at] = word[at]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = word[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digests of the spans, A-Z taken as a-z."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(_STEP, len(data)), out=total[1:])
    raw = (total[ends] - total[starts]) * powers(_BACK, len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def digest_of(word: str) -> int:
    """The digest of one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(digests(data, np.array([0]), np.array([len(data)]))[0])
