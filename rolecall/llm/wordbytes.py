"""Words of UTF-8 texts as numpy arrays, for functions that run on Arrow batches.

A word is a run of bytes other than space, tab, LF, VT, FF and CR; texts are taken
whole. Words and shingles are compared as 64-bit hashes.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once; longer runs of bytes are handled in several steps.
STEP_BYTES = 1 << 20

#: Bytes whose words are hashed at once, in arrays of 8 bytes for each.
HASH_BYTES = 1 << 17

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        _powers["up"], _powers["down"] = powers(_BASE, n)
    return _powers["up"], _powers["down"]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and its inverse modulo 2**64, for k up to ``n``; the base is odd."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n + 1, b, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] :], offsets - offsets[0]


def steps(offsets: np.ndarray, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes, of one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


@dataclass
class Words:
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after it
    row: np.ndarray  # its text
    first: np.ndarray  # index of the first word of each text, and at the end the number of words


def find_words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, cut: np.ndarray | None = None) -> Words:
    """The words of each text; ``cut`` marks bytes inside words that begin another word."""
    inside = ~space[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    if cut is not None:
        begins |= cut
        ends[:-1] |= cut[1:]
    full = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[full] = inside[full]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    return Words(start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def hash_words(data: np.ndarray, words: Words) -> np.ndarray:
    """64-bit hash of each word's bytes: differences of running polynomial sums."""
    out = np.empty(len(words.start), np.uint64)
    first = 0
    while first < len(out):
        low = words.start[first]
        last = max(first + 1, int(np.searchsorted(words.end, low + HASH_BYTES, "right")))
        up, down = _powers_to(max(HASH_BYTES, int(words.end[last - 1] - low)))
        part = data[low : words.end[last - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_OF_BYTE[part] * up[: len(part)], out=sums[1:])
        begin, end = words.start[first:last] - low, words.end[first:last] - low
        out[first:last] = (sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(_BASE)
        first = last
    return mix(out)


def shingles(hashes: np.ndarray, words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words, text after text, and the index of each text's
    first one. A text of fewer words (but one) has one: the whole sequence."""
    counts = np.diff(words.first)
    many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(many)])
    total = int(first[-1])
    at = np.repeat(words.first[:-1] - first[:-1], many) + np.arange(total)
    length = np.minimum(np.repeat(counts, many), width)
    out = length.astype(np.uint64) * np.uint64(_BASE)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for k in range(width):
        factor = np.uint64(pow(_BASE, 2 * k + 3, 1 << 64))
        out += np.where(length > k, padded[at + k], np.uint64(0)) * factor
    return mix(out), first
