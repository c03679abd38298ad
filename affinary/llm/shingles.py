"""Sets of word shingles of whole texts as sorted 64-bit hashes, computed over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = 1 << 18  # texts and words are hashed in pieces of about so many bytes
_TABLE = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers in which every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word: a polynomial in the word's bytes, from differences of running sums."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + _BYTES, side="right")))
        high = ends[last - 1]
        powers = np.full(high - low + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data[low:high]] * powers[:-1], out=sums[1:])
        inverse = np.full(high - low + 1, _INVERSE, dtype=np.uint64)
        inverse[0] = 1
        np.cumprod(inverse, out=inverse)
        begin, end = starts[first:last] - low, ends[first:last] - low
        value = (sums[end] - sums[begin]) * inverse[begin]
        out[first:last] = mix(value + (end - begin).astype(np.uint64))
        first = last
    return out


def shingle_sets(column: pa.Array, words: int = 3) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes.

    Words are runs of bytes that are not ASCII white space, A-Z in lower case.  With fewer words
    than a shingle has, all of them are one shingle; without words the set is empty, as for null.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    everything = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _BYTES, side="right")) - 1)
        low, high = offsets[first], offsets[last]
        yield from _sets(everything[low:high], offsets[first : last + 1] - low, words)
        first = last


def _sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    is_upper = (data >= 65) & (data <= 90)
    data = data + (is_upper.astype(np.uint8) << 5)
    is_word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = np.zeros(len(data) + 1, dtype=bool)  # a text begins or ends here
    begins[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~before | begins[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~after | begins[1:])) + 1
    hashes = _word_hashes(data, starts, ends)
    rolled = hashes
    # in a short text all words are hashed, in order and with their number
    for j in range(1, words):
        rolled = mix(rolled[: len(hashes) - j] + np.uint64(_BASE)) + hashes[j:] if len(hashes) > j else np.zeros(0, dtype=np.uint64)
    rolled = mix(rolled)
    bounds = np.searchsorted(starts, offsets)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        count = high - low
        if count >= words:
            yield np.unique(rolled[low : high - words + 1])
        elif count:
            value = hashes[low : low + 1]
            for j in range(1, count):
                value = mix(value + np.uint64(_BASE)) + hashes[low + j : low + j + 1]
            yield mix(value ^ np.uint64(count))
        else:
            yield np.zeros(0, dtype=np.uint64)
