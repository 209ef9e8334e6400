"""Texts of Arrow batches as words, and 64-bit hashes of words.

A word is a run of bytes other than the six ASCII blanks (9 to 13 and 32), which is what
``bytes.split()`` without an argument yields. ``bytes.lower()`` changes A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 1 << 20
MEMO_WORDS = 1 << 17


class Hashes(dict):
    """64-bit hashes by word. It is emptied when it grows large, so that memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches with about ``most`` bytes of text each, and their texts as bytes.

    A longer text is a slice of its own; none is cut.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes.astype(np.int64)) // most
        starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(starts, starts[1:]):
            yield batch.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of ``BASE`` modulo 2^64, and their inverses, as many as were ever asked for."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]))
                for base in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of some bytes begin and end, and a hash of each: its bytes as the digits of a
    number, from differences of running sums."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    start, stop = edges[::2], edges[1::2]
    up, down = _powers.of(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.multiply(data, up, out=sums[1:])
    sums[1:] += up
    np.cumsum(sums, out=sums)
    # Digits that come first count least, so a word's sum is divided by the power it begins with.
    return start, stop, mix((sums[stop] - sums[start]) * down[start])


def ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each ``begin`` on, ``length`` of them, one run after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + length, length)
