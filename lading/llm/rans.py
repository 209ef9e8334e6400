"""A static range asymmetric numeral system over token ids.

A table gives every id that occurs a whole number of the 2^bits slots, by its share of all ids. The
ids of a block are dealt over lanes, id i to lane i mod lanes; each lane is a 64-bit state, and all
lanes of a step are worked on as one vector. Encoding goes backwards and pushes the low 32 bits of a
state out whenever it would grow too large, decoding goes forwards and takes them in again, lanes in
ascending order, from one common stream of words.

Every so many steps the states are written down. Such a checkpoint begins a segment, which can be
decoded without those before it; the last segment of a block ends in the states that encoding began
with, which is checked, as is a checksum of every segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

BITS = 20
LANES = 1024
BLOCK = 1 << 20
CHECKPOINT_STEPS = 256
LANE_IDS = 64
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def frequencies(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Slots of every id, at least one where the count is not 0; together 2^bits (0 without ids).

    What rounding leaves over goes to the commonest id; what it lacks is taken from those with most.
    """
    total, slots = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.uint32)
    if np.count_nonzero(counts) > slots // 2:
        raise ValueError(f"2^{bits} slots are too few for so many ids")
    share = np.array([int(c) * slots // total for c in counts.tolist()], np.int64)
    share[(counts > 0) & (share == 0)] = 1
    rest = slots - int(share.sum())
    if rest >= 0:
        share[int(counts.argmax())] += rest
    while rest < 0:
        # Every round takes up to half of what each has, the largest first.
        for k in np.argsort(-share, kind="stable"):
            less = min(int(share[k]) // 2, -rest)
            share[k] -= less
            rest += less
            if not rest or not less:
                break
    return share.astype(np.uint32)


class Table:
    """Frequencies as the coder needs them."""

    def __init__(self, slots: np.ndarray, bits: int = BITS):
        self.slots, self.bits = slots.astype("<u4"), bits
        self.frequency = slots.astype(np.uint64)
        self.start = np.cumsum(self.frequency) - self.frequency
        # A state at or above this would outgrow 63 bits by taking the id in.
        self.most = self.frequency << np.uint64(63 - bits)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        """The id of every slot."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.slots), dtype=np.uint32), self.slots)
        return self._symbol

    def tobytes(self) -> bytes:
        return bytes([self.bits]) + zlib.compress(self.slots.tobytes())

    @classmethod
    def frombytes(cls, data: bytes) -> Table:
        return cls(np.frombuffer(zlib.decompress(data[1:]), "<u4"), data[0])

    @property
    def checksum(self) -> int:
        return zlib.crc32(self.slots.tobytes(), self.bits)


def lanes_of(n: int) -> int:
    return max(1, min(LANES, n // LANE_IDS))


def encode_block(ids: np.ndarray, table: Table) -> Iterator[tuple[int, int, bytes]]:
    """(ids, lanes, payload) of the segments of one block, in order."""
    n = len(ids)
    lanes = lanes_of(n)
    bits = np.uint64(table.bits)
    state = np.full(lanes, _LOW)
    frequency, start, most = table.frequency[ids], table.start[ids], table.most[ids]
    if not frequency.all():
        raise ValueError("an id has no slot in the table")
    steps = -(-n // lanes)
    segments, words = [], []
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        f = frequency[at]
        x = state[:len(f)]
        full = np.flatnonzero(x >= most[at])
        words.append(x[full].astype("<u4"))
        x[full] >>= _WORD
        share = x // f
        x[:] = (share << bits) + (x - share * f) + start[at]
        if step % CHECKPOINT_STEPS == 0:
            held = min(n, (step + CHECKPOINT_STEPS) * lanes) - step * lanes
            segments.append(
                (held, lanes, state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))))
            words = []
    return reversed(segments)


def decode_segment(payload: bytes, n: int, lanes: int, table: Table, final: bool) -> np.ndarray:
    """The ``n`` ids of a segment. ``final``: it is the last one of its block."""
    state = np.frombuffer(payload, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(payload, "<u4", offset=8 * lanes).astype(np.uint64)
    mask, bits = np.uint64((1 << table.bits) - 1), np.uint64(table.bits)
    symbol, frequency, start = table.symbol, table.frequency, table.start
    out, taken = np.empty(n, np.uint32), 0
    for begin in range(0, n, lanes):
        x = state[:min(lanes, n - begin)]
        slot = x & mask
        found = symbol[slot]
        out[begin:begin + len(x)] = found
        x[:] = frequency[found] * (x >> bits) + slot - start[found]
        low = np.flatnonzero(x < _LOW)
        x[low] = (x[low] << _WORD) | words[taken:taken + len(low)]
        taken += len(low)
    if taken != len(words) or (final and (state != _LOW).any()):
        raise ValueError("a segment does not end as it was begun")
    return out
