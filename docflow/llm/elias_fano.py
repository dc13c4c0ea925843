"""Elias-Fano sequences: ascending numbers with constant-time select.

Of each of n numbers up to u, the low ``log2(u / n)`` bits are stored as they are; the rest, which ascend too, are
stored in unary: bit ``high + i`` is set for number i. Number i is found by the place of the i-th set bit. The place
of every 256th set bit is stored relative to the start of the bits in 32-bit samples, so one lookup reads a sample and
counts bits over a short stretch. Space: about 2 + log2(u / n) bits a number, no table of 64-bit numbers.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = "<QQB"  # numbers, bits of the high part, low bits a number
SAMPLE = 256
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    """``values``: ascending unsigned numbers."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
    low = values & np.uint64((1 << low_bits) - 1)
    places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    if n and places[-1] >= 2**32:
        raise ValueError("too many numbers for one sequence; split it")
    high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    high[places] = 1
    bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return b"".join([struct.pack(HEAD, n, len(high), low_bits), places[::SAMPLE].astype("<u4").tobytes(),
                     np.packbits(high, bitorder="little").tobytes(), np.packbits(bits.ravel(), bitorder="little").tobytes()])


class Sequence:
    """Reads an encoded sequence in place."""

    def __init__(self, data: bytes):
        self.n, high, self.low_bits = struct.unpack_from(HEAD, data)
        samples, at = -(-self.n // SAMPLE), struct.calcsize(HEAD)
        self.samples = np.frombuffer(data, "<u4", samples, at)
        at += 4 * samples
        self.high = np.frombuffer(data, np.uint8, -(-high // 8), at)
        at += len(self.high)
        self.low = np.frombuffer(data, np.uint8, -(-self.n * self.low_bits // 8), at)
        self.size = at + len(self.low)

    def __len__(self) -> int:
        return self.n

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        part = self.low[first // 8:(first + self.low_bits + 7) // 8].tobytes()
        return int.from_bytes(part, "little") >> first % 8 & (1 << self.low_bits) - 1

    def __getitem__(self, i: int) -> int:
        """Number i: select the i-th set bit from the sample before it on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = at // 8, at % 8
        left += int(ONES[int(self.high[byte]) & (1 << skip) - 1])
        while True:
            counts = np.cumsum(ONES[self.high[byte:byte + 64]])
            k = int(np.searchsorted(counts, left, "right"))
            if k < len(counts):
                break
            left -= int(counts[-1])
            byte += 64
        left -= int(counts[k - 1]) if k else 0
        value = int(self.high[byte + k])
        for _ in range(left):
            value &= value - 1
        place = 8 * (byte + k) + (value & -value).bit_length() - 1
        return place - i << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits, dtype=np.int64)).sum(1)
        return (places - np.arange(self.n) << self.low_bits) + low
