"""Vectorised hashes over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
POWERS = 64  # powers of BASE are tabled up to this place in a word, then computed


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x = x ^ (x >> U(27))
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def powers(n: int) -> np.ndarray:
    out = np.empty(max(n, 1), U)
    out[0] = 1
    if n > 1:
        out[1:] = BASE
        out = np.multiply.accumulate(out)
    return out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each followed by a space, and where each begins (one more at the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b" ".join(texts) + b" ", np.uint8), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of all texts, A-Z in lower case, and where the words of each text begin."""
    data, starts = joined(texts)
    data = LOWER[data]
    space = SPACE[data]
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(first):
        return np.empty(0, U), np.zeros(len(texts) + 1, np.int64)
    begins = np.zeros(len(data), np.int64)
    begins[first] = first
    place = np.arange(len(data)) - np.maximum.accumulate(begins)
    table = powers(int(place[~space].max()) + 1)
    place[space] = 0
    value = (data.astype(U) + U(1)) * table[place]
    value[space] = 0
    return mix(np.add.reduceat(value, first)), np.searchsorted(first, starts)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words; of all words together when there are fewer, none for none."""
    size = min(size, len(hashes))
    if not size:
        return np.empty(0, U)
    out = np.zeros(len(hashes) - size + 1, U)
    for k in range(size):
        out = out * BASE + hashes[k:len(hashes) - size + 1 + k]
    return mix(out + U(size))
