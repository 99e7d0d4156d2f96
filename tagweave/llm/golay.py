"""The binary Golay code [23, 12, 7] as a fuzzy hash of 23-bit values.

The code is perfect: every 23-bit value lies within three bits of exactly one codeword, whose 12-bit index is its hash. A value
is also given the indices of its 23 neighbours at one bit; two values that differ in at most one bit then always meet, as the index
of either is among those of the other. Because the balls around codewords tile the space, a value has one or six distinct indices.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS = 23
# Fixed value: a generator polynomial of the code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the 12 leading bits, and the error pattern of each 11-bit syndrome."""
    remainders = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(BITS - 1, 10, -1):
        remainders = np.where(remainders >> bit & 1, remainders ^ (GENERATOR << (bit - 11)), remainders)
    errors = np.zeros(1 << 11, dtype=np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(BITS), weight):
            pattern = sum(1 << p for p in places)
            errors[(pattern & 0x7FF) ^ remainders[pattern >> 11]] = pattern
    return remainders, errors


def decode(values: np.ndarray) -> np.ndarray:
    """The index of the codeword nearest to each 23-bit value."""
    remainders, errors = _tables()
    syndromes = (values & 0x7FF) ^ remainders[values >> 11]
    return (values ^ errors[syndromes]) >> 11


def neighbour_indices(values: np.ndarray) -> np.ndarray:
    """Indices of each value and of its 23 one-bit neighbours, one row per value; the value's own comes first."""
    flips = np.concatenate(([0], 1 << np.arange(BITS, dtype=np.int64)))
    return decode(values[:, None] ^ flips[None, :])
