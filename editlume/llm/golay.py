"""The perfect binary Golay code [23, 12, 7] as a fuzzy hash of 23-bit segments.

Every 23-bit word lies within distance 3 of exactly one code word. A word at distance 3 from it
lies at distance 4 from five more. `indices` gives a word the index of its nearest code word and,
if that is at distance 3, those of the five: any two words that differ in at most two bits then
have an index in common (a word between them, at distance 1 or less from both, has a code word
within 3, which is within 4 of both).
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

N_BITS = 23
TOLERANCE = 2
_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for k in range(N_BITS - 1, 10, -1):
        if word >> k & 1:
            word ^= _GENERATOR << (k - 11)
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; error patterns (2048 x 6, -1 where none)."""
    low = np.array([_remainder(i) for i in range(1 << 12)], dtype=np.int32)
    high = np.array([_remainder(i << 12) for i in range(1 << 11)], dtype=np.int32)
    unit = [_remainder(1 << i) for i in range(N_BITS)]
    found: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(N_BITS), weight):
            s = 0
            for b in bits:
                s ^= unit[b]
            have = found.setdefault(s, [])
            pattern = sum(1 << b for b in bits)
            if weight <= 3 and not have or weight == 4 and have[0].bit_count() == 3:
                have.append(pattern)
    patterns = np.full((1 << 11, 6), -1, dtype=np.int32)
    for s, have in found.items():
        patterns[s, : len(have)] = have
    return low, high, patterns


def indices(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word its one or six code word indices (12 bits), -1 as filling: shape (n, 6)."""
    low, high, patterns = _tables()
    w = words.astype(np.int32)
    p = patterns[low[w & 0xFFF] ^ high[w >> 12]]
    return np.where(p >= 0, (w[:, None] ^ p) >> 11, -1)
