"""What the text operators share: the word class and vectorised hashing of the words of many texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

# odd multipliers of 64-bit polynomial and mixing hashes (fixed values)
_BASE = 0x9E3779B97F4A7C15
_MIX1 = 0xBF58476D1CE4E5B9
_MIX2 = 0x94D049BB133111EB


def words(text: Column) -> Column:
    """The maximal runs of characters outside ``\\x20 \\x09-\\x0D``; NULL and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (finaliser of a splittable generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX2)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand up to a block size."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = pow(_BASE, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up, self.down = (
                    np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                    for b in (_BASE, inverse))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every span; equal byte sequences hash equally wherever they stand."""
    with np.errstate(over="ignore"):
        up, down = _POWERS.get(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])
