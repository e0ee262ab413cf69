"""Fast similarity sketches: rounds of hashed bin placement that fill every coordinate.

In round i < t each element of a set falls into the bin a hash chooses and offers a value there; an empty bin keeps the
least value of the first round that reaches it. In round t + b every element falls into bin b, so that all bins are full
after 2 t rounds whatever the set. Each coordinate of two sketches agrees with probability equal to the Jaccard
similarity, with the concentration of t independent hashes, but a large set is done after one round over it.
"""

from __future__ import annotations

import numpy as np

from tessera.llm.shingles import mix

COORDINATES = 64
#: A pair at the threshold may share no band with this probability at most.
MISS = 1e-5
_SHIFT = np.uint64(64 - 6)
_LOW = np.uint64((1 << 58) - 1)
_FULL = np.uint64(2**64 - 1)
_SEEDS = np.random.default_rng(7).integers(0, 2**64, 2 * COORDINATES, dtype=np.uint64)
assert COORDINATES == 64, "the bin is taken from six bits"


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDINATES) values; no set may be empty."""
    sizes = np.asarray([len(s) for s in sets], np.int64)
    out = np.full(len(sets) * COORDINATES, _FULL, np.uint64)
    if not len(sets):
        return out.reshape(0, COORDINATES)
    items = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets), dtype=np.int64) * COORDINATES, sizes)
    for i in range(2 * COORDINATES):
        hashed = mix(items ^ _SEEDS[i])
        at = row + (hashed >> _SHIFT).astype(np.int64) if i < COORDINATES else row + (i - COORDINATES)
        value = hashed & _LOW
        if i:
            free = out[at] == _FULL
            at, value = at[free], value[free]
        # the least value of each bin: later writes win, so write in descending order of value
        order = np.argsort(value)[::-1]
        out[at[order]] = value[order]
        short = (out.reshape(-1, COORDINATES) == _FULL).any(1)
        if not short.any():
            break
        live = short[row // COORDINATES]
        items, row = items[live], row[live]
    return out.reshape(-1, COORDINATES)


def rows_for(similarity: float) -> int:
    """Rows of a band: as many as keep the probability to share no band at this similarity within MISS."""
    missed = lambda rows: (1 - similarity**rows) ** (COORDINATES // rows)
    return max((rows for rows in range(1, COORDINATES) if missed(rows) <= MISS), default=1)


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """(sets, COORDINATES // rows) keys; equal keys mean that all rows of a band agree."""
    count = COORDINATES // rows
    parts = values[:, : count * rows].reshape(len(values), count, rows)
    key = np.broadcast_to(_SEEDS[:count], parts.shape[:2]).copy()
    for k in range(rows):
        key = mix(key ^ parts[:, :, k])
    return key.view(np.int64)
