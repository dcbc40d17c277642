"""Content-chosen anchors of token sequences, for finding repeated windows of a fixed length.

A window of ``size`` tokens that starts at s is filed under its anchor: the place of the smallest
rolling hash among the first ``reach`` places of the window. The anchor depends on the window
alone, so equal windows have equal anchors wherever they stand. Neighbouring windows share
anchors; the windows of one anchor form a stretch, and a stretch with its windows reads
``tokens[first : last + size]``. Every window lies in exactly one stretch.
"""

from __future__ import annotations

import numpy as np

PLACE_BITS = 24  # room for the place beside the hash in one 64-bit key
BLOCK = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Polynomial hashes of any slice of a sequence of 64-bit tokens, alike wherever it stands."""

    def __init__(self, tokens: np.ndarray, which: int = 0):
        n = len(tokens)
        inverse = pow(_BASES[which], -1, 1 << 64)
        powers = np.full(n + 1, _BASES[which], dtype=np.uint64)
        self.back = np.full(n + 1, inverse, dtype=np.uint64)
        powers[0] = self.back[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(tokens * powers[:n], out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def window_places(hashes: np.ndarray, reach: int) -> np.ndarray:
    """For each s, the leftmost place of the smallest of ``hashes[s : s + reach]``."""
    n = len(hashes) - reach + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = np.empty(n, dtype=np.int64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, n, BLOCK):
        part = hashes[at : min(at + BLOCK, n) + reach - 1]
        keys = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        rows = -(-len(keys) // reach)
        padded = np.full(rows * reach, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[: len(keys)] = keys
        grid = padded.reshape(rows, reach)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        m = len(part) - reach + 1
        least = np.minimum(back[:m], ahead[reach - 1 : reach - 1 + m])
        out[at : at + m] = (least & low).astype(np.int64) + at
    return out


def stretches(hashes: np.ndarray, valid: np.ndarray, reach: int):
    """(first, last, anchor) of each stretch.

    ``hashes`` has one value per place, ``valid`` marks the places where a whole window starts;
    several documents may stand one behind the other.
    """
    places = window_places(hashes, reach)
    places = np.concatenate([places, np.full(len(valid) - len(places), -1)])
    places[~valid] = -1
    changed = np.flatnonzero(places[1:] != places[:-1]) + 1
    first = np.concatenate([[0], changed]).astype(np.int64)[: len(places)]
    last = np.concatenate([changed, [len(places)]])[: len(first)].astype(np.int64) - 1
    anchor = places[first]
    held = anchor >= 0
    return first[held], last[held], anchor[held]
