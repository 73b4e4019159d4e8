"""E8 lattice arithmetic in numpy: nearest lattice point and neighbouring cells.

E8 = D8 united with D8 + 1/2, where D8 holds the integer vectors with an even
sum.  Points are kept doubled, so that both cosets are integer vectors.
"""

from __future__ import annotations

import itertools

import numpy as np


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8: round, and where the sum is odd re-round the worst coordinate the other way."""
    r = np.rint(x)
    err = x - r
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    worst = np.abs(err[odd]).argmax(axis=1)
    r[odd, worst] += np.where(err[odd, worst] >= 0, 1.0, -1.0)
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """Doubled coordinates (int16) of the E8 point nearest to each row of ``x`` (n x 8)."""
    a = _nearest_d8(x)
    b = _nearest_d8(x - 0.5) + 0.5
    da = ((x - a) ** 2).sum(axis=1)
    db = ((x - b) ** 2).sum(axis=1)
    return np.rint(2 * np.where((da <= db)[:, None], a, b)).astype(np.int16)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: neighbours of a cell's centre."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = s, t
            out.append(v)
    out += [v for v in itertools.product((1, -1), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out, dtype=np.int16)


def neighbours(x: np.ndarray, home: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` lattice points next to ``home`` that lie closest to ``x`` (n x probes x 8, doubled)."""
    v = minimal_vectors()
    gain = (x - home / 2.0) @ (v.T / 2.0)
    best = np.argpartition(-gain, probes - 1, axis=1)[:, :probes] if probes else np.empty((len(x), 0), dtype=int)
    return home[:, None, :] + v[best]
