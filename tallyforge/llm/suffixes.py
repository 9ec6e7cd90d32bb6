"""Blockwise suffix sorting with a difference cover.

Suffixes of many short byte rows are sorted one bucket at a time. A bucket is ordered by the first
PERIOD bytes of its suffixes; suffixes that tie there are ordered by the rank of a sampled suffix at
most PERIOD bytes further on. The sample holds the offsets of a difference cover, so that any two
suffixes reach sampled ones after the same number of bytes, and its ranks are computed once.
"""

from __future__ import annotations

from functools import cmp_to_key

import numpy as np

PERIOD = 32


def difference_cover(v: int) -> list[int]:
    """Residues such that every number mod v is a difference of two of them: small ones and multiples of their number."""
    k = 1
    while k * k < v:
        k += 1
    return sorted({*range(k), *range(0, v, k)})


COVER = difference_cover(PERIOD)
_IN = np.isin(np.arange(PERIOD), COVER)
#: For two residues, the least shift that brings both into the cover.
SHIFT = np.array([[next(d for d in range(PERIOD) if _IN[(a + d) % PERIOD] and _IN[(b + d) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)])
SHIFTS = SHIFT.tolist()
#: For a residue, the shifts that bring it into the cover, as bits.
REACHES = np.array([sum(1 << d for d in range(PERIOD) if _IN[(a + d) % PERIOD]) for a in range(PERIOD)], np.int64)


def word_at(rows: np.ndarray, r: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The eight bytes from offset s of rows r as one big-endian number."""
    width = rows.shape[1]
    every = np.ndarray((rows.size - 7,), dtype=">u8", buffer=rows, strides=(1,))
    return every[r * width + s].astype(np.uint64)


def _words(rows: np.ndarray, r: np.ndarray, s: np.ndarray, n: int) -> list[np.ndarray]:
    """n big-endian 8-byte words from offset s of rows r."""
    return [word_at(rows, r, s + 8 * w) for w in range(n)]


def _dense(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks of composite keys, most significant first; equal keys share a rank; ranks start at 1."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    step = np.zeros(len(order), bool)
    for k in keys:
        step[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step) + 1
    return rank


def sample_ranks(rows: np.ndarray, width: int) -> np.ndarray:
    """Ranks of the sampled suffixes of each row (0 elsewhere and past the end), by doubling from PERIOD bytes."""
    m = len(rows)
    at = np.nonzero(np.isin(np.arange(width) % PERIOD, COVER))[0]
    r, s = np.repeat(np.arange(m), len(at)), np.tile(at, m)
    table = np.zeros((m, width + 2 * PERIOD + width), np.int64)
    table[r, s] = _dense(_words(rows, r, s, PERIOD // 8))
    h = PERIOD
    while h < width:
        table[r, s] = _dense([table[r, s] * (len(r) + 1) + table[r, s + h]])
        h *= 2
    return table


def sort_bucket(rows: np.ndarray, width: int, r: np.ndarray, s: np.ndarray, group: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The order of suffixes (row r, offset s) inside their groups. rows: zero bytes follow each row's width."""
    first = _words(rows, r, s, PERIOD // 8)
    order = np.lexsort((*first[::-1], group))
    g, f, res = group[order], [w[order] for w in first], (s % PERIOD)[order]
    tie = (g[1:] == g[:-1]) & np.logical_and.reduce([w[1:] == w[:-1] for w in f])
    head = np.concatenate([[True], ~tie])
    starts, run = np.nonzero(head)[0], np.cumsum(head) - 1
    # suffixes that tie: mostly one shift brings all of their residues into the cover
    shifts = np.bitwise_and.reduceat(REACHES[res], starts)
    least = np.zeros(len(starts), np.int64)
    for d in range(PERIOD - 1, -1, -1):
        least[(shifts >> d) & 1 == 1] = d
    key = ranks[r[order], s[order] + least[run]]
    order = order[np.argsort(run * (int(ranks.max()) + 1) + key, kind="stable")]
    ends = np.append(starts[1:], len(order))
    if (shifts == 0).any():  # no common shift: compare each pair at the shift that suits it
        row, at, mod, rank = r.tolist(), s.tolist(), (s % PERIOD).tolist(), memoryview(ranks)

        def compare(i: int, j: int) -> int:
            d = SHIFTS[mod[i]][mod[j]]
            return rank[row[i], at[i] + d] - rank[row[j], at[j] + d]

        for k in np.nonzero(shifts == 0)[0]:
            order[starts[k] : ends[k]] = sorted(order[starts[k] : ends[k]].tolist(), key=cmp_to_key(compare))
    return order
