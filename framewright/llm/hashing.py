"""Rolling hashes and sliding minima over arrays."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each ``k`` consecutive values: those at i, ..., i + k - 1 give entry i.

    Built by doubling, so it takes about 2 log2(k) passes.
    """
    n = len(x) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = x.astype(np.uint64)
    power = (power + np.uint64(1)) * _MIX
    power ^= power >> np.uint64(31)
    size, out, done = 1, None, 0
    while True:
        if k & size:
            if out is None:
                out, done = power, size
            else:
                m = len(x) - done - size + 1
                out = out[:m] * np.uint64(pow(_BASE, size, 1 << 64)) + power[done : done + m]
                done += size
        if done == k:
            out = out[:n]
            out = out ^ (out >> np.uint64(29))
            out *= _MIX
            return out ^ (out >> np.uint64(32))
        m = len(power) - size
        power = power[:m] * np.uint64(pow(_BASE, size, 1 << 64)) + power[size : size + m]
        size *= 2


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """The positions that hold the minimum of some ``w`` consecutive entries: of equal ones the last of the window."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if w <= 16:
        low, at = h[:n], np.arange(n)
        for j in range(1, w):
            later = h[j : j + n] <= low
            low, at = np.where(later, h[j : j + n], low), np.where(later, np.arange(j, j + n), at)
        return np.unique(at)
    pad = -len(h) % w
    top = np.iinfo(np.uint64).max
    a = np.concatenate([h, np.full(pad, top, np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(a, axis=1).ravel()
    right = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(right[:n], left[w - 1 : w - 1 + n])
    # An entry is picked where it is its window's minimum and no later entry of that window is.
    change = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    picked = []
    for s, e in zip(change.tolist(), [*change[1:].tolist(), n], strict=True):
        v = low[s]
        at = s + np.flatnonzero(h[s : e - 1 + w] == v)
        if len(at) > 1:
            # one window after another takes the last occurrence that it holds
            last = at[np.searchsorted(at, np.arange(s, e) + w - 1, "right") - 1]
            picked.append(np.unique(last))
        else:
            picked.append(at)
    return np.unique(np.concatenate(picked))
