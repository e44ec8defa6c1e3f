"""Polynomial hashes of all windows of a byte string, modulo 2^64."""

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
_held = []


def powers(n):
    """Powers of the base and of its inverse, n of them."""
    if not _held or len(_held[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        _held[:] = [
            np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)])
            for base in (BASE, inverse)
        ]
    return _held[0][:n], _held[1][:n]


def window_hashes(values, width):
    """Hash of the ``width`` bytes from each place on: equal bytes, equal hash, wherever."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    hashes = (sums[width:] - sums[:-width]) * down[:len(values) - width + 1]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    return hashes
