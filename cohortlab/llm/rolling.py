"""Rolling hashes over byte arrays (numpy; used inside tasks)."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(0x5EED)
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
PLACE_BITS = 22       # arrays of up to 4 M values
_INVERSE = pow(BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _series(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 1 << 14, 2 * len(_powers))
        _powers, _inverse = _series(BASE, size), _series(_INVERSE, size)
    return _powers[:n], _inverse[:n]


def prefix(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Prefix sums of ``table[byte] * BASE**i``; length ``len(data) + 1``."""
    p, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * p[:-1], out=out[1:])
    return out


def spans(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]``; equal bytes give equal hashes wherever they lie."""
    _, inv = powers(len(pre))
    return mix((pre[end] - pre[start]) * inv[start])


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xCA5A826395121157)
    return x ^ (x >> np.uint64(29))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the (leftmost) minimum of some ``width`` values in a row, ascending."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    # The same low bits everywhere: a choice must not depend on the array's length.
    low = np.uint64((1 << PLACE_BITS) - 1)
    packed = (values & ~low) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[:n - width + 1], head[width - 1:n])
    places = (least & low).astype(np.int64)
    return places[np.concatenate(([True], places[1:] != places[:-1]))]
