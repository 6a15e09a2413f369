"""Golomb code for sorted integers, on whole arrays.

Gaps between neighbours are divided by a modulus of 2^r; quotients go out in unary, remainders in r bits. Both runs are
stored one after the other, so that neither coding nor decoding needs a loop over the values.
"""

from __future__ import annotations

import struct

import numpy as np

HEADER = "<IB"  # number of values, r


def _parameter(gaps: np.ndarray) -> int:
    """The r that suits geometric gaps of this mean: 2^r is about 0.69 of the mean."""
    mean = float(gaps.mean()) if len(gaps) else 0.0
    return max(0, int(np.floor(np.log2(max(mean * 0.69, 1.0)))))


def encode(values: np.ndarray) -> bytes:
    """Code of strictly increasing, non-negative int64 values."""
    gaps = np.diff(values, prepend=-1) - 1
    r = _parameter(gaps)
    unary = (gaps >> r) + 1
    ends = np.cumsum(unary)
    bits = np.ones(int(ends[-1]) if len(ends) else 0, np.uint8)
    bits[ends - 1] = 0
    low = ((gaps[:, None] >> np.arange(r - 1, -1, -1)) & 1).astype(np.uint8)
    return struct.pack(HEADER, len(values), r) + np.packbits(bits).tobytes() + np.packbits(low.ravel()).tobytes()


def decode(code: bytes) -> np.ndarray:
    n, r = struct.unpack_from(HEADER, code)
    if not n:
        return np.empty(0, np.int64)
    body = np.frombuffer(code, np.uint8, offset=struct.calcsize(HEADER))
    low_bytes = (n * r + 7) // 8
    bits = np.unpackbits(body[: len(body) - low_bytes])
    ends = np.flatnonzero(bits == 0)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.int64) << r
    if r:
        low = np.unpackbits(body[len(body) - low_bytes:])[: n * r].reshape(n, r).astype(np.int64)
        gaps += low @ (np.int64(1) << np.arange(r - 1, -1, -1, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1
