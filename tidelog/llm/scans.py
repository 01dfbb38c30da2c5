"""Prefix products of small matrices over a long sequence, many blocks side by side."""

from __future__ import annotations

import numpy as np


def chain(entry: np.ndarray, matrices: np.ndarray) -> np.ndarray:
    """``v[i] = v[i - 1] @ matrices[i]`` scaled to sum 1, for all i, from ``v[-1] = entry``.

    Products are associative, so blocks are multiplied through in step with each other; then each
    block's product is applied in turn, and one product joins the two.
    """
    n, s = len(matrices), matrices.shape[1]
    width = max(1, int(n ** 0.5))
    blocks = -(-n // width)
    padded = np.broadcast_to(np.eye(s), (blocks * width, s, s)).copy()
    padded[:n] = matrices
    inner = padded.reshape(blocks, width, s, s)
    for j in range(1, width):
        product = inner[:, j - 1] @ inner[:, j]
        inner[:, j] = product / product.max(axis=(1, 2), keepdims=True)
    starts = np.empty((blocks, s))
    v = entry
    for b in range(blocks):
        starts[b] = v
        v = v @ inner[b, -1]
        v = v / v.sum()
    out = np.einsum("bi,bjik->bjk", starts, inner).reshape(-1, s)[:n]
    return out / out.sum(axis=1, keepdims=True)
