"""Exact integer dot products by floating-point matrix products."""

from __future__ import annotations

import numpy as np

# Integers below this are exact in float64.
EXACT_BITS = 53


def limb_bits(length: int) -> int:
    """Bits a limb may have, so that ``length`` products of two limbs add up exactly in float64."""
    return (EXACT_BITS - max(1, length).bit_length()) // 2


def split(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as float64 limbs, lowest first: ``x`` is the sum of ``limb[i] * 2**(bits * i)``.

    All limbs but the last are not negative; the last one carries the sign. As many as are needed.
    """
    out = []
    rest = x
    while rest.size and not (-(1 << bits) < int(rest.min()) and int(rest.max()) < 1 << bits):
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    out.append(rest.astype(np.float64))
    return out


def exact_products(a: np.ndarray, b: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``a @ b.T`` of int64 matrices (or stacks of them), exact where the result fits 64 bits.

    Every limb of one side meets every limb of the other in a BLAS product that stays below 2^53;
    the products are shifted and added in int64, where wrapping sums cancel out.
    """
    bits = bits or limb_bits(a.shape[-1])
    right = [np.swapaxes(limb, -1, -2) for limb in split(b, bits)]
    total = np.zeros((*a.shape[:-1], b.shape[-2]), np.int64)
    for i, x in enumerate(split(a, bits)):
        for j, y in enumerate(right):
            if bits * (i + j) < 64:
                total += (x @ y).astype(np.int64) << (bits * (i + j))
    return total
