"""Vectors of Arrow batches as matrices of whole numbers, and exact sums of products of them."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa

# Whole numbers are cut into limbs of so many bits: products of two limbs,
# summed over up to LIMB_ROWS rows, are exact in a double.
LIMB_BITS = 20
LIMB_ROWS = 1 << (53 - 2 * LIMB_BITS)
EXACT = pa.decimal128(38, 0)


def scaled(vectors: pa.Array, scale: float, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(kept, values): which vectors count, and floor(scale * entry) of those as a matrix of doubles.

    NULL vectors and vectors with a NULL or non-finite entry do not count.
    Entries that a vector lacks to ``dims`` (the longest of the batch if not
    given) are 0.
    """
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.float64)
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
    kept = (bad[offsets[1:]] == bad[offsets[:-1]]) & vectors.is_valid().to_numpy(zero_copy_only=False)
    values = flat[np.repeat(kept, sizes)]
    sizes = sizes[kept]
    dims = int(sizes.max(initial=0)) if dims is None else dims
    if (sizes == dims).all():
        return kept, np.floor(scale * values).reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = np.floor(scale * values)
    return kept, out


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as doubles whose sum, each shifted by ``LIMB_BITS`` more than the one before, they are."""
    out, rest = [], values
    while True:
        low = rest & ((1 << LIMB_BITS) - 1)
        rest = rest >> LIMB_BITS
        if not rest.any() or (rest == -1).all():
            # What is left of negative numbers belongs to the highest limb.
            out.append((low + (rest << LIMB_BITS)).astype(np.float64))
            return out
        small = np.abs(rest).max() < 1 << LIMB_BITS
        out.append(low.astype(np.float64))
        if small:
            out.append(rest.astype(np.float64))
            return out


def exact_sums(values: np.ndarray) -> list[int]:
    """Sum of each column of a matrix of 64-bit whole numbers."""
    low, high = values & ((1 << 31) - 1), values >> 31
    return [int(a) + (int(b) << 31) for a, b in zip(low.sum(0), high.sum(0))]


def exact_products(values: np.ndarray) -> np.ndarray:
    """transpose(values) @ values of 64-bit whole numbers, as Python integers."""
    dims = values.shape[1]
    total = np.zeros((dims, dims), object)
    for at in range(0, len(values), LIMB_ROWS):
        parts = limbs(values[at : at + LIMB_ROWS])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB_BITS * (i + j))
    return total


def exact_squares(values: np.ndarray) -> list[int]:
    """Sum of squares of each row of a matrix of whole numbers."""
    top = int(np.abs(values).max(initial=0))
    if top * top * max(values.shape[1], 1) < 1 << 62:
        return np.einsum("ij,ij->i", values, values).tolist()
    wide = values.astype(object)
    return (wide * wide).sum(1).tolist()


def decimals(numbers: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in numbers], EXACT)
