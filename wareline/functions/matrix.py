"""Small numpy helpers used inside tasks, on one Arrow batch at a time."""

from __future__ import annotations

import numpy as np


def unit_rows(matrix):
    """Rows scaled to length one; zero rows stay zero."""
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length == 0, 1.0, length)


def flat_rows(index_lists, value_lists):
    """Row starts, column numbers and values of a list of sparse rows."""
    sizes = [len(row) for row in index_lists]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    if not starts[-1]:
        return starts, np.empty(0, dtype=int), np.empty(0)
    return (
        starts,
        np.concatenate([np.asarray(row, dtype=int) for row in index_lists]),
        np.concatenate([np.asarray(row, dtype=float) for row in value_lists]),
    )


def sparse_product(starts, columns, values, dense):
    """Sparse rows times a dense matrix, row by row, so that a row's share of
    the matrix stays in the processor's cache."""
    out = np.zeros((len(starts) - 1, dense.shape[1]))
    for row, (low, high) in enumerate(zip(starts[:-1], starts[1:])):
        if high > low:
            out[row] = values[low:high] @ dense.take(columns[low:high], axis=0)
    return out


def add_transposed_product(out, starts, columns, values, dense):
    """Add the transpose of sparse rows times a dense matrix to ``out``.

    A row holds a column once at most.
    """
    for row, (low, high) in enumerate(zip(starts[:-1], starts[1:])):
        if high > low:
            out[columns[low:high]] += values[low:high, None] * dense[row]
