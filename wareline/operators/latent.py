"""Latent axes of a sparse matrix, found in a few passes over its rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from wareline.functions.matrix import (
    add_transposed_product,
    flat_rows,
    sparse_product,
    unit_rows,
)
from wareline.operators.features import sparse_parts

# Power iterations and spare directions of the usual
# randomised decomposition.
PASSES, SPARE = 5, 10
# Tasks per core and at most in a pass, and terms per block of their partial sums.
TASKS_PER_CORE, PARTIALS, BLOCK = 2, 2048, 512


def project(starts, terms, weights, axes):
    """Sparse rows in latent space, scaled to length one."""
    return unit_rows(sparse_product(starts, terms, weights, axes))


def _gram_times(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """``A' (A basis)`` for the sparse rows of A.

    Each task sums its own rows and hands its sum on in blocks of terms, so
    that many tasks add up the blocks. At most ``PARTIALS`` blocks of fixed
    size meet in one group.
    """
    shared = rows.sparkSession.sparkContext.broadcast(basis)
    size, width = basis.shape

    def partial(batches):
        total = np.zeros((size, width))
        for batch in batches:
            flat = flat_rows(batch["terms"], batch["weights"])
            here = sparse_product(*flat, shared.value)
            add_transposed_product(total, *flat, here)
        for block in range(0, size, BLOCK):
            yield pd.DataFrame(
                {"block": [block], "total": [total[block : block + BLOCK].tobytes()]}
            )

    def add(key, group):
        total = sum(np.frombuffer(part) for part in group["total"])
        return pd.DataFrame({"block": [key[0]], "total": [total.tobytes()]})

    kind = "block int, total binary"
    sums = rows.mapInPandas(partial, kind).groupBy("block").applyInPandas(add, kind)
    parts = sorted(sums.collect(), key=lambda row: row.block)
    shared.unpersist()
    return np.concatenate([np.frombuffer(bytes(r.total)).reshape(-1, width) for r in parts])


def latent_axes(df: DataFrame, vector: str, size: int, width: int, seed: int = 42):
    """Up to ``width`` leading right singular vectors, as columns.

    Subspace iteration: a handful of passes whatever the width. The driver
    only holds ``size`` (at most the vocabulary cap) times ``width`` numbers.
    """
    terms, weights = sparse_parts(vector)
    # Each task hands on a sum of the same size, so their number follows the cores.
    tasks = min(PARTIALS, TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    rows = df.select(terms.alias("terms"), weights.alias("weights")).coalesce(tasks)
    spread = min(width + SPARE, size)
    basis = np.random.default_rng(seed).standard_normal((size, spread))
    basis = np.linalg.qr(basis)[0]
    for _ in range(PASSES):
        basis = np.linalg.qr(_gram_times(rows, basis))[0]
    within = basis.T @ _gram_times(rows, basis)
    values, vectors = np.linalg.eigh((within + within.T) / 2)
    leading = np.argsort(values)[::-1][:width]
    # Directions that no row has are arbitrary and would only blur queries.
    leading = leading[values[leading] > values.max() * 1e-10]
    return basis @ vectors[:, leading]
