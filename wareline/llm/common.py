"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id, parts: int):
    """Remainder of crc32 over the id as text, as a column."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def fold_of(doc_id: int, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def range_borders(df: DataFrame, col: str, parts: int) -> list:
    """Rising values that cut ``col`` into at most ``parts`` ranges of like size."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(df.agg(F.percentile_approx(col, shares, 10000)).first()[0] or []))


def range_of(value, borders: list):
    """Number of the range that holds ``value``: how many borders are not above it."""
    if not borders:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b <= value))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Python strings of an Arrow column, nulls as empty texts."""
    return [text or "" for text in column.to_pylist()]


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType
) -> DataFrame:
    """``fn`` over every Arrow batch; no row leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep, max_rows: int, text_col="text"
) -> tuple[list[tuple[str, int]], tuple[int, int]]:
    """At most ``max_rows`` labelled texts of each class, and all rows of each class.

    The order is a hash of the id, so the sample does not hang on partitioning;
    ids are not part of what comes back. The counts are taken over all labels. ``keep`` filters ``doc_id``. Rows
    without an id, a text or a label, and labels other than 0 and 1, are left
    out; of repeated labels of one document the largest holds, and of texts that
    repeat an id the least. So no more than the bound reaches the driver.
    """
    wanted = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & keep(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .withColumn("at", F.xxhash64("doc_id"))
    )
    total = {r.label: r["count"] for r in wanted.groupBy("label").count().collect()}
    chosen = [
        wanted.where(F.col("label") == value).orderBy("at", "doc_id").limit(max_rows)
        for value in (0, 1)
    ]
    rows = (
        docs.select("doc_id", F.col(text_col).alias("text"))
        .where(F.col("text").isNotNull())
        .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .groupBy("doc_id", "at", "label")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (r.at, r.doc_id, r.text))
    return [(r.text, r.label) for r in rows], (total.get(0, 0), total.get(1, 0))


def one_of_each(texts: list[str], alike: float = 0.5) -> list[str]:
    """``texts`` without near copies of earlier ones.

    Texts that share one of eight minima over their 3-word runs are compared in
    full: near copies share at least ``alike`` of all their runs.
    """
    kept: list[np.ndarray] = []
    seen: dict[tuple[int, int], list[int]] = {}
    out = []
    for text in texts:
        words = text.lower().encode("utf-8", "replace").split()
        runs = [zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))]
        own = np.unique(np.array(runs, dtype=np.uint64))
        keys = [(i, int((own * _ODD[i] >> np.uint64(20)).min())) for i in range(len(_ODD))]
        if any(_jaccard(own, kept[n]) >= alike for n in {n for k in keys for n in seen.get(k, ())}):
            continue
        for key in keys:
            seen.setdefault(key, []).append(len(kept))
        kept.append(own)
        out.append(text)
    return out


_ODD = np.random.default_rng(11).integers(1 << 40, 1 << 63, 8).astype(np.uint64) * 2 + 1


def _jaccard(left: np.ndarray, right: np.ndarray) -> float:
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared / (len(left) + len(right) - shared)


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 60):
    """Weights, bias last, of an L2-regularised logistic fit by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(design.shape[1])
    penalty = np.full(design.shape[1], l2 * len(x))
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(design @ weights)
        gradient = design.T @ (p - y) + penalty * weights
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
