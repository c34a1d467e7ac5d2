"""Quality by logistic regression on hashed word n-grams.

Words and runs of punctuation are tokens; single tokens and pairs of
neighbours are hashed into a fixed number of slots. A pair of equal tokens is
one feature whatever the token, so the model sees repetition. A text's vector
holds the damped count of every slot, scaled to length one. The weights are
learnt by follow-the-regularised-leader updates, one text at a time, and a
score is the logistic of one sparse dot product.

Null and empty texts have the zero vector and score by the bias alone. With
no labelled rows every score is 0.5. Rows come back one for one, repeated ids
included.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from wareline.llm.common import labelled_sample, map_batches, one_of_each, sigmoid, texts_of

#: Bound of the fit: labelled rows of each class.
MAX_ROWS = 3000
SLOTS = 1 << 18
EPOCHS = 8
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[!-/:-@\[-`{-~]+")
REPEAT = 0x5BD1E995


def features(text: str, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of the whole text's vector."""
    tokens = TOKEN.findall(text.lower().encode("utf-8", "replace"))
    if not tokens:
        return np.empty(0, np.int64), np.empty(0)
    single = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    left, right = single[:-1], single[1:]
    pairs = left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs ^= pairs >> np.uint64(29)
    pairs[left == right] = REPEAT
    at, counts = np.unique(np.concatenate([single, pairs]) % np.uint64(slots), return_counts=True)
    values = np.log1p(counts)
    return at.astype(np.int64), values / np.sqrt((values * values).sum())


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            at, values = features(text, len(self.weights))
            out[i] += self.weights[at] @ values
        return sigmoid(out)


def fit_texts(
    rows: list[tuple[str, int]],
    totals: tuple[int, int],
    slots: int = SLOTS,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 1e-3,
    l2: float = 1e-3,
) -> QualityModel:
    """Follow-the-regularised-leader over the texts, near copies left out.

    Each class weighs as much as it has rows among all labels.
    """
    groups = [one_of_each([t for t, label in rows if label == k]) for k in (0, 1)]
    n = sum(map(len, groups))
    if not n:
        return QualityModel(np.zeros(slots, np.float32), 0.0)
    shares = [t / max(1, sum(totals)) for t in totals]
    weight = [shares[k] * n / len(groups[k]) if groups[k] else 0.0 for k in (0, 1)]
    examples = [(*features(t, slots), k) for k in (0, 1) for t in groups[k]]
    order = np.random.default_rng(7)
    # The bias is one more coordinate, without a penalty.
    z, total = np.zeros(slots + 1), np.zeros(slots + 1)
    penalty1 = np.full(slots + 1, l1)
    penalty1[-1] = 0.0
    for _ in range(EPOCHS):
        for i in order.permutation(n):
            at, values, label = examples[i]
            at, values = np.append(at, slots), np.append(values, 1.0)
            w = _leader(z[at], total[at], penalty1[at], alpha, beta, l2)
            gradient = (sigmoid(w @ values) - label) * weight[label] * values
            squared = gradient * gradient
            step = (np.sqrt(total[at] + squared) - np.sqrt(total[at])) / alpha
            z[at] += gradient - step * w
            total[at] += squared
    w = _leader(z, total, penalty1, alpha, beta, l2)
    return QualityModel(w[:-1].astype(np.float32), float(w[-1]))


def _leader(z, total, l1, alpha, beta, l2):
    """The weights that minimise the regularised sum of all updates so far."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
    return -shrunk / ((beta + np.sqrt(total)) / alpha + l2)


def fit(docs: DataFrame, labels: DataFrame, keep, max_rows: int = MAX_ROWS) -> QualityModel:
    """Fit on at most ``max_rows`` rows a class whose id passes ``keep``."""
    return fit_texts(*labelled_sample(docs, labels, "quality", keep, max_rows))


def score(docs: DataFrame, model: QualityModel, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, score, predicted) of every row; no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score(texts_of(batch.column(1)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype("int32"))],
            names=[id_col, "score", "predicted"],
        )

    source = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType(
        [
            source.schema[0],
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return map_batches(source, run, schema)


def keep_good(docs: DataFrame, model: QualityModel, text_col="text") -> DataFrame:
    """The rows of good quality, with all their columns."""
    position = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score(texts_of(batch.column(position)))
        return batch.filter(pa.array(scores >= 0.5))

    return map_batches(docs, run, docs.schema)
