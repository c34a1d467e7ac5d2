"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on the
passages that set toxic text apart from it. A window of words is compressed
with the ordinary dictionary, and with the toxic dictionary in front of the
ordinary one. Ordinary wording costs the same bytes either way, so the bytes
saved measure toxic wording. The savings of all windows of a text give a few
figures; a logistic curve fitted on cross-fitted figures turns them into a
score whose threshold is 0.5.

Texts are lower-cased and cut at white space. A null or empty text has no
window and is scored like any text without savings. Without labelled rows of
both classes every score is the toxic share of the sample (0 without rows).
Rows come back one for one, repeated ids included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from wareline.llm.common import (
    labelled_sample,
    logistic,
    map_batches,
    one_of_each,
    sigmoid,
    texts_of,
)

WINDOW = 16
#: Bound of the fit: labelled rows of each class. Their texts count whole.
MAX_ROWS = 1200
#: Words of an ordinary sample for the dictionary.
SAMPLE = 32
ORDINARY_BYTES = 16384
TOXIC_BYTES = 8192
GRAM_SIZES = (4, 5)
MIN_RATE_RATIO = 3.0
MIN_EVIDENCE = 10.0
PADDING = "\n" * 24


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The whole text in windows of ``size`` words."""
    words = text.lower().split()
    return [
        f" {' '.join(words[i : i + size])} ".encode("utf-8", "replace")
        for i in range(0, len(words), size)
    ]


@lru_cache(1 << 15)
def _grams(word: str) -> frozenset[str]:
    padded = f" {word} "
    return frozenset(padded[i : i + n] for n in GRAM_SIZES for i in range(len(padded) - n + 1))


def _gram_counts(texts: list[str], among=None) -> Counter:
    """In how many texts each character gram occurs, or each of ``among``."""
    counts: Counter = Counter()
    for text in texts:
        seen: set[str] = set()
        for word in set(text.lower().split()):
            seen |= _grams(word)
        counts.update(seen if among is None else seen & among)
    return counts


def _telling_grams(toxic: list[str], ordinary: list[str]) -> set[str]:
    """Grams far more frequent in toxic texts, by a likelihood ratio."""
    n1, n0 = len(toxic), len(ordinary)
    prior = n1 / (n1 + n0)
    often = {gram: k for gram, k in _gram_counts(toxic).items() if k >= 3}
    against = _gram_counts(ordinary, often.keys())
    out = set()
    for gram, k in often.items():
        m = against[gram]
        share = k / (k + m)
        if k / n1 < MIN_RATE_RATIO * (m + 0.5) / n0 or share <= prior:
            continue
        evidence = k * np.log(share / prior)
        if m:
            evidence += m * np.log((1 - share) / (1 - prior))
        if evidence > MIN_EVIDENCE:
            out.add(gram)
    return out


def _passages(words: list[str], grams: set[str]) -> list[str]:
    """Maximal runs of each word that ``grams`` cover."""
    out = []
    for word in words:
        if grams.isdisjoint(_grams(word)):
            continue
        padded = f" {word} "
        hit = bytearray(len(padded))
        for n in GRAM_SIZES:
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] in grams:
                    hit[i : i + n] = b"\x01" * n
        run = ""
        for char, covered in zip(padded + "\0", [*hit, 0]):
            if covered:
                run += char
            elif run:
                out.append(run)
                run = ""
    return out


def train_dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """A zstandard dictionary; the samples themselves if too few to train on."""
    total = sum(map(len, samples))
    if len(samples) >= 8 and total >= 4 * 256:
        try:
            return zstd.train_dictionary(
                max(256, min(size, total // 4)), samples, k=segment, d=6
            ).as_bytes()
        except zstd.ZstdError:
            pass
    return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    params = zstd.ZstdCompressionParameters(
        window_log=18,
        hash_log=16,
        chain_log=16,
        search_log=4,
        min_match=5,
        target_length=32,
        strategy=zstd.STRATEGY_GREEDY,
        write_content_size=0,
        write_dict_id=0,
        format=zstd.FORMAT_ZSTD1_MAGICLESS,
    )
    if len(content) < 8:
        return zstd.ZstdCompressor(compression_params=params)
    raw = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    return zstd.ZstdCompressor(dict_data=raw, compression_params=params)


class Lengths:
    """Bytes saved on each window of a text by the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self._plain = _compressor(ordinary).compress
        self._toxic = _compressor(toxic + ordinary).compress

    def savings(self, text: str) -> np.ndarray:
        plain, toxic = self._plain, self._toxic
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)], dtype=float)


def figures(savings: np.ndarray) -> list[float]:
    """What the calibration sees of a text: its best window and its density."""
    if not len(savings):
        return [0.0] * 5
    gains = np.maximum(savings, 0.0)
    return [
        min(float(gains.max()), 12.0),
        float(np.log1p((savings >= 2).sum())),
        float((savings >= 2).mean()),
        float((savings >= 1).mean()),
        float(np.log1p(gains.mean())),
    ]


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: list[float]
    base_rate: float

    def scorer(self):
        if not self.weights:
            return lambda texts: np.full(len(texts), self.base_rate)
        lengths = Lengths(self.ordinary, self.toxic)
        weights = np.array(self.weights)

        def score(texts: list[str]) -> np.ndarray:
            x = np.array([figures(lengths.savings(t)) for t in texts]).reshape(-1, 5)
            return sigmoid(x @ weights[:-1] + weights[-1])

        return score


def _ordinary_samples(texts: list[str]) -> Iterator[bytes]:
    """Every run of ``SAMPLE`` neighbouring words of the whole texts."""
    for text in texts:
        words = text.lower().split()
        for i in range(0, len(words), SAMPLE):
            yield " ".join(words[i : i + SAMPLE]).encode("utf-8", "replace")


def _toxic_samples(toxic: list[str], ordinary: list[str]) -> Iterator[bytes]:
    """The telling passages of each whole toxic text."""
    grams = _telling_grams(toxic, ordinary)
    for text in toxic:
        if runs := _passages(text.lower().split(), grams):
            yield "".join(run + PADDING for run in runs).encode("utf-8", "replace")


def _dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    return (
        train_dictionary(list(_ordinary_samples(ordinary)), ORDINARY_BYTES, segment=16),
        train_dictionary(list(_toxic_samples(toxic, ordinary)), TOXIC_BYTES, segment=32),
    )


def fit_texts(
    rows: list[tuple[str, int]], totals: tuple[int, int], folds: int = 2
) -> ToxicityModel:
    """Dictionaries and calibration from labelled texts.

    Of near copies one is used. The calibration sees each text only through
    dictionaries trained without it, and is moved to the class sizes of all
    labels, ``totals``.
    """
    toxic = one_of_each([t for t, label in rows if label])
    ordinary = one_of_each([t for t, label in rows if not label])
    rate = totals[1] / max(1, sum(totals))
    if len(toxic) < folds or len(ordinary) < folds:
        return ToxicityModel(b"", b"", [], rate)
    x, y = [], []
    for part in range(folds):
        kept = [[t for i, t in enumerate(g) if i % folds != part] for g in (toxic, ordinary)]
        lengths = Lengths(*_dictionaries(*kept))
        for label, group in ((1, toxic), (0, ordinary)):
            for i, text in enumerate(group):
                if i % folds == part:
                    x.append(figures(lengths.savings(text)))
                    y.append(label)
    weights = logistic(np.array(x), np.array(y, dtype=float), l2=1e-4)
    weights[-1] += np.log(totals[1] / len(toxic)) - np.log(totals[0] / len(ordinary))
    plain, marked = _dictionaries(toxic, ordinary)
    return ToxicityModel(plain, marked, weights.tolist(), rate)


def fit(docs: DataFrame, labels: DataFrame, keep, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Fit on at most ``max_rows`` rows a class whose id passes ``keep``."""
    model = fit_texts(*labelled_sample(docs, labels, "toxic", keep, max_rows))
    # Grams are cut in the fit alone.
    _grams.cache_clear()
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, score, predicted) of every row; no shuffle."""
    cached = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "score" not in cached:
            cached["score"] = model.scorer()
        scores = cached["score"](texts_of(batch.column(1)))
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


def keep_clean(docs: DataFrame, model: ToxicityModel, text_col="text") -> DataFrame:
    """The rows that are not toxic, with all their columns."""
    cached, position = {}, docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "score" not in cached:
            cached["score"] = model.scorer()
        scores = cached["score"](texts_of(batch.column(position)))
        return batch.filter(pa.array(scores < 0.5))

    return map_batches(docs, run, docs.schema)
