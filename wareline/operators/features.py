"""Text features: words and bigrams, weighted and normalised."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import ElementwiseProduct, NGram, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from wareline.functions import text as X
from wareline.session import written

MAX_FEATURES = 20000
COUNTS = "_counts"
_ALL, _WORDS, _PAIRS = "_all", "_words", "_pairs"
_TERMS, _SCALED = "_terms", "_scaled"


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input has fewer files than there are cores.

    Cutting text into terms is the expensive part; with as many files as
    cores, which is the case for any large input, nothing is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def add_words(df: DataFrame, text: Column, stop_words=()) -> DataFrame:
    """Add ``_words``: words of the folded text without the stop words."""
    found = F.coalesce(X.words(X.fold_accents(text)), F.array().cast("array<string>"))
    if not stop_words:
        return df.withColumn(_WORDS, found)
    return StopWordsRemover(
        inputCol=_ALL, outputCol=_WORDS, stopWords=list(stop_words), caseSensitive=True
    ).transform(df.withColumn(_ALL, found)).drop(_ALL)


def add_terms(df: DataFrame, text: Column, stop_words=()) -> DataFrame:
    """Add ``_terms``: words of the folded text, then pairs of neighbours.

    Stop words go before the pairs are formed.
    """
    worded = add_words(df, text, stop_words)
    paired = NGram(n=2, inputCol=_WORDS, outputCol=_PAIRS).transform(worded)
    return paired.withColumn(_TERMS, F.concat(_WORDS, _PAIRS)).drop(_WORDS, _PAIRS)


def _numbered(words: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row of each word and its number among ``known``, -1 if it is not there."""
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    flat = words.flatten()
    found = pc.index_in(flat, value_set=known.cast(flat.type)).fill_null(-1)
    return np.repeat(np.arange(len(sizes)), sizes), found.to_numpy().astype(np.int64)


def _pair_keys(rows: np.ndarray, numbers: np.ndarray, known: int):
    """Row and key of each pair of neighbours that are both known."""
    left, right = numbers[:-1], numbers[1:]
    whole = (left >= 0) & (right >= 0) & (rows[:-1] == rows[1:])
    return rows[:-1][whole], left[whole] * known + right[whole]


def _word_counts(words: DataFrame) -> DataFrame:
    """Every word with its number of occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten())
            yield pa.RecordBatch.from_arrays(
                [found.field("values"), found.field("counts")], ["term", "count"]
            )

    parts = words.select(_WORDS).mapInArrow(count, "term string, count bigint")
    return parts.groupBy("term").agg(F.sum("count").alias("count"))


def _pair_counts(words: DataFrame, known: list[str]) -> DataFrame:
    """Every pair of neighbours among the ``known`` words, with its number.

    Pairs are counted by the numbers of their words, and spelt again afterwards
    by ``_spelt``.
    """
    listed = pa.array(known, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, keys = _pair_keys(*_numbered(batch.column(0), listed), len(listed))
            keys, counts = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["pair", "count"]
            )

    parts = words.select(_WORDS).mapInArrow(count, "pair bigint, count bigint")
    return parts.groupBy("pair").agg(F.sum("count").alias("count"))


def _spelt(pairs: DataFrame, known: list[str]) -> DataFrame:
    listed = pa.array(known, pa.string())

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            sides = [listed.take(pa.array(side)) for side in np.divmod(keys, max(len(listed), 1))]
            terms = pc.binary_join_element_wise(*sides, " ")
            yield pa.RecordBatch.from_arrays([terms, batch.column(1)], ["term", "count"])

    return pairs.select("pair", "count").mapInArrow(spell, "term string, count bigint")


def vocabulary(words: DataFrame, size: int = MAX_FEATURES) -> list[str]:
    """The most frequent words and pairs in alphabetical order, ties by the term.

    A pair is no more frequent than either of its words. So a pair counts only
    if both words occur as often as the last of the ``size`` best words, and
    rarer pairs, which are most of all terms, are never exchanged. Two times
    ``size`` strings reach the driver at most; if more words than that are as
    frequent as the last one, pairs are counted by their spelling.
    """
    order = [F.desc("count"), F.asc("term")]
    counts = _word_counts(words)
    best = counts.orderBy(*order).limit(2 * size).collect()
    least = best[size - 1]["count"] if len(best) >= size else 0
    known = [row.term for row in best if row["count"] >= least]
    if len(known) < 2 * size:
        pairs = _spelt(_pair_counts(words, known).where(F.col("count") >= least), known)
    else:
        paired = NGram(n=2, inputCol=_WORDS, outputCol=_PAIRS).transform(words.select(_WORDS))
        pairs = paired.select(F.explode(_PAIRS).alias("term")).groupBy("term").count()
    best += pairs.orderBy(*order).limit(size).collect()
    best.sort(key=lambda row: (-row["count"], row.term))
    return sorted(row.term for row in best[:size])


@dataclass
class TextFeatures:
    """A fitted weighting: term counts times idf, rows of length one."""

    terms: list[str]
    idf: list[float]
    documents: int
    stop_words: tuple[str, ...]

    @property
    def width(self) -> int:
        """Length of the vectors; an empty vocabulary has one term that no text holds."""
        return max(1, len(self.terms))

    @cached_property
    def _counter(self):
        """Column function from words to the vector of term counts."""
        split = [term.split(" ") for term in self.terms]
        known = sorted({word for parts in split for word in parts})
        number = {word: i for i, word in enumerate(known)}
        # The last place answers for the words that are not known.
        places = np.full(len(known) + 1, -1)
        pairs = []
        for place, parts in enumerate(split):
            if len(parts) == 1:
                places[number[parts[0]]] = place
            elif len(parts) == 2:
                pairs.append((number[parts[0]] * len(known) + number[parts[1]], place))
        pair_keys, pair_places = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2).T
        listed, width = pa.array(known, pa.string()), self.width

        def count(words: pa.Array) -> pa.Array:
            rows, numbers = _numbered(words, listed)
            terms = places[numbers]
            cells = [rows[terms >= 0] * width + terms[terms >= 0]]
            if len(pair_keys):
                pair_rows, keys = _pair_keys(rows, numbers, len(listed))
                at = np.minimum(np.searchsorted(pair_keys, keys), len(pair_keys) - 1)
                hit = pair_keys[at] == keys
                cells.append(pair_rows[hit] * width + pair_places[at[hit]])
            filled, counts = np.unique(np.concatenate(cells), return_counts=True)
            starts = np.searchsorted(filled, np.arange(len(words) + 1) * width)
            starts = pa.array(starts, pa.int32())
            return pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(len(words)), pa.int8()),
                    pa.array(np.full(len(words), width), pa.int32()),
                    pa.ListArray.from_arrays(starts, pa.array(filled % width, pa.int32())),
                    pa.ListArray.from_arrays(starts, pa.array(counts, pa.float64())),
                ],
                ["type", "size", "indices", "values"],
            )

        return F.arrow_udf(count, VectorUDT())

    def count_words(self, words: DataFrame) -> DataFrame:
        """Turn the words of each row into its term counts."""
        return words.withColumn(COUNTS, self._counter(F.col(_WORDS))).drop(_WORDS)

    def count(self, df: DataFrame, text: Column) -> DataFrame:
        """Add the term counts of ``text``, row by row."""
        return self.count_words(add_words(df, text, self.stop_words))

    def weigh(self, counted: DataFrame, output: str = "features") -> DataFrame:
        """Turn counts into the normalised vector, row by row."""
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol=COUNTS, outputCol=_SCALED
        )
        unit = Normalizer(p=2.0, inputCol=_SCALED, outputCol=output)
        return unit.transform(scale.transform(counted)).drop(COUNTS, _SCALED)

    def transform(self, df: DataFrame, text: Column, output: str = "features") -> DataFrame:
        return self.weigh(self.count(df, text), output)


def document_frequencies(counted: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """How many rows hold each term, and how many rows there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(width, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=width)
        # The rows stand in one more place.
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width + 1), pa.int32()), pa.array([*total, rows], pa.int64())],
            ["place", "rows"],
        )

    places = counted.select(sparse_parts(COUNTS)[0].alias("terms"))
    parts = places.mapInArrow(count, "place int, rows bigint").where(F.col("rows") > 0)
    found = np.zeros(width + 1, dtype=np.int64)
    for row in parts.groupBy("place").agg(F.sum("rows").alias("rows")).collect():
        found[row.place] = row.rows
    return found[:-1], int(found[-1])


def fit_features(
    df: DataFrame, text: Column, keep: list[str], stop_words=(), size: int = MAX_FEATURES
) -> tuple[TextFeatures, DataFrame]:
    """Learn vocabulary and smoothed idf, ``ln((1 + n) / (1 + df)) + 1``.

    Also returns the ``keep`` columns with their features. The texts are cut
    into words once; these, and later the counts, are written to the shared
    folder and all later passes read them.
    """
    worded = add_words(spread(df).select(*keep, text.alias("_text")), F.col("_text"), stop_words)
    words = written(worded.select(*keep, _WORDS), "words")
    fitted = TextFeatures(vocabulary(words, size), [], 0, tuple(stop_words))
    counted = written(fitted.count_words(words), "counts")
    held, fitted.documents = document_frequencies(counted, fitted.width)
    if not fitted.documents:
        raise ValueError("Features take one row or more.")
    fitted.idf = (np.log((fitted.documents + 1.0) / (held + 1.0)) + 1.0).tolist()
    return fitted, fitted.weigh(counted)


def sparse_parts(vector: str) -> tuple[Column, Column]:
    """Term numbers and weights of a sparse vector column."""
    raw = F.unwrap_udt(F.col(vector))
    return raw.getField("indices"), raw.getField("values")


def known_terms(vector: str) -> Column:
    """How many vocabulary terms a row holds."""
    return F.coalesce(F.size(sparse_parts(vector)[0]), F.lit(0))
