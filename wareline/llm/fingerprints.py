"""I-Match document fingerprints.

The lexicon holds the terms whose inverse document frequency lies within a
band; frequencies are counted over all documents. The distinct lexicon terms
of a text, sorted, are hashed once as a whole and once for each of ``SUBSETS``
randomised parts of the lexicon, the parts having several sampling rates. Two
texts are as alike as the share of those parts, empty in both left out, that
hash the same.

Terms are lower-cased words, known by a 32-bit hash, and every hash has its
own count. A term of the lexicon stands in a share of at least ``LEAST_SHARE``
of all documents, so there are at most (mean distinct terms of a text) /
``LEAST_SHARE`` of them, however many documents there are. Texts without a lexicon term are known by their terms, so equal texts
always have equal fingerprints. A null text counts as empty. Rows come back
one for one; rows that repeat an id are ordered by their texts, and rows
without an id stand last.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from wareline.llm.common import map_batches, range_borders, range_of, texts_of

#: Hashes a task gathers before it adds them up and passes them on.
GATHERED = 1 << 22
#: Band of document frequency, as shares of all documents.
LEAST_SHARE = 0.002
MOST_SHARE = 0.2
#: Sampling rates of the lexicon parts, and how many parts have each. Large
#: parts tell exact copies from near ones, small ones survive heavy edits.
RATES = (0.5, 0.1, 0.01, 0.004)
PARTS = (6, 10, 32, 48)
SUBSETS = sum(PARTS)
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def term_hashes(text: str) -> np.ndarray:
    """Sorted hashes of the distinct terms of a whole text."""
    terms = set(TERM.findall(text.lower().encode("utf-8", "replace")))
    return np.unique(np.fromiter(map(zlib.crc32, terms), np.uint32, len(terms)))


def document_frequencies(docs: DataFrame, text_col="text", gathered: int = GATHERED) -> DataFrame:
    """(term, n): in how many documents each term hash occurs.

    Each task adds up ``gathered`` hashes at a time, and Spark what the task
    passes on, before anything is shuffled; no task holds all terms.
    """

    def counted(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.unique(np.concatenate(parts), return_counts=True)
        for start in range(0, len(terms), 65536):
            part = slice(start, start + 65536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms[part].astype(np.int64)), pa.array(counts[part].astype(np.int64))],
                names=["term", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for text in texts_of(batch.column(0)):
                parts.append(term_hashes(text))
                held += len(parts[-1])
                if held >= gathered:
                    yield from counted(parts)
                    parts, held = [], 0
        if parts:
            yield from counted(parts)

    rows = docs.select(F.col(text_col)).mapInArrow(run, "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """The sorted term hashes within the band."""

    terms: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Those of the sorted hashes that belong to the lexicon."""
        if not len(self.terms):
            return hashes[:0]
        at = np.searchsorted(self.terms, hashes)
        return hashes[self.terms[np.minimum(at, len(self.terms) - 1)] == hashes]


def lexicon(
    docs: DataFrame, text_col="text", least: float = LEAST_SHARE, most: float = MOST_SHARE
) -> Lexicon:
    """The band of the corpus; only its hashes reach the driver."""
    total = docs.count()
    low, high = max(2.0, least * total), max(2.0, most * total)
    band = document_frequencies(docs, text_col).where(F.col("n").between(low, high))
    found = band.select(F.col("term")).toArrow().column(0).to_numpy()
    return Lexicon(np.sort(found.astype(np.uint32)))


class Printer:
    """Fingerprints under one lexicon."""

    def __init__(self, words: Lexicon):
        self.words = words
        seeds = np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        rates = np.repeat(RATES, PARTS)
        self.seeds, self.limits = seeds, (rates * 2.0**32).astype(np.uint64)

    def signature(self, text: str) -> tuple[str, list[str]]:
        """The whole hash and one for each part of the lexicon, "" where it is empty."""
        every = term_hashes(text)
        terms = self.words.of(every)
        if not len(terms):
            digest = hashlib.blake2b(every.tobytes(), digest_size=8, person=b"no terms")
            return digest.hexdigest(), [""] * SUBSETS
        mixed = terms.astype(np.uint64)[None, :] ^ self.seeds[:, None]
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        inside = (mixed >> np.uint64(32)) < self.limits[:, None]
        parts = []
        for chosen in inside:
            part = terms[chosen]
            parts.append(
                hashlib.blake2b(part.tobytes(), digest_size=3).hexdigest() if len(part) else ""
            )
        return hashlib.blake2b(terms.tobytes(), digest_size=8).hexdigest(), parts


def as_text(signature: tuple[str, list[str]]) -> str:
    return signature[0] + ":" + ".".join(signature[1])


def likeness(a: tuple[str, list[str]], b: tuple[str, list[str]]) -> float:
    """1 for equal fingerprints, else the share of non-empty parts that agree."""
    if a == b:
        return 1.0
    pairs = [(x, y) for x, y in zip(a[1], b[1]) if x or y]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def fingerprint(docs: DataFrame, words: Lexicon, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, fingerprint) of every row; no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        printer = Printer(words)
        found = [as_text(printer.signature(t)) for t in texts_of(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.string())], names=[id_col, "fingerprint"]
        )

    source = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType([source.schema[0], T.StructField("fingerprint", T.StringType())])
    return map_batches(source, run, schema)


COMPARED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _ranges(docs: DataFrame, parts: int) -> tuple[list[int], list]:
    """Lower borders of id ranges of like size, and the largest id in each (or None)."""
    borders = range_borders(docs, "doc_id", parts)
    largest = dict(
        docs.where(F.col("doc_id").isNotNull())
        .groupBy(range_of(F.col("doc_id"), borders).alias("part"))
        .agg(F.max("doc_id"))
        .collect()
    )
    return borders, [largest.get(i) for i in range(len(borders) + 1)]


def compare_with_edits(docs: DataFrame, words: Lexicon, id_col="doc_id", text_col="text"):
    """Fingerprints of every text, of its edited form, and of its successor.

    The successor is the next row by falling id, for the last row the first.
    The edited form is the text with its second half replaced by as much of
    the start of its successor's text. The texts are dealt once, to ranges of
    ids; a range gets, besides its own rows, the one row that follows its last.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id")
    borders, largest = _ranges(ids, parts)
    filled = [i for i, top in enumerate(largest) if top is not None]
    missing = ids.where(F.col("doc_id").isNull()).limit(1).count()
    # Rows without an id follow all others, in the lowest range that has rows.
    lowest = filled[0] if filled else 0
    # The range whose last row the head of range i follows.
    above = {filled[n]: filled[n + 1] for n in range(len(filled) - 1)}
    if filled:
        above[filled[-1]] = lowest
    at = F.when(F.col("doc_id").isNull(), F.lit(lowest)).otherwise(range_of(F.col("doc_id"), borders))
    targets = F.map_from_arrays(
        F.array(*[F.lit(largest[i]).cast("long") for i in above]),
        F.array(*[F.lit(target) for target in above.values()]),
    )
    goes_to = F.try_element_at(targets, F.col("doc_id")) if above else F.lit(None).cast("int")
    own = rows.select(at.cast("int").alias("part"), F.lit(0).alias("extra"), "doc_id", "text")
    # Rows that share a largest id are all sent; the reader takes the first.
    copies = rows.where(goes_to.isNotNull()).select(
        goes_to.alias("part"), F.lit(1).alias("extra"), "doc_id", "text"
    )
    if not filled and missing:
        copies = own.withColumn("extra", F.lit(1))
    dealt = (
        own.unionByName(copies)
        .repartitionById(max(1, len(borders) + 1), "part")
        .sortWithinPartitions("extra", F.col("doc_id").desc_nulls_last(), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Printer(words)
        before = None
        for batch in batches:
            out = []
            for extra, doc_id, text in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), texts_of(batch.column(3))
            ):
                if before is None:
                    if extra:
                        break
                    before = (doc_id, text, printer.signature(text))
                    continue
                head = (doc_id, text, printer.signature(text))
                out.append(_compared(before, head, printer))
                before = head
                if extra:
                    before = None
                    break
            else:
                yield _batch(out)
                continue
            yield _batch(out)
            break

    return dealt.mapInArrow(run, COMPARED)


def _compared(own, following, printer: Printer) -> tuple:
    doc_id, text, mark = own
    half = len(text) // 2
    edited = text[: len(text) - half] + following[1][:half]
    changed = printer.signature(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
        as_text(mark),
        as_text(changed),
        likeness(mark, changed),
        likeness(mark, following[2]),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(COMPARED)
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)], names=COMPARED.names
    )
