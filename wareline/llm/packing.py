"""Conflict-constrained best-fit packing.

Texts are packed into bins of ``capacity`` words. A bin never holds two pieces
of one source, nor of one duplicate cluster: it carries a bitmap of each, and
its residual decides its place in an order. An item goes to the bin with the
least residual that holds it; where that bin conflicts, the search goes on to
its successors until the tightest compatible bin is found, and a new bin is
opened if there is none. Items come by falling size, then by id.

A text longer than a bin is cut into whole pieces and a rest. Items are dealt
by a hash of id and piece into shards of about ``SHARD_ROWS`` items, each
packed by itself; a source or cluster that holds a third of all rows is so
spread over all shards, and no task holds more than one shard. Rows that are
equal in all that packing sees are counted first and numbered as copies.

Null and empty texts have size 0 and are packed like all others. A null source
or cluster is one of its own that conflicts with itself (``null_conflicts``) or
with nothing. Null ids are packed too. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

CAPACITY = 2048
SHARD_ROWS = 4096
WORDS = r"[^\x20\x09-\x0D]+"

PLACED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("copy", T.IntegerType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("at", T.LongType()),
    ]
)


class Bins:
    """The open bins of one shard, ordered by residual."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self._bits: tuple[dict, dict] = ({}, {})

    def _bit(self, kind: int, value) -> int:
        if value is None:
            return 0
        known = self._bits[kind]
        return 1 << known.setdefault(value, len(known))

    def place(self, size: int, source, cluster) -> tuple[int, int]:
        """(bin, offset in it) for the next item."""
        source_bit, cluster_bit = self._bit(0, source), self._bit(1, cluster)
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, number = self.order[at]
            if not (self.sources[number] & source_bit or self.clusters[number] & cluster_bit):
                del self.order[at]
                break
            at += 1
        else:
            residual, number = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[number] |= source_bit
        self.clusters[number] |= cluster_bit
        insort(self.order, (residual - size, number))
        return number, self.capacity - residual


def items(
    docs: DataFrame, cluster, capacity: int = CAPACITY, id_col="doc_id", text_col="text",
    source_col="source", null_conflicts: bool = False,
) -> DataFrame:
    """(doc_id, copy, piece, first_word, n_words, source, cluster), one row a piece."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    mark = F.coalesce if null_conflicts else (lambda column, _: column)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        words.alias("words"),
        mark(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        mark(cluster.cast("long"), F.lit(0)).alias("cluster"),
    )
    equal = rows.groupBy("doc_id", "words", "source", "cluster").agg(F.count("*").alias("n"))
    copies = equal.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)))
    last = F.greatest(F.expr(f"(words - 1) div {capacity}"), F.lit(0)).cast("int")
    pieces = copies.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    first = F.col("piece").cast("long") * capacity
    return pieces.select(
        "doc_id",
        "copy",
        "piece",
        first.alias("first_word"),
        F.least(F.col("words") - first, F.lit(capacity).cast("long")).alias("n_words"),
        "source",
        "cluster",
    )


def pack(pieces: DataFrame, rows: int, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS):
    """Place every piece; ``rows`` is about how many there are."""
    shards = max(1, -(-rows // shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(shards)).cast("int")
    spark = pieces.sparkSession
    parts = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bins = None, None
        for batch in batches:
            columns = batch.to_pydict()
            placed = []
            for number, size, source, cluster in zip(
                columns["shard"], columns["n_words"], columns["source"], columns["cluster"]
            ):
                if number != current:
                    current, bins = number, Bins(capacity)
                placed.append(bins.place(size, source, cluster))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in PLACED.names[:6]),
                    pa.array([n for n, _ in placed], pa.int32()),
                    pa.array([at for _, at in placed], pa.int64()),
                ],
                names=PLACED.names,
            )

    return (
        pieces.select(*PLACED.names[:5], shard.alias("shard"), "source", "cluster")
        .repartition(parts, "shard")
        .sortWithinPartitions("shard", F.col("n_words").desc(), "doc_id", "copy", "piece")
        .mapInArrow(run, PLACED)
    )
