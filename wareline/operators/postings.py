"""Lexical search over an inverted index that is a table.

Documents are weighed as in ``features``: term counts times smoothed idf, rows of
length one, with every term of the corpus and no term list in memory. The index
is two tables in one folder:

* ``entries``: one row per term and document with the count of the term, sorted by
  term in runs of up to ``RUN_POSTINGS``. ``bucket``, a hash of the term, is the folder, so a search reads the buckets
  of its terms only. The first row of a term spells it; a row per document names it;
* ``blocks``: the block of each document, its place there and the length of its
  weights. A block holds up to ``BLOCK_DOCS`` documents of like numbers of terms,
  so of like weights, and is the same for all terms: a frequent term is spread over
  all blocks, none is a hot key.

A term crosses the network once: each task packs the sorted terms of many rows, and
where they occur, in one row a cell, a cell being a hash of the term. That exchange
brings the rows of a term together, which counts and numbers it, and they are written
as they lie there. Weights are not stored, as a count and a length give them.

A search first bounds the weight of its terms in each block by their largest count
there over the shortest length. A block whose bound for a query lies below the
threshold holds no hit and is left there. The entries of the asked terms are gathered
by block, once for all queries that ask for the block, and summed there; of the sums,
those below the threshold go no further.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import NGram
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from wareline.functions import text as X
from wareline.operators.features import _TERMS, _WORDS, add_terms, add_words, spread
from wareline.session import scratch_path, written

BLOCK_DOCS = 256
#: Postings a bucket is made for.
BUCKET_POSTINGS = 1 << 23
#: Rows whose terms are counted at once in a task.
COUNT_ROWS = 256
# A bound is summed in another order than a score.
SLACK = 1e-9
#: Characters of text that make one posting, roughly; it sizes buckets only.
POSTING_CHARS = 5
#: Files of a bucket.
BUCKET_FILES = 4
#: Words that are counted and packed together in a task, beyond those of one block.
CHUNK_WORDS = 1 << 21
#: Postings that are put in order together.
RUN_POSTINGS = 1 << 22
#: Asked terms whose queries meet a block together.
SHARE_TERMS = 1 << 14
DOC_COLUMNS = (("product_id", "string"), ("level", "int"), ("repeated", "boolean"))
#: Rows that leave a task in one Arrow batch.
OUT_ROWS = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)
_CODEC = pa.Codec("zstd", compression_level=3)
PACKED = (
    "_cell int, block bigint, numbers array<bigint>, words binary, places binary, "
    "product_id {kind}, at int, size int"
)
TABLES = {
    "entries": "term_id bigint, term string, df bigint, block bigint, at int, tf int, "
    "product_id string, size int, bucket int",
    "blocks": "product_id string, block bigint, at int, level int, unit double, repeated boolean",
    "documents": "product_id string",
}
COUNTS = "{id} {kind}, term string, tf int, size int, first boolean"


def term_counts(df: DataFrame, id_col: str) -> DataFrame:
    """One row per row of ``df`` and distinct term, without an exchange.

    ``size`` is the number of distinct terms of the row; ``first`` marks one of
    its rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, COUNT_ROWS):
                part = batch.slice(start, COUNT_ROWS)
                lists = part.column(1)
                flat = lists.flatten()
                if not len(flat):
                    continue
                encoded = flat.dictionary_encode()
                lengths = np.asarray(lists.value_lengths().fill_null(0))
                rows = np.repeat(np.arange(part.num_rows), lengths)
                width = len(encoded.dictionary)
                codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                pairs, counts = np.unique(rows * width + codes, return_counts=True)
                rows, codes = pairs // width, pairs % width
                sizes = np.bincount(rows, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        encoded.dictionary.take(pa.array(codes)),
                        pa.array(counts.astype(np.int32)),
                        pa.array(sizes[rows].astype(np.int32)),
                        pa.array(np.concatenate([[True], rows[1:] != rows[:-1]])),
                    ],
                    names=[id_col, "term", "tf", "size", "first"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, _TERMS).mapInArrow(count, COUNTS.format(id=id_col, kind=kind))


def corpus_terms(df: DataFrame, text: Column, stop_words=()) -> DataFrame:
    """The distinct terms of a text column."""
    worded = add_terms(spread(df.select(text.alias("_text"))), F.col("_text"), stop_words)
    # The outer form: the plain one adds a filter that cuts every text again.
    found = worded.select(F.explode_outer(_TERMS).alias("term")).where(F.col("term").isNotNull())
    return found.distinct()


def smoothed_idf(documents: int, frequency: Column) -> Column:
    return F.log(F.lit(1.0 + documents) / (1 + frequency)) + 1


def _unit(rows: str, weight: str) -> Column:
    """Length of the weights in an array of structs."""
    squares = F.transform(rows, lambda row: row[weight] * row[weight])
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


@contextmanager
def open_files(spark: SparkSession, number: int) -> Iterator[None]:
    """A task that writes to no more than ``number`` folders does not sort its rows for it."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(number))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{path}/{name}")


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every task."""
    ends = np.asarray(pc.cumulative_sum(pc.binary_length(words)), dtype=np.int64)
    letters = np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), dtype=np.uint8)
    starts = ends - np.diff(ends, prepend=0)
    place = np.arange(len(letters)) - np.repeat(starts, ends - starts)
    powers = np.cumprod(np.full(place.max() + 1, MIX, dtype=np.uint64))
    return _mixed(np.add.reduceat((letters + np.uint64(1)) * powers[place], starts))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * MIX
    return hashes ^ (hashes >> np.uint64(29))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _packed(*parts: np.ndarray) -> bytes:
    """Numbers by their bytes, the lowest of all first; letters as they are."""
    planes = [
        part if part.dtype == np.uint8 else part.astype("<u4").view(np.uint8).reshape(-1, 4).T
        for part in parts
    ]
    return _CODEC.compress(b"".join(plane.tobytes() for plane in planes), asbytes=True)


def _unpacked(blob, *sizes: int) -> list[np.ndarray]:
    """As many numbers as ``sizes`` tells; a negative size stands for letters."""
    lengths = [-size if size < 0 else 4 * size for size in sizes]
    raw = np.frombuffer(_CODEC.decompress(blob, sum(lengths)), dtype=np.uint8)
    parts = np.split(raw, np.cumsum(lengths)[:-1])
    return [
        part if size < 0 else np.ascontiguousarray(part.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
        for part, size in zip(parts, sizes)
    ]


def _counted(lists: pa.Array):
    """Of the rows' words and pairs: left and right word of each distinct term, in the
    order of the terms, its first place in the rest, and row and count of its uses.

    A word is a term without a right word, which is -1. No letter of a word comes
    before a space, so words in their order put the terms in theirs.
    """
    encoded = lists.flatten().dictionary_encode()
    order = pc.sort_indices(encoded.dictionary)
    words = encoded.dictionary.take(order).cast(pa.string())
    rank = np.empty(len(words), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(words))
    left = rank[encoded.indices.to_numpy()]
    rows = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    whole, width, count = rows[:-1] == rows[1:], len(words) + 1, len(lists)
    terms = np.concatenate([left * width, (left[:-1] * width + left[1:] + 1)[whole]])
    rows = np.concatenate([rows, rows[:-1][whole]])
    names = None
    if width * width * count >= 1 << 63:
        names, terms = np.unique(terms, return_inverse=True)
    pairs, uses = np.unique(terms * count + rows, return_counts=True)
    terms, rows = np.divmod(pairs, count)
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    distinct = terms[starts] if names is None else names[terms[starts]]
    left, right = np.divmod(distinct, width)
    return words, left, right - 1, starts, rows, uses


def _by_cell(lists: pa.Array, cells: int):
    """Cell and packed terms of the rows, then the number of terms of each row."""
    words, left, right, starts, rows, uses = _counted(lists)
    hashes = np.append(_word_hashes(words), np.uint64(0))
    cell = (_mixed(hashes[left] + hashes[right] * MIX) % np.uint64(cells)).astype(np.int64)
    held = np.diff(np.append(starts, len(rows)))
    order = np.argsort(cell, kind="stable")
    cell, left, right, starts, held = (x[order] for x in (cell, left, right, starts, held))
    first = words.take(pa.array(left))
    second = words.take(pa.array(right, mask=right < 0))
    terms = pc.coalesce(pc.binary_join_element_wise(first, second, " "), first)
    lengths, (ends, text) = np.asarray(pc.binary_length(terms)), terms.buffers()[1:]
    ends = np.frombuffer(ends, dtype=np.int32)[terms.offset :]
    text = np.frombuffer(text or b"", dtype=np.uint8)
    # Rows by their distance from the one before; the first of a term as it is.
    places = _ranges(starts, held)
    at, tf, begin = rows[places], uses[places], np.cumsum(held) - held
    apart = np.diff(at, prepend=0)
    apart[begin] = at[begin]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
    packed = []
    for low, high in zip(cuts, cuts[1:]):
        letters = text[ends[low] : ends[high]]
        span = slice(begin[low], begin[high - 1] + held[high - 1])
        packed.append(
            (
                int(cell[low]),
                [high - low, span.stop - span.start, len(letters)],
                _packed(lengths[low:high], letters, held[low:high]),
                _packed(apart[span], tf[span]),
            )
        )
    return packed, np.bincount(rows, minlength=len(lists))


def packed_terms(df: DataFrame, id_col: str, cells: int) -> DataFrame:
    """The terms of many rows in one row a cell, and one row that names each row.

    Blocks are formed from the rows of an Arrow batch, ordered by their number of
    words; the rows packed together lie in blocks from ``block`` on. Rows without
    words have no block.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            held = np.asarray(batch.column(1).value_lengths().fill_null(0))
            order = np.argsort(held, kind="stable")
            order = order[held[order] > 0]
            blocks = np.arange(0, len(order), block_docs)
            sizes = np.add.reduceat(held[order], blocks, dtype=np.int64) if len(order) else blocks
            share = np.cumsum(sizes) // CHUNK_WORDS
            for chunk in np.split(blocks, np.flatnonzero(np.diff(share)) + 1) if len(blocks) else []:
                part = batch.take(pa.array(order[chunk[0] : chunk[-1] + block_docs]))
                packed, terms = _by_cell(part.column(1), cells)
                cell, numbers, words, places = zip(*packed)
                rows, count = np.arange(part.num_rows), part.num_rows
                blobs, ids = len(packed), part.column(0)
                here = block + rows // block_docs
                columns = [
                    pa.array(np.concatenate([cell, here % cells]).astype(np.int32)),
                    pa.array(np.concatenate([np.full(blobs, block), here])),
                    pa.array([*numbers, *[None] * count], pa.list_(pa.int64())),
                    pa.array([*words, *[None] * count], pa.binary()),
                    pa.array([*places, *[None] * count], pa.binary()),
                    pa.concat_arrays([pa.nulls(blobs, ids.type), ids]),
                    pa.concat_arrays([pa.nulls(blobs, pa.int32()), pa.array((rows % block_docs).astype(np.int32))]),
                    pa.concat_arrays([pa.nulls(blobs, pa.int32()), pa.array(terms.astype(np.int32))]),
                ]
                names = [field.split()[0] for field in PACKED.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                block += len(chunk)

    block_docs = BLOCK_DOCS
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, _WORDS).mapInArrow(cut, PACKED.format(kind=kind))


def _cell_entries(packed: list[tuple], first_id: int, block_docs: int) -> Iterator[tuple]:
    """Columns of the entries of one cell, up to ``RUN_POSTINGS`` a time in their order."""
    spelt, counts = [], []
    for _, (terms, _, letters), words, _ in packed:
        lengths, text, held = _unpacked(words, terms, -letters, terms)
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        spelt.append(pa.StringArray.from_buffers(terms, pa.py_buffer(ends), pa.py_buffer(text)))
        counts.append(held)
    encoded = pa.concat_arrays(spelt).dictionary_encode()
    order = pc.sort_indices(encoded.dictionary)
    terms = encoded.dictionary.take(order)
    rank = np.empty(len(terms), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(terms))
    ranks = rank[encoded.indices.to_numpy()]
    df = np.bincount(ranks, weights=np.concatenate(counts), minlength=len(terms)).astype(np.int64)
    ranks = np.split(ranks, np.cumsum([len(x) for x in counts])[:-1])
    told, share = np.zeros(len(terms), dtype=bool), np.cumsum([n[1] for _, n, _, _ in packed]) // RUN_POSTINGS
    for run in np.split(np.arange(len(packed)), np.flatnonzero(np.diff(share)) + 1):
        found = []
        for i in run:
            block, (_, postings, _), _, places = packed[i]
            apart, tf = _unpacked(places, postings, postings)
            begin = np.cumsum(counts[i]) - counts[i]
            row = np.cumsum(apart)
            row -= np.repeat(row[begin] - apart[begin], counts[i])
            found.append((np.repeat(ranks[i], counts[i]), block + row // block_docs, row % block_docs, tf))
        term, block, at, tf = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(term, kind="stable")
        term, block, at, tf = term[order], block[order], at[order], tf[order]
        fresh = np.concatenate([[True], term[1:] != term[:-1]]) & ~told[term]
        told[term] = True
        yield first_id + term, terms.take(pa.array(term, mask=~fresh)), df[term], block, at, tf


def gathered_entries(packed: DataFrame, buckets: int) -> DataFrame:
    """``entries`` from packed terms whose cells each lie together in one task."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_id, waiting, last = TaskContext.get().partitionId() << 40, [], None

        def entries() -> Iterator[pa.RecordBatch]:
            nonlocal first_id
            more = 0
            for term_id, *rest in _cell_entries(waiting, first_id, block_docs):
                more = max(more, int(term_id[-1]) + 1)
                for low in range(0, len(term_id), OUT_ROWS):
                    ids, term, df, block, at, tf = (x[low : low + OUT_ROWS] for x in (term_id, *rest))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids), term, pa.array(df), pa.array(block),
                            pa.array(at.astype(np.int32)), pa.array(tf.astype(np.int32)),
                            pa.nulls(len(ids), pa.string()), pa.nulls(len(ids), pa.int32()),
                            pa.array(np.full(len(ids), last % buckets, dtype=np.int32)),
                        ],
                        names=names,
                    )
            first_id = more
            waiting.clear()

        for batch in batches:
            named = batch.filter(batch.column("size").is_valid())
            count = named.num_rows
            if count:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(count, pa.int64()), pa.nulls(count, pa.string()), pa.nulls(count, pa.int64()),
                        named.column("block"), named.column("at"), pa.nulls(count, pa.int32()),
                        named.column("product_id"), named.column("size"),
                        pa.array((np.asarray(named.column("_cell")) % buckets).astype(np.int32)),
                    ],
                    names=names,
                )
            rest = batch.filter(batch.column("size").is_null())
            columns = [rest.column(name).to_pylist() for name in ("_cell", "block", "numbers", "words", "places")]
            for cell, *run in zip(*columns):
                if waiting and cell != last:
                    yield from entries()
                last = cell
                waiting.append(tuple(run))
        if waiting:
            yield from entries()

    block_docs, names = BLOCK_DOCS, [field.split()[0] for field in TABLES["entries"].split(", ")]
    return packed.mapInArrow(gather, TABLES["entries"])


@dataclass
class PostingsIndex:
    """An index in ``path`` over ``documents`` documents, in ``buckets`` folders."""

    spark: SparkSession
    path: str
    documents: int
    buckets: int
    stop_words: tuple[str, ...]

    def table(self, name: str) -> DataFrame:
        """``terms``, ``postings`` and ``largest`` are read off the entries."""
        if name not in ("terms", "postings", "largest"):
            return _read(self.spark, self.path, name)
        entries = _read(self.spark, self.path, "entries")
        if name == "terms":
            return entries.where("term IS NOT NULL").select("term", "df", "term_id", "bucket")
        weight = F.col("tf") * smoothed_idf(self.documents, F.col("df"))
        postings = entries.where("size IS NULL").select(
            "bucket", "term_id", "block", "at", weight.alias("w")
        )
        if name == "postings":
            return postings
        most = postings.groupBy("bucket", "term_id", "block").agg(F.max("w").alias("w"))
        return most.join(_shortest(self), "block").select("bucket", "term_id", "block", _bound("w").alias("most"))


def _shortest(index: PostingsIndex) -> DataFrame:
    """Per block the shortest length, and whether a document of it lies elsewhere too."""
    return index.table("blocks").groupBy("block").agg(
        F.min("unit").alias("least"), F.max("repeated").alias("repeated")
    )


def _bound(weights: str) -> Column:
    """A block that holds rows of a repeated id is never left out."""
    return F.when(F.col("repeated"), float("inf")).otherwise(F.col(weights) / F.col("least"))


def fit_postings(
    docs: DataFrame, text: Column, stop_words=tuple(X.STOP_WORDS), path: str | None = None
) -> PostingsIndex:
    """Index ``text`` of the documents by ``product_id``, which must be unique."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "postings")
    sizes = docs.agg(F.count("*"), F.coalesce(F.sum(F.length(text).cast("bigint")), F.lit(0))).first()
    documents, buckets = sizes[0], 1 + sizes[1] // POSTING_CHARS // BUCKET_POSTINGS
    cells = buckets * BUCKET_FILES
    worded = add_words(spread(docs.select("product_id", text.alias("_text"))), F.col("_text"), stop_words)
    dealt = (
        packed_terms(worded.withColumn("product_id", F.col("product_id").cast("string")), "product_id", cells)
        .repartitionById(cells, F.col("_cell"))
        .sortWithinPartitions("_cell", "block")
    )
    # Sorted numbers and terms take a fraction of their plain size.
    packing = {"compression": "zstd", "parquet.writer.version": "v2"}
    with open_files(spark, 1):
        gathered_entries(dealt, buckets).write.partitionBy("bucket").options(**packing).parquet(f"{path}/entries")
    index = PostingsIndex(spark, path, documents, buckets, tuple(stop_words))
    squares = index.table("postings").groupBy("block", "at").agg(F.sum(F.col("w") * F.col("w")).alias("square"))
    named = _read(spark, path, "entries").where("size IS NOT NULL").select(
        "product_id", "block", "at", F.floor(F.log2("size")).cast("int").alias("level")
    )
    # Rows of one id and like size count as one document.
    placed = written(named.join(squares, ["block", "at"]), "squares")
    whole = placed.groupBy(F.col("product_id").alias("_id"), F.col("level").alias("_level")).agg(
        F.sqrt(F.sum("square")).alias("unit"), (F.count("*") > 1).alias("repeated")
    )
    same = F.col("product_id").eqNullSafe(F.col("_id")) & (F.col("level") == F.col("_level"))
    placed.join(whole, same).select(
        "product_id", "block", "at", "level", "unit", "repeated"
    ).write.parquet(f"{path}/blocks")
    return index


def query_weights(index: PostingsIndex, queries: DataFrame) -> DataFrame:
    """``query_id``, ``bucket``, ``term_id`` and weight ``qw`` of the terms the index knows."""
    worded = add_terms(queries.select("query_id", "query"), F.col("query"), index.stop_words)
    # Written, so that the join is planned from its real size.
    counts = written(term_counts(worded, "query_id"), "query_terms")
    known = counts.join(index.table("terms"), "term")
    weighed = known.select(
        "query_id",
        "bucket",
        "term_id",
        (F.col("tf") * smoothed_idf(index.documents, F.col("df"))).alias("qw"),
    )
    rows = weighed.groupBy("query_id").agg(F.collect_list(F.struct("bucket", "term_id", "qw")).alias("row"))
    flat = rows.withColumn("unit", _unit("row", "qw")).select(
        "query_id", "unit", F.explode("row").alias("at")
    )
    return flat.select(
        "query_id", "at.bucket", "at.term_id", (F.col("at.qw") / F.col("unit")).alias("qw")
    )


def asked_postings(index: PostingsIndex, asked: DataFrame) -> DataFrame:
    """The postings of the terms that are asked for, written once."""
    wanted = written(asked.select("bucket", "term_id").distinct(), "asked_terms")
    return written(index.table("postings").join(wanted, ["bucket", "term_id"], "left_semi"), "met")


def likely_blocks(
    index: PostingsIndex, asked: DataFrame, threshold: float, met: DataFrame | None = None
) -> DataFrame:
    """(query, block) pairs that may hold a document at the threshold.

    ``met`` are the postings of the asked terms, where they have been gathered.
    """
    met = asked_postings(index, asked) if met is None else met
    largest = met.groupBy("bucket", "term_id", "block").agg(F.max("w").alias("w"))
    sums = (
        largest.join(asked, ["bucket", "term_id"])
        .groupBy("query_id", "block")
        .agg(F.sum(F.col("w") * F.col("qw")).alias("sum"))
    )
    bounds = sums.join(_shortest(index), "block").select("query_id", "block", _bound("sum").alias("bound"))
    return bounds.where(F.col("bound") >= threshold - SLACK)


def scores_at_least(
    index: PostingsIndex, asked: DataFrame, threshold: float, met: DataFrame | None = None
) -> DataFrame:
    """``query_id``, ``product_id`` and ``raw`` of every pair at the threshold."""
    met = asked_postings(index, asked) if met is None else met
    blocks = likely_blocks(index, asked, threshold, met).select("query_id", "block")
    # Written, so that the join is planned from its real size.
    wanted = written(asked.join(blocks, "query_id"), "wanted")
    shares = 1 + asked.count() // SHARE_TERMS
    nothing = {name: F.lit(None).cast(kind) for name, kind in (("term_id", "bigint"), *DOC_COLUMNS)}
    documents = index.table("blocks").withColumns({"term_id": nothing["term_id"], "w": F.col("unit")})
    columns = ["block", "term_id", "at", "w", *[name for name, _ in DOC_COLUMNS]]
    postings = met.withColumns({name: nothing[name] for name, _ in DOC_COLUMNS}).select(columns)
    held = postings.unionByName(documents.select(columns)).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    )
    asking = wanted.select("block", "query_id", "term_id", "qw").withColumn(
        "share", F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int")
    )
    kind = asked.schema["query_id"].dataType.simpleString()
    # A block meets its queries in one task: postings cross the network, pairs do not.
    hopeful = (
        asking.groupBy("block", "share")
        .cogroup(held.groupBy("block", "share"))
        .applyInArrow(_block_scorer(threshold), f"query_id {kind}, product_id string, level int, raw double")
    )
    scored = hopeful.groupBy("query_id", "product_id", "level").agg(F.sum("raw").alias("raw"))
    return scored.where(F.col("raw") >= threshold).select("query_id", "product_id", "raw")


def _block_scorer(threshold: float):
    """Score the documents of a block for the queries that ask for it.

    Rows that lie in this block alone and are no hit go no further.
    """

    def score(asking: pa.Table, held: pa.Table) -> pa.Table:
        documents = held.filter(pc.is_null(held["term_id"]))
        postings = held.filter(pc.is_valid(held["term_id"])).sort_by("term_id")
        terms, place, w = (postings[name].to_numpy() for name in ("term_id", "at", "w"))
        queries = asking["query_id"].combine_chunks().dictionary_encode()
        wanted = asking["term_id"].to_numpy()
        low = np.searchsorted(terms, wanted)
        sizes = np.searchsorted(terms, wanted, "right") - low
        met = _ranges(low, sizes)
        at = documents["at"].to_numpy()
        width = 1 + max(at, default=0)
        pairs = np.repeat(queries.indices.to_numpy().astype(np.int64), sizes) * width + place[met]
        parts = np.repeat(asking["qw"].to_numpy(), sizes) * w[met]
        sums = np.bincount(pairs, weights=parts, minlength=len(queries.dictionary) * width)
        row, unit, repeated = np.full(width, -1), np.full(width, np.nan), np.zeros(width, dtype=bool)
        row[at], unit[at] = np.arange(len(at)), documents["w"].to_numpy()
        repeated[at] = documents["repeated"].to_numpy()
        # Weights are positive, so a pair without a shared term has no sum.
        found = np.flatnonzero(sums > 0)
        query, at = np.divmod(found, width)
        raw = sums[found] / unit[at]
        kept = (row[at] >= 0) & (repeated[at] | (raw >= threshold))
        chosen = documents.take(pa.array(row[at][kept]))
        return pa.table(
            {
                "query_id": queries.dictionary.take(pa.array(query[kept])),
                "product_id": chosen["product_id"],
                "level": chosen["level"],
                "raw": pa.array(raw[kept]),
            }
        )

    return score


def scores_of(
    index: PostingsIndex, asked: DataFrame, pairs: DataFrame, met: DataFrame | None = None
) -> DataFrame:
    """``raw`` of the given distinct (query, document) pairs that share a term."""
    met = asked_postings(index, asked) if met is None else met
    placed = pairs.join(index.table("blocks"), "product_id").join(asked, "query_id")
    shared = placed.join(met, ["bucket", "term_id", "block", "at"])
    part = F.col("w") * F.col("qw") / F.col("unit")
    return shared.groupBy("query_id", "product_id").agg(F.sum(part).alias("raw"))


def _known_rows(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Ids of the rows that hold a term of ``terms``."""
    counts = term_counts(rows, "row_id").select("row_id", "term")
    return counts.join(terms.select("term"), "term", "left_semi").select("row_id").distinct()


def unknown_share(terms: DataFrame, names: DataFrame, name: str, stop_words=()) -> DataFrame:
    """Share of the rows of ``names`` without a single term of ``terms``.

    A row is known by one term, so the pairs of words, which are most of all
    terms, are looked up only for rows without a known word.
    """
    text = F.coalesce(F.col(name), F.lit("")).alias("_text")
    pair = F.contains("term", F.lit(" "))
    single = F.filter(_TERMS, lambda term: ~F.contains(term, F.lit(" "))).alias(_TERMS)
    # Written once, so the numbers stay.
    keyed = written(
        add_terms(names.select(F.monotonically_increasing_id().alias("row_id"), text), F.col("_text"), stop_words)
        .select("row_id", single),
        "names",
    )
    known = written(_known_rows(keyed, terms.where(~pair)), "known")
    left = keyed.join(known, "row_id", "left_anti").where(F.size(_TERMS) > 1)
    if not left.isEmpty():
        paired = NGram(n=2, inputCol=_TERMS, outputCol="_pairs").transform(left)
        paired = paired.select("row_id", F.col("_pairs").alias(_TERMS))
        known = known.unionByName(_known_rows(paired, terms.where(pair)))
    marked = keyed.select("row_id").join(known.withColumn("unknown", F.lit(0.0)), "row_id", "left")
    return marked.agg(F.avg(F.coalesce("unknown", F.lit(1.0))).alias("unknown_vocabulary_fraction"))
