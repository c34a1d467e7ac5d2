"""Near-duplicates by b-bit MinHash.

A document is the set of its shingles of ``words`` lower-cased words. Equal
word sequences are one class, and only its smallest id goes on. ``BANDS``
bands of ``ROWS`` minima give candidates; the low ``BITS`` bits of all minima,
packed into longs, estimate their similarity by counting equal fields, with
the share of chance agreements taken off. Candidates whose estimate comes near
the limit are confirmed on the full sets.

No bucket is expanded into all its pairs. In a first round each document is
compared with one hub of every bucket it is in, and confirmed against the one
most like it; that joins large groups. Then all pairs that share a bucket but
not yet a component are estimated inside the join, each in the first band that
it shares. Those that pass are confirmed in rounds, the likeliest of every
document first and at last all that are still between two components. The
components are so those of all links among candidates. At the limit of 0.8 a
pair shares no band with a chance of 5e-8, and passes the estimate unless that
errs by four and a half deviations. In the second round a pair must also pass a
finer signature, the b-bit minima of one permutation cut into ``BINS`` bins; so
a large group of texts that are alike just below the limit leaves few pairs.

Rows come back one for one. Documents without words (null texts too) have no
shingles and are linked with nothing; with fewer words than a shingle the whole
sequence is one. Rows without an id are linked with nothing, have no component
and count as kept. Rows that repeat an id are one document: what links one of
them links all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql import types as T

from wareline.llm.common import map_batches, texts_of
from wareline.session import written

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BANDS, ROWS, BITS = 32, 4, 2
#: Minima in a signature; the bands take the first of them.
MINIMA = 512
LONGS = MINIMA * BITS // 64
#: How far below the limit an estimate may lie; its deviation there is 0.021.
SLACK = 0.095
#: Bins of the finer signature: two bits each, 0 for an empty bin, else the minimum modulo 3
#: plus 1. Four and a half deviations of its estimate at the limit are 0.051. Pairs that fill
#: fewer than ``FEW`` bins pass: there one collision would move the estimate too far.
BINS = 2048
FINE_SLACK = 0.051
FEW = 32
#: Candidates of a document confirmed in each round, likeliest first; then all.
ROUNDS = (1, 8)

_RANDOM = np.random.default_rng(41)
_FACTORS = (_RANDOM.integers(1, 1 << 62, MINIMA, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 62, MINIMA, dtype=np.uint64)

SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("class_a", T.LongType()),
        T.StructField("class_b", T.LongType()),
        T.StructField("buckets", T.ArrayType(T.LongType())),
        T.StructField("bits", T.ArrayType(T.LongType())),
        T.StructField("fine", T.ArrayType(T.LongType())),
    ]
)


def word_hashes(text: str) -> np.ndarray:
    words = WORD.findall(text.encode("utf-8", "replace").translate(LOWER))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a word sequence."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(words, n)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - size + 1 + i])
    return np.unique(total)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function, 32 bits each."""
    best = np.full(MINIMA, 1 << 32, np.uint64)
    for start in range(0, len(shingles), 1024):
        part = shingles[start : start + 1024]
        values = (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]) >> np.uint64(32)
        best = np.minimum(best, values.min(axis=1))
    return best


def _buckets(best: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in best[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _packed(best: np.ndarray) -> np.ndarray:
    """The low bits of the minima, side by side in longs."""
    low = (_mixed(best) & np.uint64((1 << BITS) - 1)).reshape(LONGS, -1)
    places = np.arange(low.shape[1], dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << places, axis=1).view(np.int64)


def _fine(shingles: np.ndarray) -> np.ndarray:
    """The least value of every bin of one permutation, two bits a bin."""
    values = np.sort(_mixed(shingles ^ _SHIFTS[0]))
    at = (values >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    codes = np.zeros(BINS, np.uint64)
    codes[at[first]] = _mixed(values[first]) % np.uint64(3) + np.uint64(1)
    places = np.arange(32, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(codes.reshape(-1, 32) << places, axis=1).view(np.int64)


def sketches(docs: DataFrame, words: int, id_col="doc_id", text_col="text") -> DataFrame:
    """One sketch a row; no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, a, b, buckets, bits, fine = [], [], [], [], [], []
        for text in texts_of(batch.column(1)):
            hashes = word_hashes(text)
            shingles = shingle_set(hashes, words)
            counts.append(len(shingles))
            digest = xxhash.xxh3_128_digest(hashes.tobytes())
            one, two = np.frombuffer(digest, np.int64)
            a.append(int(one))
            b.append(int(two))
            if len(shingles):
                best = minima(shingles)
                buckets.append(_buckets(best))
                bits.append(_packed(best))
                fine.append(_fine(shingles))
            else:
                buckets.append(None)
                bits.append(None)
                fine.append(None)
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(a, pa.int64()),
                pa.array(b, pa.int64()),
                pa.array(buckets, longs),
                pa.array(bits, longs),
                pa.array(fine, longs),
            ],
            names=SKETCH.names,
        )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col))
    return map_batches(source, run, SKETCH)


def estimate(left: Column, right: Column) -> Column:
    """Collision-corrected similarity from two packed signatures."""
    field = (1 << 64) // ((1 << BITS) - 1)  # the lowest bit of every field
    field = field - (1 << 64) if field >= 1 << 63 else field

    def unequal(i):
        x = left[i].bitwiseXOR(right[i])
        folded = reduce(
            lambda y, s: y.bitwiseOR(F.shiftrightunsigned(x, s)), range(1, BITS), x
        )
        return F.bit_count(folded.bitwiseAND(F.lit(field)))

    differing = reduce(lambda p, q: p + q, [unequal(i) for i in range(LONGS)])
    chance = 2.0**-BITS
    return ((1.0 - differing / float(MINIMA)) - chance) / (1.0 - chance)


def fine_estimate(left: Column, right: Column) -> Column:
    """Collision-corrected similarity from two finer signatures; 1 where few bins are filled."""
    mask = F.lit(0x5555555555555555)

    def filled(x):
        return x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(mask)

    def counted(x, y):
        """Bins of one long pair that are equal, filled in both, filled in any: 20 bits each."""
        both = filled(x).bitwiseAND(filled(y))
        equal = both.bitwiseAND(F.bitwise_not(filled(x.bitwiseXOR(y))))
        some = filled(x.bitwiseOR(y))
        one, two, three = (F.bit_count(v).cast("long") for v in (equal, both, some))
        return one + F.shiftleft(two, 20) + F.shiftleft(three, 40)

    def similarity(total):
        equal = total.bitwiseAND(F.lit((1 << 20) - 1))
        both = F.shiftright(total, 20).bitwiseAND(F.lit((1 << 20) - 1))
        some = F.shiftright(total, 40)
        matched = (equal - both / 3.0) * 1.5
        return F.when(some < FEW, 1.0).otherwise(matched / some)

    counts = F.zip_with(left, right, counted)
    return F.aggregate(counts, F.lit(0).cast("long"), lambda total, x: total + x, similarity)


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are alike enough."""
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))
    )
    texts = docs.join(wanted.distinct(), "doc_id")
    first = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("one")), "a")
    both = first.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("two")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] = ("", np.empty(0, np.uint64))
        for batch in batches:
            keep = []
            for one, two in zip(texts_of(batch.column(2)), texts_of(batch.column(3))):
                if two != last[0]:
                    last = (two, shingle_set(word_hashes(two), words))
                left, right = shingle_set(word_hashes(one), words), last[1]
                shared = len(np.intersect1d(left, right, assume_unique=True))
                union = len(left) + len(right) - shared
                keep.append(shared > 0 and 100 * shared >= percent * union)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(node, root): every linked node and the smallest node it reaches.

    Stars towards the larger and the smaller neighbours in turn. Each turn is
    written once, and counted while it is written. It was the last if every
    node has one neighbour below it and none of these has one itself: then all
    hang on the smallest node of their component.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        )
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        across = (
            large.join(least, "u")
            .where("v <> least")
            .select(F.col("v").alias("u"), F.col("least").alias("v"), F.lit(True).alias("moved"))
        )
        down = least.select("u", F.col("least").alias("v"), F.lit(False).alias("moved"))
        turned = across.unionByName(down).groupBy("u", "v").agg(F.max("moved").alias("moved"))
        seen = Observation()
        counted = F.sum(F.col("moved").cast("long")).alias("moved")
        edges = written(turned.observe(seen, counted), "links").select("u", "v")
        if not seen.get["moved"]:
            below = edges.select(F.col("u").alias("v"))
            if edges.join(below, "v", "left_semi").isEmpty():
                return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _likeliest(pairs: DataFrame, most: int) -> DataFrame:
    """For every document of ``pairs`` the ``most`` pairs with the best estimates.

    The rank is limited before the shuffle too, so no document's pairs gather.
    """
    ends = pairs.select("a", "b", "alike", F.explode(F.array("a", "b")).alias("end"))
    best = Window.partitionBy("end").orderBy(F.col("alike").desc(), "a", "b")
    ranked = ends.withColumn("at", F.row_number().over(best)).where(F.col("at") <= most)
    return ranked.select("a", "b").distinct()


def _between(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends lie in two components."""
    root_a = joined.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    root_b = joined.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    rooted = pairs.join(root_a, "a", "left").join(root_b, "b", "left")
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return rooted.where(apart).select("a", "b", "alike")


def components(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col="doc_id", text_col="text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    drawn = written(sketches(own, words), "sketches")
    able = drawn.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = written(
        able.groupBy("class_a", "class_b").agg(
            F.min("doc_id").alias("rep"),
            F.first("buckets").alias("buckets"),
            F.first("bits").alias("bits"),
            F.first("fine").alias("fine"),
        ),
        "classes",
    )
    limit = percent / 100.0 - SLACK
    members = classes.select(F.posexplode("buckets").alias("band", "bucket"), "rep")
    bits = classes.select("rep", "bits")
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    crowded = written(members.join(shared, "bucket"), "members")
    # The text that others were made from shares most buckets with most of them.
    weights = crowded.groupBy("rep").agg(F.sum("n").alias("weight"))
    hubs = (
        crowded.join(weights, "rep")
        .groupBy("bucket")
        .agg(F.max_by("rep", F.struct("weight", F.negative("rep"))).alias("hub"))
    )
    held = written(crowded.select("band", "bucket", "rep").join(hubs, "bucket"), "candidates")
    near = (
        held.where("rep <> hub")
        .select("rep", "hub")
        .distinct()
        .join(bits, "rep")
        .join(bits.select(F.col("rep").alias("hub"), F.col("bits").alias("other")), "hub")
        .withColumn("alike", estimate(F.col("bits"), F.col("other")))
        .where(F.col("alike") >= limit)
    )
    first = near.groupBy("rep").agg(F.max_by("hub", F.struct("alike", "hub")).alias("hub"))
    first = written(first.select(F.col("rep").alias("a"), F.col("hub").alias("b")), "pairs")
    # Rows that repeat an id join the classes of their texts.
    ids = able.select("doc_id", "class_a", "class_b").join(
        classes.select("class_a", "class_b", "rep"), ["class_a", "class_b"]
    )
    spans = ids.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    repeated = (
        spans.where("low <> high")
        .join(ids, "doc_id")
        .select(F.col("low").alias("a"), F.col("rep").alias("b"))
    )
    sure = written(confirmed(first, own, words, percent).unionByName(repeated), "confirmed")
    joined = connected(sure)

    rest = held.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "bucket", "rep", F.coalesce("root", "rep").alias("root")
    )
    mixed = (
        rest.groupBy("bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    known = classes.select("rep", "bits", "fine", "buckets")
    open_rows = written(
        rest.join(mixed, "bucket")
        .join(known, "rep")
        .select(
            "bucket", "rep", "root", "bits", "fine", F.expr("slice(buckets, 1, band)").alias("before")
        ),
        "open",
    )
    left, right = open_rows.alias("l"), open_rows.alias("r")
    alike = estimate(F.col("l.bits"), F.col("r.bits"))
    pairs = left.join(
        right,
        (F.col("l.bucket") == F.col("r.bucket"))
        & (F.col("l.root") < F.col("r.root"))
        & (alike >= limit)
        & ~F.arrays_overlap("l.before", "r.before")
        & (fine_estimate(F.col("l.fine"), F.col("r.fine")) >= percent / 100.0 - FINE_SLACK),
    ).select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b"), alike.alias("alike"))
    both_ways = first.unionByName(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = written(pairs.join(both_ways, ["a", "b"], "left_anti"), "pairs")
    for most in (*ROUNDS, None):
        if pairs.isEmpty():
            break
        chosen = pairs if most is None else _likeliest(pairs, most)
        chosen = written(chosen.select("a", "b"), "chosen")
        more = written(confirmed(chosen, own, words, percent), "confirmed")
        if not more.isEmpty():
            stars = joined.select(F.col("node").alias("a"), F.col("root").alias("b"))
            joined = connected(stars.unionByName(more))
        if most is not None:
            pairs = written(_between(pairs, joined).join(chosen, ["a", "b"], "left_anti"), "pairs")

    roots = classes.select("class_a", "class_b", "rep").join(
        joined.withColumnRenamed("node", "rep"), "rep", "left"
    ).select("class_a", "class_b", F.coalesce("root", "rep").alias("root"))
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("root"))
    component = F.coalesce(linked, F.col("doc_id"))
    return (
        drawn.select("doc_id", "n_shingles", "class_a", "class_b")
        .join(roots, ["class_a", "class_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def keep_one(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col="doc_id", text_col="text"
) -> DataFrame:
    """One document of every component, with all columns; one row of a repeated id."""
    gone = (
        components(docs, words, percent, id_col, text_col)
        .where("NOT kept")
        .select(F.col("doc_id").alias("__gone"))
        .distinct()
    )
    rest = docs.join(gone, docs[id_col].cast("long") == gone["__gone"], "left_anti")
    named = rest.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return named.unionByName(rest.where(F.col(id_col).isNull()))
