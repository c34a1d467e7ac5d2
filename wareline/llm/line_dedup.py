"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in
lower case; keys under ``LEAST_CHARS`` code points are never dropped. A key
found in ``least_docs`` documents or more is blocked: all its lines go, except
in the largest id that holds it.

``LineStore`` keeps, in a folder that all executors reach:

* ``refs``: signed line counts per (key, document), one folder per change.
  Inserting documents adds rows, deleting them adds the same rows with the
  sign turned, so what a document holds is the sum of its rows, exactly;
* ``blocked``: each blocked key with its document count and owner;
* ``filters``: one cuckoo filter per shard of the keys, over blocked keys.

A change recounts the keys it touches and no others. Keys that come to be
blocked enter their shard's filter, keys that cease to be are deleted from it,
which a cuckoo filter allows. To clean documents, their distinct keys meet the
filter of their shard; the few that pass are looked up in ``blocked``, so a
filter may err only towards a lookup and the result is exact. Keys are dealt by
hash and counted per document first; no key, however frequent, owns a task, and
a shard holds about ``SHARD_KEYS`` blocked keys: their number doubles when
filters fill up. Versions are folders named in ``manifest``; readers of an
older version are not disturbed, and a change that fails leaves nothing valid.

Keys stand as 128-bit digests. Null and empty texts are one empty line. Rows
without an id are neither counted nor changed. Rows that repeat an id count as
one document, and all of them lose the blocked lines. Other columns than
``doc_id`` and the text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wareline.session import scratch_path, written

LEAST_CHARS, LEAST_DOCS = 20, 3
#: Blocked keys a shard is made for.
SHARD_KEYS = 1 << 16
SLOTS, MOST_KICKS = 4, 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EDGES = " \t\n\x0b\x0c\r"
REFS = "digest binary, doc_id bigint, lines bigint"
BLOCKED = "digest binary, docs bigint, owner bigint"
FILTERS = "shard int, buckets binary, stash binary, keys bigint"


class CuckooFilter:
    """Sixteen-bit fingerprints in buckets of four, with a stash for the rest.

    A key of 64 bits may be in either of two buckets, of which each follows
    from the other and the fingerprint. Keys that find no place after
    ``MOST_KICKS`` moves lie in the stash as they are, so nothing is lost.
    """

    def __init__(self, buckets: np.ndarray, stash: np.ndarray | None = None, keys: int = 0):
        self.table, self.keys = buckets, keys
        self.stash = np.zeros(0, np.uint64) if stash is None else stash
        self._rng = np.random.default_rng(7)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        need = max(8, int(keys / (0.85 * SLOTS)) + 1)
        return cls(np.zeros((1 << (need - 1).bit_length(), SLOTS), np.uint16))

    @classmethod
    def read(cls, buckets: bytes, stash: bytes, keys: int) -> CuckooFilter:
        table = np.frombuffer(buckets, np.uint16).reshape(-1, SLOTS).copy()
        return cls(table, np.frombuffer(stash, np.uint64).copy(), keys)

    def written(self) -> tuple[bytes, bytes, int]:
        return self.table.tobytes(), self.stash.tobytes(), self.keys

    def _marks(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        marks = (keys >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1
        return marks, (keys & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, marks: np.ndarray) -> np.ndarray:
        jump = marks.astype(np.uint64) * np.uint64(0x5BD1E995C6A4A793)
        jump = (jump >> np.uint64(32)) & np.uint64(len(self.table) - 1)
        return bucket ^ jump.astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        marks, first = self._marks(keys)
        second = self._other(first, marks)
        found = (self.table[first] == marks[:, None]).any(axis=1)
        found |= (self.table[second] == marks[:, None]).any(axis=1)
        return found | np.isin(self._signs(marks, first), self.stash)

    def _signs(self, marks: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Mark and lesser bucket in one number: what the stash holds."""
        lesser = np.minimum(bucket, self._other(bucket, marks)).astype(np.uint64)
        return (marks.astype(np.uint64) << np.uint64(48)) | lesser

    def insert(self, keys: np.ndarray) -> None:
        """Add distinct keys that are not held; many move in one step."""
        marks, bucket = self._marks(keys)
        self.keys += len(keys)
        for _ in range(MOST_KICKS):
            for _ in range(2):
                left = self._settle(marks, bucket)
                marks, bucket = marks[left], bucket[left]
                bucket = self._other(bucket, marks)
            if not len(marks):
                return
            # One mark a bucket is thrown out at a time; the others wait.
            here, first = np.unique(bucket, return_index=True)
            slot = self._rng.integers(0, SLOTS, len(first))
            thrown = self.table[here, slot]
            self.table[here, slot] = marks[first]
            marks[first], bucket[first] = thrown, self._other(here, thrown)
        self.stash = np.concatenate([self.stash, self._signs(marks, bucket)])

    def _settle(self, marks: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Place marks in free slots of their buckets; tells which are left."""
        left = np.ones(len(marks), bool)
        if not len(marks):
            return left
        order = np.argsort(bucket, kind="stable")
        there = bucket[order]
        starts = np.flatnonzero(np.concatenate([[True], there[1:] != there[:-1]]))
        turn = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
        free = self.table[there] == 0
        placed, slot = np.nonzero(free & (np.cumsum(free, axis=1) - 1 == turn[:, None]))
        self.table[there[placed], slot] = marks[order[placed]]
        left[order[placed]] = False
        return left

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are held, one copy of the mark for each."""
        marks, first = self._marks(keys)
        second, signs = self._other(first, marks), self._signs(marks, first)
        self.keys -= len(keys)
        for mark, one, two, sign in zip(marks, first, second, signs):
            for bucket in (one, two):
                slots = np.flatnonzero(self.table[bucket] == mark)
                if len(slots):
                    self.table[bucket, slots[0]] = 0
                    break
            else:
                self.stash = np.delete(self.stash, np.flatnonzero(self.stash == sign)[:1])


def line_key(line: Column) -> Column:
    """What two lines must share to be the same."""
    return F.translate(F.btrim(line, F.lit(EDGES)), UPPER, LOWER)


def lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id``, a hash of the text, ``pos`` and ``digest`` of each line that may go."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    return cut.where(F.length(F.btrim("line", F.lit(EDGES))) >= LEAST_CHARS).select(
        "doc_id", "text_hash", "pos", F.unhex(F.md5(line_key(F.col("line")))).alias("digest")
    )


def _hash(digest: str = "digest") -> Column:
    return F.xxhash64(digest)


def _shard(hashed: Column, shards: int) -> Column:
    """Bits that neither the bucket nor the mark of a filter uses."""
    return F.pmod(F.shiftright(hashed, 32), F.lit(shards)).cast("int")


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


FILTER_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("buckets", pa.binary()), ("stash", pa.binary()), ("keys", pa.int64())]
)


def _filter_of(rows: pa.Table, shard_keys: int) -> CuckooFilter:
    if not rows.num_rows:
        return CuckooFilter.sized(shard_keys)
    row = rows.slice(0, 1).to_pylist()[0]
    return CuckooFilter.read(row["buckets"], row["stash"], row["keys"])


def changed_filters(
    changes: DataFrame, filters: DataFrame, shards: int, shard_keys: int = SHARD_KEYS
) -> DataFrame:
    """The filters after ``changes``: digests with ``enters`` true or false."""
    hashed = changes.select(_hash().alias("hash"), "enters")
    dealt = hashed.select(_shard(F.col("hash"), shards).alias("shard"), "hash", "enters")

    def change(keys: pa.Table, held: pa.Table) -> pa.Table:
        cuckoo = _filter_of(held, shard_keys)
        enters = keys.column("enters").to_numpy().astype(bool)
        hashes = _numbers(keys.column("hash"))
        cuckoo.delete(np.sort(hashes[~enters]))
        cuckoo.insert(np.sort(hashes[enters]))
        shard = (keys if keys.num_rows else held).column("shard")[0].as_py()
        return pa.Table.from_arrays(
            [pa.array([v], t) for v, t in zip((shard, *cuckoo.written()), FILTER_SCHEMA.types)],
            schema=FILTER_SCHEMA,
        )

    both = dealt.groupBy("shard").cogroup(filters.groupBy("shard"))
    return both.applyInArrow(change, FILTERS)


def passing(
    digests: DataFrame, filters: DataFrame, shards: int, slices: int
) -> DataFrame:
    """The distinct ``digests`` that the filter of their shard may hold.

    Each shard's keys come in ``slices`` groups, each with a copy of the filter.
    """
    hashed = digests.select("digest", _hash().alias("hash"))
    dealt = hashed.select(
        _shard(F.col("hash"), shards).alias("shard"),
        F.pmod("hash", F.lit(slices)).cast("int").alias("slice"),
        "hash",
        "digest",
    )
    copies = filters.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def probe(keys: pa.Table, held: pa.Table) -> pa.Table:
        if not (keys.num_rows and held.num_rows):
            return keys.select(["digest"]).slice(0, 0)
        hits = _filter_of(held, 0).holds(_numbers(keys.column("hash")))
        return keys.select(["digest"]).filter(pa.array(hits))

    both = dealt.groupBy("shard", "slice").cogroup(copies.groupBy("shard", "slice"))
    return both.applyInArrow(probe, "digest binary")


CLEANED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines at the given places, and how many they were."""
    for batch in batches:
        counts, dropped, kept = [], [], []
        for text, places in zip(batch.column(1).to_pylist(), batch.column(2)):
            found = (text or "").split("\n")
            gone = set(places.as_py() or ())
            counts.append(len(found))
            dropped.append(len(gone))
            kept.append("\n".join([x for i, x in enumerate(found) if i not in gone]) if gone else text or "")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()),
                pa.array(kept, pa.string()),
            ],
            names=CLEANED.names,
        )


MANIFEST = "version bigint, refs array<string>, blocked string, filters string, shards int"


@dataclass(frozen=True)
class LineStore:
    """One version of the store below ``path``; changes give the next version."""

    spark: SparkSession
    path: str
    version: int = 0
    refs: tuple[str, ...] = ()
    blocked: str | None = None
    filters: str | None = None
    shards: int = 1
    least_docs: int = LEAST_DOCS
    shard_keys: int = SHARD_KEYS

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None, **settings) -> LineStore:
        """The newest version below ``path``, or the one asked for."""
        found = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/*")
        if version is not None:
            found = found.where(F.col("version") == version)
        row = found.orderBy(F.desc("version")).first()
        if row is None:
            raise ValueError(f"No such version of a line store in {path}.")
        return cls(spark, path, row.version, tuple(row.refs), row.blocked, row.filters, row.shards, **settings)

    def _table(self, name: str | None, schema: str) -> DataFrame:
        if name is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def blocked_keys(self) -> DataFrame:
        return self._table(self.blocked, BLOCKED)

    def references(self) -> DataFrame:
        """Lines per key and document, as they now stand."""
        if not self.refs:
            return self._table(None, REFS)
        logged = self.spark.read.schema(REFS).parquet(*[f"{self.path}/{r}" for r in self.refs])
        held = logged.groupBy("digest", "doc_id").agg(F.sum("lines").alias("lines"))
        return held.where(F.col("lines") > 0)

    def insert(self, docs: DataFrame, text_col: str = "text") -> LineStore:
        """The store with the lines of ``docs`` counted too."""
        found = lines(docs, text_col).groupBy("digest", "doc_id")
        return self._changed(found.agg(F.count("*").alias("lines")))

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """The store without the documents whose ids stand in ``doc_ids``."""
        gone = doc_ids.select(F.col("doc_id").cast("long")).distinct()
        held = self.references().join(gone, "doc_id", "left_semi")
        return self._changed(held.select("digest", "doc_id", (-F.col("lines")).alias("lines")))

    def _put(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}/{scratch_path(self.spark, kind).rsplit('-', 1)[1]}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _changed(self, change: DataFrame) -> LineStore:
        log = self._put(change, "refs")
        delta, before = self._table(log, REFS), self.blocked_keys()
        after = replace(self, version=self.version + 1, refs=(*self.refs, log))
        touched, held = delta.select("digest").distinct(), delta
        if self.refs:
            held = after.references().join(touched, "digest", "left_semi")
        counted = held.groupBy("digest").agg(
            F.count("*").alias("docs"), F.max("doc_id").alias("owner")
        )
        now = written(counted.where(F.col("docs") >= self.least_docs), "blocked")
        blocked = now
        if self.blocked is not None:
            blocked = before.join(touched, "digest", "left_anti").unionByName(now)
        after = replace(after, blocked=self._put(blocked, "blocked"))
        shards, keys = self.shards, after.blocked_keys().count()
        while keys > shards * self.shard_keys:
            shards *= 2
        enters = now.join(before, "digest", "left_anti").select("digest", F.lit(True).alias("enters"))
        leaves = before.join(touched, "digest", "left_semi").join(now, "digest", "left_anti")
        if shards == self.shards and self.filters is not None:
            changes = enters.unionByName(leaves.select("digest", F.lit(False).alias("enters")))
            old = self._table(self.filters, FILTERS)
        else:
            changes = after.blocked_keys().select("digest", F.lit(True).alias("enters"))
            old = self._table(None, FILTERS)
        filters = changed_filters(changes, old, shards, self.shard_keys)
        after = replace(after, filters=self._put(filters, "filters"), shards=shards)
        row = (after.version, list(after.refs), after.blocked, after.filters, shards)
        manifest = self.spark.createDataFrame([row], MANIFEST).coalesce(1)
        manifest.write.mode("error").parquet(f"{self.path}/manifest/{after.version:09d}")
        return after

    def clean(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``doc_id``, ``n_lines``, ``n_dropped`` and the ``text`` that is left, per row."""
        found = written(lines(docs, text_col), "lines")
        digests = written(found.select("digest").distinct(), "digests")
        slices = 1 + digests.count() // (4 * self.shard_keys * self.shards)
        likely = passing(digests, self._table(self.filters, FILTERS), self.shards, slices)
        certain = written(
            self.blocked_keys().join(likely, "digest").select("digest", "owner"), "certain"
        )
        gone = (
            found.join(certain, "digest")
            .where(F.col("doc_id") != F.col("owner"))
            # Bounded by the lines of one text, however often it is repeated.
            .groupBy("doc_id", "text_hash")
            .agg(F.collect_set("pos").alias("places"))
        )
        rows = docs.select(
            F.col("doc_id").cast("long"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).withColumn("text_hash", F.xxhash64("text"))
        marked = rows.join(written(gone, "gone"), ["doc_id", "text_hash"], "left")
        return marked.select("doc_id", "text", "places").mapInArrow(_without, CLEANED)


def dedup(docs: DataFrame, text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """All documents cleaned by a store of their own lines."""
    spark = docs.sparkSession
    store = LineStore(spark, scratch_path(spark, "line-store"), least_docs=least_docs)
    return store.insert(docs, text_col).clean(docs, text_col)
