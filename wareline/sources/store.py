"""The published catalog: Parquet parts, announced by one manifest per version.

Every attempt to make a version writes its tables to folders of its own. A
manifest, put in place last and at once, names the parts of the version: the
state tables, the log parts that it adds, and the batch that it applied. What no
manifest names does not exist, so the leavings of a crashed attempt are never
read, whatever version is published next.

A version number is given once. Of two writers that want the same one, the
slower starts again from the version of the faster. The manifests together are
the ledger of applied batches, by stream: a batch that comes again, at once or
after others, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wareline.operators.catalog import public_snapshot
from wareline.operators.cleaning import ORD, guard_batch
from wareline.operators.events import CatalogState, feed_page, resolve_events
from wareline.operators.merge import batch_changes, merge_batch, verify_batch
from wareline.schema import (
    CHANGE_SCHEMA,
    INVENTORY_SCHEMA,
    PRODUCT_SCHEMA,
    RECEIPT_SCHEMA,
    VERSION_SCHEMA,
    empty_table,
)


@dataclass(frozen=True)
class Descriptor:
    """One version: what it applied and which parts form it. Empty: no part.

    Its changes have the ids after ``first_change`` up to ``revision``.
    """

    version: int = 0
    stream: str = ""
    batch: str = ""
    first_change: int = 0
    revision: int = 0
    products: str = ""
    inventory: str = ""
    versions: str = ""
    receipts: str = ""
    changes: str = ""
    outcomes: str = ""
    rejected: str = ""


_MANIFEST = T.StructType(
    [
        T.StructField(name, T.StringType() if value == "" else T.LongType())
        for name, value in asdict(Descriptor()).items()
    ]
)
_STATE = {
    "products": PRODUCT_SCHEMA,
    "inventory": INVENTORY_SCHEMA,
    "versions": VERSION_SCHEMA,
}
OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("original_status", T.StringType()),
        T.StructField("revision", T.LongType()),
        T.StructField("v", T.LongType()),
    ]
)
REJECTED_SCHEMA = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
_LOGS = {
    "receipts": RECEIPT_SCHEMA,
    "changes": CHANGE_SCHEMA,
    "outcomes": OUTCOME_SCHEMA,
    "rejected": REJECTED_SCHEMA,
}
#: The stream of batch loads.
LOADS = "loads"


class CatalogStore:
    """One catalog below ``root``, for any number of readers and writers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str, part: str) -> str:
        return f"{self.root}/{name}/{part}"

    def manifests(self) -> DataFrame:
        """One small row per published version."""
        try:
            return self.spark.read.schema(_MANIFEST).json(f"{self.root}/published")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_table(self.spark, _MANIFEST)

    def follow(self) -> DataFrame:
        """The manifests as a stream: each version once, when it is published."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/published")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        return (
            self.spark.readStream.schema(_MANIFEST)
            .option("maxFileAge", "36500d")
            .json(f"{self.root}/published")
        )

    def current(self) -> Descriptor:
        """The newest published version."""
        row = self.manifests().orderBy(F.desc("version")).first()
        return Descriptor(**row.asDict()) if row else Descriptor()

    def applied(self, stream: str, batch: str) -> Descriptor | None:
        """The version that applied a batch of a stream."""
        found = self.manifests().where((F.col("stream") == stream) & (F.col("batch") == batch))
        row = found.orderBy("version").first()
        return Descriptor(**row.asDict()) if row else None

    def table(self, name: str, at: Descriptor) -> DataFrame:
        """A state table as of a published version."""
        part = getattr(at, name)
        if not part:
            return empty_table(self.spark, _STATE[name])
        return self.spark.read.schema(_STATE[name]).parquet(self._path(name, part))

    def parts(self, name: str, manifests: DataFrame) -> DataFrame:
        """The parts of a log that some manifests name, and no others."""
        named = manifests.where(F.col(name) != "").select("version", name)
        paths = [self._path(name, row[name]) for row in named.orderBy("version").collect()]
        if not paths:
            return empty_table(self.spark, _LOGS[name])
        return self.spark.read.schema(_LOGS[name]).parquet(*paths)

    def log(self, name: str, at: Descriptor) -> DataFrame:
        """An append-only table up to a published version."""
        return self.parts(name, self.manifests().where(F.col("version") <= at.version))

    def state(self, at: Descriptor | None = None) -> CatalogState:
        at = at or self.current()
        return CatalogState(
            *[self.table(name, at) for name in _STATE],
            self.log("receipts", at),
            at.revision,
        )

    def changes(self) -> DataFrame:
        """The whole change feed."""
        return self.log("changes", self.current())

    def changes_between(self, after: int, upto: int) -> DataFrame:
        """Changes with ids above ``after`` up to ``upto``.

        Ids have no gaps and each version knows its own, so only the parts that
        hold some of these are opened.
        """
        wanted = (F.col("revision") > after) & (F.col("first_change") < upto)
        return self.parts("changes", self.manifests().where(wanted)).where(
            (F.col("change_id") > after) & (F.col("change_id") <= upto)
        )

    def page(self, after: int = 0, limit: int = 100) -> DataFrame:
        """Ordered page of the published feed behind a cursor."""
        return feed_page(self.changes_between(after, after + limit), after, limit)

    def snapshot(self) -> tuple[int, DataFrame]:
        """Revision and public rows of the same published version."""
        at = self.current()
        rows = public_snapshot(self.table("products", at), self.table("inventory", at))
        return at.revision, rows

    def product_count(self) -> int:
        return self.table("products", self.current()).count()

    def _write(self, name: str, rows: DataFrame) -> str:
        """A new part of a table; its name is not used again."""
        part = uuid.uuid4().hex
        rows.write.parquet(self._path(name, part))
        return part

    def _publish(self, descriptor: Descriptor) -> bool:
        """Put the manifest in place unless its version has one already.

        It is written aside and renamed, so it is there whole or not at all.
        """
        text = json.dumps(asdict(descriptor)) + "\n"
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        settings = self.spark._jsc.hadoopConfiguration()
        folder = hadoop.Path(f"{self.root}/published")
        files = folder.getFileSystem(settings)
        files.mkdirs(folder)
        folder = files.makeQualified(folder)
        aside = hadoop.Path(folder, f".{uuid.uuid4().hex}")
        target = hadoop.Path(folder, f"{descriptor.version:012d}.json")
        out = files.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        keep = self.spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
        keep[0] = hadoop.Options.Rename.NONE
        try:
            hadoop.FileContext.getFileContext(files.getUri(), settings).rename(aside, target, keep)
        except Py4JJavaError as error:
            files.delete(aside, False)
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            return False
        return True

    def _advance(
        self, stream: str, batch: str, build: Callable[[Descriptor], Descriptor]
    ) -> Descriptor:
        """Publish what ``build`` makes of the newest version, once per batch."""
        while True:
            at = self.current()
            if done := self.applied(stream, batch):
                return done
            made = replace(
                build(at), version=at.version + 1, stream=stream, batch=batch, first_change=at.revision
            )
            if self._publish(made):
                return made

    def load_batch(self, batch: DataFrame, batch_id: str, ord_col: str = ORD) -> int:
        """Upsert a prepared batch and return its verified rows.

        The merged table is read back and compared before it is announced.
        """
        rows = guard_batch(batch)

        def build(at: Descriptor) -> Descriptor:
            target = self.table("products", at)
            products = self._write("products", merge_batch(target, batch))
            made = replace(at, products=products, receipts="", outcomes="", rejected="")
            verify_batch(self.table("products", made), batch, rows)
            changes = batch_changes(target, batch, at.revision, ord_col)
            return replace(
                made, revision=at.revision + rows, changes=self._write("changes", changes)
            )

        self._advance(LOADS, batch_id, build)
        return rows

    def apply_events(
        self,
        events: DataFrame,
        batch_id: str,
        stream: str = "events",
        rejected: DataFrame | None = None,
    ) -> Descriptor:
        """Resolve valid events against the published state and publish.

        ``rejected`` lines are kept with the version. A batch that the stream
        has had applied before changes nothing.
        """

        def build(at: Descriptor) -> Descriptor:
            result = resolve_events(events, self.state(at))
            rows = {name: getattr(result, name) for name in ("changes", "receipts", *_STATE)}
            rows["outcomes"] = result.outcomes.withColumn("v", F.lit(at.version + 1))
            if rejected is not None:
                rows["rejected"] = rejected
            # Independent tables of one version: their jobs may overlap.
            with ThreadPoolExecutor(len(rows)) as pool:
                parts = dict(zip(rows, pool.map(lambda name: self._write(name, rows[name]), rows)))
            fed = self.spark.read.schema(CHANGE_SCHEMA).parquet(self._path("changes", parts["changes"]))
            return Descriptor(revision=at.revision + fed.count(), **parts)

        return self._advance(stream, batch_id, build)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash of all rows."""
    row_hash = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("fingerprint"),
    )


def copy_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Copy to a new place and verify; an existing place is refused."""
    df.write.mode("errorifexists").parquet(path)
    copied = df.sparkSession.read.schema(df.schema).parquet(path)
    if fingerprint(copied).first() != fingerprint(df).first():
        raise ValueError("The copy does not match its source.")
    return copied
