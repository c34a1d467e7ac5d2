"""The published change feed as a stream.

The stream follows the manifests of a catalog, which come into place whole, once
per version. Each micro-batch opens only the log parts that its versions name, so
a follower never reads a version twice nor the leavings of a crashed attempt. The
checkpoint keeps which versions it has seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wareline.schema import CHANGE_SCHEMA, empty_table
from wareline.sources.store import CatalogStore


def follow_feed(
    store: CatalogStore,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    after: int = 0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Call ``handle(changes, epoch)`` for the changes of newly published versions.

    ``changes`` have ids above ``after`` and lie above all of earlier epochs if
    every version was published after the one before it was seen; within an
    epoch ``change_id`` gives the order. After a crash an epoch may be handled
    again, with the same versions. Versions without changes make empty epochs.
    """

    def apply(manifests: DataFrame, epoch: int) -> None:
        # Clock differences of writers may bring versions out of order in one epoch.
        changes = CatalogStore(manifests.sparkSession, store.root).parts("changes", manifests)
        handle(changes.where(F.col("change_id") > after), epoch)

    return (
        store.follow()
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def copy_feed(store: CatalogStore, target: str, checkpoint: str, after: int = 0, **options) -> StreamingQuery:
    """Keep a copy of the feed; an epoch that comes again replaces its own part."""

    def handle(changes: DataFrame, epoch: int) -> None:
        changes.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    return follow_feed(store, handle, checkpoint, after, **options)


def copied_feed(spark: SparkSession, target: str) -> DataFrame:
    """The changes copied so far; none before the first epoch."""
    try:
        return spark.read.schema(CHANGE_SCHEMA).parquet(target).select(CHANGE_SCHEMA.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, CHANGE_SCHEMA)
