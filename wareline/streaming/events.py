"""Product events as a stream into the published catalog."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wareline.operators.events import parse_events, rejected_events, valid_events
from wareline.session import written
from wareline.sources.files import number_rows, stream_event_lines
from wareline.sources.store import REJECTED_SCHEMA, CatalogStore, Descriptor


class RejectedEvents(ValueError):
    """Raised in fail-fast mode; the batch is not published."""


def apply_lines(
    store: CatalogStore,
    lines: DataFrame,
    batch_id: str,
    fail_fast: bool = False,
    stream: str = "events",
) -> Descriptor:
    """Validate, quarantine, resolve and publish one batch of JSON lines.

    ``lines`` has ``value`` and either ``ord`` or file positions. Rejected lines
    are published with the version, so a replay leaves them as they were.
    """
    if done := store.applied(stream, batch_id):
        return done
    if "ord" not in lines.columns:
        lines = number_rows(lines, "ord")
    parsed = written(parse_events(lines), "parsed")
    rejected = rejected_events(parsed)
    if fail_fast and not rejected.isEmpty():
        raise RejectedEvents("The batch holds invalid events.")
    kept = rejected.select(*[F.col(f.name).cast(f.dataType) for f in REJECTED_SCHEMA.fields])
    return store.apply_events(valid_events(parsed), batch_id, stream, kept)


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps for its stream across restarts."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return json.loads(row.value)["id"]


def start_event_stream(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    fail_fast: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply every micro-batch of ``lines`` in turn.

    The checkpoint remembers the source position and the stream's id, the
    catalog the batches of each stream: a batch that is replayed after a crash
    is recognised, and several streams may feed one catalog.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stream = stream_identity(spark, checkpoint)
        apply_lines(CatalogStore(spark, root), batch, str(epoch), fail_fast, stream)

    return (
        lines.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_file_stream(
    spark: SparkSession, path: str, root: str, checkpoint: str, **options
) -> StreamingQuery:
    """The same over JSON-lines files that arrive in a directory."""
    return start_event_stream(
        stream_event_lines(spark, path), root, checkpoint, **options
    )


def outcomes(store: CatalogStore) -> DataFrame:
    """What became of every event up to the published version, which is ``v``."""
    return store.log("outcomes", store.current())


def rejected_lines(store: CatalogStore) -> DataFrame:
    """The lines that were refused up to the published version, with reasons."""
    return store.log("rejected", store.current())
