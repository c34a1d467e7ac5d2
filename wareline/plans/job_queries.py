"""Queries that run whole jobs below the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wareline.plans import adapters as D
from wareline.plans.batch import run_batch
from wareline.plans.event_queries import EV, STATE_SQL, event_lines
from wareline.plans.registry import query, with_ctes
from wareline.schema import PRODUCT_COLUMNS
from wareline.session import scratch_path, written
from wareline.sources.store import CatalogStore, copy_snapshot
from wareline.streaming.events import outcomes, start_event_stream
from wareline.streaming.feed import copied_feed, copy_feed
from wareline.streaming.gate import gated_outcomes, start_gate

DROPS = 3


def _in_drops(spark, sf, place: str):
    """Events arrive as JSON lines in a few drops; yields the stream of each.

    Each drop holds a range of ordinals and is one micro-batch, so the
    arrival order of the stream is the order of the events.
    """
    # Written once, not made again for every drop.
    lines = written(event_lines(D.product_events(spark, sf)).select("ord", "value"), "lines")
    low, high = lines.agg(F.min("ord"), F.max("ord")).first()
    width = (high - low) // DROPS + 1
    for drop in range(DROPS):
        start = low + drop * width
        part = lines.where(F.col("ord").between(start, start + width - 1))
        part.write.mode("append").parquet(f"{place}/in")
        yield spark.readStream.schema(lines.schema).parquet(f"{place}/in")


def _streamed(spark, sf) -> CatalogStore:
    """The catalog after the events have passed through a stream, drop by drop."""
    place = scratch_path(spark, "stream")
    for arriving in _in_drops(spark, sf, place):
        start_event_stream(
            arriving, f"{place}/catalog", f"{place}/checkpoint"
        ).awaitTermination()
    return CatalogStore(spark, f"{place}/catalog")


@query("stream_catalog", with_ctes(D.EVENTS_SQL, select=STATE_SQL))
def _(spark, sf):
    """Products left after the events came in as a stream."""
    store = _streamed(spark, sf)
    return store.table("products", store.current()).select(
        "product_id", "product_name", "category", "discounted_price"
    )


@query("stream_outcomes", with_ctes(EV, select="SELECT * FROM outcomes"))
def _(spark, sf):
    """What became of every event that came in as a stream."""
    return outcomes(_streamed(spark, sf)).drop("v")


@query(
    "gated_stream",
    with_ctes(EV, select="SELECT ord, event_id, status, original_status FROM outcomes"),
)
def _(spark, sf):
    """The same outcomes from a stream that keeps ids and versions as its state.

    The stream stops after every drop and starts again from its checkpoint.
    """
    place = scratch_path(spark, "gate")
    for arriving in _in_drops(spark, sf, place):
        start_gate(arriving, f"{place}/log", f"{place}/checkpoint").awaitTermination()
    return gated_outcomes(spark, f"{place}/log")


@query(
    "published_feed_page",
    with_ctes(
        EV,
        select="SELECT * FROM feed WHERE change_id > 700 ORDER BY change_id LIMIT 500",
    ),
)
def _(spark, sf):
    """A page of the published feed; parts of other versions stay unread."""
    return _streamed(spark, sf).page(700, 500).drop("changed_at")


@query("followed_feed", with_ctes(EV, select="SELECT * FROM feed"))
def _(spark, sf):
    """The feed as a follower has copied it, version by version."""
    store = _streamed(spark, sf)
    place = scratch_path(spark, "follower")
    copy_feed(store, f"{place}/feed", f"{place}/checkpoint").awaitTermination()
    return copied_feed(spark, f"{place}/feed").drop("changed_at")


# The gate refuses a batch with inverted prices, so those prices are absent.
SOUND_SQL = """
sound AS (
  SELECT * REPLACE (CASE WHEN substr(trim(product_id), 2)::BIGINT % 97 <> 0
    THEN discounted_price END AS discounted_price) FROM raw),
sound_rows AS (SELECT DISTINCT * EXCLUDE (_ord) FROM sound)"""


@query(
    "batch_summary",
    with_ctes(
        D.RAW_SQL,
        SOUND_SQL,
        select="""
SELECT (SELECT count(*) FROM sound) AS raw_rows, count(*) AS cleaned_rows,
  (SELECT count(*) FROM sound) - count(*) AS removed_rows,
  count(*) - count(DISTINCT product_id) AS duplicate_product_ids,
  count(DISTINCT product_id) AS batch_rows, count(DISTINCT product_id) AS database_rows
FROM sound_rows""",
    ),
)
def _(spark, sf):
    """Counts of a whole batch run, from CSV files to the published catalog."""
    place = scratch_path(spark, "batch")
    key = F.regexp_extract("product_id", "([0-9]+)", 1).cast("bigint")
    sound = D.raw_products(spark, sf).withColumn(
        "discounted_price", F.when(key % 97 != 0, F.col("discounted_price"))
    )
    sound.select(*PRODUCT_COLUMNS, "user_id", "user_name").write.option(
        "header", True
    ).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).option("escape", '"').csv(f"{place}/raw")
    summary = run_batch(spark, f"{place}/raw", place)
    names = [
        "raw_rows", "cleaned_rows", "removed_rows", "duplicate_product_ids",
        "batch_rows", "database_rows",
    ]
    return spark.range(1).select(
        *[F.lit(summary[name]).cast("bigint").alias(name) for name in names]
    )


@query(
    "snapshot_copy_check",
    with_ctes(D.PRODUCTS_SQL, select="SELECT count(*) AS row_count FROM products"),
)
def _(spark, sf):
    """Products copied to a new place and compared with their source."""
    place = scratch_path(spark, "copy")
    copied: DataFrame = copy_snapshot(D.products(spark, sf), place)
    return copied.agg(F.count("*").alias("row_count"))
