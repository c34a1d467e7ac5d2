"""Queries over product events, the change feed and the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wareline.operators import events as E
from wareline.plans import adapters as D
from wareline.plans.registry import query, with_ctes

EV = D.EVENTS_SQL
STATE_SQL = (
    "SELECT product_id, product_name, category, discounted_price FROM catalog_rows"
)


def _resolved(spark, sf) -> E.Resolution:
    return E.resolve_events(D.product_events(spark, sf), E.CatalogState.empty(spark))


def _catalog(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "discounted_price")


@query("event_outcomes", with_ctes(EV, select="SELECT * FROM outcomes"))
def _(spark, sf):
    """Applied, stale, duplicate or conflict, with the revision reached."""
    return _resolved(spark, sf).outcomes


@query(
    "event_receipts",
    with_ctes(
        EV,
        select="SELECT event_id, product_id, version AS source_version, "
        "status AS outcome FROM decided",
    ),
)
def _(spark, sf):
    """One receipt per new event."""
    return _resolved(spark, sf).receipts.drop("payload_hash")


@query("catalog_after_events", with_ctes(EV, select=STATE_SQL))
def _(spark, sf):
    """Products left after all events."""
    return _catalog(_resolved(spark, sf).products)


@query("inventory_after_events", with_ctes(EV, select="SELECT * FROM stock_rows"))
def _(spark, sf):
    """Inventory left after all events."""
    return _resolved(spark, sf).inventory


@query(
    "versions_after_events",
    with_ctes(
        EV,
        select="SELECT product_id, max(version) AS source_version FROM applied GROUP BY ALL",
    ),
)
def _(spark, sf):
    """Newest version per product; deleted products keep theirs."""
    return _resolved(spark, sf).versions


@query("change_feed", with_ctes(EV, select="SELECT * FROM feed"))
def _(spark, sf):
    """Row-level changes in order."""
    return _resolved(spark, sf).changes.drop("changed_at")


@query(
    "feed_page",
    with_ctes(
        EV,
        select="SELECT * FROM feed WHERE change_id > 700 ORDER BY change_id LIMIT 500",
    ),
)
def _(spark, sf):
    """One page of the feed behind a cursor."""
    return E.feed_page(_resolved(spark, sf).changes, 700, 500).drop("changed_at")


# Lines that break one rule each, by position; the rest are well formed.
LINES_SQL = """
faults AS (
  SELECT ord, CASE
    WHEN ord % 17 = 3 THEN 'unknown field'
    WHEN ord % 17 = 4 THEN 'version'
    WHEN ord % 17 = 5 THEN 'event_id'
    WHEN ord % 17 = 6 THEN 'not a JSON object'
    WHEN operation = 'delete' AND ord % 17 = 7 THEN 'delete with values'
    WHEN operation = 'delete' AND ord % 17 = 8 THEN 'upsert without product'
    WHEN operation = 'upsert' AND ord % 17 = 9 THEN 'unknown product field'
    WHEN operation = 'upsert' AND ord % 17 = 10 THEN 'product.rating'
    WHEN operation = 'upsert' AND ord % 17 = 11 THEN 'product.rating_count'
    WHEN operation = 'upsert' AND ord % 17 = 12 THEN 'discounted_price_not_above_actual'
    WHEN ord % 17 = 13 THEN 'operation' END AS reason
  FROM ev)"""


def event_lines(events: DataFrame) -> DataFrame:
    """Typed events as JSON lines; omitted stock stays omitted."""
    with_stock = F.to_json(
        F.struct("event_id", "product_id", "version", "operation", "product",
                 "stock_quantity"),
        {"ignoreNullFields": "false"},
    )
    without = F.to_json(
        F.struct("event_id", "product_id", "version", "operation", "product"),
        {"ignoreNullFields": "false"},
    )
    return events.select(
        "ord",
        "operation",
        F.when(F.col("inventory_provided"), with_stock).otherwise(without).alias(
            "value"
        ),
    )


def faulty_lines(events: DataFrame) -> DataFrame:
    """The same lines with one fault of each kind at fixed positions."""
    at, upsert, line = F.col("ord") % 17, F.col("operation") == "upsert", F.col("value")
    tail = F.expr("substring(value, 2)")

    def swap(pattern, by):
        return F.regexp_replace(line, pattern, by)

    faulty = (
        F.when(at == 3, F.concat(F.lit('{"extra":1,'), tail))
        .when(at == 4, swap('"version":([0-9]+)', '"version":"$1"'))
        .when(at == 5, swap('"event_id":"e', '"event_id":"e/'))
        .when(at == 6, F.concat(line, F.lit("}")))
        .when(
            (at == 7) & ~upsert,
            swap('"product":null', '"product":{"product_name":"x"}'),
        )
        .when((at == 8) & ~upsert, swap('"delete"', '"upsert"'))
        .when((at == 9) & upsert, swap(r'"product":\{', '"product":{"colour":1,'))
        .when((at == 10) & upsert, swap('"rating":null', '"rating":5.5'))
        .when((at == 11) & upsert, swap('"rating_count":null', '"rating_count":2.0'))
        .when((at == 12) & upsert, swap('"actual_price":null', '"actual_price":0'))
        .when(at == 13, swap('"operation":"', '"operation":"x'))
    )
    return events.select("ord", F.coalesce(faulty, line).alias("value"))


@query(
    "event_validation",
    with_ctes(EV, LINES_SQL, select="SELECT ord, reason FROM faults"),
)
def _(spark, sf):
    """First broken rule of every JSON line, NULL for an accepted one."""
    lines = faulty_lines(event_lines(D.product_events(spark, sf)))
    return E.parse_events(lines).select("ord", "reason")
