"""Versioned product events: validation, resolution, state and feed.

Every function is a pure DataFrame function. The batch job and the stream
call the same ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wareline.functions import text as X
from wareline.functions.numeric import parse_number
from wareline.operators.ordered import before, lookup, running_total
from wareline.schema import (
    EVENT_SCHEMA,
    INVENTORY_SCHEMA,
    PAYLOAD_SCHEMA,
    PRODUCT_COLUMNS,
    PRODUCT_SCHEMA,
    RECEIPT_SCHEMA,
    VERSION_SCHEMA,
    empty_table,
)
from wareline.session import written

# The identifier pattern and the length limits of an event.
IDENTIFIER = r"^[A-Za-z0-9_-]+$"
ID_LENGTH = 100
TEXT_LENGTH = {"product_name": 2000, "category": 1000, "about_product": 10000}
NUMBER_LIMIT = {
    "discounted_price": None,
    "actual_price": None,
    "discount_percentage": 100,
    "rating": 5,
}
EVENT_FIELDS = [
    "event_id", "product_id", "version", "operation", "product", "stock_quantity",
]
# What follows the white space of JSON.
OBJECT_START = r"\A[ \t\r\n]*\{"
WHOLE = r"^(TINYINT|SMALLINT|INT|BIGINT)$"
NUMERIC = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


# The parser ignores what follows a complete value, so each line is parsed as
# the only element of an array, where anything behind it shows.
_ROOT, _BEHIND = "$[0]", "$[1]"


def _kind(path: str) -> Column:
    """Type name of a JSON value: NULL if absent, VOID for an explicit null."""
    return F.col("_kinds").getField(path)


def _value(path: str, kind: str) -> Column:
    return F.try_variant_get("_doc", f"{_ROOT}.{path}", kind)


def _is_whole_object() -> Column:
    """Whether the line is one JSON object; its type, spelt out, would cost more than all else."""
    root, behind = (F.try_variant_get("_doc", path, "variant") for path in (_ROOT, _BEHIND))
    return root.isNotNull() & F.col("value").rlike(OBJECT_START) & behind.isNull()


def _unset(path: str) -> Column:
    return _kind(path).isNull() | (_kind(path) == "VOID")


def _strict_int(path: str) -> Column:
    """A JSON integer that fits a long; text, fractions and booleans do not."""
    return F.when(_kind(path).rlike(WHOLE), _value(path, "bigint"))


def _lax_number(path: str) -> Column:
    """A finite JSON number, boolean, or text spelling a number."""
    kind = _kind(path)
    value = (
        F.when(kind.rlike(NUMERIC), _value(path, "double"))
        .when(kind == "BOOLEAN", _value(path, "boolean").cast("double"))
        .when(kind == "STRING", parse_number(_value(path, "string")))
    )
    return F.when(F.abs(value) < float("inf"), value)


def _text(path: str) -> Column:
    return F.when(_kind(path) == "STRING", X.strip(_value(path, "string")))


def _first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first broken rule, NULL when all hold."""
    return F.coalesce(
        *[
            F.when(F.coalesce(broken, F.lit(False)), F.lit(name))
            for name, broken in rules
        ],
        F.lit(None).cast("string"),
    )


def _extra_keys(keys: Column, allowed: list[str]) -> Column:
    return F.size(F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))) > 0


def parse_events(lines: DataFrame) -> DataFrame:
    """Validate JSON lines ``(ord, value)`` against the closed event schema.

    Adds a ``reason`` column: NULL for a valid event, otherwise the first
    broken rule. Blank lines are dropped.
    """
    fields = PAYLOAD_SCHEMA.fieldNames()
    paths = [*EVENT_FIELDS, *[f"product.{name}" for name in fields]]
    document = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]")))

    def kind_of(path, name):
        value = F.try_variant_get("_doc", path, "variant")
        return F.schema_of_variant(value).alias(name)

    raw = (
        lines.where(X.strip(F.col("value")) != "")
        .withColumn("_doc", document)
        .withColumns(
            {
                "_kinds": F.struct(
                    *[kind_of(f"{_ROOT}.{path}", path) for path in paths],
                ),
                "_whole": _is_whole_object(),
                "_keys": F.json_object_keys("value"),
                "_product_keys": F.json_object_keys(
                    F.get_json_object("value", "$.product")
                ),
            }
        )
    )
    typed = raw.withColumns(
        {
            "event_id": _text("event_id"),
            "product_id": _text("product_id"),
            "version": _strict_int("version"),
            "operation": F.when(
                _kind("operation") == "STRING", _value("operation", "string")
            ),
            "product": F.when(
                ~_unset("product"),
                F.struct(
                    *[
                        (
                            _strict_int
                            if name == "rating_count"
                            else _lax_number
                            if name in NUMBER_LIMIT
                            else _text
                        )(f"product.{name}").alias(name)
                        for name in fields
                    ]
                ),
            ),
            "inventory_provided": F.coalesce(
                F.array_contains("_keys", "stock_quantity"), F.lit(False)
            ),
            "stock_quantity": _strict_int("stock_quantity"),
            "_has_product": ~_unset("product"),
            "_has_stock": ~_unset("stock_quantity"),
        }
    )

    def bad_id(name):
        col = F.col(name)
        return (
            col.isNull() | ~F.length(col).between(1, ID_LENGTH) | ~col.rlike(IDENTIFIER)
        )

    is_upsert = F.col("operation") == "upsert"
    rules = [
        (
            "not a JSON object",
            ~F.col("_whole"),
        ),
        ("unknown field", _extra_keys(F.col("_keys"), EVENT_FIELDS)),
        ("event_id", bad_id("event_id")),
        ("product_id", bad_id("product_id")),
        ("version", F.col("version").isNull() | (F.col("version") <= 0)),
        (
            "operation",
            F.col("operation").isNull() | ~F.col("operation").isin("upsert", "delete"),
        ),
        (
            "stock_quantity",
            F.col("_has_stock")
            & (F.col("stock_quantity").isNull() | (F.col("stock_quantity") < 0)),
        ),
        (
            "product",
            F.col("_has_product") & ~_kind("product").startswith("OBJECT"),
        ),
        ("unknown product field", _extra_keys(F.col("_product_keys"), fields)),
    ]
    for name in fields:
        value = F.col("product").getField(name)
        given = ~_unset(f"product.{name}")
        if name in TEXT_LENGTH:
            broken = given & (value.isNull() | (F.length(value) > TEXT_LENGTH[name]))
            if name == "product_name":
                broken |= F.col("_has_product") & (
                    value.isNull() | (F.length(value) == 0)
                )
        else:
            broken = given & (value.isNull() | (value < 0))
            if NUMBER_LIMIT.get(name):
                broken |= value > NUMBER_LIMIT[name]
        rules.append((f"product.{name}", broken))
    rules += [
        ("upsert without product", is_upsert & ~F.col("_has_product")),
        ("delete with values", ~is_upsert & (F.col("_has_product") | F.col("_has_stock"))),
        (
            "discounted_price_not_above_actual",
            is_upsert & (F.col("product.discounted_price") > F.col("product.actual_price")),
        ),
    ]
    return typed.withColumns(
        {"payload_hash": payload_hash(), "reason": _first_reason(rules)}
    ).select(*EVENT_SCHEMA.fieldNames(), "reason", "value")


def payload_hash() -> Column:
    """Identity of a request: typed values before redaction, plus whether
    stock was mentioned at all."""
    return F.sha2(
        F.to_json(
            F.struct(
                "event_id",
                "inventory_provided",
                "operation",
                "product",
                "product_id",
                "stock_quantity",
                "version",
            ),
            {"ignoreNullFields": "false"},
        ),
        256,
    )


def valid_events(parsed: DataFrame) -> DataFrame:
    """Accepted events with contact details masked before anything is stored."""
    product = F.col("product")
    masked = [
        F.when(product.getField(name).isNotNull(), X.redact(product.getField(name)))
        .otherwise(F.lit(None))
        .alias(name)
        if name in TEXT_LENGTH
        else product.getField(name).alias(name)
        for name in PAYLOAD_SCHEMA.fieldNames()
    ]
    return (
        parsed.where(F.col("reason").isNull())
        .withColumn("product", F.when(product.isNotNull(), F.struct(*masked)))
        .select(EVENT_SCHEMA.fieldNames())
    )


def rejected_events(parsed: DataFrame) -> DataFrame:
    """Quarantine of lines that break a rule. They leave no receipt."""
    return parsed.where(F.col("reason").isNotNull()).select("ord", "value", "reason")


@dataclass
class CatalogState:
    """The tables that change together, at one revision."""

    products: DataFrame
    inventory: DataFrame
    versions: DataFrame
    receipts: DataFrame
    revision: int = 0

    @staticmethod
    def empty(spark) -> "CatalogState":
        return CatalogState(
            *[
                empty_table(spark, schema)
                for schema in (
                    PRODUCT_SCHEMA, INVENTORY_SCHEMA, VERSION_SCHEMA, RECEIPT_SCHEMA,
                )
            ]
        )


@dataclass
class Resolution:
    """What a batch of events does to a state."""

    outcomes: DataFrame
    changes: DataFrame
    receipts: DataFrame
    products: DataFrame
    inventory: DataFrame
    versions: DataFrame


def _only(table: DataFrame, key: str, events: DataFrame) -> DataFrame:
    """Rows of a state table whose key occurs in the batch."""
    return table.join(events.select(key).distinct(), key, "left_semi")


def classify(events: DataFrame, state: CatalogState) -> DataFrame:
    """Add ``status``: applied, stale, duplicate or conflict.

    The first use of an event id decides; later uses only compare hashes.
    A new event is applied when its version exceeds the stored one and every
    earlier new one of the product. Stale versions never raise that maximum,
    so the maximum over all new events equals the one over applied events.
    """
    known = _only(state.receipts, "event_id", events).select(
        "event_id",
        F.struct(F.lit(-1).cast("bigint").alias("ord"), "payload_hash").alias("first"),
    )
    seen = before(
        events,
        ["event_id"],
        "ord",
        {"first": ("min", F.struct("ord", "payload_hash"))},
        seed=known,
    )
    is_new = F.col("first").isNull()
    stored = _only(state.versions, "product_id", events).select(
        "product_id", F.col("source_version").alias("newest")
    )
    versioned = before(
        seen,
        ["product_id"],
        "ord",
        {"newest": ("max", F.when(is_new, F.col("version")))},
        seed=stored,
    )
    repeat = F.when(
        F.col("first.payload_hash") == F.col("payload_hash"), "duplicate"
    ).otherwise("conflict")
    outcome = F.when(
        F.col("newest").isNull() | (F.col("version") > F.col("newest")), "applied"
    ).otherwise("stale")
    return versioned.withColumn("status", F.when(is_new, outcome).otherwise(repeat))


def row_changes(classified: DataFrame, state: CatalogState) -> DataFrame:
    """Add ``ops``: the row-level changes of each applied event, in order.

    Whether a product row exists is decided by the previous applied event,
    whether an inventory row exists by the last event that touched it.
    """
    applied = F.col("status") == "applied"
    upsert = F.col("operation") == "upsert"
    touches = applied & (~upsert | F.col("inventory_provided"))

    def at(flag):
        return F.struct(F.col("ord").alias("ord"), flag.alias("there"))

    there = F.struct(
        F.lit(-1).cast("bigint").alias("ord"), F.lit(True).alias("there")
    )
    none = F.lit(None).cast("struct<ord:bigint,there:boolean>")
    products = _only(state.products, "product_id", classified).select(
        "product_id", F.lit(True).alias("_p")
    )
    stocked = _only(state.inventory, "product_id", classified).select(
        "product_id", F.lit(True).alias("_i")
    )
    seed = products.join(stocked, "product_id", "full").select(
        "product_id",
        F.when(F.col("_p"), there).otherwise(none).alias("was_product"),
        F.when(F.col("_i"), there).otherwise(none).alias("was_stocked"),
    )
    history = before(
        classified,
        ["product_id"],
        "ord",
        {
            "was_product": ("max", F.when(applied, at(upsert))),
            "was_stocked": ("max", F.when(touches, at(upsert))),
        },
        seed=seed,
    )
    product = F.coalesce(F.col("was_product.there"), F.lit(False))
    stock = F.coalesce(F.col("was_stocked.there"), F.lit(False))
    on_upsert = F.array(
        F.when(product, "products_update").otherwise("products_insert"),
        F.when(
            F.col("inventory_provided"),
            F.when(stock, "inventory_update").otherwise("inventory_insert"),
        ),
    )
    # A delete cascades to the inventory row before the product row goes.
    on_delete = F.array(
        F.when(stock, F.lit("inventory_delete")),
        F.when(product, F.lit("products_delete")),
    )
    ops = F.array_compact(F.when(upsert, on_upsert).otherwise(on_delete))
    return history.withColumn(
        "ops", F.when(applied, ops).otherwise(F.array().cast("array<string>"))
    ).drop("was_product", "was_stocked")


def resolve_events(
    events: DataFrame, state: CatalogState, changed_at: Column | None = None
) -> Resolution:
    """Apply a batch of valid events, in ``ord`` order, to a state.

    ``events.ord`` must be unique within the batch and not negative. Every
    step reads its input more than once, so each is written to the shared
    folder once instead of being computed again by every reader.
    """
    classified = written(classify(events, state), "classified")
    numbered = written(
        running_total(
            row_changes(classified, state), "ord", F.size("ops"), "rows_before"
        ),
        "numbered",
    )
    return assemble(numbered, state, changed_at)


def assemble(
    numbered: DataFrame, state: CatalogState, changed_at: Column | None = None
) -> Resolution:
    """Read outcomes, feed and next state off the numbered events."""
    base = F.lit(state.revision).cast("bigint")
    stamp = changed_at if changed_at is not None else F.current_timestamp()
    is_new = F.col("status").isin("applied", "stale")
    new = numbered.where(is_new)
    applied = numbered.where(F.col("status") == "applied")

    receipts = new.select(
        "event_id",
        "payload_hash",
        "product_id",
        F.col("version").alias("source_version"),
        F.col("status").alias("outcome"),
    )
    originals = _only(state.receipts, "event_id", numbered).select(
        "event_id", "outcome"
    ).unionByName(receipts.select("event_id", "outcome"))
    outcomes = lookup(numbered, originals, ["event_id"], "ord").select(
        "ord",
        "event_id",
        "status",
        F.when(F.col("status") == "duplicate", F.col("outcome")).alias(
            "original_status"
        ),
        F.when(is_new, base + F.col("rows_before") + F.size("ops")).alias("revision"),
    )
    changes = applied.select(
        "product_id", "rows_before", F.posexplode("ops").alias("pos", "operation")
    ).select(
        (base + F.col("rows_before") + F.col("pos") + 1).alias("change_id"),
        "product_id",
        "operation",
        stamp.alias("changed_at"),
    )

    latest = applied.groupBy("product_id").agg(
        F.max_by(F.struct("operation", "product"), "ord").alias("last"),
        F.max("version").alias("source_version"),
        F.max_by(
            F.struct("operation", "stock_quantity"),
            F.when(
                (F.col("operation") == "delete") | F.col("inventory_provided"),
                F.col("ord"),
            ),
        ).alias("touch"),
    )
    payload = PAYLOAD_SCHEMA.fieldNames()
    upserted = latest.where(F.col("last.operation") == "upsert").select(
        "product_id",
        *[
            (
                F.col(f"last.product.{f.name}")
                if f.name in payload
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in PRODUCT_SCHEMA.fields
            if f.name != "product_id"
        ],
    )
    products = _replace(state.products, latest, upserted.select(PRODUCT_COLUMNS))
    restocked = latest.where(F.col("touch.operation") == "upsert").select(
        "product_id", F.col("touch.stock_quantity").alias("stock_quantity")
    )
    inventory = _replace(
        state.inventory, latest.where(F.col("touch").isNotNull()), restocked
    )
    versions = _replace(
        state.versions, latest, latest.select("product_id", "source_version")
    )
    return Resolution(outcomes, changes, receipts, products, inventory, versions)


def _replace(table: DataFrame, touched: DataFrame, rows: DataFrame) -> DataFrame:
    """Copy-on-write: untouched rows of ``table`` plus the new rows."""
    kept = table.join(touched.select("product_id"), "product_id", "left_anti")
    return kept.select(rows.columns).unionByName(rows)


def feed_page(changes: DataFrame, after: int = 0, limit: int = 100) -> DataFrame:
    """Ordered page of the change feed behind a cursor."""
    if after < 0 or not 1 <= limit <= 500:
        raise ValueError("Invalid change-feed cursor or limit.")
    return changes.where(F.col("change_id") > after).orderBy("change_id").limit(limit)


def next_cursor(page: DataFrame, after: int = 0) -> DataFrame:
    """The cursor a reader stores after a page."""
    return page.agg(
        F.coalesce(F.max("change_id"), F.lit(after).cast("bigint")).alias("next_after")
    )
