"""Table layouts shared by every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The product columns, in storage order.
PRODUCT_COLUMNS = [
    "product_id",
    "product_name",
    "category",
    "discounted_price",
    "actual_price",
    "discount_percentage",
    "rating",
    "rating_count",
    "about_product",
    "review_id",
    "review_title",
    "review_content",
    "img_link",
    "product_link",
]
NUMERIC_COLUMNS = [
    "discounted_price",
    "actual_price",
    "discount_percentage",
    "rating",
    "rating_count",
]
PUBLIC_COLUMNS = [
    "product_id",
    "product_name",
    "category",
    "discounted_price",
    "actual_price",
    "rating",
    "rating_count",
    "about_product",
    "stock_quantity",
]
EVIDENCE_COLUMNS = [
    "product_id",
    "product_name",
    "discounted_price",
    "rating",
    "stock_quantity",
    "about_product",
]
USER_COLUMNS = ["user_id", "user_name"]


def _type_of(name: str) -> T.DataType:
    if name == "rating_count":
        return T.LongType()
    return T.DoubleType() if name in NUMERIC_COLUMNS else T.StringType()


PRODUCT_SCHEMA = T.StructType(
    [T.StructField(name, _type_of(name)) for name in PRODUCT_COLUMNS]
)


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_STRING, _LONG = T.StringType(), T.LongType()
INVENTORY_SCHEMA = _table(product_id=_STRING, stock_quantity=_LONG)
VERSION_SCHEMA = _table(product_id=_STRING, source_version=_LONG)
RECEIPT_SCHEMA = _table(
    event_id=_STRING,
    payload_hash=_STRING,
    product_id=_STRING,
    source_version=_LONG,
    outcome=_STRING,
)
CHANGE_SCHEMA = _table(
    change_id=_LONG,
    product_id=_STRING,
    operation=_STRING,
    changed_at=T.TimestampType(),
)
PAYLOAD_SCHEMA = T.StructType([PRODUCT_SCHEMA[name] for name in PRODUCT_COLUMNS[1:9]])
EVENT_SCHEMA = _table(
    ord=_LONG,
    event_id=_STRING,
    product_id=_STRING,
    version=_LONG,
    operation=_STRING,
    product=PAYLOAD_SCHEMA,
    inventory_provided=T.BooleanType(),
    stock_quantity=_LONG,
    payload_hash=_STRING,
)


def missing_columns(df: DataFrame, names=PRODUCT_COLUMNS) -> list[str]:
    """Names that ``df`` lacks; looks at the schema only."""
    return sorted(set(names) - set(df.columns))


def require_columns(df: DataFrame, names=PRODUCT_COLUMNS) -> DataFrame:
    """Pass ``df`` on, or name what it lacks."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A relation the optimizer knows to be empty, so joins with it vanish."""
    return (
        spark.range(0)
        .where(F.lit(False))
        .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    )
