"""From raw text rows to one clean row per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wareline.functions import numeric as N, text as X
from wareline.schema import PRODUCT_COLUMNS, USER_COLUMNS, require_columns

ORD = "_ord"


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names without surrounding space, in lower case."""
    return df.toDF(*[name.strip().lower() for name in df.columns])


def trim_text(df: DataFrame) -> DataFrame:
    """Strip every text column."""
    return df.withColumns(
        {
            f.name: X.strip(F.col(f.name))
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)
        }
    )


def distinct_rows(df: DataFrame, ord_col: str = ORD) -> DataFrame:
    """Drop whole-row copies, keeping the earliest ordinal of each."""
    columns = [c for c in df.columns if c != ord_col]
    return df.groupBy(*columns).agg(F.min(ord_col).alias(ord_col))


def require_identity(df: DataFrame) -> DataFrame:
    """Rows need a product id and a name; blank counts as missing."""
    names = [c for c in ("product_id", "product_name") if c in df.columns]
    return df.withColumns(
        {name: X.blank_to_null(F.col(name)) for name in names}
    ).dropna(subset=names)


def within(value: Column, low: float, high: float | None = None) -> Column:
    """Keep a value inside its possible range, else NULL."""
    possible = value >= low if high is None else value.between(low, high)
    return F.when(possible, value)


def parse_values(df: DataFrame) -> DataFrame:
    """Read the numeric columns that are present."""
    rules = {
        "discounted_price": within(N.clean_currency(F.col("discounted_price")), 0),
        "actual_price": within(N.clean_currency(F.col("actual_price")), 0),
        "discount_percentage": within(
            N.clean_percentage(F.col("discount_percentage")), 0, 100
        ),
        "rating": within(N.parse_number(F.col("rating")), 0, 5),
        "rating_count": within(N.clean_count(F.col("rating_count")), 0),
    }
    return df.withColumns({k: v for k, v in rules.items() if k in df.columns})


def clean_products(df: DataFrame, ord_col: str = ORD) -> DataFrame:
    """The whole cleaning step.

    Copies are dropped after trimming but before numbers are read, and while
    the user columns are still there: rows that differ only in spelling or
    only in the user survive here and meet in ``prepare_unique``.
    """
    rows = distinct_rows(trim_text(normalize_names(df)), ord_col)
    return parse_values(require_identity(rows)).drop(*USER_COLUMNS)


def prepare_unique(df: DataFrame, ord_col: str = ORD) -> DataFrame:
    """One row per product: most ratings first, then the earliest source row.

    An aggregate rather than a window, so copies of one product meet in the
    map-side combine instead of in one task.
    """
    require_columns(df)
    rest = PRODUCT_COLUMNS[1:]
    preference = F.struct(
        F.col("rating_count").isNull(), -F.col("rating_count"), F.col(ord_col)
    )
    best = df.groupBy("product_id").agg(
        F.min_by(F.struct(*rest, ord_col), preference).alias("best")
    )
    return best.select(
        "product_id", *[F.col(f"best.{c}").alias(c) for c in [*rest, ord_col]]
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop on an empty frame. Runs a job that reads at most one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def guard_batch(batch: DataFrame) -> int:
    """Refuse an empty batch, blank identities and repeated ids.

    Returns the number of rows; runs one aggregate.
    """
    require_columns(batch)

    def blank(name):
        return F.count_if(F.coalesce(X.strip(F.col(name)), F.lit("")) == "")

    facts = batch.agg(
        F.count("*").alias("rows"),
        blank("product_id").alias("product_id"),
        blank("product_name").alias("product_name"),
        F.count_distinct(X.strip(F.col("product_id"))).alias("ids"),
    ).first()
    if not facts["rows"]:
        raise ValueError("Cannot load an empty batch.")
    for name in ("product_id", "product_name"):
        if facts[name]:
            raise ValueError(f"Missing or blank {name}.")
    if facts["ids"] != facts["rows"]:
        raise ValueError("Duplicate product IDs in prepared batch.")
    return facts["rows"]
