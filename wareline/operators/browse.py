"""Filtering, paging, figures and export for people looking at products."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from wareline.functions import numeric as N, text as X
from wareline.operators.analytics import product_analytics
from wareline.operators.selection import exact_median
from wareline.schema import NUMERIC_COLUMNS


def analytics_scan(products: DataFrame) -> DataFrame:
    """The analytics view in id order, with every number as a number."""
    view = product_analytics(products)
    text = {
        n: N.parse_number(F.col(n))
        for n in [*NUMERIC_COLUMNS, "savings_inr"]
        if isinstance(view.schema[n].dataType, T.StringType)
    }
    return view.withColumns(text).orderBy("product_id")


def filter_products(
    data: DataFrame,
    search: str = "",
    categories=None,
    min_rating: float = 0,
    include_unrated: bool = True,
) -> DataFrame:
    """Literal, caseless search in name or id, plus category and rating."""
    wanted = F.lower(F.lit(search))
    keep = F.lit(False)
    for name in ("product_name", "product_id"):
        keep |= F.coalesce(F.contains(F.lower(name), wanted), F.lit(False))
    if categories:
        keep &= F.col("main_category").isin(list(categories))
    rated = F.col("rating") >= min_rating
    if include_unrated:
        rated |= F.col("rating").isNull()
    return data.where(keep & rated)


def kpis(data: DataFrame) -> DataFrame:
    """Product count, mean rating, median price; NULL where there is nothing."""
    median = exact_median(data, "discounted_price")
    return data.agg(
        F.count("*").alias("products"),
        N.exact_mean(F.col("rating")).alias("average_rating"),
    ).withColumn("median_price", F.round(F.lit(median).cast("double"), 4))


def value_counts(data: DataFrame, column: str) -> DataFrame:
    return (
        data.groupBy(column)
        .agg(F.count("*").alias("product_count"))
        .orderBy(F.desc("product_count"), column)
    )


def page_products(data: DataFrame, offset: int = 0, limit: int = 20) -> DataFrame:
    """One page in id order, each row carrying the total."""
    if offset < 0 or not 1 <= limit <= 100:
        raise ValueError("Offset must not be negative and limit must be 1 to 100.")
    total = data.select(F.count("*"))
    return (
        data.orderBy("product_id")
        .offset(offset)
        .limit(limit)
        .withColumn("total", total.scalar())
    )


def lookup_product(data: DataFrame, product_id: str) -> DataFrame:
    return data.where(F.col("product_id") == product_id)


def export_safe(data: DataFrame) -> DataFrame:
    """Every text cell made harmless for a spreadsheet."""
    return data.withColumns(
        {
            f.name: X.spreadsheet_safe(F.col(f.name))
            for f in data.schema.fields
            if isinstance(f.dataType, T.StringType)
        }
    )
