"""The analytics views and the saved reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wareline.functions import numeric as N, text as X
from wareline.schema import NUMERIC_COLUMNS


def rating_level(rating: Column) -> Column:
    return (
        F.when(rating.isNull(), "Unknown")
        .when(rating >= 4.5, "Excellent")
        .when(rating >= 4.0, "Good")
        .when(rating >= 3.0, "Average")
        .otherwise("Low")
    )


def product_analytics(products: DataFrame) -> DataFrame:
    """Derived columns per product."""
    missing = sum(
        (F.col(name).isNull().cast("int") for name in NUMERIC_COLUMNS), F.lit(0)
    )
    return products.select(
        "product_id",
        "product_name",
        "category",
        X.view_category(F.col("category")).alias("main_category"),
        "actual_price",
        "discounted_price",
        "discount_percentage",
        F.round(F.col("actual_price") - F.col("discounted_price"), 2).alias(
            "savings_inr"
        ),
        "rating",
        "rating_count",
        rating_level(F.col("rating")).alias("rating_level"),
        missing.alias("missing_numeric_fields"),
    )


def _rating_ranks(analytics: DataFrame) -> DataFrame:
    """Dense rank of each distinct rating per main category.

    Ranking the distinct values keeps a category that holds a large share of
    all products out of a single window.
    """
    values = (
        analytics.where(F.col("rating").isNotNull())
        .select("main_category", "rating")
        .distinct()
    )
    best_first = W.partitionBy("main_category").orderBy(F.desc("rating"))
    return values.withColumn("rating_rank", F.dense_rank().over(best_first))


def category_rankings(products: DataFrame) -> DataFrame:
    """Every product with its rating rank; no rating, no rank."""
    analytics = product_analytics(products)
    return analytics.join(
        _rating_ranks(analytics), ["main_category", "rating"], "left"
    ).select(*analytics.columns, "rating_rank")


def top_ranks_with_ties(products: DataFrame, ranks: int = 3) -> DataFrame:
    """Products in the best rating ranks of their category."""
    analytics = product_analytics(products)
    best = _rating_ranks(analytics).where(F.col("rating_rank") <= ranks)
    return (
        analytics.join(best, ["main_category", "rating"])
        .select("main_category", "product_id", "product_name", "rating", "rating_rank")
        .orderBy("main_category", "rating_rank", "product_id")
    )


def total_products(products: DataFrame) -> DataFrame:
    return products.agg(F.count("*").alias("total_products"))


def average_rating(products: DataFrame) -> DataFrame:
    return products.where(F.col("rating").isNotNull()).agg(
        N.exact_mean(F.col("rating")).alias("average_rating")
    )


def rating_level_counts(products: DataFrame) -> DataFrame:
    return (
        product_analytics(products)
        .groupBy("rating_level")
        .agg(F.count("*").alias("product_count"))
        .orderBy(F.desc("product_count"), "rating_level")
    )


def category_prices(products: DataFrame) -> DataFrame:
    """Count, mean price and mean savings by main category."""
    return (
        product_analytics(products)
        .groupBy("main_category")
        .agg(
            F.count("*").alias("product_count"),
            N.exact_mean(F.col("discounted_price")).alias("average_price_inr"),
            N.exact_mean(F.col("savings_inr")).alias("average_savings_inr"),
        )
        .orderBy(F.desc("product_count"), "main_category")
    )


def category_summary(products: DataFrame, n: int = 10) -> DataFrame:
    """Largest full categories with mean price and mean rating."""
    return (
        products.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.count("*").alias("product_count"),
            N.exact_mean(F.col("discounted_price")).alias("average_price"),
            N.exact_mean(F.col("rating")).alias("average_rating"),
        )
        .orderBy(F.desc("product_count"), "category")
        .limit(n)
    )


def top_popular(products: DataFrame, n: int = 10, min_count: int = 1000) -> DataFrame:
    """Best rated among the often rated."""
    return (
        products.where(F.col("rating_count") >= min_count)
        .select("product_id", "product_name", "rating", "rating_count")
        .orderBy(F.desc("rating"), F.desc("rating_count"), "product_id")
        .limit(n)
    )


def top_discounts(products: DataFrame, n: int = 10) -> DataFrame:
    return (
        products.where(F.col("discount_percentage").isNotNull())
        .orderBy(F.desc("discount_percentage"), "product_id")
        .limit(n)
        .select(
            "product_name", "actual_price", "discounted_price", "discount_percentage"
        )
    )


def incomplete_rows(products: DataFrame) -> DataFrame:
    return (
        product_analytics(products)
        .where(F.col("missing_numeric_fields") > 0)
        .select("product_id", "product_name", "missing_numeric_fields")
        .orderBy(F.desc("missing_numeric_fields"), "product_id")
    )


def price_inversions(products: DataFrame) -> DataFrame:
    return (
        products.where(F.col("discounted_price") > F.col("actual_price"))
        .select("product_id", "actual_price", "discounted_price")
        .orderBy("product_id")
    )


def register_views(products: DataFrame) -> None:
    """Expose the two views to ``spark.sql``."""
    product_analytics(products).createOrReplaceTempView("product_analytics")
    category_rankings(products).createOrReplaceTempView("category_product_rankings")
