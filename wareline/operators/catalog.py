"""The public view of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wareline.functions import numeric as N, text as X
from wareline.schema import PUBLIC_COLUMNS


def public_snapshot(products: DataFrame, inventory: DataFrame) -> DataFrame:
    """Nine public columns plus the main category, contact details masked."""
    joined = products.join(inventory, "product_id", "left")
    public = joined.select(
        *[
            X.redact(F.col(name)).alias(name)
            if name in ("product_name", "category", "about_product")
            else N.public_value(F.col(name)).alias(name)
            if name in ("discounted_price", "actual_price", "rating")
            else F.col(name)
            for name in PUBLIC_COLUMNS
        ]
    )
    return public.withColumn("main_category", X.public_category(F.col("category")))
