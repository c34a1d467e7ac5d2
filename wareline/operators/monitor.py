"""Catalog health and drift of the category mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wareline.operators.classify import label_distribution

# The drift threshold and the alert texts.
DRIFT_THRESHOLD = 0.2
EMPTY_ALERT = "Catalog is empty."
DRIFT_ALERT = (
    "Category mix changed by more than the demo threshold (0.2); "
    "review before retraining."
)


def health(snapshot: DataFrame) -> DataFrame:
    """Products and what is unknown about them."""
    return snapshot.agg(
        F.count("*").alias("products"),
        F.count_if(F.col("discounted_price").isNull()).alias("missing_price"),
        F.count_if(F.col("rating").isNull()).alias("missing_rating"),
        F.count_if(F.col("stock_quantity").isNull()).alias("unknown_inventory"),
    )


def category_shift(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Share per label now and before; an absent label has share 0."""
    now = current.select("label", F.col("share").alias("share"))
    then = baseline.select("label", F.col("share").alias("baseline_share"))
    return now.join(then, "label", "full").select(
        "label",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("share", "baseline_share")],
    )


def total_variation(shift: DataFrame) -> DataFrame:
    """Half the summed absolute difference; NULL for an empty catalog."""
    distance = F.sum(F.abs(F.col("share") - F.col("baseline_share"))) / 2
    return shift.agg(
        F.when(F.sum("share") > 0, distance).alias("category_total_variation")
    )


def monitor(
    snapshot: DataFrame, baseline: DataFrame | None = None, unknown: DataFrame | None = None
) -> DataFrame:
    """One report row: health, drift against ``baseline``, and alerts.

    ``unknown`` is the one-row share of names without known vocabulary.
    """
    report = health(snapshot)
    alerts = [F.when(F.col("products") == 0, F.lit(EMPTY_ALERT))]
    if baseline is not None:
        shares = label_distribution(snapshot, "main_category")
        distance = total_variation(category_shift(shares, baseline))
        report = report.withColumn("category_total_variation", distance.scalar())
        drifted = F.col("category_total_variation") > DRIFT_THRESHOLD
        alerts.append(F.when(drifted, F.lit(DRIFT_ALERT)))
    if unknown is not None:
        report = report.withColumn("unknown_vocabulary_fraction", unknown.scalar())
    return report.withColumn("alerts", F.array_compact(F.array(*alerts)))
