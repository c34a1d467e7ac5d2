"""Batch upsert, its read-back check, and its rows in the change feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wareline.operators.cleaning import ORD
from wareline.operators.ordered import running_total
from wareline.schema import PRODUCT_COLUMNS


def merge_batch(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Incoming rows replace stored ones entirely; absent ids stay."""
    kept = target.join(batch.select("product_id"), "product_id", "left_anti")
    return kept.select(PRODUCT_COLUMNS).unionByName(batch.select(PRODUCT_COLUMNS))


def verified_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: how many batch rows are stored with equal values."""
    stored, incoming = target.alias("p"), batch.alias("b")
    same = reduce(
        Column.__and__,
        [
            F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}"))
            for c in PRODUCT_COLUMNS
            if c != "product_id"
        ],
    )
    matched = incoming.join(
        stored, (F.col("p.product_id") == F.col("b.product_id")) & same
    )
    return matched.agg(F.count("*").alias("verified_rows"))


def verify_batch(target: DataFrame, batch: DataFrame, expected: int) -> int:
    """Raise unless every batch row reads back equal."""
    verified = verified_rows(target, batch).first()["verified_rows"]
    if verified != expected:
        raise ValueError("Stored values do not match the incoming batch.")
    return verified


def batch_changes(
    target: DataFrame,
    batch: DataFrame,
    revision: int = 0,
    ord_col: str = ORD,
    changed_at: Column | None = None,
) -> DataFrame:
    """Feed rows of a batch load: one per row, in source order.

    A stored id gives an update even when nothing differs.
    """
    stored = target.select("product_id", F.lit(True).alias("stored"))
    marked = batch.select("product_id", ord_col).join(stored, "product_id", "left")
    operation = F.when(F.col("stored"), "products_update").otherwise("products_insert")
    stamp = changed_at if changed_at is not None else F.current_timestamp()
    return running_total(marked, ord_col, F.lit(1), "earlier").select(
        (F.lit(revision) + F.col("earlier") + 1).cast("bigint").alias("change_id"),
        "product_id",
        operation.alias("operation"),
        stamp.alias("changed_at"),
    )
