"""Quality report, gate, and dataset profile. Reports hold counts, not rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wareline.functions import numeric as N, text as X
from wareline.schema import (
    NUMERIC_COLUMNS,
    USER_COLUMNS,
    missing_columns,
)

UPPER = {"rating": 5, "discount_percentage": 100}


def _text(name: str) -> Column:
    return X.strip(F.col(name).cast("string"))


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _number(df: DataFrame, name: str) -> Column:
    col = F.col(name)
    return N.parse_number(col) if _is_text(df, name) else col.cast("double")


def _absent(df: DataFrame, name: str) -> Column:
    col = F.col(name)
    if _is_text(df, name):
        return col.isNull()
    return col.isNull() | F.isnan(col.cast("double"))


def _valid(df: DataFrame, name: str) -> Column:
    value = _number(df, name)
    ok = N.is_finite(value) & (value >= 0)
    if name in UPPER:
        ok &= value <= UPPER[name]
    if name == "rating_count":
        ok &= value % 1 == 0
    return F.coalesce(ok, F.lit(False))


def quality_report(df: DataFrame, source_columns=None) -> DataFrame:
    """One row per check: position, name, severity, invalid_count, passed.

    All counts come from a single aggregate over the batch. Checks on a
    column that is absent are left out.
    """
    seen = set(df.columns) | set(source_columns or [])
    checks: list[tuple[str, str, Column]] = [
        ("required_columns", "error", F.lit(len(missing_columns(df)))),
        ("nonempty_batch", "error", (F.count("*") == 0).cast("bigint")),
        ("no_user_identifiers", "error", F.lit(len(seen & set(USER_COLUMNS)))),
    ]
    for name in ("product_id", "product_name"):
        if name in df.columns:
            blank = F.coalesce(_text(name), F.lit("")) == ""
            checks.append((name + "_present", "error", F.count_if(blank)))
    if "product_id" in df.columns:
        present = F.count_distinct(_text("product_id"))
        any_null = F.coalesce(F.max(F.col("product_id").isNull().cast("int")), F.lit(0))
        checks.append(
            ("unique_product_ids", "error", F.count("*") - present - any_null)
        )
    numbers = [name for name in NUMERIC_COLUMNS if name in df.columns]
    for name in numbers:
        absent = _absent(df, name)
        checks.append(
            (name + "_valid", "error", F.count_if(~absent & ~_valid(df, name)))
        )
        checks.append((name + "_missing", "warning", F.count_if(absent)))
    if {"actual_price", "discounted_price"} <= set(numbers):
        inverted = _number(df, "discounted_price") > _number(df, "actual_price")
        known = ~_absent(df, "actual_price") & ~_absent(df, "discounted_price")
        checks.append(
            (
                "discounted_price_not_above_actual",
                "error",
                F.count_if(F.coalesce(known & inverted, F.lit(False))),
            )
        )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("name"),
                F.lit(severity).alias("severity"),
                F.col(f"c{i}").alias("invalid_count"),
                (F.col(f"c{i}") == 0).alias("passed"),
            )
            for i, (name, severity, _) in enumerate(checks)
        ]
    )
    counted = df.agg(
        *[count.cast("bigint").alias(f"c{i}") for i, (_, _, count) in enumerate(checks)]
    )
    return counted.select(F.inline(rows))


def report_summary(report: DataFrame) -> DataFrame:
    """Roll the checks up to one row: failed, warnings, status, checks."""
    failed = F.count_if(~F.col("passed") & (F.col("severity") == "error"))
    return report.agg(
        failed.alias("failed_checks"),
        F.count_if(~F.col("passed") & (F.col("severity") == "warning")).alias(
            "warning_checks"
        ),
        F.when(failed > 0, "failed").otherwise("passed").alias("status"),
        F.array_sort(
            F.collect_list(
                F.struct("position", "name", "severity", "invalid_count", "passed")
            )
        ).alias("checks"),
    )


def require_quality(report: DataFrame) -> None:
    """Raise, naming every failed error check. ``report`` has a fixed size."""
    failed = [
        row["name"]
        for row in report.orderBy("position").collect()
        if not row["passed"] and row["severity"] == "error"
    ]
    if failed:
        raise ValueError("Data quality failed: " + ", ".join(failed))


def missing_values(df: DataFrame, columns=None) -> DataFrame:
    """Columns that have missing cells, most first."""
    names = list(columns or df.columns)
    counted = df.agg(
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"c{i}") for i, n in enumerate(names)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column_name"), F.col(f"c{i}").alias("missing"))
            for i, n in enumerate(names)
        ]
    )
    return (
        counted.select(F.inline(rows))
        .where("missing > 0")
        .orderBy(F.desc("missing"), "column_name")
    )


def duplicate_rows(df: DataFrame, columns=None) -> DataFrame:
    """Rows beyond the first of each group, NULLs equal, as one number."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")
    )


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, duplicate rows and the column types."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.lit(", ".join(f"{name}:{kind}" for name, kind in df.dtypes)).alias("dtypes"),
    )


def preview(df: DataFrame, ord_col: str, n: int = 5) -> DataFrame:
    """First rows in source order, identifying columns left out."""
    return df.drop(*USER_COLUMNS).orderBy(ord_col).limit(n)
