"""File sources and sinks."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from wareline.functions import text as X
from wareline.operators.browse import export_safe
from wareline.operators.cleaning import ORD
from wareline.operators.quality import preview
from wareline.schema import PRODUCT_SCHEMA
from wareline.sources.csv_ranges import read_cells

_SPLIT = ["_path", "_start"]
BYTE_ORDER_MARK = "\ufeff"


def _with_split(df: DataFrame) -> DataFrame:
    """Where a row came from: its file and the offset of its split."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
    )


def number_rows(df: DataFrame, ord_col: str = ORD) -> DataFrame:
    """Replace the split columns by a gap-free ordinal in source order.

    Must sit directly on the scan, where row ids follow the lines. Splits are ordered by file and offset; one small row per split carries
    how many rows lie before it. Row ids only count inside a split, so the
    result does not depend on how splits are packed into tasks.
    """
    df = df.withColumn("_row", F.monotonically_increasing_id())
    splits = df.groupBy("_path", "_start").agg(
        F.count("*").alias("_n"), F.min("_row").alias("_first")
    )
    in_order = W.orderBy("_path", "_start")
    offsets = splits.select(
        "_path",
        "_start",
        (F.sum("_n").over(in_order) - F.col("_n") - F.col("_first")).alias("_shift"),
    )
    return (
        df.join(offsets, ["_path", "_start"])
        .withColumn(ord_col, F.col("_row") + F.col("_shift"))
        .drop(*_SPLIT, "_row", "_shift")
    )


def _existing(load, path: str) -> DataFrame:
    try:
        return load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Dataset not found: {path}") from None
        raise


def read_raw_products(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """CSV as text cells plus the source ordinal ``_ord``.

    Nothing is inferred. Files are cut into ranges even where quoted cells hold
    line breaks; ``whole_files`` reads each file in one task instead, as for
    lines that end in a bare carriage return.
    """
    if not whole_files:
        raw = _existing(lambda p: read_cells(spark, p, ORD), path)
        cells = [c for c in raw.columns if c != ORD]
        return raw.select(*[X.missing_to_null(F.col(f"`{c}`")).alias(c) for c in cells], ORD)
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", True)
        .option("escape", '"')
    )
    raw = _existing(reader.csv, path)
    cells = raw.columns
    return number_rows(
        _with_split(raw).select(
            *[X.missing_to_null(F.col(f"`{c}`")).alias(c) for c in cells], *_SPLIT
        )
    )


def read_cleaned(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Cleaned products, typed by the fixed schema; extra columns are dropped."""
    reader = spark.read.schema(PRODUCT_SCHEMA)
    if kind == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        reader = reader.option("multiLine", True).option("escape", '"')
    return _existing(getattr(reader, kind), path)


def read_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as ``(ord, value)`` in file order."""
    lines = _existing(spark.read.text, path)
    return number_rows(_with_split(lines), "ord").select("ord", "value")


def stream_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same lines as a stream; ordinals are given per micro-batch."""
    return _with_split(spark.readStream.text(path))


def read_search_cases(spark: SparkSession, path: str) -> DataFrame:
    """Retrieval cases: a JSON array of queries with their relevant ids."""
    schema = T.StructType(
        [
            T.StructField("query", T.StringType()),
            T.StructField("relevant_ids", T.ArrayType(T.StringType())),
        ]
    )
    return _existing(spark.read.schema(schema).option("multiLine", True).json, path)


def write_cleaned(df: DataFrame, path: str, sample_path: str, n: int = 100) -> None:
    """Cleaned rows as Parquet and their first ``n`` as CSV."""
    df.write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    write_sample(written, sample_path, n)


def write_sample(df: DataFrame, path: str, n: int = 100, ord_col: str = ORD) -> None:
    """A small CSV of the first rows without the user columns."""
    sample = preview(df, ord_col, n).drop(ord_col)
    sample.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_export(df: DataFrame, path: str) -> None:
    """Spreadsheet-safe CSV that opens as UTF-8."""
    safe = export_safe(df)
    first, *rest = safe.columns
    safe.toDF(BYTE_ORDER_MARK + first, *rest).write.option("header", True).option(
        "escape", '"'
    ).csv(path)


def write_report(spark: SparkSession, payload: dict, path: str) -> None:
    """One JSON document in a new directory; existing reports stay whole."""
    text = json.dumps(payload, ensure_ascii=False, allow_nan=False)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)


def read_report(spark: SparkSession, path: str) -> dict:
    return json.loads(_existing(spark.read.text, path).first()["value"])
