"""Products in a PostgreSQL table. Connection details stay out of errors."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from wareline.schema import PRODUCT_COLUMNS


def jdbc_options(
    host: str,
    database: str,
    user: str,
    password: str,
    port: int = 5432,
    table: str = "products",
    read_only: bool = True,
    partitions: int | None = None,
    bounds: tuple[int, int] | None = None,
    partition_column: str = "rating_count",
) -> dict[str, str]:
    """Reader or writer options. ``bounds`` splits a large read by a column."""
    if not password:
        raise ValueError("A database password is required.")
    options = {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "connectTimeout": "10",
    }
    if read_only:
        options["readOnly"] = "true"
    if partitions and bounds:
        options.update(
            numPartitions=str(partitions),
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
        )
    return options


def _guarded(action):
    try:
        return action()
    except (Py4JJavaError, PySparkException):
        raise RuntimeError("PostgreSQL operation failed.") from None


def read_products(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    reader = spark.read.format("jdbc").options(**options)
    return _guarded(lambda: reader.load().select(PRODUCT_COLUMNS))


def stage_products(batch: DataFrame, options: dict[str, str]) -> None:
    """Write a batch to a staging table for the database to merge from."""
    writer = batch.select(PRODUCT_COLUMNS).write.format("jdbc").options(**options)
    _guarded(lambda: writer.mode("overwrite").option("truncate", "true").save())
