"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A deep page must become a distributed sort, not one task's heap.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    # Keyed stream state grows with the keys ever seen: on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="wareline-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only in local mode, as in unit tests, a local one serves where the session
    names none; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (folder or _local_dir(spark.sparkContext.applicationId)).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused."""
    return f"{shared_dir(spark)}/wareline/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder once.

    The copy outlives lost executors and is read back with statistics, so
    later joins can be planned from its real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
