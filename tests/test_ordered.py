"""Totals over ordinals."""

from pyspark.sql import functions as F

from wareline.operators.ordered import running_total


def test_a_million_rows_are_totalled_by_many_tasks(spark):
    rows = spark.range(0, 1 << 20, 1 << 12).withColumnRenamed("id", "ord")
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in plain.items():
        spark.conf.set(name, value)
    total = running_total(rows, "ord", F.lit(1), "before")
    tasks = total.select("ord", "before", F.spark_partition_id().alias("task")).collect()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.ord, r.before) for r in tasks) == [(i << 12, i) for i in range(256)]
    assert len({r.task for r in tasks}) > 1
