"""Which rows train the classifier, and where their names are worked on."""

from pyspark.sql import functions as F

from wareline.operators import classify as K

ROWS = [
    # The first usable row of a product stays: order 0 lacks a name, 1 a label.
    (0, "a", None, "X|1"), (1, "a", "name one", " | x"), (2, "a", "name  ONE", "X|2"), (3, "a", "later", "Y"),
    (0, "b", "Name one", "Y"), (0, "c", " ", "Y"), (0, "d", "call +1 234 567 8901", "Z"), (0, "e", "five", None),
    (0, None, "no id", "X"), (0, " ", "no id", "X"), (None, "f", "no order", "X"),
]


def test_first_usable_row_of_a_product_stays(spark):
    df = spark.createDataFrame(ROWS, "o int, product_id string, product_name string, category string")
    got = sorted(map(tuple, K.labelled_rows(df, "o").collect()))
    assert got == [
        ("a", "name  ONE", "X", "name one"),
        ("d", "call [phone removed]", "Z", "call [phone removed]"),
    ]


def test_names_of_one_file_are_masked_by_all_tasks(spark, tmp_path):
    spark.createDataFrame(ROWS[:3], "o int, product_id string, product_name string, category string").coalesce(
        1
    ).write.parquet(f"{tmp_path}/p")
    df = spark.read.parquet(f"{tmp_path}/p").withColumn("category", F.initcap("category"))
    plan = K.labelled_rows(df)._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("RoundRobinPartitioning")
    assert "regexp_replace" in above and "regexp_replace" not in below
    # Neither names nor labels are judged where the file is read.
    assert below and "substring_index" in above and "substring_index" not in below
