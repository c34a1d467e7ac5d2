"""From raw documents to packed training text, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes the result of each as Parquet and reads it again. The
first four return rows with the columns of ``documents``; the last returns
where each piece of the kept texts is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wareline.llm import near_duplicates, packing, pii, quality, toxicity
from wareline.llm.common import table
from wareline.llm.queries import quality_model, toxicity_model
from wareline.session import configure, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.keep_clean(docs, toxicity_model(configure(spark), sf_dir))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of poor quality go."""
    return quality.keep_good(docs, quality_model(configure(spark), sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity 0.8 or more."""
    configure(spark)
    return near_duplicates.keep_one(docs, words=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs, pii.fit(configure(spark)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in bins of 2048 words without two of one source or one text."""
    configure(spark)
    cluster = F.xxhash64(F.lower(F.trim(F.coalesce("text", F.lit("")))))
    return packing.pack(packing.items(docs, cluster), rows=docs.count())


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: No SQL says what the classifiers do; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
