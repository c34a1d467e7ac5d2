"""Fitted category models as folders.

A saved model has a description in JSON, the terms with their weights as Parquet,
the linear model in the format of Spark ML, and the share of each label among
the training rows. The report of the training run lies beside it as tables, so
its parts (split, errors, confusion) may be as long as the data. ``model_id`` is a
digest of everything a prediction depends on. The description is written last: a
folder without one is the leaving of a run that stopped.

``load_model`` refuses what it cannot vouch for, and says what is wrong.
"""

from __future__ import annotations

import hashlib
import json
import math
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from wareline.operators.classify import (
    CategoryModel,
    UnfitModel,
    class_figures,
    confusion_counts,
    data_fingerprint,
    metrics,
)
from wareline.operators.features import TextFeatures
from wareline.sources.files import read_report, write_report

FORMAT = 1
TERMS = "place int, term string, idf double"
DISTRIBUTION = "label string, rows bigint, share double"
REPORT = {
    "split": "product_id string, split string",
    "excluded": "label string, rows bigint",
    "candidates": "strength double, accuracy double, macro_f1 double",
    "confusion": "label string, predicted string, rows bigint",
    "classes": "label string, precision double, recall double, f1 double, support bigint",
    "errors": "product_id string, expected string, predicted string",
    "test": "accuracy double, macro_f1 double",
    "baseline": "accuracy double, macro_f1 double",
}


def model_id(model: CategoryModel) -> str:
    """Digest of classes, terms and weights."""
    parts = [
        model.classes,
        model.strength,
        list(model.features.stop_words),
        model.features.documents,
        model.features.terms,
        [float(x).hex() for x in model.features.idf],
        [float(x).hex() for x in model.linear.coefficientMatrix.toArray().ravel()],
        [float(x).hex() for x in model.linear.interceptVector.toArray()],
    ]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:16]


def save_model(
    model: CategoryModel,
    path: str,
    rows: DataFrame,
    frames: dict[str, DataFrame],
    excluded: DataFrame,
) -> str:
    """Save a model and the report of its training run to a new folder.

    ``rows`` are all labelled rows, ``frames`` what ``train_classifier`` returned
    and ``excluded`` the labels too rare to be learnt. Returns the model's id.
    """
    model.check()
    spark, path = rows.sparkSession, path.rstrip("/")
    # The vocabulary is on the driver already, bounded by the size it was fitted with.
    terms = [(i, t, float(w)) for i, (t, w) in enumerate(zip(model.features.terms, model.features.idf))]
    spark.createDataFrame(terms, TERMS).write.parquet(f"{path}/terms")
    model.linear.write().save(f"{path}/linear")
    model.distribution.write.parquet(f"{path}/distribution")
    tested = confusion_counts(frames["test"])
    report = {
        "split": frames["split"],
        "excluded": excluded,
        "candidates": frames["candidates"],
        "confusion": tested,
        "classes": class_figures(tested),
        "errors": frames["errors"],
        "test": metrics(tested),
        "baseline": metrics(confusion_counts(frames["baseline"])),
    }
    for name, table in report.items():
        table.select(*[c.split()[0] for c in REPORT[name].split(", ")]).write.parquet(
            f"{path}/report/{name}"
        )
    data, identity = data_fingerprint(rows).first(), model_id(model)
    write_report(
        spark,
        {
            "format": FORMAT,
            "model_id": identity,
            "classes": model.classes,
            "strength": model.strength,
            "documents": model.features.documents,
            "stop_words": list(model.features.stop_words),
            "rows": data.row_count,
            "data_fingerprint": data.fingerprint,
            "spark": spark.version,
            "created_at": datetime.now(timezone.utc).isoformat(),
        },
        f"{path}/about",
    )
    return identity


def describe(spark: SparkSession, path: str) -> dict:
    """The description of a saved model."""
    try:
        about = read_report(spark, f"{path.rstrip('/')}/about")
    except (FileNotFoundError, AnalysisException, TypeError, ValueError) as error:
        raise UnfitModel(f"No finished model lies in {path}.") from error
    if not isinstance(about, dict) or about.get("format") != FORMAT:
        raise UnfitModel(f"The model in {path} has a format that this version does not read.")
    return about


def load_model(spark: SparkSession, path: str) -> CategoryModel:
    """Read a saved model, or raise ``UnfitModel`` with all that is wrong."""
    path = path.rstrip("/")
    about = describe(spark, path)
    try:
        terms = spark.read.schema(TERMS).parquet(f"{path}/terms").orderBy("place").collect()
        distribution = spark.read.schema(DISTRIBUTION).parquet(f"{path}/distribution")
        distribution.head(1)
        linear = LogisticRegressionModel.load(f"{path}/linear")
        model = CategoryModel(
            TextFeatures(
                [r.term for r in terms],
                [math.nan if r.idf is None else r.idf for r in terms],
                about["documents"],
                tuple(about["stop_words"]),
            ),
            linear,
            list(about["classes"]),
            about["strength"],
            distribution,
        )
    except KeyError as error:
        raise UnfitModel(f"The description in {path} lacks {error}.") from error
    except Exception as error:
        raise UnfitModel(f"A part of the model in {path} cannot be read.") from error
    if [r.place for r in terms] != list(range(len(terms))):
        raise UnfitModel("The places of the terms have gaps or repeats.")
    model.check()
    if model_id(model) != about.get("model_id"):
        raise UnfitModel("The parts are not those that were saved under this model id.")
    return model


def report_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One table of the report saved with a model."""
    return spark.read.schema(REPORT[name]).parquet(f"{path.rstrip('/')}/report/{name}")


def training_distribution(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DISTRIBUTION).parquet(f"{path.rstrip('/')}/distribution")
