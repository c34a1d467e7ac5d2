"""Category classifier: training rows, split, fit, prediction, evaluation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from wareline.functions import text as X
from wareline.operators.features import (
    MAX_FEATURES,
    TextFeatures,
    fit_features,
    known_terms,
    spread,
)
from wareline.operators.ordered import hash_rank
from wareline.schema import require_columns
from wareline.session import written

# Smallest label, holdout share, candidate strengths, input limit,
# and the texts that stand in the output.
MIN_ROWS, HOLDOUT, STRENGTHS, MAX_NAME = 5, 0.2, (0.5, 2.0), 2000
ABSTAINED = "No known vocabulary in this name."
INVALID = "Product name must contain 1–2000 characters."
BLANK = "Text must not be blank."


def labelled_rows(df: DataFrame, ord_col: str | None = None) -> DataFrame:
    """Usable rows with label, masked name and name key, repeats dropped.

    The first row per product stays, then the first product per name key.
    Both are aggregates, so repeats meet in the map-side combine.
    """
    columns = ["product_id", "product_name", "category"]
    require_columns(df, columns)
    # Short rows: many lie in one file, and masking them is the expensive part.
    rows = spread(df.select(*dict.fromkeys([*columns, *([ord_col] if ord_col else [])]))).select(
        X.blank_to_null(X.strip(F.col("product_id"))).alias("product_id"),
        X.blank_to_null(X.strip(F.col("product_name"))).alias("product_name"),
        X.training_label(F.col("category")).alias("label"),
        (F.col(ord_col) if ord_col else F.lit(0)).alias("_ord"),
    ).dropna(subset=["product_id"])
    # Judged where the rows are aggregated: a filter is moved before their exchange,
    # and would cut names and labels in the few tasks that read them.
    whole = F.col("product_name").isNotNull() & F.col("label").isNotNull() & F.col("_ord").isNotNull()
    rows = rows.withColumn("_whole", whole)
    rows = rows.withColumn("product_name", X.redact(F.col("product_name")))
    rows = rows.withColumn("name_key", X.name_key(F.col("product_name")))
    row = F.struct("_ord", "product_name", "name_key", "label")
    once = rows.groupBy("product_id").agg(F.min(F.when(F.col("_whole"), row)).alias("r"))
    once = once.where(F.col("r").isNotNull())
    item = F.struct("product_id", "r.product_name", "r.label")
    kept = once.groupBy(F.col("r.name_key").alias("name_key")).agg(F.min(item).alias("k"))
    return kept.select("k.product_id", "k.product_name", "k.label", "name_key")


def training_rows(
    df: DataFrame, ord_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of labels with at least five names, and the rarer labels."""
    rows = labelled_rows(df, ord_col)
    counts = rows.groupBy("label").agg(F.count("*").alias("rows"))
    enough = counts.where(F.col("rows") >= MIN_ROWS)
    kept = rows.join(enough.select("label"), "label", "left_semi")
    excluded = counts.where(F.col("rows") < MIN_ROWS)
    return kept.select("product_id", "product_name", "label", "name_key"), excluded


def require_labels(rows: DataFrame) -> None:
    """Two labels are the least a classifier can tell apart."""
    if rows.select("label").distinct().limit(2).count() < 2:
        raise ValueError(
            f"Training takes two labels or more with {MIN_ROWS} different names each."
        )


def stratified_split(rows: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``split``: a fifth of each label for test, as much for validation.

    Rows are shuffled by a hash of their id, so the split is repeatable and
    does not depend on how the rows are partitioned.
    """
    mixed = rows.withColumn(
        "_h", F.md5(F.concat_ws("#", F.col("product_id"), F.lit(str(seed))))
    )
    ranked = hash_rank(mixed, ["label"], "_h", "_rank")
    held = F.greatest(F.lit(1), F.floor(F.col("_rank_of") * HOLDOUT))
    split = (
        F.when(F.col("_rank") <= held, "test")
        .when(F.col("_rank") <= 2 * held, "validation")
        .otherwise("train")
    )
    return ranked.withColumn("split", split).drop("_h", "_rank", "_rank_of")


def label_distribution(rows: DataFrame, label: str = "label") -> DataFrame:
    """Share of each label."""
    counts = rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("rows"))
    total = rows.select(F.count("*"))
    return counts.withColumn("share", F.col("rows") / total.scalar())


def data_fingerprint(rows: DataFrame) -> DataFrame:
    """Order-free hash of (id, name, label), for comparing training sets."""
    digest = F.md5(F.concat_ws("\x1f", "product_id", "product_name", "label"))
    part = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(part), F.lit(0)).cast("string").alias("fingerprint"),
    )


class UnfitModel(ValueError):
    """Raised for a model that must not predict."""


@dataclass
class CategoryModel:
    """Text weighting plus a linear model; labels in alphabetical order."""

    features: TextFeatures
    linear: LogisticRegressionModel
    classes: list[str]
    strength: float
    distribution: DataFrame

    def faults(self) -> Iterator[str]:
        """What keeps the parts from being one model."""
        weights = self.linear.coefficientMatrix.toArray()
        bias = self.linear.interceptVector.toArray()
        idf = np.asarray(self.features.idf, dtype=float)
        repeated = len(self.classes) - len(set(self.classes))
        if repeated or len(self.classes) < 2:
            yield f"{len(self.classes)} labels, {repeated} of them repeats"
        if len(set(self.features.terms)) != len(self.features.terms):
            yield "a term stands in two places"
        if len(idf) != len(self.features.terms):
            yield f"{len(idf)} term weights for {len(self.features.terms)} terms"
        # Two classes share one line of weights.
        lines = len(self.classes) if len(self.classes) > 2 else 1
        # An empty vocabulary stands as one term that no text holds.
        if weights.shape != (lines, max(1, len(self.features.terms))) or bias.shape != (lines,):
            yield f"weights of shape {weights.shape} and {bias.shape}"
        for name, values in (("term weight", idf), ("weight", weights), ("intercept", bias)):
            if not np.isfinite(values).all():
                yield f"a {name} that is not a finite number"

    def check(self) -> None:
        """Refuse a model whose parts do not fit together."""
        if found := list(self.faults()):
            raise UnfitModel("This is not a usable model: " + "; ".join(found) + ".")


def _class_number(classes: list[str], label: Column) -> Column:
    known = F.array(*[F.lit(name) for name in classes])
    return (F.array_position(known, label) - 1).cast("double")


def _fit_one(rows: DataFrame, strength: float, total: int) -> LogisticRegressionModel:
    """Penalty as ``1 / (C * n)``; the class weights sum to ``n``."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="_y",
        weightCol="_weight",
        regParam=1.0 / (strength * total),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
    ).fit(rows)


def _score(model: CategoryModel, featured: DataFrame) -> DataFrame:
    """Add ``category``, ``probability`` and ``probabilities`` to features."""
    classes = F.array(*[F.lit(name) for name in model.classes])
    scored = model.linear.transform(featured.withColumn("_known", known_terms("features")))
    shares = vector_to_array("probability")
    return scored.withColumns(
        {
            "probabilities": F.transform(shares, lambda p: F.round(p, 6)),
            "category": F.element_at(classes, F.col("prediction").cast("int") + 1),
        }
    ).withColumn("probability", F.array_max("probabilities"))


def train_classifier(
    split: DataFrame, size: int = MAX_FEATURES
) -> tuple[CategoryModel, dict[str, DataFrame]]:
    """Fit both candidates on the training rows and keep the better one.

    Selection uses macro F1 on the validation rows; the first wins a tie and
    nothing is refitted. Returns the model and the evaluation frames.
    """
    keep = ["product_id", "label", "product_name"]
    rows = written(split.select(*keep, "split"), "split")
    training = rows.where(F.col("split") == "train")
    features, weighted = fit_features(training, F.col("product_name"), keep, (), size)
    # One row per class.
    counts = {
        r.label: r.rows
        for r in training.groupBy("label").agg(F.count("*").alias("rows")).collect()
    }
    classes, total = sorted(counts), sum(counts.values())
    weights = F.array(
        *[F.lit(total / (len(classes) * counts[name])) for name in classes]
    )
    fit_rows = (
        weighted.withColumn("_y", _class_number(classes, F.col("label")))
        .withColumn("_weight", F.element_at(weights, F.col("_y").cast("int") + 1))
        .select("features", "_y", "_weight")
        .persist()
    )
    distribution = label_distribution(training)
    held = features.transform(rows.where(F.col("split") != "train"), F.col("product_name"))
    candidates, frames = [], []
    for strength in STRENGTHS:
        linear = _fit_one(fit_rows, strength, total)
        model = CategoryModel(features, linear, classes, strength, distribution)
        model.check()
        predicted = _score(model, held).select("split", "product_id", "label", "category")
        figures = metrics(
            confusion_counts(predicted.where(F.col("split") == "validation"))
        ).first()
        candidates.append((figures.macro_f1, model, predicted))
        frames.append((strength, figures.accuracy, figures.macro_f1))
    fit_rows.unpersist()
    best = max(range(len(candidates)), key=lambda i: candidates[i][0])
    _, model, predicted = candidates[best]
    tested = predicted.where(F.col("split") == "test")
    majority = min(classes, key=lambda name: (-counts[name], name))
    spark = rows.sparkSession
    return model, {
        "candidates": spark.createDataFrame(
            frames, "strength double, accuracy double, macro_f1 double"
        ),
        "split": rows.select("product_id", "split"),
        "test": tested,
        "baseline": tested.withColumn("category", F.lit(majority)),
        "errors": tested.where(F.col("label") != F.col("category")).select(
            "product_id",
            F.col("label").alias("expected"),
            F.col("category").alias("predicted"),
        ),
    }


def predict_categories(
    model: CategoryModel,
    names: DataFrame,
    name: str = "product_name",
    max_length: int | None = MAX_NAME,
) -> DataFrame:
    """Category and probabilities per name; unknown wording abstains.

    Names outside the allowed length stay in the result with a reason. Without
    ``max_length`` a text of any length is scored whole.
    """
    model.check()
    text = F.col(name)
    allowed, reason = X.strip(text) != "", BLANK
    if max_length is not None:
        allowed &= F.length(text) <= max_length
        reason = INVALID.replace(str(MAX_NAME), str(max_length))
    valid = F.coalesce(allowed, F.lit(False))
    # A name that is too long is not cut into terms at all.
    featured = model.features.transform(
        names.withColumn("_valid", valid),
        F.when(F.col("_valid"), X.redact(text)).otherwise(F.lit("")),
    )
    scored = _score(model, featured)
    usable = F.col("_valid") & (F.col("_known") > 0)
    return scored.select(
        *names.columns,
        F.when(usable, F.col("category")).alias("category"),
        (F.col("_valid") & (F.col("_known") == 0)).alias("abstained"),
        F.when(~F.col("_valid"), reason)
        .when(F.col("_known") == 0, ABSTAINED)
        .alias("reason"),
        F.when(usable, F.col("probability")).alias("probability"),
        F.when(usable, F.col("probabilities")).alias("probabilities"),
    )


def unknown_vocabulary(features: TextFeatures, names: DataFrame, name: str = "product_name") -> DataFrame:
    """Share of names without a single known term."""
    counted = features.transform(names.select(name), F.coalesce(F.col(name), F.lit("")))
    return counted.agg(
        F.avg((known_terms("features") == 0).cast("double")).alias(
            "unknown_vocabulary_fraction"
        )
    )


def confusion_counts(predicted: DataFrame, truth="label", guess="category") -> DataFrame:
    """Pairs of true and predicted label with their number."""
    return predicted.groupBy(
        F.col(truth).cast("string").alias("label"),
        F.col(guess).cast("string").alias("predicted"),
    ).agg(F.count("*").alias("rows"))


def class_figures(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label, true or predicted."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("predicted"), F.col("rows")).otherwise(zero)
    actual = confusion.select("label", hit.alias("tp"), F.col("rows").alias("support"), zero.alias("guessed"))
    guessed = confusion.select(
        F.col("predicted").alias("label"), zero.alias("tp"), zero.alias("support"), F.col("rows").alias("guessed")
    )
    sums = (
        actual.unionByName(guessed)
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "guessed")])
    )

    def share(part, whole):
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    return sums.select(
        "label",
        share(F.col("tp"), F.col("guessed")).alias("precision"),
        share(F.col("tp"), F.col("support")).alias("recall"),
        share(2 * F.col("tp"), F.col("support") + F.col("guessed")).alias("f1"),
        "support",
        "tp",
    )


def metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy and macro F1, over true and predicted labels together."""
    return class_figures(confusion).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
    )


def classification_report(confusion: DataFrame) -> DataFrame:
    """One row per label, then the macro and the weighted average."""
    rows = class_figures(confusion).drop("tp")
    names = ("precision", "recall", "f1")
    macro = rows.agg(
        F.lit("macro avg").alias("label"),
        *[F.avg(c).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    weighted = rows.agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    return rows.unionByName(macro).unionByName(weighted)


def confusion_matrix(confusion: DataFrame, classes: list) -> DataFrame:
    """Counts by true label (rows) and predicted label (columns)."""
    return (
        confusion.groupBy("label")
        .pivot("predicted", [str(name) for name in classes])
        .agg(F.sum("rows"))
        .na.fill(0)
    )


def majority_label(rows: DataFrame, label: str = "label") -> DataFrame:
    """Most frequent label, the smallest of several."""
    counts = rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "label").limit(1)


def evaluation_report(model: CategoryModel, frames: dict[str, DataFrame]) -> DataFrame:
    """The figures of one training run as a single row."""
    tested = confusion_counts(frames["test"])
    figures = metrics(tested).select(
        F.col("accuracy").alias("test_accuracy"), F.col("macro_f1").alias("test_macro_f1")
    )
    baseline = metrics(confusion_counts(frames["baseline"]))
    sizes = frames["split"].agg(
        *[
            F.count_if(F.col("split") == name).alias(f"{name}_rows")
            for name in ("train", "validation", "test")
        ]
    )
    per_class = classification_report(tested).select(
        F.collect_list(F.struct("label", "precision", "recall", "f1", "support"))
    )
    candidates = frames["candidates"].select(
        F.collect_list(F.struct("strength", "accuracy", "macro_f1"))
    )
    return sizes.select(
        "*",
        F.lit(model.strength).alias("chosen_strength"),
        F.array(*[F.lit(c) for c in model.classes]).alias("class_order"),
        figures.select("test_accuracy").scalar().alias("test_accuracy"),
        figures.select("test_macro_f1").scalar().alias("test_macro_f1"),
        baseline.select("accuracy").scalar().alias("baseline_accuracy"),
        baseline.select("macro_f1").scalar().alias("baseline_macro_f1"),
        candidates.scalar().alias("validation_candidates"),
        per_class.scalar().alias("classification_report"),
    )
