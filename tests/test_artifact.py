"""Saved category models: round trip, report, and what a reader refuses."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from wareline.operators import artifact as A
from wareline.operators import classify as K
from wareline.operators.monitor import category_shift, total_variation
from wareline.sources.files import write_report


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    stock = {"Pots": "iron pot", "Lamps": "desk lamp", "Rugs": "wool rug"}
    rows = [
        (f"{label}-{i}", f"{text} number{i} {'tall' if i % 2 else 'wide'}", f"{label}|x")
        for label, text in stock.items() for i in range(20)
    ] + [("odd", "a lone thing", "Rare")]
    kept, excluded = K.training_rows(
        spark.createDataFrame(rows, "product_id string, product_name string, category string")
    )
    kept = kept.cache()
    model, frames = K.train_classifier(K.stratified_split(kept))
    path = str(tmp_path_factory.mktemp("model") / "m")
    identity = A.save_model(model, path, kept, frames, excluded)
    return model, path, identity, kept


NAMES = ["iron pot small", "desk lamp", "zzz qqq", "", None, "wool", "x" * 2001]


def predictions(spark, model):
    names = spark.createDataFrame(list(enumerate(NAMES)), "i int, product_name string")
    return sorted(map(tuple, K.predict_categories(model, names).collect()))


def test_reloaded_model_predicts_the_same(spark, trained):
    model, path, identity, rows = trained
    loaded = A.load_model(spark, path)
    assert predictions(spark, loaded) == predictions(spark, model)
    assert A.model_id(loaded) == identity == A.describe(spark, path)["model_id"]
    about = A.describe(spark, path)
    assert about["rows"] == 60 and about["data_fingerprint"] == K.data_fingerprint(rows).first().fingerprint
    with pytest.raises(Exception, match="exist"):
        A.save_model(model, path, rows, {}, rows)


def test_report_tables_agree_with_each_other(spark, trained):
    model, path, *_ = trained
    table = lambda name: A.report_table(spark, path, name)
    sizes = {r.split: r["count"] for r in table("split").groupBy("split").count().collect()}
    assert sizes == {"train": 36, "validation": 12, "test": 12}
    assert [tuple(r) for r in table("excluded").collect()] == [("Rare", 1)]
    assert table("confusion").agg(F.sum("rows")).first()[0] == 12
    wrong = table("confusion").where("label <> predicted").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    assert table("errors").count() == wrong
    assert abs(table("test").first().accuracy - (12 - wrong) / 12) < 1e-12
    assert abs(table("baseline").first().accuracy - 4 / 12) < 1e-12
    assert {r.strength for r in table("candidates").collect()} == set(K.STRENGTHS)
    assert {r.label: r.support for r in table("classes").collect()} == {"Pots": 4, "Lamps": 4, "Rugs": 4}
    shares = A.training_distribution(spark, path)
    assert total_variation(category_shift(shares, model.distribution)).first()[0] == 0


def edit_about(spark, place, **values):
    about = A.describe(spark, place)
    shutil.rmtree(f"{place}/about")
    write_report(spark, {k: v for k, v in {**about, **values}.items() if v != "drop"}, f"{place}/about")


def edit_terms(spark, place, change):
    terms = spark.createDataFrame(spark.read.parquet(f"{place}/terms").collect(), A.TERMS)
    shutil.rmtree(f"{place}/terms")
    change(terms).write.parquet(f"{place}/terms")


LATER = "place > 0"
REFUSALS = {
    "no finished model": lambda s, p: shutil.rmtree(f"{p}/about"),
    "format": lambda s, p: edit_about(s, p, format=2),
    "lacks 'classes'": lambda s, p: edit_about(s, p, classes="drop"),
    "1 labels": lambda s, p: edit_about(s, p, classes=["Pots"]),
    "1 of them repeats": lambda s, p: edit_about(s, p, classes=["Pots", "Pots", "Rugs"]),
    "not those that were saved": lambda s, p: edit_about(s, p, classes=["Pots", "Rugs", "Lamps"]),
    "gaps or repeats": lambda s, p: edit_terms(s, p, lambda t: t.where(LATER)),
    "two places": lambda s, p: edit_terms(
        s, p, lambda t: t.withColumn("term", F.when(F.col("place") < 2, "same").otherwise(F.col("term")))
    ),
    "term weight that is not": lambda s, p: edit_terms(
        s, p, lambda t: t.withColumn("idf", F.when(F.expr(LATER), F.col("idf")))
    ),
    "weights of shape": lambda s, p: edit_terms(
        s, p, lambda t: t.where(F.col("place") < 3)
    ),
    "cannot be read": lambda s, p: shutil.rmtree(f"{p}/linear"),
}


@pytest.mark.parametrize("message", REFUSALS)
def test_unfit_models_are_refused(spark, trained, tmp_path, message):
    place = str(tmp_path / "copy")
    shutil.copytree(trained[1], place)
    REFUSALS[message](spark, place)
    with pytest.raises(K.UnfitModel, match=f"(?i){message}"):
        A.load_model(spark, place)


def test_a_run_that_stopped_leaves_no_model(spark, trained, tmp_path, monkeypatch):
    model, _, _, rows = trained
    monkeypatch.setattr(A, "data_fingerprint", lambda rows: 1 / 0)
    frames = {"test": None}
    with pytest.raises(Exception):
        A.save_model(model, str(tmp_path / "m"), rows, frames, rows)
    with pytest.raises(K.UnfitModel, match="No finished model"):
        A.load_model(spark, str(tmp_path / "m"))
    assert json.dumps(model.classes)
