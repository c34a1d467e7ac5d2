import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import SCHEMA, documents, words
from wareline.llm import quality, toxicity


def labelled(n, bad, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        text = words(seed * 1000 + i, 80)
        if i % 4 == 0:
            for _ in range(4):
                text[rng.randrange(80)] = rng.choice(bad)
        rows.append((" ".join(text), int(i % 4 == 0)))
    return rows


def test_toxicity_learns_passages_on_held_out_texts():
    bad = ["grobkraut", "zankapfel", "schuftig"]
    model = toxicity.fit_texts(labelled(400, bad, 1), (300, 100))
    rows = labelled(200, bad, 2)
    scores = model.scorer()([t for t, _ in rows])
    right = (scores >= 0.5) == np.array([bool(label) for _, label in rows])
    assert right.mean() > 0.95
    assert ((scores >= 0) & (scores <= 1)).all()


def test_toxicity_windows_cover_the_whole_text():
    text = " ".join(words(1, 1000))
    joined = b"".join(toxicity.windows(text)).decode().split()
    assert joined == text.split()


def test_toxicity_fit_sees_whole_texts():
    # Late in long texts, at places that a prefix or an even choice of 1,600 words skips.
    phrase = "amber birch cedar dahlia elder fennel garlic hazel".split()
    good = [" ".join(words(200 + i, 3008) + phrase + words(300 + i, 1984)) for i in range(30)]
    bad = [" ".join(words(i, 4001) + ["schuftig"] + words(100 + i, 998)) for i in range(30)]
    ordinary, toxic = toxicity._dictionaries(bad, good)
    assert any(word.encode() in ordinary for word in phrase)
    assert b"schuftig" in toxic


@pytest.mark.parametrize("rows, share", [([], 0.0), ([("a b c", 1)], 1.0)])
def test_toxicity_without_two_classes(rows, share):
    totals = (0, 1) if rows else (0, 0)
    assert toxicity.fit_texts(rows, totals).scorer()(["any", ""]).tolist() == [share, share]


def test_quality_learns_repetition_and_marks():
    good = [(" ".join(words(i, 60)), 1) for i in range(150)]
    bad = [(" ".join(w for x in words(i, 15) for w in [x] * 4), 0) for i in range(60)]
    bad += [(" ".join(x + "###" for x in words(i, 60)), 0) for i in range(60)]
    model = quality.fit_texts(good[:100] + bad[:40] + bad[60:100], (80, 100))
    assert (model.score([t for t, _ in good[100:]]) >= 0.5).mean() > 0.9
    assert (model.score([t for t, _ in bad[40:60] + bad[100:]]) < 0.5).mean() > 0.9


def test_quality_score_is_a_sparse_dot_product():
    at, values = quality.features("the the cat")
    assert np.isclose((values**2).sum(), 1.0)
    assert len(quality.features("")[0]) == 0
    assert quality.features("a a")[0].tolist() != quality.features("b b")[0].tolist()
    model = quality.fit_texts([], (0, 0))
    assert model.score(["", "x"]).tolist() == [0.5, 0.5]


@pytest.mark.parametrize("module, label, keep", [
    (toxicity, "toxic", "keep_clean"), (quality, "quality", "keep_good")])
def test_rows_stay_whole(spark, module, label, keep):
    docs = documents(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias(label)).unionByName(
        spark.createDataFrame([(None, 1), (1, None), (3, 7)], f"doc_id long, {label} int"))
    model = module.fit(docs, labels, keep=lambda c: c > 0)
    scored = module.score(docs, model)
    assert scored.columns == ["doc_id", "score", "predicted"]
    got = scored.collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    kept = getattr(module, keep)(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(
        r.predicted == (0 if module is toxicity else 1) for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert module.score(empty, module.fit(empty, labels, keep=lambda c: c > 0)).count() == 0


def test_near_copies_are_left_out_and_texts_that_share_a_phrase_are_not():
    from tests.llm.fixtures import words
    from wareline.llm.common import one_of_each

    phrase = "aaa rarest phrase of all"
    one, two = (" ".join([phrase, *words(n, 80, f"k{n}x")]) for n in (1, 2))
    near = one.replace("k1x", "K1X").replace(" ", "  ", 3) + " more"
    assert one_of_each([one, two, near, one, "", "", "short"]) == [one, two, "", "short"]


def test_sample_is_bounded_whatever_ids_repeat(spark):
    from wareline.llm.common import labelled_sample

    docs = spark.createDataFrame(
        [(1, f"text {i:03d}") for i in range(500)] + [(i, f"other {i}") for i in range(2, 40)],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame(
        [(i, i % 2, "x") for i in range(1, 40)] + [(3, 1, "x")] * 9, "doc_id long, toxic int, text string"
    )
    rows, totals = labelled_sample(docs, labels, "toxic", lambda i: i > 0, 50)
    assert len(rows) == 39 and totals == (19, 20)
    assert ("text 000", 1) in rows and not any(t == "text 001" for t, _ in rows)
    few, _ = labelled_sample(docs, labels, "toxic", lambda i: i > 0, 5)
    assert len(few) == 10 and sum(label for _, label in few) == 5
