"""Vocabulary, counts and sparse products against plain counting; what leaves a task."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wareline.functions import matrix as M, text as X
from wareline.operators import features as Fe, search as S


def terms_of(text, stop_words):
    words = [w for w in (text or "").lower().split() if w not in stop_words]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


@pytest.fixture(scope="module")
def texts():
    # Repeated names bring ties at the cut; "aa zz" is a pair as frequent as its words.
    rng = random.Random(5)
    common = [f"word{i}" for i in range(30)]
    rows = [" ".join(rng.choices(common, range(30, 0, -1), k=rng.randint(0, 25))) for _ in range(60)]
    return [*rows, None, "", "the aa zz", "the aa zz", "mm the nn", "mm oo nn", "aa zz"]


@pytest.mark.parametrize("size", [1, 3, 20, 31, 32, 33, 34, 35, 60, 5000])
def test_vocabulary_is_the_most_frequent_terms(spark, texts, size):
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts = sum((terms_of(t, {"the"}) for t in texts), Counter())
    best = sorted(counts, key=lambda term: (-counts[term], term))[:size]
    words = Fe.add_words(df, F.col("text"), ("the",))
    assert Fe.vocabulary(words, size) == sorted(best)


def test_vocabulary_where_many_words_are_as_rare(spark):
    words = Fe.add_words(
        spark.createDataFrame([("bb zz",), ("cc dd",), ("aa yy",), ("ee ff",)], "text string"), F.col("text")
    )
    assert Fe.vocabulary(words, 3) == ["aa", "aa yy", "bb"]


def test_counts_and_frequencies(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    fitted, rows = Fe.fit_features(df, F.col("text"), ["i"], ("the",), 40)
    per_row = [terms_of(t, {"the"}) for t in texts]
    held = [sum(t in found for found in per_row) for t in fitted.terms]
    assert fitted.documents == len(texts) and len(fitted.terms) == 40
    assert np.allclose(fitted.idf, np.log((1 + len(texts)) / (1 + np.array(held))) + 1)
    for row in rows.collect():
        raw = np.array([per_row[row.i][t] for t in fitted.terms]) * fitted.idf
        assert np.allclose(row.features.toArray(), raw / (np.linalg.norm(raw) or 1))


def test_nothing_is_known_without_a_vocabulary(spark):
    df = spark.createDataFrame([("a",), (None,)], "text string")
    fitted, rows = Fe.fit_features(df, F.col("text"), ["text"])
    assert fitted.terms == [] and {len(r.features.indices) for r in rows.collect()} == {0}
    with pytest.raises(ValueError):
        Fe.fit_features(df.limit(0), F.col("text"), ["text"])


def test_marks_are_dropped(spark):
    texts = ["Ñandú Às", "plain", "ﬁne Å", "á̧b", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(X.fold_accents(F.col("t"))).collect()]
    assert got == ["nandu as", "plain", "fine a", "ab", None]


def test_sparse_products_equal_dense_ones():
    rng = np.random.default_rng(3)
    a = rng.random((7, 11)) * (rng.random((7, 11)) < 0.4)
    a[2] = 0
    lists = [np.flatnonzero(row) for row in a]
    flat = M.flat_rows(lists, [row[at] for row, at in zip(a, lists)])
    dense, out = rng.random((11, 3)), np.zeros((11, 3))
    assert np.allclose(M.sparse_product(*flat, dense), a @ dense)
    M.add_transposed_product(out, *flat, a @ dense)
    assert np.allclose(out, a.T @ (a @ dense))


def test_a_task_hands_on_few_rows_per_query():
    """However many batches a task reads, ``limit`` rows of a query leave it."""
    rng = np.random.default_rng(4)
    scores = np.round(rng.random((90, 3)), 1)
    scores[5, 0] = 0.0
    batches = [
        pd.DataFrame({"product_id": [f"p{i}" for i in at], "key": [f"p{i}" for i in at], "at": at})
        for at in np.split(np.arange(90), 9)
    ]
    scorer = S.block_scorer([7, 8, 9], scores, {"p5": [0]}, 0.3, 4, lambda batch, all_: all_[batch["at"]])
    found = pd.concat(scorer(iter(batches)))
    assert len(found) == 12
    for column, query in enumerate((7, 8, 9)):
        true = sorted(
            (not (i == 5 and column == 0), -scores[i, column], f"p{i}")
            for i in range(90)
            if scores[i, column] >= 0.3 or (i == 5 and column == 0)
        )[:4]
        mine = found[found.query_id == query]
        assert sorted(zip(~mine.exact_match, -mine.score, mine.product_id)) == true
    assert list(S.block_scorer([7], scores, {}, 2.0, 4, lambda batch, all_: all_[batch["at"], :1])(batches)) == []
