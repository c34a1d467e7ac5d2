"""Lexical search from written postings, against plain algebra."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wareline.operators import postings as P
from wareline.operators import search as S
from wareline.operators.features import add_words

DOC = "product_id string, product_name string, category string, about_product string"


def brute(docs, queries, threshold, limit):
    """Hits (query, id, score, exact) from whole vectors."""

    def terms(text):
        words = [w for w in text.lower().split() if len(w) > 1]
        return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])

    counts = {i: terms(t) for i, t in docs}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}

    def unit(c):
        w = {t: n * idf[t] for t, n in c.items() if t in idf}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    vectors, out = {i: unit(c) for i, c in counts.items()}, []
    for q, text in queries:
        mine, found = unit(terms(text)), []
        for i, v in vectors.items():
            raw = sum(x * v.get(t, 0.0) for t, x in mine.items())
            exact = i.lower() in text.lower().split()
            if exact or raw >= threshold:
                found.append((not exact, -round(raw, 6), i))
        out += [(q, i, -s, not e) for e, s, i in sorted(found)[:limit]]
    return sorted(out)


def corpus(n, seed=1):
    """Words of a long tail, far more distinct terms than documents; sizes from 1 to 600."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        size = int(2 ** rng.uniform(0, 9.2))
        docs.append((f"d{i}", " ".join(f"w{int(rng.paretovariate(0.5)) % 40000}" for _ in range(size))))
    return docs


def frames(spark, docs, queries):
    rows = spark.createDataFrame([(i, t, None, None) for i, t in docs], DOC)
    return rows, spark.createDataFrame(queries, "query_id int, query string")


@pytest.fixture
def small(monkeypatch):
    """Blocks and buckets small enough that there are many of both."""
    monkeypatch.setattr(P, "BLOCK_DOCS", 8)
    monkeypatch.setattr(P, "BUCKET_POSTINGS", 1 << 12)


def test_hits_equal_whole_vectors(spark, small):
    docs = corpus(300) + [("short", "w1"), ("twin1", "rare words here"), ("twin2", "rare words here")]
    rng = random.Random(4)
    queries = [(n, " ".join(rng.sample(docs[rng.randrange(300)][1].split() * 3, 3))) for n in range(25)]
    queries += [(90, "d7 w1"), (91, "rare words"), (92, "zz unknown"), (93, "D3"), (94, " "), (95, "x" * 1001)]
    rows, asked = frames(spark, docs, queries)
    index = S.fit_lexical(rows, ())
    assert index.buckets > 2 and index.table("blocks").select("block").distinct().count() > 20
    got = sorted(
        (r.query_id, r.product_id, r.score, r.exact_match) for r in S.lexical_search(index, asked, 50).collect()
    )
    want = brute(docs, queries[:-2], S.THRESHOLD, 50)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(got, want))
    assert {r.query_id: r.reason for r in S.refused_queries(asked).collect()} == {
        94: "empty", 95: "over 1000 characters"
    }


def test_blocks_that_cannot_reach_the_threshold_are_not_read(spark, small):
    rows, asked = frames(spark, corpus(400), [(n, f"w{n} w{n + 1} w{2 * n}") for n in range(1, 30)])
    index = S.fit_lexical(rows, ())
    weights = P.query_weights(index, asked).cache()
    met = index.table("largest").join(weights, ["bucket", "term_id"]).select("query_id", "block").distinct()
    likely = P.likely_blocks(index, weights, S.THRESHOLD)
    assert 0 < likely.count() < met.count()
    hits = P.scores_at_least(index, weights, S.THRESHOLD).join(index.table("blocks"), "product_id")
    assert hits.join(likely, ["query_id", "block"], "left_anti").isEmpty()


def test_no_term_is_left_out_however_many_there_are(spark):
    docs = [(f"d{i}", " ".join(f"t{i}x{j}" for j in range(300))) for i in range(100)]
    rows, asked = frames(spark, docs, [(i, f"t{i}x299") for i in range(100)])
    index = S.fit_lexical(rows, ())
    assert index.table("terms").count() > 50_000
    hits = S.lexical_search(index, asked, 1).collect()
    # One of some 600 like terms weighs less than the threshold, but is found.
    weights = P.query_weights(index, asked)
    assert {(r.query_id, r.product_id) for r in P.scores_at_least(index, weights, 0.01).collect()} == {
        (i, f"d{i}") for i in range(100)
    } and not hits


def test_an_index_takes_few_bytes_a_posting(spark, tmp_path):
    docs = [(f"d{i}", " ".join(f"t{i}x{j}" for j in range(600))) for i in range(200)]
    rows, _ = frames(spark, docs, [(1, "t1x1")])
    index = P.fit_postings(rows, S.searchable(), (), f"{tmp_path}/index")
    held = index.table("postings").count()
    assert held == 200 * 1199
    size = sum(p.stat().st_size for p in (tmp_path / "index").rglob("*.parquet"))
    # Spelled once, without a weight and an id at each posting.
    assert size < 20 * held and "w" not in index.table("entries").columns


def test_terms_cross_the_network_packed(spark):
    docs = corpus(400, 7)
    rows, _ = frames(spark, docs, [(1, "w1")])
    worded = add_words(rows.coalesce(2), F.col("product_name"))
    packed = P.packed_terms(worded, "product_id", 4).where("size IS NULL")
    moved, held = packed.agg(
        F.sum(F.length("words") + F.length("places")), F.sum(F.element_at("numbers", 2))
    ).first()
    assert held == sum(len({*words, *zip(words, words[1:])}) for words in (t.split() for _, t in docs))
    # Spelt out, a pair alone takes more than 10.
    assert moved < 8 * held


def test_runs_and_chunks_of_any_length_give_the_same_entries(spark, monkeypatch):
    rows, _ = frames(spark, corpus(120, 5), [(1, "w1")])
    want = Counter()
    for _, text in corpus(120, 5):
        words = text.split()
        want.update({*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))})
    for chunk, run in ((1 << 21, 1 << 22), (500, 300)):
        monkeypatch.setattr(P, "CHUNK_WORDS", chunk)
        monkeypatch.setattr(P, "RUN_POSTINGS", run)
        monkeypatch.setattr(P, "BLOCK_DOCS", 8)
        index = S.fit_lexical(rows.coalesce(3), ())
        terms = index.table("terms").collect()
        assert {r.term: r.df for r in terms} == want and len(terms) == len(want)
        held = index.table("postings").groupBy("term_id").count().collect()
        assert {r.term_id: r["count"] for r in held} == {r.term_id: r.df for r in terms}
        assert index.table("postings").groupBy("term_id", "block", "at").count().where("count > 1").isEmpty()


def test_queries_in_many_shares_find_the_same(spark, small, monkeypatch):
    rows, asked = frames(spark, corpus(200, 6), [(n, f"w{n} w{n + 1} w{2 * n}") for n in range(1, 25)])
    index = S.fit_lexical(rows, ())
    weights = P.query_weights(index, asked).cache()
    once = {(r.query_id, r.product_id): r.raw for r in P.scores_at_least(index, weights, 0.05).collect()}
    monkeypatch.setattr(P, "SHARE_TERMS", 7)
    shared = {(r.query_id, r.product_id): r.raw for r in P.scores_at_least(index, weights, 0.05).collect()}
    assert once and shared == pytest.approx(once)


def test_rows_of_one_id_in_several_blocks_count_together(spark, small):
    text = " ".join(f"w{i}" for i in range(40))
    docs = [("twice", text)] * 2 + corpus(60, 3)
    rows, asked = frames(spark, docs, [(1, "w3 w4")])
    index = S.fit_lexical(rows.repartition(8), ())
    (row,) = index.table("blocks").where("product_id = 'twice'").select("unit", "repeated").distinct().collect()
    assert row.repeated
    hits = P.scores_at_least(index, P.query_weights(index, asked), 0.0).where("product_id = 'twice'")
    assert hits.count() == 1


def test_empty_corpus_and_empty_texts(spark):
    rows, asked = frames(spark, [], [(1, "anything d1")])
    assert S.lexical_search(S.fit_lexical(rows, ()), asked).isEmpty()
    rows, asked = frames(spark, [("d1", ""), ("d2", "a b")], [(1, "anything d1")])
    hits = S.lexical_search(S.fit_lexical(rows, ()), asked).collect()
    assert [(r.product_id, r.score, r.exact_match, r.rank) for r in hits] == [("d1", 0.0, True, 1)]


def test_share_of_rows_without_known_terms(spark):
    names = spark.createDataFrame([("blue kettle",), ("zz yy",), ("",), (None,)], "n string")
    known = P.corpus_terms(spark.createDataFrame([("a blue cup",)], "t string"), F.col("t"))
    assert P.unknown_share(known, names, "n").first()[0] == 0.75
    assert P.unknown_share(known, names.limit(0), "n").first()[0] is None


def test_pairs_are_looked_up_only_where_no_word_is_known(spark, monkeypatch):
    asked = []
    whole = P._known_rows
    monkeypatch.setattr(P, "_known_rows", lambda rows, terms: asked.append(rows.count()) or whole(rows, terms))
    names = spark.createDataFrame([("blue cup",), ("red kettle",), ("zz yy",), ("one",), (None,)], "n string")
    known = spark.createDataFrame([("blue",), ("red kettle",)], "term string")
    assert P.unknown_share(known, names, "n").first()[0] == 0.6
    assert asked == [5, 2]
    known = spark.createDataFrame([(w,) for w in ("blue", "red", "zz")], "term string")
    assert P.unknown_share(known, names, "n").first()[0] == 0.4
    assert P.unknown_share(known, names.where("n = 'blue cup'"), "n").first()[0] == 0.0
    assert asked == [5, 2, 5, 1]
