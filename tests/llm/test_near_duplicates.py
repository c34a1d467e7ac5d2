import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.fixtures import SCHEMA, documents, words
from wareline.llm import near_duplicates as N


def shingles(text, k):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").split(" ") if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if None in (i, j) or not a or not b:
                continue
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=repr)


def family(seed, first, n):
    """Edited copies of one text: chains and pairs on both sides of the limit."""
    rng, base, out = random.Random(seed), words(seed, 150), []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(0, 7)):
            text[rng.randrange(150)] = f"e{rng.randrange(10_000)}"
        out.append((first + i, " ".join(text)))
    return out


def test_components_against_brute_force(spark):
    extra = [*family(5, 100, 60), *family(6, 200, 40), (300, "x y z"), (301, "X Y Z")]
    docs = documents(spark, extra)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for k in (4, 5):
        got = N.components(docs, words=k).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, k)
        assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_keep_one(spark):
    docs = documents(spark, family(5, 100, 30))
    kept = N.keep_one(docs, words=5)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {c for i, _, c in brute([(r.doc_id, r.text) for r in docs.collect()], 5) if i is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert N.components(empty).count() == N.keep_one(empty).count() == 0


def test_repeated_ids_are_one_document(spark):
    a, b = " ".join(words(1, 40)), " ".join(words(2, 40))
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (3, b)], "doc_id long, text string")
    assert {r.component_id for r in N.components(docs, words=4).collect()} == {1}


def test_estimate_corrects_for_chance(spark):
    rng = np.random.default_rng(3)
    one = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for share in (0.0, 0.5, 0.8, 1.0):
        cut = int(4000 * 2 * share / (1 + share))
        two = np.concatenate([one[:cut], rng.integers(0, 1 << 63, 4000 - cut, dtype=np.uint64)])
        rows = [([int(x) for x in N._packed(N.minima(s))]) for s in (one, two)]
        df = spark.createDataFrame([tuple(rows)], "a array<long>, b array<long>")
        assert abs(df.select(N.estimate(F.col("a"), F.col("b"))).first()[0] - share) < 0.095


def test_fine_estimate(spark):
    rng = np.random.default_rng(4)
    for n in (3, 40, 400, 4000):
        one = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0.0, 0.5, 0.8, 1.0):
            cut = int(n * 2 * share / (1 + share))
            two = np.concatenate([one[:cut], rng.integers(0, 1 << 63, n - cut, dtype=np.uint64)])
            rows = [[int(x) for x in N._fine(s)] for s in (one, two)]
            df = spark.createDataFrame([tuple(rows)], "a array<long>, b array<long>")
            got = df.select(N.fine_estimate(F.col("a"), F.col("b"))).first()[0]
            truth = cut / (2 * n - cut)
            assert got == 1.0 if n < 16 else abs(got - truth) < N.FINE_SLACK, (n, share, got)


def test_large_group_around_the_limit(spark):
    """Many edited copies whose pairs lie close to the limit on both sides."""
    rows = []
    for seed in (21, 22):
        rng, base = random.Random(seed), words(seed, 400)
        for i in range(150):
            text = list(base)
            for _ in range(rng.randrange(4, 12)):
                text[rng.randrange(400)] = f"e{rng.randrange(100_000)}"
            rows.append((seed * 1000 + i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = N.components(docs, words=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 4)


def test_connected_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 49), (60, 60)], "a long, b long")
    got = {r.node: r.root for r in N.connected(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 50: 49}


def test_connected_finds_the_smallest_node_of_long_chains_and_cliques(spark):
    rng = random.Random(12)
    chain = list(range(1000, 1064))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(a, b) for a in range(20, 28) for b in range(20, 28)]
    links += [(500, i) for i in range(501, 540)] + [(539, 3), (7, 7), (8, 9), (9, 8)]
    df = spark.createDataFrame(links, "a long, b long")
    want = {i: 1000 for i in chain} | {i: 20 for i in range(20, 28)}
    want |= {i: 3 for i in (3, *range(500, 540))} | {8: 8, 9: 8}
    got = {r.node: r.root for r in N.connected(df).collect()}
    assert {k: got.get(k, k) for k in want} == want and got.keys() <= want.keys()
    assert N.connected(df.limit(0)).count() == 0
