import numpy as np

from wareline.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, rank string, score string, label int"


def brute(rows, k):
    seen = {}
    for i, v in sorted(rows, key=repr):
        seen.setdefault(i, np.array(v, np.float32).astype(float))
    out = set()
    for q in seen:
        if q % 100:
            continue
        near = sorted((float(np.sqrt(((v - seen[q]) ** 2).sum())), i) for i, v in seen.items() if i != q)
        out |= {(q, n + 1, i, round(d, 9)) for n, (d, i) in enumerate(near[:k])}
    return out


def search(spark, rows, k=10):
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SCHEMA)
    got = neighbours.search(df, lambda c: c % 100 == 0, k)
    return {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.collect()}


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 4
    rows = [(i, (centres[i % 20] + rng.normal(size=16)).tolist()) for i in range(3000)]
    got, want = search(spark, rows), brute(rows, 10)
    pairs = {(q, i): d for q, _, i, d in want}
    assert len(got) == len(want)
    assert sum((q, i) in pairs for q, _, i, _ in got) >= 0.9 * len(want)
    assert all(pairs.get((q, i), d) == d for q, _, i, d in got)


def test_copies_ties_and_unusable_vectors(spark):
    ok = [(i, [1.0, 2.0]) for i in range(0, 401)] + [(1000, [5.0, 5.0]), (1000, [5.0, 5.0])]
    odd = [(500, None), (600, []), (700, [0.0, 0.0]), (800, [1.0, None]), (900, [float("nan"), 1.0]),
           (1100, [float("inf"), 1.0]), (None, [1.0, 2.0])]
    assert search(spark, ok + odd) == brute(ok, 10)
    assert search(spark, [(100, [1.0]), (7, [3.0])]) == {(100, 1, 7, 2.0)}
    assert search(spark, []) == set()


def test_crowded_buckets_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_VECTORS", 50)
    monkeypatch.setattr(neighbours, "TILE_QUERIES", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(900)]
    got, want = search(spark, rows), brute(rows, 10)
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)


def test_perturbed_cells_rise_in_cost():
    rest = np.array([0.1, 0.4, 0.7])
    cells = list(neighbours.perturbed(np.zeros(3, int), rest, 27))
    cost = [sum(np.where(c < 0, rest**2, 0)) + sum(np.where(c > 0, (1 - rest) ** 2, 0)) for c in cells]
    assert len({tuple(c) for c in cells}) == 27
    assert cost == sorted(cost)


def test_rerank_is_exact_with_ties_and_far_from_the_origin():
    rng = np.random.default_rng(8)
    cases = {
        "binary": np.unique(rng.integers(0, 2, size=(4000, 24)).astype(float), axis=0),
        "far": 1e5 + rng.normal(size=(3000, 8)) * 1e-3,
        "outlier": np.vstack([rng.normal(size=(500, 3)), [[1e150, 0, 0]]]),
        "overflow": np.vstack([rng.normal(size=(50, 3)), [[1e300, 0, 0]]]),
        "few": rng.normal(size=(3, 2)),
    }
    for name, vectors in cases.items():
        vectors = rng.permutation(vectors)
        tile = neighbours._Tile((0, 0, 0), 10)
        tile.queries = [(i, v) for i, v in enumerate(vectors[:600])]
        with np.errstate(all="ignore"):
            for start in range(0, len(vectors), 1100):
                part = vectors[start : start + 1100]
                tile.meet(part, [[start + i] for i in range(len(part))])
            for q, own in zip(vectors[:600], tile.best):
                d = np.sqrt(((vectors - q) ** 2).sum(axis=1))
                assert own == sorted(zip(d.tolist(), range(len(d))))[:11], name
