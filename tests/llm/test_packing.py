import random

from pyspark.sql import functions as F

from tests.llm.fixtures import SCHEMA, documents
from wareline.llm import packing


def brute(items, capacity):
    bins, out = [], []
    for size, source, cluster in items:
        fits = [
            (capacity - sum(s for s, _, _ in b), n) for n, b in enumerate(bins)
            if sum(s for s, _, _ in b) + size <= capacity
            and all((source is None or source != s) and (cluster is None or cluster != c) for _, s, c in b)
        ]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        out.append((n, sum(s for s, _, _ in bins[n])))
        bins[n].append((size, source, cluster))
    return out


def test_place_is_the_tightest_compatible_bin():
    rng = random.Random(4)
    items = sorted(
        ((rng.randrange(0, 60), rng.choice([None, *"aaabcdefg"]), rng.choice([None, 1, 2, *range(3, 40)]))
         for _ in range(600)), key=lambda i: -i[0])
    bins = packing.Bins(100)
    assert [bins.place(*i) for i in items] == brute(items, 100)


def test_all_words_are_packed_once(spark):
    docs = documents(spark)
    pieces = packing.items(docs, F.xxhash64("text"), capacity=64)
    got = packing.pack(pieces, rows=500, capacity=64, shard_rows=50).collect()
    filled = {}
    for r in got:
        filled.setdefault((r.shard, r.bin), []).append((r.at, r.n_words))
    for held in filled.values():
        assert sum(n for _, n in held) <= 64
        end = 0
        for at, n in sorted(held):
            assert at == end
            end += n
    want = {}
    for r in docs.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + len((r.text or "").split())
    have = {}
    for r in got:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.n_words
    assert have == want
    repeated = [r for r in got if r.doc_id == 11]
    assert {r.copy for r in repeated} <= {0, 1}
    none = packing.items(spark.createDataFrame([], SCHEMA), F.xxhash64("text"))
    assert packing.pack(none, rows=0).count() == 0
