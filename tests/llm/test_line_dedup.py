import random

import numpy as np
import pytest

from tests.llm.fixtures import SCHEMA, documents
from wareline.llm import line_dedup as L

EDGES = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(EDGES))


def brute(rows, counted=None, least=3):
    """``counted`` are the rows whose lines count; by default all."""
    holders = {}
    for doc_id, text in rows if counted is None else counted:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                holders.setdefault(key_of(line), set()).add(doc_id)
    blocked = {k: max(h) for k, h in holders.items() if len(k) >= 20 and len(h) >= least}
    out = []
    for doc_id, text in rows:
        found = (text or "").split("\n")
        kept = [
            x for x in found
            if doc_id is None or blocked.get(key_of(x), doc_id) == doc_id
        ]
        out.append((doc_id, len(found), len(found) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def sample(n, seed=1, first=100):
    rng = random.Random(seed)
    common = [f"Common line number {i:04d} of the pages" for i in range(12)]
    shapes = [str, str.upper, lambda x: f"\t {x}\r", lambda x: f"\x0b{x} \x0c"]
    rows = []
    for i in range(n):
        found = [rng.choice(shapes)(rng.choice(common)) for _ in range(rng.randrange(6))]
        found += [f"own line {rng.randrange(3 * n)} that is long enough" for _ in range(rng.randrange(4))]
        found += [rng.choice(["", "short", "x" * 19, "y" * 20, "é" * 20, " " + "z" * 19])]
        rng.shuffle(found)
        rows.append((first + i, "\n".join(found)))
    return rows


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("n", [1, 3, 8, 1000])
def test_filter_holds_what_was_inserted_and_not_deleted(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**64, 2 * n + 2, dtype=np.uint64))
    keys, others = keys[:n], rng.integers(0, 2**64, 50_000, dtype=np.uint64)
    cuckoo = L.CuckooFilter.sized(n)
    cuckoo.insert(keys)
    assert cuckoo.holds(keys).all() and cuckoo.holds(others).mean() < 0.01
    cuckoo.delete(keys[::2])
    cuckoo = L.CuckooFilter.read(*cuckoo.written())
    assert cuckoo.holds(keys[1::2]).all() and cuckoo.keys == n // 2
    cuckoo.delete(keys[1::2])
    assert not cuckoo.table.any() and not len(cuckoo.stash)


def test_overfull_and_colliding_filters_lose_nothing():
    cuckoo = L.CuckooFilter.sized(8)
    keys = np.arange(1, 300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    twins = np.full(20, 5 << 48, dtype=np.uint64) + (np.arange(20, dtype=np.uint64) << np.uint64(40))
    cuckoo.insert(np.concatenate([keys, twins]))
    assert len(cuckoo.stash) and cuckoo.holds(keys).all() and cuckoo.holds(twins).all()
    cuckoo.delete(keys)
    assert cuckoo.holds(twins).all()
    cuckoo.delete(twins)
    assert not cuckoo.table.any() and not len(cuckoo.stash)


def test_dedup_equals_brute_force(spark):
    rows = sample(60)
    again = [(100, rows[1][1]), rows[2], rows[2]]
    docs = documents(spark, rows + again)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(w[2] for w in want) > 20
    assert got(L.dedup(docs)) == want
    assert L.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deleting_documents_undoes_their_insertion(spark, tmp_path):
    one, two = sample(40), sample(30, seed=2, first=1000)
    path = str(tmp_path / "store")
    first = L.LineStore(spark, path, shard_keys=4).insert(frame(spark, one))
    both = first.insert(frame(spark, two))
    assert got(both.clean(frame(spark, one + two))) == brute(one + two)
    ids = frame(spark, two).select("doc_id")
    back = both.delete(ids)
    assert got(back.clean(frame(spark, one))) == brute(one)
    # The largest holders go, so lines pass to other owners.
    last = back.delete(frame(spark, one[30:]).select("doc_id"))
    assert got(last.clean(frame(spark, one[:30]))) == brute(one[:30])
    held = {bytes(r.digest): (r.docs, r.owner) for r in last.blocked_keys().collect()}
    fresh = L.LineStore(spark, str(tmp_path / "fresh")).insert(frame(spark, one[:30]))
    assert held == {bytes(r.digest): (r.docs, r.owner) for r in fresh.blocked_keys().collect()}
    # New documents meet the lines of earlier ones; versions stay readable.
    assert got(first.clean(frame(spark, two))) == brute(two, counted=one)
    opened = L.LineStore.open(spark, path)
    assert (opened.version, opened.shards) == (4, last.shards) and opened.shards > 1
    assert got(L.LineStore.open(spark, path, 1).clean(frame(spark, one))) == brute(one)
    nothing = last.delete(frame(spark, one).select("doc_id"))
    assert nothing.blocked_keys().count() == 0 and nothing.references().count() == 0
    with pytest.raises(Exception, match="exist"):
        first.insert(frame(spark, two))


def test_filters_pass_blocked_keys_and_few_others(spark, tmp_path):
    rows = sample(80)
    store = L.LineStore(spark, str(tmp_path / "store"), shard_keys=2).insert(frame(spark, rows))
    digests = L.lines(frame(spark, rows)).select("digest").distinct()
    filters = store._table(store.filters, L.FILTERS)
    passed = {bytes(r.digest) for r in L.passing(digests, filters, store.shards, 3).collect()}
    blocked = {bytes(r.digest) for r in store.blocked_keys().collect()}
    assert blocked <= passed and len(passed) < digests.count()
