import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from tests.llm.fixtures import SCHEMA, documents
from wareline.llm import periodic_runs as P


def brute(words, least=12):
    """Runs by the definition: every lag compared word by word."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("aab"), max_size=90), st.integers(2, 12))
def test_runs_equal_the_definition(words, least):
    assert P.find_runs(words, least) == brute(words, least)


def test_runs_in_mixed_texts_equal_the_definition():
    rng = random.Random(5)
    for _ in range(150):
        words = []
        while len(words) < rng.randrange(1, 260):
            kind = rng.randrange(3)
            if kind == 0:
                words += [f"w{rng.randrange(60)}" for _ in range(rng.randrange(30))]
            else:
                part = [f"w{rng.randrange(5 * kind)}" for _ in range(rng.randrange(1, 14))]
                words += part * rng.randrange(1, 8) + part[: rng.randrange(len(part))]
        assert P.find_runs(words) == brute(words)


def test_segments_hold_no_rare_word_and_lose_no_run():
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    words[500:560] = ["x", "y", "z"] * 20
    kept = P.segments(words)
    for low, high in kept:
        held = words[low:high]
        assert high - low >= 12 and min(held.count(w) for w in set(held)) >= 2
    assert any(low <= 500 and 560 <= high for low, high in kept)


def test_misleading_hashes_fall_back_to_words(monkeypatch):
    codes = np.array([0, 1, 2] * 8 + [3] + [4, 5] * 9 + [0] * 14)
    right = P.lag_scan(codes)
    assert right == brute(codes.tolist())
    monkeypatch.setattr(P, "_MIX", np.uint64(0))
    assert P.lag_scan(codes) == right


def test_long_texts_of_few_words_take_little_time():
    words = ["a", "b"] * 60_000 + ["c"] + ["a"] * 30_000
    assert P.find_runs(words) == [(0, 120_000, 2), (120_001, 30_000, 1)]
    chain = [w for i in range(40_000) for w in (f"x{i + 1}", f"x{i}")]
    assert P.find_runs(chain) == []


def expected(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_report_equals_brute_force(spark):
    tens = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    extra = [(i, " ".join(f"w{i}{k % 37}" for k in range(n))) for n, i in enumerate(tens, 20)]
    extra += [(500, "a b\x0bc " * 30), (501, "na ve x " * 9), (tens[0], "one")]
    docs = documents(spark, extra).where("doc_id is null or doc_id <> 9")
    want = sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=repr)
    got = sorted(map(tuple, P.report(docs).collect()), key=repr)
    assert got == want
    assert P.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_and_collapsed_texts(spark):
    docs = spark.createDataFrame(
        [(1, "go " * 15 + "on"), (2, None), (3, "\n\t"), (1, "go " * 15 + "on")],
        "doc_id long, text string",
    )
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in P.runs(docs).collect()]
    assert sorted(got) == [
        (1, [(0, 15, 1)], "go on"), (1, [(0, 15, 1)], "go on"), (2, [], ""), (3, [], "")
    ]
