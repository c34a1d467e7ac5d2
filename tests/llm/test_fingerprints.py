import hashlib
import re
import zlib
from collections import Counter

import pytest

from tests.llm.fixtures import SCHEMA, documents
from wareline.llm import fingerprints as P


def test_edits_against_brute_force(spark):
    docs = documents(spark, extra=[(20 + i, "tail " * i + f"t{i}") for i in range(40)])
    got = P.compare_with_edits(docs, P.lexicon(docs)).collect()
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for n, (i, t) in enumerate(rows):
        following, half = rows[(n + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    by_text = {}
    text_of = {(i, len(t)): t for i, t in rows}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(text_of[r.doc_id, r.n_chars], r.fingerprint) == r.fingerprint


def test_likeness_grows_with_what_is_shared(spark):
    docs = documents(spark, extra=[(30 + i, f"w{i} w{i + 1} w{i + 2}") for i in range(300)])
    printer = P.Printer(P.lexicon(docs, least=0.0, most=1.0))
    base = [f"w{i}" for i in range(100)]
    marks = [printer.signature(" ".join(base[:n] + [f"z{i}" for i in range(100 - n)])) for n in (100, 90, 50, 0)]
    near = [P.likeness(marks[0], m) for m in marks]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] > near[3] == 0.0


def test_one_row_no_rows_and_no_ids(spark):
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    words = P.lexicon(one)
    row = P.compare_with_edits(one, words).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    none = spark.createDataFrame([], SCHEMA)
    assert P.compare_with_edits(none, P.lexicon(none)).count() == 0
    nameless = spark.createDataFrame([(None, "ab"), (None, "cd")], "doc_id long, text string")
    assert P.compare_with_edits(nameless, words).count() == 2
    assert P.fingerprint(documents(spark), words).count() == documents(spark).count()


@pytest.mark.parametrize("gathered", [1, 50, P.GATHERED])
def test_frequencies_count_every_term_exactly(spark, gathered):
    docs = documents(spark, extra=[(20 + i, f"All w{i} w{i // 2} w{i // 9} all") for i in range(90)])
    want = Counter()
    for r in docs.collect():
        terms = set(re.findall(rb"[0-9a-z\x80-\xff]+", (r.text or "").lower().encode()))
        want.update({zlib.crc32(term) for term in terms})
    got = P.document_frequencies(docs, gathered=gathered).collect()
    assert {r.term: r.n for r in got} == want and len(got) == len(want)


def test_rare_terms_never_enter_the_lexicon(spark):
    """Many different rare words, which crowded slots would add up."""
    rare = [(100 + i, " ".join(f"r{i}x{j}" for j in range(3000)) + f" c{i % 40}") for i in range(400)]
    words = P.lexicon(spark.createDataFrame(rare, "doc_id long, text string"))
    assert set(words.terms.tolist()) == {zlib.crc32(f"c{i}".encode()) for i in range(40)}


def test_fingerprints_and_likeness_against_brute_force(spark):
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(1, 60))) for i in range(1, 120)] + [(0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms_of = {i: {zlib.crc32(w.encode()) for w in t.split()} for i, t in rows}
    counts = Counter(h for terms in terms_of.values() for h in terms)
    band = {h for h, n in counts.items() if max(2.0, 0.002 * 120) <= n <= 0.5 * 120}

    def mixed(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % 2**64
        return ((x ^ (x >> 27)) * 0x94D049BB133111EB) % 2**64 >> 32

    limits = [int(r * 2**32) for r, n in zip(P.RATES, P.PARTS) for _ in range(n)]
    seeds = [(k * 0x9E3779B97F4A7C15) % 2**64 for k in range(1, P.SUBSETS + 1)]

    def parts(terms):
        chosen = sorted(terms & band)
        return [tuple(h for h in chosen if mixed(h ^ s) < limit) for s, limit in zip(seeds, limits)]

    def alike(a, b):
        if a & band == b & band and (a & band or a == b):
            return 1.0
        pairs = [(x, y) for x, y in zip(parts(a), parts(b)) if x or y]
        return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0

    got = {r.doc_id: r for r in P.compare_with_edits(docs, P.lexicon(docs, most=0.5)).collect()}
    ids = sorted(got, reverse=True)
    for n, i in enumerate(ids):
        assert got[i].near_next == alike(terms_of[i], terms_of[ids[(n + 1) % len(ids)]])
    for i in ids[:40]:
        for j in ids:
            same = terms_of[i] & band == terms_of[j] & band
            assert not terms_of[j] & band or (got[i].fingerprint == got[j].fingerprint) == same
