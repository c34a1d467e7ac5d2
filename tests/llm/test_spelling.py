import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import SCHEMA, documents
from wareline.llm import spelling as S


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point tells them apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def vocabulary(rng, n, letters="abcé", least=6, most=12):
    found = {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)}
    for word in list(found):
        at = rng.randrange(len(word))
        found |= {word[:at] + rng.choice(letters) + word[at + rng.randrange(2) :], word + word[-1]}
        if len(word) > least:
            found.add(word[:at] + word[at + 1 :])
    return sorted(found)


def all_pairs(words):
    return {(a, b) for a in words for b in words if one_edit(a, b)}


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_suffix_array_is_sorted(n):
    rng = np.random.default_rng(n)
    text = np.append(rng.integers(1, 3, n), 0)
    want = sorted(range(n + 1), key=lambda i: text[i:].tolist())
    assert S.suffix_array(text).tolist() == want


def test_states_stay_in_step_when_extended_at_either_end():
    rng = random.Random(3)
    words = vocabulary(rng, 60)
    index = S.BidirectionalIndex(words, "abcé")
    joined = "$" + "$".join(words) + "$"
    for _ in range(200):
        state, text = index.everywhere(1), ""
        for _ in range(rng.randrange(1, 9)):
            c, left = rng.choice("abcé$"), rng.random() < 0.5
            text = c + text if left else text + c
            symbol = np.array([S.EDGE if c == "$" else index.code[c]])
            state = S._matched(index, state, symbol, left)
            count = sum(joined.startswith(text, i) for i in range(len(joined)))
            assert state[0, 2] == count
            if not count:
                break
            places = index.forward.suffixes[state[0, 0] : state[0, 0] + count]
            assert all(joined.startswith(text, i) for i in places)
            turned = index.reverse.suffixes[state[0, 1] : state[0, 1] + count]
            assert all(joined[::-1].startswith(text[::-1], i) for i in turned)


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnop"])
def test_both_schemes_find_every_near_pair(letters, monkeypatch):
    monkeypatch.setattr(S, "STATE_BLOCK", 37)
    words = vocabulary(random.Random(8), 150, letters)
    found = {(words[q], w) for half in (True, False) for q, w in S.near_pairs(words, words, half)}
    assert found == all_pairs(words)


@pytest.mark.parametrize("shard_chars", [40, 400, 1 << 16])
def test_near_words_equal_all_pairs_whatever_the_shards(spark, shard_chars):
    rng = random.Random(9)
    words = vocabulary(rng, 60)
    # A crowded half: many words that begin alike, and as many that end alike.
    words += ["prefix" + "".join(rng.choice("xyz") for _ in range(6)) for _ in range(60)]
    words += ["".join(rng.choice("xyz") for _ in range(6)) + "suffix" for _ in range(60)]
    words = sorted(set(words))
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [tuple(r) for r in S.near_words(df, shard_chars).collect()]
    assert set(got) == all_pairs(words) and len(got) == len(set(got))


def test_very_long_words():
    word = "ab" * 3000
    other = word[:2500] + "c" + word[2500:]
    found = {(q, w) for half in (True, False) for q, w in S.near_pairs([word], [word, other], half)}
    assert found == {(0, other)}


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in __import__("re").findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in kept if one_edit(w, x)] for w in kept}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-kept[x], x), default=None)
        form[w] = best if best is not None and kept[best] >= 5 * kept[w] else None
    out = []
    for w in kept:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, kept[w], len(near[w]), kept[form[w]] if form[w] else None))
    return sorted(out)


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    stock = vocabulary(rng, 40, "abcdé", 6, 8)
    weights = [1 / (1 + i) ** 1.2 for i in range(len(stock))]
    rng.shuffle(stock)
    extra = [
        (1000 + i, " ".join(
            w.upper() if rng.random() < 0.1 else w for w in rng.choices(stock, weights, k=400)
        ) + ". Ünïcode,") for i in range(60)
    ]
    # A chain of forms: each word is five times as frequent as the one before.
    for n, word in ((5, "chainsaaa"), (25, "chainsaab"), (125, "chainsabb"), (625, "chainsbbb")):
        extra += [(None, f" {word}" * n)]
    extra.append(extra[0])
    docs = documents(spark, extra)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert ("chainsaaa", "chainsaab", "chainsbbb", 5, 1, 25) in want
    got = sorted(map(tuple, S.variants(docs).collect()))
    assert got == want
    assert S.variants(spark.createDataFrame([], SCHEMA)).count() == 0
