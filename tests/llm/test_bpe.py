import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.fixtures import documents
from wareline.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_same_ids_and_texts_as_the_library():
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzàéßñüΣσıİ0123456789'!#$% \t\n\x85  日本語\U0001f600\x1c\x00\x7f"
    texts = ["", " ", "a<|endoftext|>B <|startoftext|>", "it's we'LL I'd", "ΟΔΟΣ", "é é", "ab" * 3000]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    vocabulary, library = bpe.load(PATH), reference()
    for text, (ids, said) in zip(texts, vocabulary.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(text)
        assert said == library.decode(want, skip_special_tokens=False) == vocabulary.decode(want)


def test_short_and_long_merging_agree():
    vocabulary, rng = bpe.load(PATH), random.Random(2)
    for n in range(bpe.SHORT + 1, bpe.SHORT + 40):
        symbols = [rng.choice("etaoinsh") for _ in range(n)]
        assert vocabulary.merge(symbols) == vocabulary._merge_short(symbols)


def test_whole_table(spark):
    docs, library = documents(spark), reference()
    got = sorted(map(tuple, bpe.digests(docs, PATH).collect()), key=repr)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        said = library.decode(ids, skip_special_tokens=False).encode()
        want.append((r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(said).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.tokenized(docs.limit(0), PATH).count() == 0
    assert bpe.tokenized(docs.where("doc_id = 7"), PATH).first().decoded == "one</w> two</w>"
