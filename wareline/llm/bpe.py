"""BPE encoding by speculation and verification.

A vocabulary of word-end BPE (the last symbol of a word carries a suffix) is
read from a tokenizer file: its normaliser, splitter, merges and ids. Greedy
longest match proposes the tokens of a word. A proposal is the encoding if
every adjacent pair of tokens is compatible, that is, if merging the text of
the pair gives the same two tokens; all pairs of a batch are looked up in one
vector operation and each new pair is decided once. Words with a pair that
fails, and only those, are merged exactly.

Special tokens in a text are found first, as they stand. Decoding joins the
tokens by blanks, as a tokenizer file without a decoder says. Null texts count
as empty; an empty text has no tokens. A word of any length takes time near
linear in it. Rows come back one for one, repeated ids included.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from wareline.llm.common import map_batches, texts_of

#: Words that a task remembers before it starts anew.
REMEMBERED = 400_000
#: Up to so many symbols a plain scan beats a heap.
SHORT = 64
NEVER = 1 << 60
#: Closes a word in front of the matcher; no byte is written so.
END = "\x01"
#: Code points of the pattern class ``\\s`` of the tokenizer file.
WHITE_POINTS = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITE = "".join(f"\\u{point:04x}" for point in WHITE_POINTS)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class Vocabulary:
    """One tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        kinds = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        if (
            model["type"] != "BPE"
            or steps != ["NFC", "Replace", "Lowercase"]
            or kinds != ["Split", "ByteLevel"]
            or spec["decoder"] is not None
            or spec["post_processor"] is not None
        ):
            raise ValueError("this tokenizer file is of another kind")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self.ranks = {
            (a, b): n
            for n, (a, b) in enumerate(
                m.split(" ") if isinstance(m, str) else m for m in model["merges"]
            )
        }
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {
            i: t for t, i in self.special.items()
        }
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        pattern = pattern.replace(r"[^\s", f"[^{WHITE}")
        self.words = regex.compile(pattern, regex.V0)
        self.symbols = byte_symbols()
        # Longest match reads words closed by END; tokens that end a word hold it.
        n, ends = len(self.suffix), self.suffix
        self.matcher = ahocorasick.Automaton()
        for token, number in self.ids.items():
            final = token.endswith(ends) and len(token) > n
            self.matcher.add_word(token[:-n] + END if final else token, number)
        # An inner token may reach the end of a word; such a proposal fails.
        self.bare_end = max(self.tokens) + 1
        self.matcher.add_word(END, self.bare_end)
        self.matcher.make_automaton()
        final = [i for t, i in self.ids.items() if t.endswith(ends) and len(t) > n]
        self.is_final = np.zeros(self.bare_end + 1, bool)
        self.is_final[[*final, self.bare_end]] = True
        self.pairs: dict[int, bool] = {}
        self.memory: dict[str, bytes] = {}
        self.spelt: dict[str, str] = {}

    def normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # Letter by letter: a final sigma is not treated apart. White space need
        # not be evened out, as no word holds any.
        return text.replace("Σ", "σ").lower()

    def mapped(self, word: str) -> str:
        """The word's bytes as symbols."""
        if word.isascii() and word.isprintable():
            return word
        return "".join([self.symbols[b] for b in word.encode("utf-8")])

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match: the tokens of all mapped words, and how many each has."""
        closed = END.join(words) + END
        found = [token for _, token in self.matcher.iter_long(closed)]
        flat = np.array(found, np.int64)
        ends = np.flatnonzero(self.is_final[flat])
        if len(ends) != len(words):
            raise ValueError("the vocabulary lacks a byte")
        return flat, np.diff(ends, prepend=-1)

    def merge(self, symbols: list[str]) -> list[str]:
        """Exact merging: always the pair of least rank, the leftmost first."""
        n = len(symbols)
        if n <= SHORT:
            return self._merge_short(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        parts, ranks = list(symbols), self.ranks
        heap = [
            (rank, i)
            for i in range(n - 1)
            if (rank := ranks.get((parts[i], parts[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := ranks.get((parts[before[i]], parts[i]))) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [p for p in parts if p is not None]

    def _merge_short(self, symbols: list[str]) -> list[str]:
        parts, rank = list(symbols), self.ranks.get
        ranks = [rank(pair, NEVER) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), NEVER)
        return parts

    def exact(self, word: str) -> list[str]:
        return self.merge([*word[:-1], word[-1] + self.suffix])

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the text of two tokens gives these two."""
        a, b = self.tokens[left], self.tokens[right]
        ends = b.endswith(self.suffix)
        symbols = [*a, *(b[: -len(self.suffix)] if ends else b)]
        if ends:
            symbols[-1] += self.suffix
        return self.merge(symbols) == [a, b]

    def encode_words(self, words: list[str]) -> None:
        """Remember the ids of every word in ``words`` (distinct, not known yet)."""
        mapped = [self.mapped(w) for w in words]
        flat, lengths = self.propose(mapped)
        owner = np.repeat(np.arange(len(words)), lengths)
        same = owner[1:] == owner[:-1]
        failing = np.zeros(len(words), bool)
        failing[owner[flat == self.bare_end]] = True
        same &= ~failing[owner[1:]]
        pair = (flat[:-1] << 32 | flat[1:])[same]
        kinds, which = np.unique(pair, return_inverse=True)
        known = self.pairs
        verdict = np.empty(len(kinds), bool)
        for n, key in enumerate(kinds.tolist()):
            if key not in known:
                known[key] = self._compatible(key >> 32, key & 0xFFFFFFFF)
            verdict[n] = known[key]
        failing[owner[1:][same][~verdict[which]]] = True
        coded, tokens = flat.astype("<u4").tobytes(), self.tokens
        spelt = [tokens.get(i, "") for i in flat.tolist()]
        stops = np.cumsum(lengths).tolist()
        start = 0
        for word, symbols, stop, fails in zip(words, mapped, stops, failing.tolist()):
            if fails:
                merged = self.exact(symbols)
                self.memory[word] = array("I", [self.ids[p] for p in merged]).tobytes()
                self.spelt[word] = " ".join(merged)
            else:
                self.memory[word] = coded[4 * start : 4 * stop]
                self.spelt[word] = " ".join(spelt[start:stop])
            start = stop

    def parts(self, text: str) -> list[tuple[str, bool]]:
        """Stretches of ordinary text and special tokens, in order."""
        if self.split_special is None or not any(s in text for s in self.special):
            return [(text, False)]
        pieces = self.split_special.split(text)
        return [(p, n % 2 == 1) for n, p in enumerate(pieces) if p]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """(ids, decoded text) of every text."""
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
            self.spelt.clear()
        if len(self.pairs) > 4 * REMEMBERED:
            self.pairs.clear()
        cut: list[list[str]] = []
        marked = set()
        for n, text in enumerate(texts):
            words: list[str] = []
            for part, special in self.parts(text):
                if special:
                    marked.add(n)
                    words.append(part)
                else:
                    words += self.words.findall(self.normal(part))
            cut.append(words)
        memory, spelt = self.memory, self.spelt
        # A special token's text is no word: words hold no letters with signs.
        for token, number in self.special.items() if marked else ():
            memory[token], spelt[token] = np.array([number], "<u4").tobytes(), token
        new = [w for w in set().union(*cut) if w not in memory]
        if new:
            self.encode_words(new)
        return [
            (
                np.frombuffer(b"".join(map(memory.__getitem__, words)), "<u4"),
                " ".join(map(spelt.__getitem__, words)),
            )
            for words in cut
        ]

    def decode(self, ids) -> str:
        """The tokens joined by blanks, special ones too."""
        return " ".join(self.tokens[int(i)] for i in ids if int(i) in self.tokens)


@cache
def load(path: str) -> Vocabulary:
    """One vocabulary a process; the file lies at the same path on all machines."""
    with open(path, encoding="utf-8") as file:
        return Vocabulary(json.load(file))


def tokenized(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, ids, decoded) of every whole text; no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = list(_in_chunks(load(path), texts_of(batch.column(1))))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([ids.astype(np.int64) for ids, _ in done], pa.list_(pa.int64())),
                pa.array([said for _, said in done], pa.string()),
            ],
            names=[id_col, "ids", "decoded"],
        )

    source = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType(
        [
            source.schema[0],
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return map_batches(source, run, schema)


def digests(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text; no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = load(path)
        counts, coded, said = [], [], []
        for ids, decoded in _in_chunks(vocabulary, texts_of(batch.column(1))):
            counts.append(len(ids))
            coded.append(hashlib.sha256(ids.tobytes()).hexdigest())
            said.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
             pa.array(said, pa.string())],
            names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    source = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType(
        [
            source.schema[0],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return map_batches(source, run, schema)


def _in_chunks(vocabulary: Vocabulary, texts: list[str], chars: int = 4_000_000):
    """Encode ``texts`` some at a time, so that memory follows ``chars``."""
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= chars:
            yield from vocabulary.encode(chunk)
            chunk, size = [], 0
    yield from vocabulary.encode(chunk)
