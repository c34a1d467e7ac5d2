"""Spelling variants by search schemes over bidirectional FM-indexes.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. A word cut into two halves and held against a near word matches one
half exactly: the first as a prefix or the second as a suffix. So there are two
searches a word. Each matches a half exactly, outwards from the cut, and then
extends across the other half allowing one error, both ends anchored by
delimiters. The state is an interval of suffix ranks in the index of the
delimited vocabulary and the matching one in the index of its reversal, so it
can be extended at either end.

No task holds the vocabulary. Words to be found are dealt by the half that
would match (the prefixes and suffixes of the lengths that a word one shorter,
equal or one longer would be cut at), and queries by their own halves, so both
meet in one shard. A shard is a hash of halves, or for a crowded half a block
of its words, which its queries visit one by one; shards hold some
``SHARD_CHARS`` code points and their number grows with the vocabulary.

Counts are combined per batch before the exchange. Forms are followed to their
roots by doubling: each round joins the table of words with a form to itself.

Null and empty texts have no words; a null id stands as the text ``null`` in the
hash that deletes code points. Equal rows count each. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wareline.session import written

LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
#: Code points of words indexed together.
SHARD_CHARS = 1 << 16
SHARDS_PER_TASK = 8
#: Distinct words counted in a task before they are passed on.
COUNT_WORDS = 1 << 18
#: States extended at once; bounds the memory of a search.
STATE_BLOCK = 1 << 12
RUN = re.compile("[a-zÀ-ÿ]+")
END, EDGE = 0, 1


def seeded_slip(doc_id, run: str) -> str:
    """The contract's change: a code point less where the hash says so."""
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    if h % 199:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame,
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    change: Callable = seeded_slip,
) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Lower case of bytes touches A-Z alone.
                lowered = (text.as_py() or b"").lower().decode("utf-8", "replace")
                for run, n in Counter(RUN.findall(lowered)).items():
                    word = change(doc_id, run)
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) > COUNT_WORDS:
                    yield passed()
                    held.clear()
        if held:
            yield passed()

    texts = docs.select("doc_id", F.col(text_col).cast("binary").alias("text"))
    found = texts.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the sorted length."""
    rank, size, n = text.astype(np.int64), 1, len(text)
    while True:
        following = np.zeros(n, np.int64)
        following[: n - size] = rank[size:] + 1
        both = rank * (n + int(rank.max()) + 2) + following
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1 or size >= n:
            return order
        size *= 2


class FMIndex:
    """Symbols before each suffix in rank order, with counts up to every rank."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.suffixes = suffix_array(text)
        before = text[self.suffixes - 1]
        hot = np.zeros((len(text) + 1, symbols), np.int32)
        hot[np.arange(1, len(text) + 1), before] = 1
        self.upto = np.cumsum(hot, axis=0, dtype=np.int32)
        totals = np.bincount(text, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(totals)[:-1]]).astype(np.int64)

    def steps(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per interval and symbol: how many before it, how many inside."""
        start = self.upto[low]
        return start, self.upto[low + size] - start


class BidirectionalIndex:
    """Delimited words indexed both ways.

    A state is ``(ahead, back, size)``: the lowest rank in the index of the text
    and in that of its reversal, and the number of places.
    """

    def __init__(self, words: list[str], letters: str):
        self.words = sorted(words)
        self.code = {c: i + 2 for i, c in enumerate(letters)}
        joined = [EDGE]
        starts = np.zeros(len(self.words), np.int64)
        for at, word in enumerate(self.words):
            starts[at] = len(joined)
            joined += [self.code[c] for c in word]
            joined.append(EDGE)
        symbols = len(letters) + 2
        text = np.array(joined, np.int64)
        self.forward = FMIndex(np.append(text, END), symbols)
        self.reverse = FMIndex(np.append(text[::-1], END), symbols)
        # Which word begins behind the delimiter of a rank.
        self.word_at = np.searchsorted(starts, self.forward.suffixes + 1)

    def everywhere(self, n: int) -> np.ndarray:
        """``n`` states that match the empty string; columns ahead, back, size."""
        return np.tile([0, 0, len(self.forward.suffixes)], (n, 1)).astype(np.int64)

    def options(self, states: np.ndarray, leftwards: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts per state and symbol: ranks before, inside, and inside of lesser symbols."""
        index = self.forward if leftwards else self.reverse
        before, inside = index.steps(states[:, 0 if leftwards else 1], states[:, 2])
        lesser = np.cumsum(inside, axis=1) - inside
        return before, inside, lesser

    def extended(self, states, options, rows, symbols, leftwards: bool) -> np.ndarray:
        """States of ``rows`` with ``symbols`` added at one end; some may be empty."""
        before, inside, lesser = options
        index = self.forward if leftwards else self.reverse
        own, other = (0, 1) if leftwards else (1, 0)
        out = np.empty((len(rows), 3), np.int64)
        out[:, own] = index.first[symbols] + before[rows, symbols]
        out[:, other] = states[rows, other] + lesser[rows, symbols]
        out[:, 2] = inside[rows, symbols]
        return out


def _matched(index: BidirectionalIndex, states, symbols: np.ndarray, leftwards: bool):
    """States extended exactly, each by its own symbol."""
    rows = np.arange(len(states))
    options = index.options(states, leftwards)
    return index.extended(states, options, rows, symbols, leftwards)


def search_scheme(
    index: BidirectionalIndex, queries: list[str], first_half: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query and word numbers at one error in the half that may differ.

    ``first_half`` tells which half matches exactly. A pair may come more than
    once, by different alignments.
    """
    for start in range(0, len(queries), STATE_BLOCK):
        yield from _search_block(index, queries[start : start + STATE_BLOCK], first_half, start)


def _search_block(index, queries, first_half, base):
    code, n = index.code, len(queries)
    cut = np.array([len(q) // 2 for q in queries])
    # Symbols in the order of matching: the exact half outwards from the cut,
    # its delimiter, then the other half outwards, its delimiter.
    exact_size = np.array([c if first_half else len(q) - c for q, c in zip(queries, cut)]) + 1
    other_size = np.array([len(q) for q in queries]) + 2 - exact_size
    exact = np.full((n, int(exact_size.max())), EDGE)
    other = np.full((n, int(other_size.max())), EDGE)
    for row, (query, at) in enumerate(zip(queries, cut)):
        left, right = [code[c] for c in query[:at][::-1]], [code[c] for c in query[at:]]
        inner, outer = (left, right) if first_half else (right, left)
        exact[row, : len(inner)] = inner
        other[row, : len(outer)] = outer
    states, alive = index.everywhere(n), np.arange(n)
    for step in range(exact.shape[1]):
        moving = step < exact_size[alive]
        moved = _matched(index, states[moving], exact[alive[moving], step], first_half)
        states = np.concatenate([states[~moving], moved])
        alive = np.concatenate([alive[~moving], alive[moving]])
        states, alive = states[states[:, 2] > 0], alive[states[:, 2] > 0]
    leftwards = not first_half
    # Branches have spent their error; ``at`` is the next symbol each must match.
    branches, owner, at = states[:0], alive[:0], alive[:0]
    for step in range(other.shape[1] + 2):
        if len(alive):
            options = index.options(states, leftwards)
            inside, here = options[1], other[alive, step] if step < other.shape[1] else None
            rows, symbols = np.nonzero(inside[:, 2:])
            symbols = symbols + 2
            spread = index.extended(states, options, rows, symbols, leftwards)
            letters_left = other_size[alive] - 1 > step
            added = (spread, alive[rows], np.full(len(rows), step))
            changes = letters_left[rows] & (symbols != here[rows])
            changed = (spread[changes], alive[rows][changes], np.full(int(changes.sum()), step + 1))
            lacking = (states[letters_left], alive[letters_left], np.full(int(letters_left.sum()), step + 1))
            branches = np.concatenate([branches, added[0], changed[0], lacking[0]])
            owner = np.concatenate([owner, added[1], changed[1], lacking[1]])
            at = np.concatenate([at, added[2], changed[2], lacking[2]])
            going = np.flatnonzero(letters_left)
            states = index.extended(states, options, going, here[going], leftwards)
            alive = alive[going]
            states, alive = states[states[:, 2] > 0], alive[states[:, 2] > 0]
        if not len(branches):
            continue
        found, branches, owner, at = _advance(index, branches, owner, at, other, other_size, leftwards)
        if found is not None:
            yield base + found[0], found[1]
    while len(branches):
        found, branches, owner, at = _advance(index, branches, owner, at, other, other_size, leftwards)
        if found is not None:
            yield base + found[0], found[1]


def _advance(index, branches, owner, at, other, other_size, leftwards):
    """Branches one symbol on; those past their delimiter are whole words."""
    moved = _matched(index, branches, other[owner, at], leftwards)
    left = moved[:, 2] > 0
    moved, owner, at = moved[left], owner[left], at[left] + 1
    whole = at == other_size[owner]
    found = None
    if whole.any():
        # Words are distinct, so each state is one place: its leading delimiter.
        found = owner[whole], index.word_at[moved[whole, 0]]
    return found, moved[~whole], owner[~whole], at[~whole]


def near_pairs(queries: list[str], words: list[str], first_half: bool) -> list[tuple[int, str]]:
    """Distinct (number of the query, near word) with the given half matching."""
    if not queries or not words:
        return []
    letters = "".join(sorted(set("".join(queries)) | set("".join(words))))
    index, found = BidirectionalIndex(words, letters), set()
    for mine, theirs in search_scheme(index, queries, first_half):
        found.update(zip(mine.tolist(), theirs.tolist()))
    return [(q, index.words[w]) for q, w in sorted(found) if index.words[w] != queries[q]]


def _halves(first_half: bool) -> tuple[Column, Column]:
    """The half a query must match, and the parts at which a word may be found."""
    size = F.length("word")
    cuts = F.array_distinct(F.array(*[F.floor((size + d) / 2) for d in (-1, 0, 1)]))
    if first_half:
        return F.expr("left(word, int(length(word) div 2))"), F.transform(
            cuts, lambda cut: F.substring("word", F.lit(1), cut.cast("int"))
        )
    rests = F.array_distinct(
        F.array(*[size + d - F.floor((size + d) / 2) for d in (-1, 0, 1)])
    )
    return F.expr("right(word, int(length(word) - length(word) div 2))"), F.transform(
        rests, lambda rest: F.expr("word").substr(size - rest.cast("int") + 1, rest.cast("int"))
    )


def near_words(
    words: DataFrame, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """Pairs ``word``, ``near`` of the distinct words that one edit tells apart.

    ``words`` has ``word``; both directions of a pair are returned.
    """
    sides = []
    for first_half in (True, False):
        asked, offered = _halves(first_half)
        side = F.lit(first_half).alias("first_half")
        sides.append(
            (
                words.select(side, asked.alias("half"), "word"),
                words.select(side, F.explode(offered).alias("half"), "word"),
            )
        )
    queries = sides[0][0].unionByName(sides[1][0])
    targets = written(sides[0][1].unionByName(sides[1][1]), "halves")
    key = ["first_half", "half"]
    # Blocks by characters; only crowded halves have more than one.
    crowded = (
        targets.groupBy(key)
        .agg(F.sum(F.length("word") + 1).alias("chars"))
        .where(F.col("chars") > shard_chars)
        .select(*key, F.ceil(F.col("chars") / shard_chars).cast("int").alias("blocks"))
    )
    crowded = written(crowded, "crowded")
    total = targets.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    shards = 1 + int(total) // shard_chars
    shard = F.pmod(F.xxhash64("first_half", "half"), F.lit(shards)).cast("int")
    alone = F.concat_ws(":", "first_half", F.col("half"))
    own = F.when(F.col("blocks").isNotNull(), alone).otherwise(F.concat_ws(":", "first_half", shard))
    targets = targets.join(crowded, key, "left").select(
        "first_half",
        own.alias("shard"),
        F.coalesce(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"), F.lit(0)).alias("block"),
        "word",
    )
    queries = queries.join(crowded, key, "left").select(
        "first_half",
        own.alias("shard"),
        F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"),
        "word",
    )

    def search(asked: pa.Table, offered: pa.Table) -> pa.Table:
        queries, pairs = asked.column("word").to_pylist(), []
        if asked.num_rows and offered.num_rows:
            first_half = asked.column("first_half")[0].as_py()
            held = sorted(set(offered.column("word").to_pylist()))
            pairs = near_pairs(queries, held, first_half)
        return pa.table(
            {
                "word": pa.array([queries[q] for q, _ in pairs], pa.string()),
                "near": pa.array([w for _, w in pairs], pa.string()),
            }
        )

    at = ["shard", "block"]
    # By number: a shard of few bytes is much work, so none are joined by size.
    parts = 1 + shards // SHARDS_PER_TASK
    queries, targets = queries.repartition(parts, *at), targets.repartition(parts, *at)
    met = queries.groupBy(at).cogroup(targets.groupBy(at))
    return met.applyInArrow(search, "word string, near string").distinct()


def forms(counted: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form`` and ``form_n``.

    The form is the most frequent near word, the least of equals, if it is
    ``ratio`` times as frequent.
    """
    near = pairs.join(counted.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"),
    )
    form_n = -F.col("best.rank")
    strong = form_n >= ratio * F.col("n")
    return counted.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, form_n).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """Add ``root``: where the chain of forms ends.

    A form is more frequent than its word, so chains end; after k rounds each
    word knows the word 2^k forms on.
    """
    links = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    links = written(links, "links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(links.join(onward, "root", "left"), "links")
        if stepped.where(F.col("next").isNotNull()).isEmpty():
            break
        links = stepped.select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """All words of ``docs`` with their near words, forms and roots."""
    counted = written(count_words(docs, text_col, **settings), "words")
    formed = written(forms(counted, near_words(counted.select("word"))), "forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
