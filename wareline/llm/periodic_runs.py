"""Periodic runs of words, by recursive frequency splitting and a lag scan.

Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch of consecutive words with
smallest period q, at least ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods
long, that cannot be extended at either end keeping the period. Each of its
words occurs in it at least ``LEAST_PERIODS`` times. So a word that occurs more
rarely in a segment lies in no run there: it splits the segment, which may make
other words too rare for their part, and so on until nothing changes. What is
left of ordinary prose is little.

Surviving segments are scanned lag by lag. A run of period q holds two whole
periods, hence some words i and i + q where q divides i; only those are
compared, n/1 + n/2 + ... of them. Where they are equal, the length of the
match is found forwards and backwards by bisection over prefix hashes. Each
run is then compared word by word; should hashes have misled, its lag is
scanned plainly. A text of n words takes about n log^2 n steps, whatever it
holds, and stays within one row of one task.

Words of a run after its first period are dropped in the collapsed text.

Null and empty texts have no words and no runs. Equal rows give equal results.
A null id leaves the text as it is where ids seed changes. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from wareline.llm.common import map_batches

LEAST_WORDS, LEAST_PERIODS = 12, 2
#: Word pairs compared at once; bounds the memory of the scan.
PAIR_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

Run = tuple[int, int, int]


def segments(
    words: list, least_words: int = LEAST_WORDS, times: int = LEAST_PERIODS
) -> list[tuple[int, int]]:
    """Stretches [low, high) in which every word occurs at least ``times`` times.

    A split hands the counts of a segment to its longest part and counts only
    the others, so a word is counted a logarithmic number of times.
    """
    places: dict = {}
    for at, word in enumerate(words):
        places.setdefault(word, []).append(at)
    counts = {word: len(found) for word, found in places.items()}
    todo = [(0, len(words), counts, [w for w, n in counts.items() if n < times])]
    done = []
    while todo:
        low, high, counts, rare = todo.pop()
        if high - low < least_words:
            continue
        cuts = []
        for word in rare:
            found = places[word]
            first = bisect_left(found, low)
            cuts += found[first : bisect_left(found, high, first)]
        if not cuts:
            done.append((low, high))
            continue
        cuts.sort()
        parts = [p for p in zip([low, *(c + 1 for c in cuts)], [*cuts, high]) if p[1] > p[0]]
        if not parts:
            continue
        longest = max(parts, key=lambda p: p[1] - p[0])
        keep = longest[1] - longest[0] >= least_words
        if keep:
            for word in rare:
                counts.pop(word, None)
            lost = set()
        for part in parts:
            if part is longest:
                continue
            if keep:
                for word in words[part[0] : part[1]]:
                    counts[word] -= 1
                    if counts[word] < times:
                        lost.add(word)
            if part[1] - part[0] >= least_words:
                own = Counter(words[part[0] : part[1]])
                todo.append((*part, own, [w for w, n in own.items() if n < times]))
        if keep:
            todo.append((*longest, counts, list(lost)))
    return sorted(done)


class _Prefixes:
    """Lengths of common stretches of one array, by hashes modulo 2^64."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
        mixed ^= mixed >> np.uint64(29)
        self.power = np.ones(n + 1, dtype=np.uint64)
        np.multiply.accumulate(np.full(n, _BASE), out=self.power[1:])
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mixed * self.power[:n], out=self.total[1:])
        self.n = n

    def _equal(self, at, lag, size):
        mine = (self.total[at + size] - self.total[at]) * self.power[lag]
        return mine == self.total[at + lag + size] - self.total[at + lag]

    def ahead(self, at: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """How many words from ``at`` on equal those ``lag`` later."""
        return self._bisect(at, lag, self.n - lag - at, lambda size: at)

    def back(self, at: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """How many words before ``at`` equal those ``lag`` later."""
        return self._bisect(at, lag, at, lambda size: at - size)

    def _bisect(self, at, lag, most, start):
        size = np.zeros(len(at), dtype=np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            tried = size + step
            fits = tried <= most
            tried = np.where(fits, tried, size)
            size = np.where(fits & self._equal(start(tried), lag, tried), tried, size)
            step >>= 1
        return size


def _lag_blocks(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and lags q where q divides i and i + q lies inside, in blocks."""
    first, last = 1, n // LEAST_PERIODS
    while first <= last:
        end, held = first, 0
        while end <= last and (held == 0 or held + (n - 1) // end <= PAIR_BLOCK):
            held += (n - 1) // end
            end += 1
        lags = np.arange(first, end)
        counts = (n - 1) // lags
        starts = np.cumsum(counts) - counts
        lag = np.repeat(lags, counts)
        yield (np.arange(len(lag)) - np.repeat(starts, counts)) * lag, lag
        first = end


def _plain_scan(codes: np.ndarray, lag: int, least_words: int) -> list[Run]:
    """All stretches of period ``lag``, word by word."""
    same = np.concatenate([[False], codes[:-lag] == codes[lag:], [False]]).astype(np.int8)
    turns = np.flatnonzero(np.diff(same)).reshape(-1, 2)
    need = max(least_words, LEAST_PERIODS * lag)
    return [(int(s), int(e - s) + lag, lag) for s, e in turns if e - s + lag >= need]


def lag_scan(codes: np.ndarray, least_words: int = LEAST_WORDS) -> list[Run]:
    """Runs (start, length, period) of one segment, by start, then period."""
    n = len(codes)
    if n < least_words:
        return []
    prefixes, found = _Prefixes(codes), []
    for at, lag in _lag_blocks(n):
        same = codes[at] == codes[at + lag]
        at, lag = at[same], lag[same]
        ahead, back = prefixes.ahead(at, lag), prefixes.back(at, lag)
        length = ahead + back + lag
        runs = length >= np.maximum(least_words, LEAST_PERIODS * lag)
        found.append(np.stack([(at - back)[runs], length[runs], lag[runs]], axis=1))
    if not found:
        return []
    table = np.unique(np.concatenate(found), axis=0)
    exact: dict[tuple[int, int], int] = {}
    misled = set()
    for start, length, lag in table.tolist():
        end = start + length
        # The same stretch with a smaller period has been seen: rows are sorted.
        if exact.get((start, length), lag) < lag:
            continue
        if (
            np.array_equal(codes[start : end - lag], codes[start + lag : end])
            and (start == 0 or codes[start - 1] != codes[start - 1 + lag])
            and (end == n or codes[end] != codes[end - lag])
        ):
            exact[start, length] = lag
        else:
            misled.add(lag)
    for lag in sorted(misled):
        for start, length, _ in _plain_scan(codes, lag, least_words):
            exact[start, length] = min(lag, exact.get((start, length), lag))
    return sorted((s, length, q) for (s, length), q in exact.items())


def find_runs(words: list, least_words: int = LEAST_WORDS) -> list[Run]:
    """Every run (start, length, period) of the words, by start, then period."""
    out: list[Run] = []
    for low, high in segments(words, least_words):
        numbers: dict = {}
        codes = np.array([numbers.setdefault(w, len(numbers)) for w in words[low:high]])
        out += [(low + s, length, q) for s, length, q in lag_scan(codes, least_words)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(depth)) if d == 0]


def seeded_repeat(words: list, doc_id) -> list:
    """The words of every tenth id with a tail that repeats, as its hash says.

    The contract's change: from word ``a`` on, words repeat with period ``p``.
    """
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


REPORT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_runs", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType()),
        T.StructField("exponent_milli", T.LongType()),
        T.StructField("runs_sha256", T.StringType()),
        T.StructField("collapsed_sha256", T.StringType()),
    ]
)
RUNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(
                T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
            ),
        ),
        T.StructField("collapsed", T.StringType()),
    ]
)


def _rows(batch: pa.RecordBatch):
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        # White space of byte strings is exactly \x20 and \x09-\x0D.
        yield doc_id, (text.as_py() or b"").split()


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col(text_col).cast("binary").alias("text"))


def runs(docs: DataFrame, text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Per row: its runs and its text with every run cut to one period."""

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, found, texts = [], [], []
        for doc_id, words in _rows(batch):
            mine = find_runs(words, least_words)
            ids.append(doc_id)
            found.append([dict(zip(("start", "length", "period"), r)) for r in mine])
            texts.append(b" ".join(collapsed(words, mine)).decode("utf-8", "replace"))
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                ("collapsed", pa.string()),
            ]
        )
        return pa.RecordBatch.from_pydict(
            {"doc_id": ids, "runs": found, "collapsed": texts}, schema=schema
        )

    return map_batches(_texts(docs, text_col), find, RUNS)


def report(docs: DataFrame, text_col: str = "text", change=seeded_repeat) -> DataFrame:
    """Per row: number of runs, the longest one, digests of runs and collapsed text.

    ``change(words, doc_id)`` is applied before the search.
    """

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, words in _rows(batch):
            words = change(words, doc_id)
            mine = find_runs(words)
            start = length = period = exponent = None
            if mine:
                start, length, period = min(mine, key=lambda r: (-r[1], r[0], r[2]))
                exponent = 1000 * length // period
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in mine)
            rows.append(
                (
                    doc_id, len(mine), start, length, period, exponent,
                    hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(collapsed(words, mine))).hexdigest(),
                )
            )
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        columns = [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=REPORT.names)

    return map_batches(_texts(docs, text_col), digest, REPORT)
