"""Approximate nearest neighbours by multiprobe p-stable hashing.

``TABLES`` hash tables cut ``K`` Gaussian projections of every vector into
cells. A query visits its own bucket and perturbed ones, in the order of the
estimated chance that a neighbour lies there. All vectors of the visited
buckets are ranked by their exact Euclidean distance in double precision; the
results of all tables are merged.

The fit is bounded: cell width and direction from at most ``SAMPLE`` vectors,
the number of cells from the row count, and the number of probes from the true
neighbours of ``PROBE_QUERIES`` queries, found over all rows. It is the least
number of probes that reaches ``TARGET`` of them; where no number does, a
projection is given up, down to one bucket, which is an exact search. Vectors
without near neighbours (spread like noise) so need most buckets.

Equal vectors are searched once and keep their ``k + 1`` smallest ids, which
is all that can rank. A bucket with many vectors or queries is cut into tiles
of bounded size, so no bucket gathers in one task.

Null vectors, empty ones, zero ones and those with null or non-finite parts
take no part; nor do rows without an id. Vectors of different length are never
compared. A repeated id counts once, as query with its least vector; a query
never meets its own id. Fewer candidates than ``k`` give fewer rows, an empty
table none. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from wareline.session import written

TABLES = 2
SAMPLE = 2000
PROBE_QUERIES = 64
TARGET = 0.97
CELL = 2.4
BUCKET_ROWS = 256
CELLS_SPLIT = 2.4
TILE_VECTORS = 8192
TILE_QUERIES = 2048

HIT = T.StructType(
    [
        T.StructField("query_key", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    part = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return part.where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & (F.size("vector") > 0)
        & sound
        & F.exists("vector", lambda x: x != 0)
    )


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vector, ids): each vector once with its ``k + 1`` smallest ids.

    The limit of the rank is applied before the shuffle too, so a vector that
    fills a third of the table leaves each task in a few rows.
    """
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    return (
        rows.withColumn("at", F.dense_rank().over(by_id))
        .where(F.col("at") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    )


@dataclass
class Tables:
    """Projections of every table and how many buckets a query visits."""

    planes: dict[int, list[tuple[np.ndarray, np.ndarray]]]
    width: float
    probes: int

    def project(self, x: np.ndarray, table: int) -> np.ndarray:
        directions, offset = self.planes[x.shape[1]][table]
        return (x @ directions) / self.width + offset

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        return np.floor(self.project(x, table)).astype(np.int64)

    def probe_cells(self, x: np.ndarray, table: int) -> Iterator[np.ndarray]:
        """For each vector the cells to visit, likeliest first."""
        at = self.project(x, table)
        base = np.floor(at)
        for cell, rest in zip(base.astype(np.int64), at - base):
            yield np.array(list(perturbed(cell, rest, self.probes)))


def perturbed(cell: np.ndarray, rest: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Cells around ``cell`` by the squared distance to the borders crossed."""
    n = len(cell)
    yield cell
    gaps = np.concatenate([rest, 1.0 - rest]) ** 2
    order = np.argsort(gaps, kind="stable")
    heap, found = ([(gaps[order[0]], (0,))] if n else []), 1
    while heap and found < most:
        cost, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < 2 * n:
            more = gaps[order[last + 1]]
            heapq.heappush(heap, (cost + more, (*chosen, last + 1)))
            heapq.heappush(heap, (cost + more - gaps[order[last]], (*chosen[:-1], last + 1)))
        moves = [order[j] for j in chosen]
        if len({m % n for m in moves}) < len(moves):
            continue  # both sides of one projection
        moved = cell.copy()
        for m in moves:
            moved[m % n] += -1 if m < n else 1
        found += 1
        yield moved


def bucket_ids(cells: np.ndarray, dims: int, table: int) -> np.ndarray:
    """One long for each row of cells, with the table and vector length in it."""
    key = np.full(len(cells), dims * 1_000_003 + table, dtype=np.uint64)
    for column in cells.T.astype(np.uint64):
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row positions, matrix) for every vector length in a list column."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, flat[starts[rows][:, None] + np.arange(length)]


def fit(rows: DataFrame, distinct: DataFrame, queries: DataFrame, k: int) -> Tables:
    """Choose the tables; see the module's text for what is looked at."""
    count, lengths = distinct.agg(
        F.count("*"), F.collect_set(F.size("vector"))
    ).first()
    sample = [
        np.array(r.vector, dtype=np.float64)
        for r in distinct.orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    ]
    spread = np.mean([np.std(np.array([v for v in sample if len(v) == d]), axis=0).mean()
                      * math.sqrt(d) for d in {len(v) for v in sample}] or [1.0])
    # A projection on a Gaussian direction deviates by the spread of the vectors.
    width = CELL * max(float(spread), 1e-9) / 1.0
    asked = [
        np.array(r.vector, dtype=np.float64)
        for r in queries.orderBy(F.xxhash64("vector"), "vector").limit(PROBE_QUERIES).collect()
    ]
    truth = _true_neighbours(distinct, asked, k)
    k_cells = max(0, round(math.log(max(count, 1) / BUCKET_ROWS) / math.log(CELLS_SPLIT)))
    while True:
        rng = np.random.default_rng(20)
        planes = {
            int(d): [
                (rng.standard_normal((int(d), k_cells)), rng.random(k_cells))
                for _ in range(TABLES)
            ]
            for d in sorted(lengths or [])
        }
        tables = Tables(planes, width, 3**k_cells if k_cells < 6 else 512)
        probes = _probes_needed(tables, asked, truth)
        if probes or not k_cells:
            tables.probes = probes or 1
            return tables
        k_cells -= 1


def _true_neighbours(distinct: DataFrame, asked: list[np.ndarray], k: int):
    """The ``k`` nearest other vectors of each asked one, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_length(batch.column(0)):
                for i, q in enumerate(asked):
                    if len(q) != x.shape[1]:
                        continue
                    d = ((x - q) ** 2).sum(axis=1)
                    d[d == 0] = np.inf
                    near = np.argsort(d)[:k]
                    near = near[np.isfinite(d[near])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(near), i), pa.int32()),
                            pa.array(d[near]),
                            pa.array(list(x[near]), pa.list_(pa.float64())),
                        ],
                        names=["query", "distance", "vector"],
                    )

    schema = "query int, distance double, vector array<double>"
    nearest = Window.partitionBy("query").orderBy("distance", "vector")
    found = (
        distinct.select("vector")
        .mapInArrow(run, schema)
        .withColumn("at", F.row_number().over(nearest))
        .where(F.col("at") <= k)
        .collect()
    )
    return [(r.query, np.array(r.vector)) for r in found]


def _probes_needed(tables: Tables, asked: list[np.ndarray], truth) -> int:
    """The least number of probes that finds ``TARGET`` of ``truth``; 0 if none does."""
    if not truth:
        return 1
    place: list[list[dict]] = []
    for q in asked:
        place.append(
            [
                {tuple(c): n for n, c in enumerate(next(tables.probe_cells(q[None], t)))}
                for t in range(TABLES)
            ]
        )
    ranks = sorted(
        min(
            place[i][t].get(tuple(tables.cells(v[None], t)[0]), 1 << 30) for t in range(TABLES)
        )
        for i, v in truth
    )
    needed = ranks[math.ceil(TARGET * len(ranks)) - 1]
    return 0 if needed >= 1 << 30 else needed + 1


def _bucketed(rows: DataFrame, tables: Tables, probing: bool) -> DataFrame:
    """(bucket, ids, vector): a row for every bucket that a vector is or looks in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows_at, x in _by_length(batch.column(1)):
                dims = x.shape[1]
                for start in range(0, len(x), 256):
                    part = x[start : start + 256]
                    at, buckets = [], []
                    for t in range(TABLES):
                        if probing:
                            for i, cells in enumerate(tables.probe_cells(part, t)):
                                buckets.append(np.unique(bucket_ids(cells, dims, t)))
                                at.append(np.full(len(buckets[-1]), rows_at[start + i]))
                        else:
                            buckets.append(bucket_ids(tables.cells(part, t), dims, t))
                            at.append(rows_at[start : start + 256])
                    take = pa.array(np.concatenate(at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(buckets)),
                            batch.column(0).take(take),
                            batch.column(1).take(take),
                        ],
                        names=["bucket", "ids", "vector"],
                    )

    schema = T.StructType([T.StructField("bucket", T.LongType()), *rows.schema.fields])
    return rows.mapInArrow(run, schema)


def _tiled(index: DataFrame, probes: DataFrame) -> DataFrame:
    """Both sides dealt to tiles; only crowded buckets have more than one."""
    sizes = (
        index.groupBy("bucket").agg(F.count("*").alias("n"))
        .join(probes.groupBy("bucket").agg(F.count("*").alias("m")), "bucket")
        .where((F.col("n") > TILE_VECTORS) | (F.col("m") > TILE_QUERIES))
        .select(
            "bucket",
            F.ceil(F.col("n") / TILE_VECTORS).cast("int").alias("rows"),
            F.ceil(F.col("m") / TILE_QUERIES).cast("int").alias("columns"),
        )
    )

    def dealt(side: DataFrame, own: str, other: str, mark: int) -> DataFrame:
        own_tiles, copies = (F.coalesce(F.col(c), F.lit(1)) for c in (own, other))
        tile = F.pmod(F.xxhash64("ids"), own_tiles).cast("int")
        copy = F.explode(F.sequence(F.lit(0), copies - 1))
        joined = side.join(sizes, "bucket", "left")
        names = (own, other)
        return joined.select(
            "bucket", tile.alias("own"), copy.alias("copy"), "ids", "vector"
        ).select(
            "bucket",
            F.col("own" if names[0] == "rows" else "copy").alias("row"),
            F.col("copy" if names[0] == "rows" else "own").alias("column"),
            F.lit(mark).alias("side"),
            "ids",
            "vector",
        )

    return dealt(probes, "columns", "rows", 0).unionByName(dealt(index, "rows", "columns", 1))


class _Tile:
    """The queries of one tile and the best they have met."""

    def __init__(self, key, k: int):
        self.key, self.k = key, k
        self.queries: list[tuple[int, np.ndarray]] = []
        self.matrix = None
        self.best: list[list[tuple[float, int]]] = []

    def meet(self, vectors: np.ndarray, ids: list[list[int]]) -> None:
        if not self.queries:
            return
        if self.matrix is None:
            self.matrix = np.array([v for _, v in self.queries])
            self.best = [[] for _ in self.queries]
        most = self.k + 1
        first = np.array([own[0] for own in ids])
        # Rough distances are taken from the middle of the batch, so that vectors far from the
        # origin do not cancel. All rows that rounding may have put behind the last wanted one
        # are ranked exactly; of equal distances those of smaller ids go on.
        middle = vectors.mean(axis=0)
        moved = vectors - middle
        squares = (moved * moved).sum(axis=1)
        unit = 8 * (vectors.shape[1] + 8) * np.finfo(float).eps
        for start in range(0, len(self.matrix), 512):
            asked = self.matrix[start : start + 512]
            q = asked - middle
            rough = squares[None] - 2.0 * (q @ moved.T)
            if rough.shape[1] > most:
                last = np.partition(rough, most - 1, axis=1)[:, most - 1]
                longest = np.sqrt((q * q).sum(axis=1)) + np.sqrt(squares.max())
                far = rough > (last + unit * longest**2)[:, None]
            else:
                far = np.zeros(rough.shape, bool)
            for i, x in enumerate(asked):
                near = np.flatnonzero(~far[i])
                exact = np.sqrt(((vectors[near] - x) ** 2).sum(axis=1))
                order = np.lexsort((first[near], exact))[:most]
                own = self.best[start + i]
                own += [(float(exact[o]), v) for o in order for v in ids[near[o]]]
                own.sort()
                del own[most:]

    def hits(self) -> pa.RecordBatch:
        rows = [(q, v, d) for (q, _), own in zip(self.queries, self.best) for d, v in own]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=HIT.names
        )


def _ranked_in_tiles(tiles: DataFrame, k: int) -> DataFrame:
    """The best of every query in every tile it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(i)) for i in range(3)])
            side = np.asarray(batch.column(3))
            ids = batch.column(4).to_pylist()
            vectors = batch.column(5)
            edges = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
            for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                key = tuple(keys[:, start])
                if tile is None or tile.key != key:
                    if tile is not None:
                        yield tile.hits()
                    tile = _Tile(key, k)
                for rows, x in _by_length(vectors.slice(start, stop - start)):
                    at = rows + start
                    for i, v in zip(at, x):
                        if side[i] == 0:
                            tile.queries.append((ids[i][0], v))
                    if (met := np.flatnonzero(side[at] == 1)).size:
                        tile.meet(x[met], [ids[i] for i in at[met]])
        if tile is not None:
            yield tile.hits()

    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        tiles.repartition(parts, "bucket", "row", "column")
        .sortWithinPartitions("bucket", "row", "column", "side")
        .mapInArrow(run, HIT)
    )


def search(
    vectors: DataFrame, is_query, k: int = 10, id_col="vec_id", vector_col="embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest of every query row."""
    rows = usable(vectors, id_col, vector_col)
    distinct = written(distinct_vectors(rows, k), "ann-distinct").select("ids", "vector")
    asked = rows.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    heads = written(asked.groupBy("vector").agg(F.min("vec_id").alias("query_key")), "ann-queries")
    tables = fit(rows, distinct, heads, k)
    probes = _bucketed(heads.select(F.array("query_key").alias("ids"), "vector"), tables, True)
    tiles = _tiled(_bucketed(distinct, tables, False), probes)
    nearest = Window.partitionBy("query_key").orderBy("score", "vec_id")
    best = (
        _ranked_in_tiles(tiles, k)
        .withColumn("at", F.dense_rank().over(nearest))
        .where(F.col("at") <= k + 1)
        .select("query_key", "vec_id", "score")
        .distinct()
    )
    pairs = asked.join(heads, "vector").select(F.col("vec_id").alias("query_id"), "query_key")
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        pairs.join(best, "query_key")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
