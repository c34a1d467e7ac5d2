"""Exact order statistics by counting, whatever the distribution of the values.

Three passes count rows. The first counts cells of the floating-point scale: one
power of two, cut into ``2**16``. The second cuts the cells that hold the wanted
ranks into ``2**20`` even parts between their least and greatest value. What is
left of a part has at most ``2**16`` different doubles, so the third counts
single values. Counts are combined before they are shuffled: a third of all rows
in one cell, or on one value, is a handful of rows behind the first stage. Each
pass leaves the driver as many cells as there are ranks wanted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from wareline.operators.ordered import running_total
from wareline.session import written

SCALE, PARTS = 2**16, 2**20


def scale_cell(x: Column) -> Column:
    """Cell of a double. A greater value never has a smaller cell; NaN is the greatest."""
    size = F.abs(x)
    power = F.floor(F.log2(size))
    above = F.floor((size / F.pow(F.lit(2.0), power) - 1) * SCALE)
    cell = (power + 1100) * SCALE + F.least(F.greatest(above, F.lit(0)), F.lit(SCALE - 1)) + 1
    finite = F.when(x == 0, F.lit(0)).when(x < 0, -cell).otherwise(cell)
    return (
        F.when(F.isnan(x), F.lit(2**62 + 1))
        .when(size == float("inf"), F.signum(x).cast("bigint") * 2**62)
        .otherwise(finite)
        .cast("bigint")
    )


def _counted(rows: DataFrame) -> DataFrame:
    cells = rows.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    return written(cells, "cells")


def _holding(cells: DataFrame, ranks: list[int]) -> list[Row]:
    """The cells that hold the ranks, in order, with the rows before them."""
    start, n = F.col("start"), F.col("n")
    holds = F.lit(False)
    for rank in ranks:
        holds |= (start <= rank) & (start + n > rank)
    return running_total(cells, "cell", n, "start").where(holds).orderBy("cell").collect()


def values_at(
    df: DataFrame, value: str, ranks: Callable[[int], list[int]]
) -> dict[int, float]:
    """The values at the ranks (from 0) that ``ranks`` names for the count of values.

    NULLs do not count. Ranks outside the values are left out.
    """
    x, cell = F.col("x"), F.col("cell")
    rows = df.select(F.col(value).cast("double").alias("x")).where(x.isNotNull())
    rows = rows.withColumn("cell", scale_cell(x))
    cells = _counted(rows)
    count = cells.agg(F.sum("n")).first()[0] or 0
    wanted = sorted({r for r in ranks(count) if 0 <= r < count})
    found: dict[int, float] = {}

    def settle(held: list[Row], starts: list[int]) -> list[tuple[Row, int]]:
        """Note ranks in cells of one value; the other cells, with their starts."""
        left = []
        for row, start in zip(held, starts):
            if row.low == row.high or row.low != row.low:
                found.update({r: row.low for r in wanted if start <= r < start + row.n})
            else:
                left.append((row, start))
        return left

    held = _holding(cells, wanted) if wanted else []
    wide = settle(held, [row.start for row in held])
    if not wide:
        return found

    part = F.lit(None).cast("bigint")
    for at, (row, _) in enumerate(wide):
        even = F.floor((x - row.low) / (row.high - row.low) * (PARTS - 1))
        part = F.when(cell == row.cell, at * PARTS + even).otherwise(part)
    inner = rows.withColumn("cell", part.cast("bigint")).where(cell.isNotNull())
    # Ranks among the rows of the wide cells alone, and back.
    shift, rows_before = [], 0
    for row, start in wide:
        shift.append(start - rows_before)
        rows_before += row.n
    local = [
        r - s for (row, start), s in zip(wide, shift) for r in wanted if start <= r < start + row.n
    ]
    held = _holding(_counted(inner), local)
    narrow = settle(held, [row.start + shift[row.cell // PARTS] for row in held])
    if not narrow:
        return found

    start = F.lit(None).cast("bigint")
    for row, first in narrow:
        start = F.when(cell == row.cell, F.lit(first)).otherwise(start)
    single = (
        inner.withColumn("first", start)
        .where(F.col("first").isNotNull())
        .groupBy("first", "x")
        .agg(F.count("*").alias("n"))
    )
    earlier = W.partitionBy("first").orderBy("x").rowsBetween(W.unboundedPreceding, -1)
    placed = single.withColumn("start", F.col("first") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    holds = F.lit(False)
    for rank in wanted:
        holds |= (F.col("start") <= rank) & (F.col("start") + F.col("n") > rank)
    for row in placed.where(holds).collect():
        found.update({r: row.x for r in wanted if row.start <= r < row.start + row.n})
    return found


def exact_median(df: DataFrame, value: str) -> float | None:
    """The middle value, or the mean of the middle two; None without any."""
    found = values_at(df, value, lambda n: [(n - 1) // 2, n // 2])
    if not found:
        return None
    return (found[min(found)] + found[max(found)]) / 2


def exact_quantiles(df: DataFrame, value: str, shares: list[float]) -> list[float | None]:
    """For each share the least value that so large a share of all values does not exceed."""

    def rank(share: float, n: int) -> int:
        return max(0, min(n - 1, -int(-share * n // 1) - 1))

    counts: list[int] = []

    def ranks(n: int) -> list[int]:
        counts.append(n)
        return [rank(s, n) for s in shares]

    found = values_at(df, value, ranks)
    return [found.get(rank(s, counts[0])) for s in shares]
