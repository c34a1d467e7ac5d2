"""Order-dependent operators that never put one whole key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to a single
task. Here the 64-bit ordinal of a row is cut into buckets of ``2**bits``
values. A window runs inside each (key, bucket), whose size is bounded
because ordinals are unique, and one small row per (key, bucket) carries the
result over from the earlier buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BUCKET_BITS = 20
# A total has no key to spread its rows by, so its buckets alone make its tasks.
TOTAL_BITS = 16
_BUCKET, _SUPER, _CARRY = "__bucket", "__super", "__carry_"
_AGGREGATE = {"max": F.max, "min": F.min, "sum": F.sum}


def _combine(how: str, here: Column, earlier: Column) -> Column:
    if how == "max":
        return F.greatest(here, earlier)
    if how == "min":
        return F.least(here, earlier)
    return F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0))


def before(
    df: DataFrame,
    keys: list[str],
    ord_col: str,
    measures: dict[str, tuple[str, Column]],
    seed: DataFrame | None = None,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add, per row, an aggregate over all earlier rows of the same keys.

    ``measures`` maps a new column to ``(max|min|sum, expression)``. ``seed``
    holds one row per key with the same measure columns and counts as lying
    before every row; it joins the small per-bucket summary, not the data.
    """
    names = list(measures)
    work = df.withColumn(_BUCKET, F.shiftright(F.col(ord_col), bits)).withColumns(
        {name: expr for name, (_, expr) in measures.items()}
    )
    summary = work.groupBy(*keys, _BUCKET).agg(
        *[_AGGREGATE[how](name).alias(name) for name, (how, _) in measures.items()]
    )
    if seed is not None:
        summary = summary.unionByName(
            seed.withColumn(_BUCKET, F.lit(-(2**62)).cast("bigint")).select(
                summary.columns
            )
        )
    prior = W.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(
        W.unboundedPreceding, -1
    )
    carried = summary.select(
        *keys,
        _BUCKET,
        *[
            _AGGREGATE[how](name).over(prior).alias(_CARRY + name)
            for name, (how, _) in measures.items()
        ],
    )
    inside = W.partitionBy(*keys, _BUCKET).orderBy(ord_col).rowsBetween(
        W.unboundedPreceding, -1
    )
    local = work.withColumns(
        {
            name: _AGGREGATE[how](name).over(inside)
            for name, (how, _) in measures.items()
        }
    )
    joined = local.join(carried, [*keys, _BUCKET], "left")
    return joined.select(
        *[c for c in df.columns if c not in names],
        *[
            _combine(how, F.col(name), F.col(_CARRY + name)).alias(name)
            for name, (how, _) in measures.items()
        ],
    )


def running_total(
    df: DataFrame, ord_col: str, value: Column, name: str, bits: int = TOTAL_BITS
) -> DataFrame:
    """Add the sum of ``value`` over all rows with a smaller ordinal.

    Two levels of buckets: no window sees more than ``2**bits`` ordinals or
    bucket totals, except the topmost, which sees one row per ``2**(2*bits)``
    ordinals.
    """
    work = df.withColumns(
        {
            name: value.cast("bigint"),
            _BUCKET: F.shiftright(F.col(ord_col), bits),
            _SUPER: F.shiftright(F.col(ord_col), 2 * bits),
        }
    )
    earlier = (W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    totals = work.groupBy(_SUPER, _BUCKET).agg(F.sum(name).alias("__n"))
    tops = (
        totals.groupBy(_SUPER)
        .agg(F.sum("__n").alias("__n"))
        .select(
            _SUPER,
            F.coalesce(
                F.sum("__n").over(W.orderBy(_SUPER).rowsBetween(*earlier)), zero
            ).alias("__top"),
        )
    )
    offsets = (
        totals.withColumn(
            "__mid",
            F.coalesce(
                F.sum("__n").over(
                    W.partitionBy(_SUPER).orderBy(_BUCKET).rowsBetween(*earlier)
                ),
                zero,
            ),
        )
        .join(tops, _SUPER)
        .select(_BUCKET, (F.col("__mid") + F.col("__top")).alias("__offset"))
    )
    inside = W.partitionBy(_BUCKET).orderBy(ord_col).rowsBetween(*earlier)
    return (
        work.withColumn(name, F.coalesce(F.sum(name).over(inside), zero))
        .join(offsets, _BUCKET)
        .select(
            *[c for c in df.columns if c != name],
            (F.col(name) + F.col("__offset")).alias(name),
        )
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    ord_col: str,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Left join where ``left`` may repeat a key without bound.

    ``right`` has one row per key. It is first spread to the (key, bucket)
    pairs that ``left`` really has, so the wide join never gathers a key.
    """
    work = left.withColumn(_BUCKET, F.shiftright(F.col(ord_col), bits))
    pairs = work.select(*keys, _BUCKET).distinct().join(right, keys)
    return work.join(pairs, [*keys, _BUCKET], "left").drop(_BUCKET)


def hash_rank(
    df: DataFrame, keys: list[str], hex_col: str, name: str, digits: int = 4
) -> DataFrame:
    """1-based rank within ``keys`` in the order of a hexadecimal hash.

    The leading digits of a hash cut even a single huge key into equal
    parts. Also adds ``name + "_of"``, the number of rows of the key.
    """
    part = "__part"
    work = df.withColumn(part, F.substring(hex_col, 1, digits))
    sizes = work.groupBy(*keys, part).agg(F.count("*").alias("__n"))
    in_order = W.partitionBy(*keys).orderBy(part)
    offsets = sizes.select(
        *keys,
        part,
        (F.sum("__n").over(in_order) - F.col("__n")).alias("__offset"),
        F.sum("__n").over(W.partitionBy(*keys)).alias(name + "_of"),
    )
    return (
        work.withColumn(
            name, F.row_number().over(W.partitionBy(*keys, part).orderBy(hex_col))
        )
        .join(offsets, [*keys, part])
        .withColumn(name, F.col(name) + F.col("__offset"))
        .drop(part, "__offset")
    )


def top_k(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    k: int,
    rank: str,
    spread_by: str,
    salts: int = 64,
) -> DataFrame:
    """Best ``k`` rows per key with their rank; ``order`` must be total.

    A first round ranks each salted share of a key and keeps its best ``k``,
    so the deciding round sees at most ``salts * k`` rows of a key.
    """
    salt = "__salt"
    share = W.partitionBy(*keys, salt).orderBy(*order)
    finalists = (
        df.withColumn(salt, F.pmod(F.xxhash64(spread_by), F.lit(salts)))
        .withColumn(rank, F.row_number().over(share))
        .where(F.col(rank) <= k)
        .drop(salt, rank)
    )
    return finalists.withColumn(
        rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    ).where(F.col(rank) <= k)
