"""Order statistics against sorted values."""

import math
import random
import statistics

from pyspark.sql import functions as F

from wareline.operators import selection as S

INF = float("inf")


def frame(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "price double, cell string")


def test_cells_never_fall(spark):
    rng = random.Random(3)
    values = [rng.choice((-1, 1)) * math.ldexp(rng.random(), rng.randrange(-1080, 1024)) for _ in range(3000)]
    edges = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 1.0, INF]
    values += edges + [-v for v in edges] + [math.nextafter(2.0**e, to) for e in range(-60, 60) for to in (0, INF)]
    rows = frame(spark, values).select("price", S.scale_cell(F.col("price")).alias("c")).collect()
    cells = [r.c for r in sorted(rows, key=lambda r: r.price)]
    assert cells == sorted(cells) and None not in cells


def test_median_of_any_distribution(spark):
    rng = random.Random(4)
    close = [1 + rng.randrange(10**6) * 2.0**-52 for _ in range(2000)]
    cases = [
        [3.0], [1.25, 9.5], [2.0] * 7, [0.0, -0.0, 5e-324], close, close + [1e300] * 1000,
        [rng.randrange(10**7) / 100 for _ in range(999)],
        [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(1000)],
        [0.1 + i * 1e-9 for i in range(500)] + [0.1] * 250,
    ]
    for values in cases:
        shuffled = rng.sample(values, len(values)) + [None] * 3
        assert S.exact_median(frame(spark, shuffled), "price") == statistics.median(values)
    assert S.exact_median(frame(spark, [None]), "price") is None
    assert S.exact_median(frame(spark, []), "price") is None
    assert S.exact_median(frame(spark, [-INF, 1.0, INF]), "price") == 1.0
    assert math.isnan(S.exact_median(frame(spark, [1.0, float("nan"), float("nan")]), "price"))


def test_quantiles(spark):
    rng = random.Random(5)
    values = [rng.gauss(0, 1e-3) + 5 for _ in range(801)]
    shares = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    ordered = sorted(values)
    want = [ordered[max(0, math.ceil(s * 801) - 1)] for s in shares]
    assert S.exact_quantiles(frame(spark, values), "price", shares) == want
    assert S.exact_quantiles(frame(spark, []), "price", [0.5]) == [None]


def test_one_value_or_cell_is_counted_before_it_is_shuffled(spark):
    rows = spark.range(200000).select((F.col("id") % 3 / 3 * 1e-12 + 7).alias("price"))
    assert S.exact_median(rows, "price") == 7 + 1 / 3 * 1e-12
