"""Run registered queries next to their SQL and compare whole results.

    python tests/check.py [sf dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(repr(row[i]) for i in order) for row in rows), key=lambda r: r
    )


def compare(spark, con, name, fn, sql, sf_dir):
    """Empty string when both sides agree, otherwise what differs."""
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if rows else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    mine, theirs = canonical(df.columns, rows), canonical(names, expected)
    if mine == theirs:
        return ""
    extra = [r for r in mine if r not in set(theirs)][:3]
    lacking = [r for r in theirs if r not in set(mine)][:3]
    return f"{len(mine)} rows against {len(theirs)}; only here {extra}; only SQL {lacking}"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        kind = "sql " if name in oracles else "rows"
        print(f"{kind} {time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    sys.path.insert(0, ".")
    main()
