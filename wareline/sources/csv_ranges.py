"""CSV with line breaks inside quotes, read by byte ranges.

A range may begin inside a quoted cell, which its own bytes cannot tell. So each
range is read for both cases at once: every line carries whether it begins inside
quotes, and how many records have begun, under either. One small row per range
says how the range maps its state at the start to that at its end; these maps are
put together in the order of the file, which settles every range. Lines that are a
record of their own need no exchange; only records of several lines are grouped.

Quotes count as a CSV reader counts them: they open a cell at its start, a doubled
one stands for itself, and one within a cell that has no quotes is plain text.
Lines end in a line feed, with or without a carriage return.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from wareline.session import written

LINES = (
    "path string, start long, at long, in0 boolean, in1 boolean, out0 boolean, out1 boolean, "
    "begun0 long, begun1 long, value binary"
)


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line."""
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] == b'"':
                at += 1
            else:
                at = line.find(b',"', at) + 2
                if at == 1:
                    return False
        closing = line.find(b'"', at)
        while closing >= 0 and line[closing + 1 : closing + 2] == b'"':
            closing = line.find(b'"', closing + 2)
        if closing < 0:
            return True
        at, inside = line.find(b",", closing) + 1, False
        if at == 0:
            return False


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of every range and follow both states through it."""
    key = None
    for batch in batches:
        paths, starts, values = (batch.column(i) for i in range(3))
        n, begins = batch.num_rows, np.asarray(starts)
        if n == 0:
            continue
        quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
        blank = np.asarray(pc.binary_length(values)) == 0
        blank |= pc.equal(values, pa.scalar(b"\r", values.type)).to_numpy(zero_copy_only=False)
        new = np.asarray(begins[1:] != begins[:-1])
        if n > 1:
            new |= pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), n]
        inside = np.empty((n + 1, 2), bool)
        after = np.empty((n, 2), bool)
        begun = np.empty((n, 2), np.int64)
        number = np.empty(n, np.int64)
        for a, b in zip(edges, edges[1:]):
            if key != (here := (paths[a].as_py(), int(begins[a]))):
                key, at, state, count = here, 0, (False, True), np.zeros(2, np.int64)
            done = a
            for q in quoted[np.searchsorted(quoted, a) : np.searchsorted(quoted, b)].tolist():
                inside[done : q + 1] = state
                line = values[q].as_py()
                state, done = tuple(ends_inside(line, s) for s in state), q + 1
            inside[done : b + 1] = state
            after[a:b] = inside[a + 1 : b + 1]
            begun[a:b] = count + np.cumsum(~inside[a:b] & ~blank[a:b, None], axis=0)
            number[a:b] = at + np.arange(b - a)
            at, count = at + b - a, begun[b - 1]
        columns = [number, inside[:n, 0], inside[:n, 1], after[:, 0], after[:, 1], begun[:, 0], begun[:, 1]]
        yield pa.RecordBatch.from_arrays(
            [paths, starts, *[pa.array(np.ascontiguousarray(c)) for c in columns], values],
            names=["path", "start", "at", "in0", "in1", "out0", "out1", "begun0", "begun1", "value"],
        )


def _settled(ranges: DataFrame) -> DataFrame:
    """Per range: whether it begins inside quotes, and the records before it.

    ``ranges`` has one row each with its two end states and record counts.
    """
    in_file = W.partitionBy("path").orderBy("start")
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    flip = (F.col("out0") & ~F.col("out1")).cast("int")
    settles = F.col("out0") == F.col("out1")
    states = (
        ranges.withColumn("flips", F.sum(flip).over(in_file.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("known", F.when(settles, F.struct(F.col("out0").alias("state"), "flips")))
        .withColumn("last", F.last("known", ignorenulls=True).over(earlier))
    )
    turns = F.col("flips") - flip - F.coalesce(F.col("last.flips"), F.lit(0))
    begins = F.coalesce(F.col("last.state"), F.lit(False)) != (turns % 2 == 1)
    counted = states.withColumn("inside", begins).withColumn(
        "records", F.when(F.col("inside"), F.col("begun1")).otherwise(F.col("begun0"))
    )
    files = counted.groupBy("path").agg(F.sum("records").alias("n")).where("n > 0")
    before_file = W.orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    # Each file with records gives one of them as its header.
    files = files.select(
        "path", F.coalesce(F.sum(F.col("n") - 1).over(before_file), F.lit(0)).alias("rows_before")
    )
    return counted.withColumn(
        "in_file", F.coalesce(F.sum("records").over(earlier), F.lit(0))
    ).join(files, "path").select("path", "start", "inside", "in_file", "rows_before")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, number, ord, value): each record's whole text.

    ``number`` counts from 1 within a file, where it is the header; ``ord`` is
    the ordinal of a row over all files from 0 without gaps. Blank lines
    between records count for nothing.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    raw = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )
    lines = written(raw.mapInArrow(_states, LINES), "csv-lines")
    ends = ("out0", "out1", "begun0", "begun1")
    ranges = lines.groupBy("path", "start").agg(F.max_by(F.struct(*ends), "at").alias("last"))
    settled = _settled(ranges.select("path", "start", "last.*"))

    def chosen(name: str):
        return F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    blank = F.col("value").isin(F.lit(b""), F.lit(b"\r"))
    placed = (
        lines.join(settled, ["path", "start"])
        .withColumn("number", F.col("in_file") + chosen("begun"))
        .where(chosen("in") | ~blank)
        .withColumn("whole", ~chosen("in") & ~chosen("out"))
        .select(
            "path", "number", (F.col("rows_before") + F.col("number") - 2).alias("ord"),
            "start", "at", "value", "whole",
        )
    )
    pieces = placed.where("NOT whole").groupBy("path", "number", "ord").agg(
        F.sort_array(F.collect_list(F.struct("start", "at", F.col("value").cast("string").alias("value")))).alias("p")
    )
    joined = pieces.select("path", "number", "ord", F.array_join(F.col("p.value"), "\n").alias("value"))
    single = placed.where("whole").select(
        "path", "number", "ord", F.col("value").cast("string").alias("value")
    )
    return single.unionByName(joined).withColumn("value", F.regexp_replace("value", r"\r\z", ""))


def header_names(text: str) -> list[str]:
    """Column names of a header; empty ones get a place name, repeated ones a number."""
    cells = next(csv.reader([text.removeprefix("﻿")], strict=False), [])
    seen = [c.lower() for c in cells]
    return [
        f"_c{i}" if not c else f"{c}{i}" if seen.count(c.lower()) > 1 else c
        for i, c in enumerate(cells)
    ]


def read_cells(spark: SparkSession, path: str, ord_col: str) -> DataFrame:
    """All rows as text cells, named by the header of the first file, with their ordinal."""
    found = records(spark, path)
    first = found.where("number = 1").orderBy("path").select("value").first()
    names = header_names(first.value) if first else []
    if not names:
        raise ValueError(f"No header in {path}")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = F.from_csv("value", schema, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    rows = found.where("number > 1").select("ord", cells.alias("cells"))
    return rows.select(
        *[F.col(f"cells.c{i}").alias(name) for i, name in enumerate(names)],
        F.col("ord").alias(ord_col),
    )
