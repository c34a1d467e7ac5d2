"""Rows of split CSV files against a reader of whole files."""

import csv
import io
import random

import pytest

from wareline.operators.cleaning import ORD
from wareline.sources import csv_ranges as C
from wareline.sources.files import read_raw_products

CELLS = ["", "a", "two words", "line\nbreak", "crlf\r\nin it", 'a "quoted" part', ',"', '"', "\n\n", "x" * 70, "é\n☃",
         '\n"', '",\n,"']


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "71")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def whole(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def test_both_states_of_a_line():
    cases = [
        (b'a,b', False, True), (b'"a",b', False, False), (b'"a', True, False), (b'a","b', True, True),
        (b'5" wide,b', False, False), (b'a,"', True, False), (b'""', False, True), (b'"a""', True, False),
        (b'a,"b"",c', True, False), (b'x"",""\r', False, True), (b'",b', True, False), (b'', False, True),
    ]
    for line, from_outside, from_inside in cases:
        assert C.ends_inside(line, False) is from_outside, line
        assert C.ends_inside(line, True) is from_inside, line


def test_rows_of_small_ranges_equal_those_of_whole_files(spark, tmp_path, small_ranges):
    rng = random.Random(11)
    want = []
    for name, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", "said\nthen", "other"])
        for i in range(20):
            row = [f"{name}{i}", rng.choice(CELLS), rng.choice(CELLS)]
            writer.writerow(row)
            want.append(tuple(c or None for c in row))
            if i % 7 == 0:
                out.write(end)
        text = out.getvalue()
        (tmp_path / f"{name}.csv").write_bytes((text[: -len(end)] if name == "c" else text).encode())
    (tmp_path / "d.csv").write_bytes(b"")
    (tmp_path / "e.csv").write_bytes(b"id,x,y")
    got = C.read_cells(spark, str(tmp_path), ORD)
    assert C.records(spark, str(tmp_path)).select("path", "number").distinct().count() == 64
    rows = got.orderBy(ORD).collect()
    assert [tuple(r)[:3] for r in rows] == want
    assert [r[ORD] for r in rows] == list(range(60))
    assert got.columns[:3] == ["id", "said\nthen", "other"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    assert sorted(map(repr, whole(spark, str(tmp_path / "a.csv")).collect())) == sorted(
        repr(r) for r in got.drop(ORD).where("id LIKE 'a%'").collect())


def test_stray_quotes_and_one_open_to_the_end(spark, tmp_path, small_ranges):
    lines = ['id,v,w', '1,5" pipe,"a', 'b"', '2,"x"y,z', "3,only", "4,a,b,c", '5,"never', "closed", ""]
    (tmp_path / "f.csv").write_text("\n".join(lines))
    got = C.read_cells(spark, str(tmp_path / "f.csv"), ORD).orderBy(ORD).collect()
    assert [tuple(r)[:2] for r in got[:4]] == [("1", '5" pipe'), ("2", '"x"y'), ("3", "only"), ("4", "a")]
    assert got[0].w == "a\nb" and got[1].w == "z" and got[2].w is None and len(got) == 5


def test_header_and_products(spark, tmp_path, small_ranges):
    assert C.header_names('﻿id,"a,b",,X,x') == ["id", "a,b", "_c2", "X3", "x4"]
    (tmp_path / "p.csv").write_text('﻿product_id,about\nP1,"one\n\ntwo"\nP2,N/A\nP3,\n')
    path = str(tmp_path / "p.csv")
    mine = [tuple(r) for r in read_raw_products(spark, path).orderBy(ORD).collect()]
    assert mine == [("P1", "one\n\ntwo", 0), ("P2", None, 1), ("P3", None, 2)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    assert [tuple(r) for r in read_raw_products(spark, path, whole_files=True).orderBy(ORD).collect()] == mine
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        C.read_cells(spark, str(tmp_path / "empty.csv"), ORD)
    with pytest.raises(FileNotFoundError):
        read_raw_products(spark, str(tmp_path / "none.csv"))
