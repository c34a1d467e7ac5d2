import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.fixtures import SCHEMA, documents
from wareline.llm import revisits as V

RECORDS = "record_id long, kind string, url string, captured long, digest string, headers map<string,string>, page string, found int"


def records(spark, rows):
    return spark.createDataFrame([(*r, "own", 1) for r in rows], RECORDS)


def test_canonical_url(spark):
    cases = {
        "HTTP://www.Example.com:80/a/?b=2&a=1&utm_source=x#top": "example.com/a?a=1&b=2",
        "https://m.example.com/a": "example.com/a",
        "example.com": "example.com",
        "http://example.com/A?ref=1": "example.com/A",
        "http://example.com/?": "example.com",
        "": None,
        "  ": None,
        "http://": None,
        "https://#top": None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r.url: r.page for r in df.withColumn("page", V.canonical_url(F.col("url"))).collect()}
    assert got == cases


def test_latest_earlier_response(spark):
    u = "http://a.example/x"
    rows = [
        (1, "response", u, 10, "d1", {"etag": '"1"', "server": "old", "vary": "a"}),
        (2, "response", u + "#f", 20, "d2", {"etag": '"2"', "last-modified": "m"}),
        (3, "revisit", u, 20, None, {"etag": 'W/"2"', "date": "now", "server": "new"}),
        (4, "revisit", u, 15, None, {"etag": '"2"'}),
        (5, "revisit", u, 5, None, {"etag": '"1"'}),
        (6, "revisit", u, 30, None, {"last-modified": "m"}),
        (7, "revisit", u, 30, None, None),
        (8, "revisit", None, 30, None, {"etag": '"1"'}),
        (9, "revisit", u, None, None, {"etag": '"1"'}),
        (10, "response", u, 40, "d3", None),
        (11, "response", " ", 1, "d4", {"etag": '"1"'}),
        (12, "revisit", "http://", 2, None, {"etag": '"1"'}),
    ]
    got = {r.record_id: r for r in V.resolve(records(spark, rows)).collect()}
    assert {i: (r.status, r.refers_to, r.digest) for i, r in got.items()} == {
        3: ("resolved", 2, "d2"), 4: ("validator_mismatch", 1, None), 5: ("no_response", None, None),
        6: ("resolved", 2, "d2"), 7: ("validator_mismatch", 2, None), 8: ("no_response", None, None),
        9: ("no_response", None, None), 12: ("no_response", None, None)}
    assert got[3].headers == {"etag": 'W/"2"', "date": "now", "last-modified": "m"}
    assert V.resolve(records(spark, [])).count() == 0


def test_many_captures_of_one_url(spark):
    rows = []
    for i in range(400):
        kind = "response" if i % 7 == 0 else "revisit"
        rows.append((i, kind, "http://a.example/", i, str(i), {"etag": "e"}))
        if i % 50 == 0:
            rows.append(rows[-1])
    got = V.resolve(records(spark, rows)).collect()
    assert len(got) == sum(r[1] == "revisit" for r in rows)
    assert all(r.refers_to == r.record_id // 7 * 7 and r.status == "resolved" for r in got)


def test_pipeline_stages_keep_columns_and_clean_rows(spark, tmp_path):
    docs = documents(spark, extra=[(70, "write to a@b.example now " + "fine words here " * 9)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in (1, 2, 9, 11, 12)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality", "near_duplicates", "pii", "packing"]
    current = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, str(tmp_path))
        assert after.columns == docs.columns
        path = str(tmp_path / f"out-{name}")
        after.write.parquet(path)
        current = spark.read.parquet(path)
    rows = {r.doc_id: r for r in current.collect()}
    assert "[EMAIL]" in rows[70].text and rows[70].n_chars == len(rows[70].text)
    assert 2 not in rows and 3 not in rows and {1, 4, 5, 9, 10, 11, 12} <= set(rows)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == set(rows)
