"""Crashes, replays and several writers of one published catalog."""

import json
import shutil

import pytest
from pyspark.sql import functions as F, types as T

from tests.test_batch_and_stream import event, lines_of
from wareline.operators.cleaning import ORD
from wareline.schema import PRODUCT_SCHEMA
from wareline.sources.store import CatalogStore
from wareline.streaming.events import apply_lines, outcomes, rejected_lines, start_file_stream


class Crash(RuntimeError):
    pass


def numbered(n, first=0, **kwargs):
    return [event(1, product_id=f"P-{i}", event_id=f"e{i}", **kwargs) for i in range(first, first + n)]


def batch_of(spark, *ids):
    rows = [{"product_id": i, "product_name": f"loaded {i}"} for i in ids]
    full = [tuple(r.get(f.name) for f in PRODUCT_SCHEMA.fields) + (n,) for n, r in enumerate(rows)]
    schema = T.StructType([*PRODUCT_SCHEMA.fields, T.StructField(ORD, T.LongType())])
    return spark.createDataFrame(full, schema)


def feed(store):
    return [(r.change_id, r.product_id, r.operation) for r in store.changes().orderBy("change_id").collect()]


def crash_before_manifest(store):
    def publish(descriptor):
        raise Crash

    store._publish = publish
    return store


def test_events_that_crashed_are_neither_seen_nor_lost(spark, tmp_path):
    root = str(tmp_path / "c")
    lines = lines_of(spark, numbered(3) + ["{"])
    with pytest.raises(Crash):
        apply_lines(crash_before_manifest(CatalogStore(spark, root)), lines, "0")
    store = CatalogStore(spark, root)
    assert store.current().version == 0 and feed(store) == [] and store.state().receipts.isEmpty()
    # A load takes the version that the crashed events had prepared.
    assert store.load_batch(batch_of(spark, "L-1", "P-0"), "load") == 2
    assert store.state().receipts.isEmpty() and outcomes(store).isEmpty()
    apply_lines(store, lines, "0")
    assert [r.status for r in outcomes(store).orderBy("ord").collect()] == ["applied"] * 3
    assert store.state().receipts.count() == 3
    assert [r.reason for r in rejected_lines(store).collect()] == ["not a JSON object"]
    operations = feed(store)
    assert [c for c, *_ in operations] == list(range(1, len(operations) + 1))
    assert operations[:2] == [(1, "L-1", "products_insert"), (2, "P-0", "products_insert")]
    assert (3, "P-0", "products_update") in operations
    before = store.current()
    # Replays: of the events behind the load, and of the load behind the events.
    apply_lines(store, lines, "0")
    assert store.load_batch(batch_of(spark, "L-1", "P-0"), "load") == 2
    assert store.current() == before


def test_a_crashed_load_leaves_no_changes(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "c"))
    with pytest.raises(Crash):
        crash_before_manifest(CatalogStore(spark, store.root)).load_batch(batch_of(spark, "A"), "one")
    apply_lines(store, lines_of(spark, numbered(1)), "0")
    assert [p for _, p, _ in feed(store)] == ["P-0", "P-0"] and store.product_count() == 1


def test_the_slower_of_two_writers_starts_again(spark, tmp_path):
    slow, fast = (CatalogStore(spark, str(tmp_path / "c")) for _ in range(2))
    publish, tries = slow._publish, []

    def late(descriptor):
        if not tries:
            apply_lines(fast, lines_of(spark, numbered(2)), "0", stream="fast")
        tries.append(descriptor.version)
        return publish(descriptor)

    slow._publish = late
    apply_lines(slow, lines_of(spark, numbered(3)), "0", stream="slow")
    assert tries == [1, 2] and slow.current().version == 2
    got = [(r.v, r.event_id, r.status) for r in outcomes(slow).orderBy("v", "ord").collect()]
    assert got == [
        (1, "e0", "applied"), (1, "e1", "applied"),
        (2, "e0", "duplicate"), (2, "e1", "duplicate"), (2, "e2", "applied"),
    ]
    assert [c for c, *_ in feed(slow)] == list(range(1, 7))


def test_two_streams_and_a_restart_feed_one_catalog(spark, tmp_path):
    root = str(tmp_path / "c")

    def run(name, drop, events):
        place = tmp_path / name
        place.mkdir(exist_ok=True)
        (place / f"{drop}.jsonl").write_text("\n".join(json.dumps(e) for e in events) + "\n")
        start_file_stream(spark, str(place), root, str(tmp_path / f"{name}-checkpoint")).awaitTermination()

    run("one", 0, numbered(2))
    run("two", 0, numbered(3, first=2))
    run("one", 1, numbered(1, first=10))
    # The same files under a new checkpoint: a third stream of events already known.
    shutil.rmtree(tmp_path / "one-checkpoint")
    run("one", 2, numbered(1, first=11))
    store = CatalogStore(spark, root)
    assert {r.product_id for r in store.state().products.collect()} == {
        f"P-{i}" for i in (0, 1, 2, 3, 4, 10, 11)
    }
    ledger = store.manifests().groupBy("stream").agg(F.count("*").alias("n")).collect()
    assert sorted(r.n for r in ledger) == [1, 1, 2]
    statuses = [r.status for r in outcomes(store).where(F.col("v") == 4).collect()]
    assert sorted(statuses) == ["applied", "duplicate", "duplicate", "duplicate"]


def test_a_page_opens_the_parts_of_its_versions_only(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "c"))
    for n in range(4):
        apply_lines(store, lines_of(spark, numbered(3, first=10 * n)), str(n))
    whole = feed(store)
    assert len(whole) == 24
    for row in store.manifests().collect():
        if row.version in (1, 4):
            for file in (tmp_path / "c" / "changes" / row.changes).glob("*.parquet"):
                file.write_bytes(b"not read")
    got = [(r.change_id, r.product_id, r.operation) for r in store.page(6, 12).collect()]
    assert got == whole[6:18]
    assert store.page(24, 5).isEmpty()
    with pytest.raises(ValueError):
        store.page(-1, 5)
    with pytest.raises(Exception):
        store.page(5, 3).collect()
