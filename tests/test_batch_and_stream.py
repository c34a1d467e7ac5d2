import json
import random

import pytest

from wareline.operators import events as E
from wareline.plans.batch import run_batch
from wareline.schema import PRODUCT_COLUMNS
from wareline.sources import files
from wareline.sources.store import CatalogStore, copy_snapshot
from wareline.streaming.events import apply_lines, outcomes, start_file_stream

HEADER = [
    " Product_ID ", "product_name", "category", "discounted_price", "actual_price",
    "discount_percentage", "rating", "rating_count", "about_product", "review_id",
    "review_title", "review_content", "img_link", "product_link", "user_id", "user_name",
]


def raw_row(product_id="P1", rating="4.5", count="2,000", price="₹1,099", **over):
    row = {
        " Product_ID ": product_id, "product_name": "Keyboard, \"big\"",
        "category": "Electronics|Accessories", "discounted_price": price,
        "actual_price": "₹1,500", "discount_percentage": "27%", "rating": rating,
        "rating_count": count, "about_product": "line one\nline two", "review_id": "R1",
        "review_title": "NA", "review_content": "text", "img_link": "", "product_link": "x",
        "user_id": "U1", "user_name": "Someone",
    }
    return {**row, **over}


def write_csv(path, rows, header=HEADER):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.DictWriter(handle, header, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


def test_batch_summary_rerun_and_failures(spark, tmp_path):
    rows = [raw_row(), raw_row(), raw_row(count="500"), raw_row("P2", rating="|")]
    path = write_csv(tmp_path / "raw.csv", rows)
    root = str(tmp_path / "out")
    summary = run_batch(spark, path, root)
    expected = dict(
        raw_rows=4, cleaned_rows=3, removed_rows=1, duplicate_product_ids=1,
        batch_rows=2, database_rows=2,
    )
    assert {k: summary[k] for k in expected} == expected
    store = CatalogStore(spark, f"{root}/catalog")
    assert store.current().revision == 2
    stored = {r.product_id: r for r in store.table("products", store.current()).collect()}
    assert stored["P1"].rating_count == 2000 and stored["P1"].review_title is None
    assert stored["P1"].about_product == "line one\nline two"
    assert stored["P2"].rating is None
    assert run_batch(spark, path, root)["database_rows"] == 2
    assert store.current().revision == 4
    feed = [(r.change_id, r.operation) for r in store.changes().orderBy("change_id").collect()]
    assert feed == [
        (1, "products_insert"), (2, "products_insert"),
        (3, "products_update"), (4, "products_update"),
    ]
    report = files.read_report(spark, f"{root}/runs/{summary['run_id']}/quality")
    assert report["status"] == "passed" and len(report["checks"]) == 17
    assert "Keyboard" not in json.dumps(report)

    before = store.current()
    inverted = write_csv(tmp_path / "bad.csv", [raw_row("P9", price="₹9,999")])
    empty = write_csv(tmp_path / "empty.csv", [])
    unusable = write_csv(tmp_path / "unusable.csv", [raw_row("  ")])
    lacking = write_csv(tmp_path / "lacking.csv", [raw_row()], HEADER[:5])
    for source, message in [
        (inverted, "discounted_price_not_above_actual"),
        (empty, "no rows"),
        (unusable, "No usable"),
        (lacking, "Missing columns"),
    ]:
        with pytest.raises(ValueError, match=message):
            run_batch(spark, source, root)
    with pytest.raises(FileNotFoundError):
        run_batch(spark, str(tmp_path / "none.csv"), root)
    assert store.current() == before


def test_numbering_follows_files_and_lines(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"{part}.txt").write_text(
            "".join(f"{part}-{i}\n" for i in range(50 * (3 - part)))
        )
    rows = files.read_event_lines(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(300))
    assert [r.value for r in rows] == [
        f"{part}-{i}" for part in range(3) for i in range(50 * (3 - part))
    ]


def event(version=1, operation="upsert", **over):
    data = {
        "event_id": f"event-{int(version)}-{operation}", "product_id": "NEW-1",
        "version": version, "operation": operation,
    }
    if operation == "upsert":
        data.update(
            product={
                "product_name": "Solar lantern", "category": "Home",
                "discounted_price": 15, "actual_price": 20,
            },
            stock_quantity=3,
        )
    return {**data, **over}


def lines_of(spark, payloads, start=0):
    rows = [
        (start + i, p if isinstance(p, str) else json.dumps(p))
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, "ord bigint, value string")


def statuses(store):
    return [r.status for r in outcomes(store).orderBy("v", "ord").collect()]


def test_retry_stale_delete_recreate_across_batches(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "c"))
    for i, e in enumerate(
        [event(), event(), event(3, "delete"), event(2), event(4)]
    ):
        apply_lines(store, lines_of(spark, [e]), f"b-{i}")
    assert statuses(store) == ["applied", "duplicate", "applied", "stale", "applied"]
    revision, rows = store.snapshot()
    row = rows.first()
    assert (row.product_id, row.stock_quantity, row.main_category) == ("NEW-1", 3, "Home")
    operations = [r.operation for r in store.changes().orderBy("change_id").collect()]
    assert operations == [
        "products_insert", "inventory_insert", "inventory_delete", "products_delete",
        "products_insert", "inventory_insert",
    ]
    assert revision == 6
    # A replayed batch id changes nothing.
    apply_lines(store, lines_of(spark, [event(9)]), "b-4")
    assert store.current().revision == 6


def test_stock_omitted_differs_from_null_and_conflicts(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "c"))
    without = event(2)
    del without["stock_quantity"]
    batch = [
        event(), event(stock_quantity=9), without, {**without, "stock_quantity": None},
    ]
    apply_lines(store, lines_of(spark, batch), "one")
    assert statuses(store) == ["applied", "conflict", "applied", "conflict"]
    assert store.snapshot()[1].first().stock_quantity == 3
    apply_lines(store, lines_of(spark, [event(3, stock_quantity=None)]), "two")
    assert store.snapshot()[1].first().stock_quantity is None


def test_validation_rules(spark):
    product = event()["product"]
    cases = [
        (event(), None),
        ("   ", "dropped"),
        ("{", "not a JSON object"),
        ("[]", "not a JSON object"),
        (json.dumps(event()) + "}", "not a JSON object"),
        (event(extra=1), "unknown field"),
        (event(product={**product, "x": 1}), "unknown product field"),
        (event(event_id="a b"), "event_id"),
        (event(event_id="x" * 101), "event_id"),
        (event(event_id="  ok  "), None),
        (event(product_id=""), "product_id"),
        (event(product_id=5), "product_id"),
        (event(version=0), "version"),
        (event(event_id="e", version="1"), "version"),
        (event(version=1.0), "version"),
        (event(version=True), "version"),
        (event(version=2**63), "version"),
        (event(operation="merge"), "operation"),
        (event(stock_quantity=-1), "stock_quantity"),
        (event(stock_quantity="3"), "stock_quantity"),
        (event(stock_quantity=None), None),
        (event(product=None), "upsert without product"),
        (event(product=7), "product"),
        (event(1, "delete", product=product), "delete with values"),
        (event(1, "delete", stock_quantity=1), "delete with values"),
        (event(1, "delete", product=None, stock_quantity=None), None),
        (event(product={"category": "x"}), "product.product_name"),
        (event(product={"product_name": "  "}), "product.product_name"),
        (event(product={**product, "product_name": "n" * 2001}), "product.product_name"),
        (event(product={**product, "category": 3}), "product.category"),
        (event(product={**product, "rating": 5.1}), "product.rating"),
        (event(product={**product, "rating": "4.5"}), None),
        (event(product={**product, "rating": "nan"}), "product.rating"),
        (event(product={**product, "actual_price": -1}), "product.actual_price"),
        (event(product={**product, "discount_percentage": 101}), "product.discount_percentage"),
        (event(product={**product, "rating_count": 2.0}), "product.rating_count"),
        (event(product={**product, "discounted_price": 21}), "discounted_price_not_above_actual"),
    ]
    parsed = E.parse_events(lines_of(spark, [c for c, _ in cases])).collect()
    got = {r.ord: r.reason for r in parsed}
    for i, (case, reason) in enumerate(cases):
        assert got.get(i, "dropped") == reason, (case, got.get(i), reason)


def test_hash_ignores_number_spelling_and_redaction_follows_it(spark):
    product = event()["product"]
    same = [
        event(product={**product, "actual_price": 20}),
        event(product={**product, "actual_price": 20.0}),
        event(product={**product, "about_product": "mail a.b@example.com now"}),
    ]
    parsed = E.parse_events(lines_of(spark, same))
    hashes = [r.payload_hash for r in parsed.orderBy("ord").collect()]
    assert hashes[0] == hashes[1] != hashes[2]
    valid = E.valid_events(parsed).orderBy("ord").collect()
    assert valid[2].product.about_product == "mail [email removed] now"
    assert valid[0].product.about_product is None


def fold(events):
    """One event at a time, as the catalog is specified."""
    products, stock, versions, receipts = {}, {}, {}, {}
    feed, results = [], []
    for e in events:
        shape = json.dumps(e, sort_keys=True)
        if e["event_id"] in receipts:
            old, outcome = receipts[e["event_id"]]
            same = old == shape
            results.append(
                (e["event_id"], "duplicate" if same else "conflict", outcome if same else None)
            )
            continue
        pid = e["product_id"]
        outcome = "stale" if e["version"] <= versions.get(pid, 0) else "applied"
        if outcome == "applied":
            versions[pid] = e["version"]
            if e["operation"] == "delete":
                if stock.pop(pid, "none") != "none":
                    feed.append((pid, "inventory_delete"))
                if products.pop(pid, None):
                    feed.append((pid, "products_delete"))
            else:
                kind = "update" if pid in products else "insert"
                feed.append((pid, f"products_{kind}"))
                products[pid] = e["product"]["product_name"]
                if "stock_quantity" in e:
                    kind = "update" if pid in stock else "insert"
                    feed.append((pid, f"inventory_{kind}"))
                    stock[pid] = e["stock_quantity"]
        receipts[e["event_id"]] = (shape, outcome)
        results.append((e["event_id"], outcome, None))
    return products, stock, versions, feed, results


def random_events(seed, n=240):
    rng, made = random.Random(seed), []
    for i in range(n):
        if made and rng.random() < 0.2:
            again = dict(rng.choice(made))
            if rng.random() < 0.4:
                again["version"] += 1
            made.append(again)
            continue
        # One product takes about half of all events.
        pid = "HOT" if rng.random() < 0.5 else f"P{rng.randrange(8)}"
        e = {
            "event_id": f"e{i}", "product_id": pid,
            "version": max(1, i + rng.randrange(-30, 30)),
            "operation": "delete" if rng.random() < 0.25 else "upsert",
        }
        if e["operation"] == "upsert":
            e["product"] = {"product_name": f"name {i}"}
            if rng.random() < 0.6:
                e["stock_quantity"] = rng.choice([None, rng.randrange(9)])
        made.append(e)
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_of_random_events_equals_sequential_fold(spark, tmp_path, seed):
    events = random_events(seed)
    products, stock, versions, feed, results = fold(events)
    rng, at, root = random.Random(seed), 0, str(tmp_path / "c")
    source = tmp_path / "in"
    source.mkdir()
    drop = 0
    while at < len(events):
        size = rng.randrange(50, 150)
        text = "\n".join(json.dumps(e) for e in events[at : at + size]) + "\n\n"
        (source / f"{drop:03}.jsonl").write_text(text)
        query = start_file_stream(
            spark, str(source), root, str(tmp_path / "checkpoint")
        )
        query.awaitTermination()
        at, drop = at + size, drop + 1
    store = CatalogStore(spark, root)
    state = store.state()
    assert {r.product_id: r.product_name for r in state.products.collect()} == products
    assert {r.product_id: r.stock_quantity for r in state.inventory.collect()} == stock
    assert {r.product_id: r.source_version for r in state.versions.collect()} == versions
    changes = store.changes().orderBy("change_id").collect()
    assert [r.change_id for r in changes] == list(range(1, len(feed) + 1))
    assert [(r.product_id, r.operation) for r in changes] == feed
    got = outcomes(store).orderBy("v", "ord").collect()
    assert [(r.event_id, r.status, r.original_status) for r in got] == results
    revisions = [r.revision for r in got if r.revision is not None]
    assert revisions == sorted(revisions) and revisions[-1] == len(feed)


def test_small_buckets_give_the_same_result(spark, monkeypatch):
    """Hot keys are cut at bucket borders; force many borders."""
    from wareline.operators import ordered

    events = random_events(7)
    *_, feed, results = fold(events)
    for name in ("before", "running_total", "lookup"):
        plain = getattr(ordered, name)
        monkeypatch.setattr(E, name, lambda *a, _f=plain, **k: _f(*a, bits=3, **k))
    parsed = E.parse_events(lines_of(spark, events))
    result = E.resolve_events(E.valid_events(parsed), E.CatalogState.empty(spark))
    changes = result.changes.orderBy("change_id").collect()
    assert [(r.product_id, r.operation) for r in changes] == feed
    got = result.outcomes.orderBy("ord").collect()
    assert [(r.event_id, r.status, r.original_status) for r in got] == results


def test_feed_pages_and_copy(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "c"))
    apply_lines(
        store,
        lines_of(spark, [event(1, product_id=f"P-{i}", event_id=f"e{i}") for i in range(4)]),
        "one",
    )
    first = E.feed_page(store.changes(), 0, 3)
    cursor = E.next_cursor(first).first().next_after
    second = E.feed_page(store.changes(), cursor, 3).collect()
    assert [r.change_id for r in first.collect()] == [1, 2, 3]
    assert [r.change_id for r in second] == [4, 5, 6]
    for after, limit in ((-1, 10), (0, 0), (0, 501)):
        with pytest.raises(ValueError):
            E.feed_page(store.changes(), after, limit)
    rows = store.table("products", store.current())
    assert copy_snapshot(rows, str(tmp_path / "copy")).count() == 4
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        copy_snapshot(rows, str(tmp_path / "copy"))
    assert rows.columns == PRODUCT_COLUMNS


def test_export_has_mark_and_quotes_formulas(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", " =SUM(A1)"), ("2", "Phone")], "product_id string, product_name string"
    )
    files.write_export(rows.coalesce(1), str(tmp_path / "x"))
    text = next((tmp_path / "x").glob("*.csv")).read_bytes()
    assert text.startswith("\ufeffproduct_id".encode())
    assert b"' =SUM(A1)" in text
