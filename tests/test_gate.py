"""The streaming version gate next to the batch operator."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_batch_and_stream import event, lines_of
from wareline.operators import events as E
from wareline.operators.events import CatalogState, parse_events, resolve_events, valid_events
from wareline.streaming import gate as G


def random_events(seed, n):
    """Few products and ids, so all four outcomes are frequent."""
    draw = random.Random(seed)
    for _ in range(n):
        number = draw.randrange(n // 2)
        yield event(
            1 + (number * 7 + draw.choice([0, 0, 1])) % 20,
            "delete" if number % 5 == 0 else "upsert",
            event_id=f"e{number}",
            product_id="HOT" if number % 3 else f"P-{number % 7}",
        )


def collected(outcomes):
    return sorted(
        (r.ord, r.event_id, r.status, r.original_status) for r in outcomes.collect()
    )


def run_drops(spark, tmp_path, payloads, drops):
    """Each drop arrives shuffled; the stream starts anew from its checkpoint."""
    size = -(-len(payloads) // drops)
    for start in range(0, len(payloads), size):
        part = lines_of(spark, payloads[start : start + size], start)
        part.orderBy(F.xxhash64("ord")).write.mode("append").parquet(f"{tmp_path}/in")
        arriving = spark.readStream.schema(part.schema).parquet(f"{tmp_path}/in")
        G.start_gate(arriving, f"{tmp_path}/log", f"{tmp_path}/checkpoint").awaitTermination()
    return G.gated_outcomes(spark, f"{tmp_path}/log")


@pytest.mark.parametrize("seed, drops", [(1, 1), (2, 3)])
def test_stream_equals_batch_under_shuffled_arrival_and_restarts(spark, tmp_path, seed, drops):
    payloads = [*random_events(seed, 120), "{", event(0, event_id="zero")]
    lines = lines_of(spark, payloads)
    batch = resolve_events(valid_events(parse_events(lines)), CatalogState.empty(spark))
    expected = collected(batch.outcomes)
    assert {"applied", "stale", "duplicate", "conflict"} == {status for _, _, status, _ in expected}
    assert collected(run_drops(spark, tmp_path, payloads, drops)) == expected


def test_only_events_that_bring_something_new_change_the_state():
    class Value:
        def get(self):
            return (5,)

        def update(self, value):
            raise AssertionError(value)

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    rows = pd.DataFrame(
        {
            "ord": [2, 1, 3], "event_id": ["b", "a", "a"], "product_id": "P",
            "version": [5, 4, 9], "status": ["new", "new", "conflict"],
        }
    )
    processor = G.NewestVersion()
    processor.init(Handle())
    (out,) = processor.handleInputRows(("P",), iter([rows[:2], rows[2:]]), None)
    assert list(out["ord"]) == [1, 2, 3]
    assert list(out["status"]) == ["stale", "stale", "conflict"]


def test_ids_are_judged_together_not_in_a_call_each():
    class Map(dict):
        getValue = dict.get
        updateValue = dict.__setitem__
        exists = dict.__len__

    stored = Map({("a",): ("x",)})

    class Handle:
        def getMapState(self, name, key_schema, value_schema):
            return stored

    rows = pd.DataFrame(
        {
            "ord": [4, 1, 3, 2, 5], "event_id": ["b", "a", "b", "a", "c"], "product_id": "P", "version": 1,
            "payload_hash": ["z", "x", "y", "w", "v"],
        }
    )
    processor = G.FirstUse()
    processor.init(Handle())
    (out,) = processor.handleInputRows((7,), iter([rows[:2], rows[2:]]), None)
    assert list(out["event_id"]) == ["a", "a", "b", "b", "c"]
    assert list(out["status"]) == ["duplicate", "conflict", "new", "conflict", "new"]
    assert stored == {("a",): ("x",), ("b",): ("y",), ("c",): ("v",)}


def test_a_line_is_whole_as_the_type_of_its_value_says(spark):
    lines = [
        '{"a":1}', ' \t\r\n{"a":1} ', "{}", "{", "}", "[{}]", '"{"', "1", "null", "{} {}", "{},{}", "{},", "],[",
        "] {", '{"a":1,"a":2}', "\u00a0{}", "\x0b{}", "{}x", "{}]", "[]", "true", "\ufeff{}", "{}\n{}", "// {}", ",{}",
    ]
    document = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    rows = spark.createDataFrame([(line,) for line in lines], "value string").withColumn("_doc", document)
    kinds = [F.schema_of_variant(F.try_variant_get("_doc", path, "variant")) for path in ("$[0]", "$[1]")]
    want = F.coalesce(kinds[0].startswith("OBJECT"), F.lit(False)) & kinds[1].isNull()
    plan = rows.select("value", E._is_whole_object().alias("got"), want.alias("want"))
    assert all(r.got == r.want for r in plan.collect()) and {r.got for r in plan.collect()} == {True, False}


class Table(dict):
    """A state map that counts its calls."""

    calls = 0

    def getValue(self, key):
        Table.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        Table.calls += 1
        self[key] = value

    def iterator(self):
        return iter(self.items())


class Cell(list):
    def get(self):
        return self[0] if self else None

    def update(self, value):
        self[:] = [value]


class Store:
    def __init__(self):
        self.held = {}

    def getMapState(self, name, key_schema, value_schema):
        return self.held.setdefault(name, Table())

    def getValueState(self, name, schema):
        return self.held.setdefault(name, Cell())


@pytest.mark.parametrize("page_keys", [4, 512])
def test_pages_hold_what_a_map_holds(monkeypatch, page_keys):
    monkeypatch.setattr(G, "PAGE_KEYS", page_keys)
    draw, plain, store, loose = random.Random(3), {}, Store(), 0
    for size in [0, 1, 40, 1, 2, 300, 1, 1, 30, 3, 900, 2, 1]:
        paged = G.PagedMap(store, "m")
        changes = {f"k{draw.randrange(2000)}": draw.randrange(100) for _ in range(size)}
        asked = [*changes, *(f"k{draw.randrange(2000)}" for _ in range(draw.choice([0, 400])))]
        assert paged.read(asked) == {key: plain[key] for key in asked if key in plain}
        paged.write(changes)
        plain |= changes
        loose += bool(store.held["m_loose"])
        assert paged.read([f"k{i}" for i in range(2000)]) == plain
    pages, held, _ = store.held["m_sizes"].get()
    assert loose and len(store.held["m_pages"]) == pages and held <= pages * page_keys


def test_a_bucket_of_events_takes_few_calls_to_the_state():
    numbers = range(20_000)
    ids = pd.DataFrame(
        {
            "ord": numbers, "event_id": [f"e{i}" for i in numbers], "product_id": [f"P{i % 5000}" for i in numbers],
            "version": [1 + i // 5000 for i in numbers], "payload_hash": "h",
        }
    )
    uses, versions = G.PagedFirstUse(), G.NewestVersions()
    stores = Store(), Store()
    for start, want in ((0, {"new"}), (10_000, {"new", "duplicate"})):
        for processor, store in zip((uses, versions), stores):
            processor.init(store)
        Table.calls = 0
        part = pd.concat([ids[start : start + 10_000], ids[:start]]).assign(ord=range(start, 10_000 + 2 * start))
        (seen,) = uses.handleInputRows((1,), iter([part]), None)
        assert set(seen["status"]) == want
        (out,) = versions.handleInputRows((1,), iter([seen]), None)
        assert (out["status"] == "applied").sum() == 10_000
        assert Table.calls < 250


def test_versions_of_one_bucket_equal_those_of_one_product_at_a_time():
    draw, store, single = random.Random(5), Store(), {}
    for batch in range(4):
        rows = pd.DataFrame(
            [
                (batch * 1000 + n, f"e{n}", f"P{draw.randrange(9)}", draw.randrange(1, 2**60), draw.choice(["new", "new", "conflict"]))
                for n in range(200)
            ],
            columns=["ord", "event_id", "product_id", "version", "status"],
        ).sample(frac=1, random_state=batch)
        versions, want = G.NewestVersions(), []
        versions.init(store)
        (got,) = versions.handleInputRows((1,), iter([rows[:50], rows[50:]]), None)
        for product, part in rows.groupby("product_id"):
            one = G.NewestVersion()
            one.init(single.setdefault(product, Store()))
            want += one.handleInputRows((product,), iter([part]), None)
        want = pd.concat(want).sort_values("ord", ignore_index=True)
        pd.testing.assert_frame_equal(got, want)
