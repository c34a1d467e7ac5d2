"""The version gate as keyed state of a stream.

Where a catalog takes events rarely, a micro-batch resolves them against its
tables (`streaming.events`). Here the stream remembers by itself: one payload
hash an event id, one newest version a product. A micro-batch then costs its
own events and never reads the catalog. Ids and products are judged a bucket at a
time and found in pages of state (`PagedMap`), as a call to the state costs far more
than the work on an event. The state lies in the checkpoint, by hash of its key, and
moves to another executor when one is lost.

Only five narrow columns pass through the gate. The rows of one key within a
micro-batch are put in order in one task, so limit what a trigger takes
(``maxFilesPerTrigger`` of the source) where one product may own a third of
all events; `operators.events.classify` splits such products over tasks.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wareline.operators.events import parse_events
from wareline.operators.ordered import lookup

#: Buckets of event ids and of products. The state is kept by bucket, so a checkpoint holds for one number.
ID_BUCKETS = 1024
PRODUCT_BUCKETS = 1024
#: Keys of a page, at most, if they fall on pages evenly.
PAGE_KEYS = 512
#: Loose keys are put into pages once they are more than this part of the keys there.
LOOSE_PART = 8
GATED_SCHEMA = "ord bigint, event_id string, product_id string, version bigint, status string"


def _in_order(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(frames, ignore_index=True).sort_values("ord", ignore_index=True)


class PagedMap:
    """A map from text to a JSON value in the state of one bucket.

    Most keys lie in pages, by hash, which are read and written as a whole. The
    few changes of a small micro-batch are kept loose, a row each, until they are
    a fair part of all; so a page is not written again for every one of its keys.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.pages = handle.getMapState(f"{name}_pages", "page int", "entries string")
        self.loose = handle.getMapState(f"{name}_loose", "key string", "entry string")
        self.sizes = handle.getValueState(f"{name}_sizes", "pages int, paged bigint, loose bigint")

    def read(self, keys: Iterable[str]) -> dict:
        """The values of those of the keys that are held."""
        pages, _, loose = self.sizes.get() or (0, 0, 0)
        found, keys = {}, list(keys)
        for page, here in _by_page(keys, pages).items():
            entries = self._page(page)
            found.update((key, entries[key]) for key in here if key in entries)
        if loose > len(keys):
            held = ((key, self.loose.getValue((key,))) for key in keys)
            found.update((key, json.loads(entry[0])) for key, entry in held if entry is not None)
        elif loose:
            held, wanted = self._all_loose(), set(keys)
            found.update((key, value) for key, value in held.items() if key in wanted)
        return found

    def write(self, changes: dict) -> None:
        if not changes:
            return
        pages, paged, loose = self.sizes.get() or (0, 0, 0)
        if (loose + len(changes)) * LOOSE_PART <= paged:
            for key, value in changes.items():
                self.loose.updateValue((key,), (json.dumps(value),))
            # A key that was loose before counts twice, so it is put into its page sooner.
            self.sizes.update((pages, paged, loose + len(changes)))
            return
        if loose:
            changes = self._all_loose() | changes
            self.loose.clear()
        enough = 1 << max(0, -(-(paged + len(changes)) // PAGE_KEYS) - 1).bit_length()
        if enough > pages:
            kept = [self._page(page) for page in range(pages)]
            changes = {key: value for entries in kept for key, value in entries.items()} | changes
            dealt, paged = {page: {} for page in range(enough)}, 0
            pages = enough
        else:
            dealt = {page: self._page(page) for page in _by_page(changes, pages)}
        for page, here in _by_page(changes, pages).items():
            paged -= len(dealt[page])
            dealt[page].update((key, changes[key]) for key in here)
            paged += len(dealt[page])
        for page, entries in dealt.items():
            self.pages.updateValue((page,), (json.dumps(entries),))
        self.sizes.update((pages, paged, 0))

    def _page(self, page: int) -> dict:
        held = self.pages.getValue((page,))
        return json.loads(held[0]) if held is not None else {}

    def _all_loose(self) -> dict:
        return {key[0]: json.loads(entry[0]) for key, entry in self.loose.iterator()}


def _by_page(keys: Iterable[str], pages: int) -> dict[int, list[str]]:
    dealt = defaultdict(list)
    for key in keys if pages else ():
        dealt[zlib.crc32(key.encode()) % pages].append(key)
    return dealt


class FirstUse(StatefulProcessor):
    """Status of every use of the event ids of one bucket: new, duplicate or conflict.

    The ids of a bucket are judged together: one read an id, one write a new one.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.hashes = handle.getMapState("hashes", "event_id string", "payload_hash string")

    def stored(self, ids: Iterable[str]) -> dict[str, str]:
        """The payload hash of those of the ids that were used before."""
        held = ((i, self.hashes.getValue((i,))) for i in ids) if self.hashes.exists() else ()
        return {i: hashed[0] for i, hashed in held if hashed is not None}

    def keep(self, hashes: dict[str, str]) -> None:
        for event_id, payload_hash in hashes.items():
            self.hashes.updateValue((event_id,), (payload_hash,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        uses = _in_order(rows)
        earliest = ~uses["event_id"].duplicated()
        first = dict(zip(uses["event_id"][earliest], uses["payload_hash"][earliest]))
        known = self.stored(first)
        self.keep({i: hashed for i, hashed in first.items() if i not in known})
        same = uses["payload_hash"] == uses["event_id"].map(first | known)
        uses["status"] = same.map({True: "duplicate", False: "conflict"})
        uses.loc[earliest & ~uses["event_id"].isin(known), "status"] = "new"
        yield uses[["ord", "event_id", "product_id", "version", "status"]]


class PagedFirstUse(FirstUse):
    """The same with many ids a read and a write."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.hashes = PagedMap(handle, "hashes")

    def stored(self, ids: Iterable[str]) -> dict[str, str]:
        return self.hashes.read(ids)

    def keep(self, hashes: dict[str, str]) -> None:
        self.hashes.write(hashes)


def _judge_versions(events: pd.DataFrame, products: pd.Series, newest: dict[str, int]) -> dict[str, int]:
    """New events in order become applied or stale; returns the versions that rose."""
    codes, names = pd.factorize(products)
    held = np.array([newest.get(name, 0) for name in names], dtype=np.int64)
    new = events["status"] == "new"
    versions = events["version"].where(new, 0).astype("int64")
    reached = np.maximum(versions.groupby(codes).cummax(), held[codes])
    before = reached.groupby(codes).shift(fill_value=-1)
    before = before.where(before >= 0, held[codes])
    events.loc[new, "status"] = (versions > before)[new].map({True: "applied", False: "stale"})
    last = reached.groupby(codes).last().to_numpy()
    return {names[i]: int(last[i]) for i in np.flatnonzero(last > held)}


class NewestVersion(StatefulProcessor):
    """New events of one product become applied or stale; others pass."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.version = handle.getValueState("version", "newest bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events, known = _in_order(rows), self.version.get()
        one = pd.Series("", index=events.index)
        for version in _judge_versions(events, one, {"": known[0]} if known else {}).values():
            self.version.update((version,))
        yield events[["ord", "event_id", "product_id", "version", "status"]]


class NewestVersions(StatefulProcessor):
    """The same for the products of one bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = PagedMap(handle, "versions")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = _in_order(rows)
        # No identifier holds this character, which stands for none.
        products = events["product_id"].fillna("\0")
        new = products[events["status"] == "new"].unique()
        if len(new):
            self.versions.write(_judge_versions(events, products, self.versions.read(new)))
        yield events[["ord", "event_id", "product_id", "version", "status"]]


def gate(events: DataFrame) -> DataFrame:
    """``status`` of a stream of valid events, in the order of their arrival.

    Events of one micro-batch are taken by ``ord``. Versions are positive, as
    the event schema demands, so 0 stands for none.
    """
    uses = events.select("ord", "event_id", "product_id", "version", "payload_hash")
    # A call for each id or product would cost far more than the work on it.
    dealt = uses.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(ID_BUCKETS)))
    seen = dealt.groupBy("bucket").transformWithStateInPandas(
        PagedFirstUse(), GATED_SCHEMA, "append", "none"
    )
    dealt = seen.withColumn("bucket", F.pmod(F.xxhash64("product_id"), F.lit(PRODUCT_BUCKETS)))
    return dealt.groupBy("bucket").transformWithStateInPandas(
        NewestVersions(), GATED_SCHEMA, "append", "none"
    )


def start_gate(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Gate a stream of JSON lines ``(ord, value)`` into a log of outcomes.

    The file sink commits each micro-batch once, whatever is replayed. Lines
    that break a rule leave no state; `rejected_events` lists them.
    """
    columns = ["ord", "event_id", "product_id", "version", "payload_hash"]
    # As a filter on its outcome, the whole check would be computed twice.
    kept = F.when(F.col("reason").isNull(), F.array(F.struct(*columns)))
    valid = parse_events(lines).select(F.explode_outer(kept).alias("event")).where("event IS NOT NULL")
    return (
        gate(valid.select("event.*"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def gated_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The log, each duplicate with the outcome of the first use of its id."""
    log = spark.read.schema(GATED_SCHEMA).parquet(path)
    originals = log.where(F.col("status").isin("applied", "stale")).select(
        "event_id", F.col("status").alias("original_status")
    )
    columns = ["ord", "event_id", "status", "original_status"]
    # Only duplicates ask for an original.
    repeated = F.coalesce(F.col("status") == "duplicate", F.lit(False))
    others = log.where(~repeated).withColumn("original_status", F.lit(None).cast("string"))
    found = lookup(log.where(repeated), originals, ["event_id"], "ord")
    return others.select(columns).unionByName(found.select(columns))
