"""Followers of the published feed: restarts, crashes, parts left unread."""

import pytest

from tests.test_batch_and_stream import lines_of
from tests.test_publication import Crash, batch_of, crash_before_manifest, feed, numbered
from wareline.sources.store import CatalogStore
from wareline.streaming.events import apply_lines
from wareline.streaming.feed import copied_feed, copy_feed, follow_feed


def ids(df):
    return sorted(r.change_id for r in df.collect())


def test_a_follower_restarts_where_it_stopped(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "c"))
    target, checkpoint = str(tmp_path / "copy"), str(tmp_path / "checkpoint")
    copy_feed(store, target, checkpoint).awaitTermination()
    assert copied_feed(spark, target).isEmpty()
    apply_lines(store, lines_of(spark, numbered(2)), "0")
    copy_feed(store, target, checkpoint).awaitTermination()
    assert ids(copied_feed(spark, target)) == [1, 2, 3, 4]
    # Parts that have been followed are not opened again, nor those of a crashed attempt.
    for file in (tmp_path / "c" / "changes" / store.current().changes).glob("*.parquet"):
        file.write_bytes(b"not read")
    with pytest.raises(Crash):
        crash_before_manifest(CatalogStore(spark, store.root)).load_batch(batch_of(spark, "X"), "lost")
    store.load_batch(batch_of(spark, "L-1", "L-2"), "load")
    apply_lines(store, lines_of(spark, numbered(1, first=5)), "1")
    copy_feed(store, target, checkpoint).awaitTermination()
    got = copied_feed(spark, target)
    assert ids(got) == list(range(1, 9))
    assert {r.product_id for r in got.where("change_id > 4").collect()} == {"L-1", "L-2", "P-5"}


def test_an_epoch_that_failed_comes_again(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "c"))
    checkpoint, seen = str(tmp_path / "checkpoint"), []
    apply_lines(store, lines_of(spark, numbered(3)), "0")

    def failing(changes, epoch):
        raise Crash

    with pytest.raises(Exception):
        follow_feed(store, failing, checkpoint).awaitTermination()
    follow_feed(store, lambda c, e: seen.append((e, ids(c))), checkpoint, after=2).awaitTermination()
    assert seen == [(0, [3, 4, 5, 6])]
    assert [c for c, *_ in feed(store)] == list(range(1, 7))
