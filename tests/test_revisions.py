"""Late rows correct published windows, whatever fails on the way."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.streaming import revisions as V

SCHEMA = "symbol string, ts timestamp, price double, qty long, buyer_maker boolean, trade_id long"


def quality():
    return V.quality_parts({"large": F.col("qty") > 5})


def hourly():
    return V.window_pieces("ts", "1 hour", ["symbol"], quality())


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


@pytest.fixture
def feed(spark, tmp_path):
    """Publish rows (symbol, minute, qty) as one more micro-batch."""
    def push(rows, pieces=None, delay="30 MINUTES"):
        pieces = pieces or hourly()
        made = [(s, None if m is None else at(m), float(q), q, bool(q % 2), i) for i, (s, m, q) in enumerate(rows)]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        V.publish_revisions(stream, f"{tmp_path}/out", f"{tmp_path}/state", delay, pieces).awaitTermination()
        return f"{tmp_path}/out"

    return push


def windows(spark, root):
    return {(r.symbol, r.window_start.hour): (r.n_rows, r.large, r.revision, r.window_state) for r in V.published_windows(spark, root, ["symbol"], quality()).collect()}


def test_late_rows_correct_published_windows(spark, feed):
    root = feed([("a", 10, 1), ("a", 70, 9)])
    assert windows(spark, root) == {("a", 0): (1, 0, 0, "open"), ("a", 1): (1, 1, 0, "open")}
    feed([("a", 20, 2), ("a", 100, 1)])  # behind no watermark yet: not a correction
    assert windows(spark, root)[("a", 0)] == (2, 0, 0, "published")
    feed([("a", 30, 7), ("a", 31, 7), ("b", 5, 1), (None, 5, 1), ("a", None, 1)])
    got = windows(spark, root)
    assert got[("a", 0)] == (4, 2, 1, "published") and got[("b", 0)] == (1, 0, 1, "published") and got[(None, 0)] == (1, 0, 1, "published")
    feed([("a", 1, 1), ("a", 400, 1)])
    assert windows(spark, root) == {("a", 0): (5, 2, 2, "published"), ("a", 1): (2, 1, 0, "published"), ("a", 6): (1, 0, 0, "open"),
                                    ("b", 0): (1, 0, 1, "published"), (None, 0): (1, 0, 1, "published")}
    then = {(r.symbol, r.window_start.hour, r.revision): (r.n_rows, r.epoch) for r in V.window_history(spark, root, ["symbol"], quality()).collect()}
    assert {k[2]: v for k, v in then.items() if k[:2] == ("a", 0)} == {0: (2, 1), 1: (4, 2), 2: (5, 3)}


def test_compaction_does_not_show(spark, feed):
    root = feed([("a", 10, 1), ("a", 200, 9)])
    feed([("a", 20, 2)])
    before = windows(spark, root)
    for _ in range(2):  # the second time there is nothing to do
        V.compact(spark, root, ["symbol"], quality())
        assert windows(spark, root) == before and before[("a", 0)] == (2, 0, 1, "published")
    feed([("a", 21, 8)])
    assert windows(spark, root)[("a", 0)] == (3, 1, 2, "published")
    V.compact(spark, root, ["symbol"], quality())
    assert windows(spark, root)[("a", 0)] == (3, 1, 2, "published")


def test_epoch_that_broke_is_not_read_and_done_again(spark, feed, tmp_path):
    root = feed([("a", 10, 1), ("a", 200, 9)])
    rows = spark.createDataFrame([("a", at(11), 1.0, 1, True, 7)], SCHEMA)
    hourly()(rows, F.lit(None).cast("bigint")).write.parquet(f"{root}/epoch=1/data")  # its manifest was never written
    assert windows(spark, root)[("a", 0)] == (1, 0, 0, "published")
    V.revision_writer(root, "30 MINUTES", hourly())(rows, 1)
    assert windows(spark, root)[("a", 0)] == (2, 0, 1, "published")
    V.revision_writer(root, "30 MINUTES", hourly())(rows, 1)  # published: stays as it is
    assert windows(spark, root)[("a", 0)] == (2, 0, 1, "published")


def test_nothing_published(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing is published"):
        V.published_windows(spark, str(tmp_path), ["symbol"], quality())


def test_empty_first_batch(spark, feed):
    root = feed([])
    V.revision_writer(root, "30 MINUTES", hourly())(spark.createDataFrame([], SCHEMA), 0)
    feed([("a", 10, 1)])
    assert windows(spark, root) == {("a", 0): (1, 0, 0, "open")}


def test_late_row_joins_two_segments(spark, feed):
    pieces = V.segment_pieces("ts", "10 MINUTES", ["symbol"])
    root = feed([("a", 0, 1), ("a", 5, 1), ("a", 20, 1), ("b", 0, 1), ("a", 300, 1)], pieces)

    def segments():
        return {(r.symbol, r.first_ts, r.last_ts): (r.n_rows, r.revision, r.window_state) for r in V.published_segments(spark, root, ["symbol"], "10 MINUTES").collect()}

    assert segments() == {("a", at(0), at(5)): (2, 0, "published"), ("a", at(20), at(20)): (1, 0, "published"), ("b", at(0), at(0)): (1, 0, "published"),
                          ("a", at(300), at(300)): (1, 0, "open")}
    feed([("a", 12, 1), ("a", 309, 1)], pieces)
    got = segments()
    assert got[("a", at(0), at(20))] == (4, 1, "published") and got[("a", at(300), at(309))] == (2, 0, "open") and len(got) == 3
    feed([("a", 30, 1)], pieces)  # exactly the gap away: a segment of its own
    assert segments()[("a", at(30), at(30))] == (1, 1, "published") and len(segments()) == 4


def test_bars_merge_first_and_last_trade(spark, feed):
    parts = V.bar_parts()
    pieces = V.window_pieces("ts", "1 hour", ["symbol"], parts)
    root = feed([("a", 30, 5), ("a", 40, 6)], pieces)
    feed([("a", 10, 3), ("a", 50, 4)], pieces)
    bar = V.published_windows(spark, root, ["symbol"], parts).first()
    assert (bar.high, bar.low, bar.volume, bar.taker_buy, bar.taker_sell, bar.n_trades) == (6.0, 3.0, 18, 10, 8, 4)
