"""Features, running state and ranks over keys cut into many blocks: the same rows as plain windows over whole keys."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import features as X
from plumbline.operators import ranking as R
from plumbline.ordering import in_blocks, numbered, over_blocks, upto


@pytest.fixture(scope="module")
def bars(spark):
    rng, rows = random.Random(5), []
    for symbol, n in (("a", 400), ("b", 61), ("c", 60), ("d", 1), (None, 130)):
        price = 100.0
        for i in range(n):
            price *= 1 + rng.uniform(-0.02, 0.02)
            rows.append((symbol, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), price, price * 1.01, price * 0.99, price * rng.uniform(0.99, 1.01),
                         rng.randint(1, 60), rng.choice([None, True, False]), rng.choice([None, True, False]), rng.randint(-9, 9)))
    schema = "symbol string, bar_ts timestamp, open double, high double, low double, close double, volume long, compressed boolean, qualified boolean, oi long"
    return spark.createDataFrame(rows, schema).repartition(7)


def table(df, *names):
    got = df.toPandas().sort_values(["symbol", "bar_ts"], na_position="last").reset_index(drop=True)
    return got[sorted(got.columns)] if not names else got[["symbol", "bar_ts", *names]]


@pytest.mark.parametrize("feature", [
    lambda b, block: X.volatility(b, 14, block=block), lambda b, block: X.volume_contraction(b, block=block), lambda b, block: X.body_ratio(b, block=block),
    lambda b, block: X.oi_change(b, block=block), lambda b, block: X.range_break(b, block=block),
    lambda b, block: X.retest_hold(X.range_break(b, block=block), block=block), lambda b, block: X.first_release(b, block=block),
    lambda b, block: X.bounded_features(X.number_bars(b), block=block),
], ids=["volatility", "volume", "body", "oi", "break", "retest", "release", "all"])
def test_blocks_change_nothing(bars, split, feature):
    whole, cut = table(feature(bars, 1 << 16)), table(feature(bars, 30))
    assert len(whole) == bars.count()
    pd.testing.assert_frame_equal(cut, whole)


def test_features_against_plain_windows(bars, split):
    w = Window.partitionBy("symbol").orderBy("bar_ts")
    fall = F.coalesce(F.col("volume") < F.lag("volume").over(w), F.lit(False))
    run = bars.withColumn("fall", fall).withColumn("still", F.sum((~F.col("fall")).cast("int")).over(w))
    run = run.withColumn("fall_run", F.sum(F.col("fall").cast("long")).over(Window.partitionBy("symbol", "still").orderBy("bar_ts")))
    pd.testing.assert_frame_equal(table(X.volume_contraction(bars, block=30), "fall_run"), table(run, "fall_run"))
    high = F.when(F.count("*").over(w.rowsBetween(-20, -1)) == 20, F.max("high").over(w.rowsBetween(-20, -1)))
    pd.testing.assert_frame_equal(table(X.range_break(bars, block=30), "range_high"), table(bars.withColumn("range_high", high), "range_high"))


def test_first_release_against_a_loop(bars, split):
    got = table(X.first_release(bars, block=25), "compressed", "qualified", "compression_run", "is_first_release")
    for _, rows in got.groupby("symbol", dropna=False):
        run, before, open_run = 0, False, False
        for r in rows.itertuples():
            now = r.compressed is True
            run, open_run = (run + 1, True) if now and not before else (run, open_run)
            first = not now and r.qualified is True and open_run
            open_run = open_run and not first
            before = now
            assert (r.compression_run, r.is_first_release) == (run, first)


def test_macd_against_the_recursion(bars, split):
    got = table(X.macd(bars), "close", "macd", "macd_signal")
    for _, rows in got.groupby("symbol", dropna=False):
        close = rows["close"]
        macd = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
        pd.testing.assert_series_equal(rows["macd"], macd, check_names=False, rtol=1e-9, atol=1e-12)
        pd.testing.assert_series_equal(rows["macd_signal"], macd.ewm(span=9, adjust=False).mean(), check_names=False, rtol=1e-9, atol=1e-12)


def test_ema_composes_maps_over_many_blocks(spark):
    rng = random.Random(6)
    values = [rng.uniform(-1e6, 1e6) if i % 97 else 0.0 for i in range(2_000)]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "symbol string, bar_no long, v double")
    got = {r.bar_no: (r.fast, r.slow) for r in X.ema(df, {"fast": ("v", 1), "slow": ("v", 2), "long": ("v", 60)}).collect()}  # blocks of 48 and of 1,440 rows
    fast, slow = values[0], values[0]
    for i, v in enumerate(values):
        fast, slow = v if i == 0 else fast + (v - fast) * 1.0, v if i == 0 else slow + (v - slow) * 2 / 3
        assert got[i] == pytest.approx((fast, slow), rel=1e-9, abs=1e-6)


def test_numbers_and_carried_state(bars, split):
    rows = numbered(bars, ["symbol"], [F.col("bar_ts")], "n")
    w = Window.partitionBy("symbol").orderBy("bar_ts")
    assert rows.withColumn("want", F.row_number().over(w) - 1).where("n <> want").count() == 0 and rows.count() == bars.count()
    total = over_blocks(rows, ["symbol"], "n", {"__v": (F.col("volume"), "sum")}, {"total": lambda x: F.sum("__v").over(upto(x))}, 17)
    assert total.withColumn("want", F.sum("volume").over(w)).where("total <> want").count() == 0
    with pytest.raises(ValueError, match="halo"):
        in_blocks(rows, ["symbol"], "n", 40, 0, lambda x, keys: x, 30)
    assert numbered(bars.where("false"), ["symbol"], [F.col("bar_ts")], "n").count() == 0


def test_percent_rank_with_ties_and_nulls(bars, split):
    rows = bars.withColumn("v", F.when(F.col("volume") > 20, F.col("volume"))).withColumn("t", F.lit(1))
    ranked = R.rank_factors(rows, ["symbol"], {"v": 0.25, "close": 0.75, "t": 1.0})
    w = Window.partitionBy("symbol")
    for name in ("v", "close", "t"):
        want = F.percent_rank().over(w.orderBy(F.col(name).asc_nulls_first()))
        assert ranked.withColumn("want", want).where(f"{name}_rank is null or abs({name}_rank - want) > 1e-12").count() == 0
    assert ranked.count() == bars.count() and ranked.columns[-1] == "score"
    everything = R.percent_rank(rows, [], "volume", "p")
    assert everything.withColumn("want", F.percent_rank().over(Window.orderBy("volume"))).where("abs(p - want) > 1e-12").count() == 0
    assert R.percent_rank(rows.where("false"), ["symbol"], "v", "p").count() == 0


def test_event_windows_of_crowds(split):
    """Bars crowd in one minute, events in another: only events whose window holds bars meet any, however crowded; ties and nulls included."""
    import random

    from plumbline.operators import joins

    rng = random.Random(5)
    at = lambda minute: f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00"
    events = [(i, "a", 0 if i % 40 else rng.randrange(600)) for i in range(2_000)] + [(9_000, "b", 5), (9_001, None, 5), (9_002, "a", None)]
    rows = [(i, "a", 30 if i % 40 else rng.randrange(600)) for i in range(2_000)] + [(9_000, "b", 0), (9_001, "b", 25), (9_002, None, 5), (9_003, "a", None)]
    make = lambda table, name: split.createDataFrame([(i, k, None if m is None else at(m)) for i, k, m in table], f"{name} int, k string, t string").selectExpr(
        name, "k", f"CAST(t AS timestamp) AS {name}_ts")
    got = joins.event_window_join(make(events, "e"), make(rows, "r"), ["k"], "e_ts", "r_ts", 10, 20)
    want = sorted((e, r) for e, k, m in events for r, j, n in rows if None not in (k, j, m, n) and k == j and m - 10 <= n <= m + 20)
    assert got.columns == ["k", "e", "e_ts", "r", "r_ts"]
    assert sorted((x["e"], x["r"]) for x in got.collect()) == want
    assert joins.event_window_join(make(events, "e").where("false"), make(rows, "r"), ["k"], "e_ts", "r_ts", 10, 20).count() == 0


def test_event_windows_longer_than_a_span(spark, monkeypatch):
    from plumbline.operators import joins

    monkeypatch.setattr(joins, "SPAN", 7)
    rows = spark.range(100).selectExpr("id AS r", "'a' AS k", "timestamp_seconds(id * 60) AS r_ts")
    events = spark.range(0, 100, 9).selectExpr("id AS e", "'a' AS k", "timestamp_seconds(id * 60) AS e_ts")
    got = joins.event_window_join(events, rows, ["k"], "e_ts", "r_ts", 30, 15).select("e", "r").collect()
    assert sorted(map(tuple, got)) == sorted((e, r) for e in range(0, 100, 9) for r in range(100) if e - 30 <= r <= e + 15)


def test_outcomes_by_length_of_compression(spark):
    """Runs of 2 (released, goes on), 3 (released, turns back), 1 (released, outcome unknown), 2 (reaches the end: censored) and one never released."""
    from plumbline.plans import jobs

    marks = [*"cc.rxx", *"ccc", *"rxx", *"c.", *"cc", *"r", *"cc"]
    close = {3: 12, 4: 13, 9: 12, 10: 11}
    rows, run, was = [], 0, False
    for i, m in enumerate(marks):
        run += m == "c" and not was
        was = m == "c"
        rows.append(("s", i, f"2024-01-01 {i:02d}:00:00", 11.0, float(close.get(i, 11)), m == "c", m == "r", run))
    bars = spark.createDataFrame(rows, "symbol string, bar_no long, t string, open double, close double, compressed boolean, is_first_release boolean, compression_run long").selectExpr(
        "*", "CAST(t AS timestamp) AS bar_ts")
    got = sorted(tuple(r) for r in jobs.run_length_outcomes(bars, 60).collect())
    # symbol, length, censored, runs, released, known, continued, rate
    assert got == [("s", 1, False, 1, 0, 0, 0, None), ("s", 2, False, 2, 2, 2, 1, 0.5), ("s", 2, True, 1, 0, 0, 0, None), ("s", 3, False, 1, 1, 1, 0, 0.0)]
    assert jobs.run_length_outcomes(bars.where("false"), 60).collect() == []
