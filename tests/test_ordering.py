"""Split keys against brute force in plain Python."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.operators import joins as C
from plumbline.operators import windows as E
from plumbline.ordering import cut, ordinal, over_order, prior, skew_join, upto


def rows_with_hot_key(n: int = 400, ties: bool = False, seed: int = 1):
    """Half of the rows share one key; with `ties` a third of them share one order value."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if r.random() < 0.5 else f"k{r.randrange(30)}"
        at = 500 if ties and r.random() < 0.35 else r.randrange(1000)
        out.append((key, at, i, r.randrange(50)))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("ties", [False, True])
def test_prior_and_running_maximum_match_brute_force(split, ties):
    data = rows_with_hot_key(ties=ties)
    df = split.createDataFrame(data, "k string, at long, id long, v long").repartition(5)
    seen = {r.id: r for r in prior(df, ["k"], [F.col("at"), F.col("id")], ["v"], "p").collect()}
    top = {r.id: r.m for r in over_order(
        df, ["k"], [F.col("at"), F.col("id")], {"x": (F.col("v"), "max")}, {"m": lambda w: F.max("x").over(upto(w))}).collect()}
    last, best = {}, {}
    for k, at, i, v in sorted(data, key=lambda t: (t[1], t[2])):
        assert (seen[i].p and seen[i].p.v) == last.get(k)
        best[k] = max(best.get(k, v), v)
        assert top[i] == best[k]
        last[k] = v
    assert len(seen) == len(top) == len(data)


def test_ordinal_over_the_whole_table(split):
    data = rows_with_hot_key(ties=True, seed=3)
    df = split.createDataFrame(data, "k string, at long, id long, v long")
    got = {r.id: r.ordinal for r in ordinal(df, [], [F.col("at"), F.col("id")]).collect()}
    expected = {t[2]: n for n, t in enumerate(sorted(data, key=lambda t: (t[1], t[2])), 1)}
    assert got == expected


def sizes_of(df, order):
    """Rows and bounds of each chunk of a table that is cut by `order` inside the key k."""
    return cut(df, ["k"], order).groupBy("__chunk").agg(
        F.count("*").alias("n"), F.min(F.struct("k", *order)).alias("lo"), F.max(F.struct("k", *order)).alias("hi")).orderBy("__chunk").collect()


def test_chunks_are_monotone_and_small(split):
    sizes = sizes_of(split.range(0, 5000).select(F.lit("one").alias("k"), F.col("id").alias("a")), ["a"])
    assert len(sizes) > 8 and max(s.n for s in sizes) < 5000 / 8
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:]))


def test_one_key_and_time_holding_most_rows_is_cut(split):
    """Also where the rest of the order does not tell the rows apart, as in an as-of join."""
    df = split.range(0, 4000).select(F.lit("one").alias("k"), F.lit(7).alias("at"), F.lit(0).alias("side"), "id")
    assert max(s.n for s in sizes_of(df, ["at", "side"])) < 4000 / 8
    right = split.createDataFrame([("one", 7, 1), ("one", 8, 2)], "k string, at long, id long").withColumn("at", F.timestamp_seconds("at"))
    left = df.select("k", "id", F.timestamp_seconds("at").alias("ts"))
    found = C.asof_join(left, right, ["k"], "ts", "at", "id", []).groupBy("matched.id").count().collect()
    assert [tuple(r) for r in found] == [(1, 4000)]


def test_thousands_of_tied_values(split):
    df = split.range(0, 9000).select(F.lit("one").alias("k"), (F.col("id") % 3000).alias("day"), "id")
    got = ordinal(df, ["k"], [F.col("day"), F.col("id")])
    assert got.filter(F.col("ordinal") != F.col("day") * 3 + F.floor(F.col("id") / 3000) + 1).count() == 0


@pytest.mark.parametrize("kind", ["string", "decimal(20,3)", "double", "date"])
def test_order_keys_keep_their_type(split, kind):
    values = {"string": "printf('%05d', id)", "decimal(20,3)": "id / 1000", "double": "id / 7", "date": "date_add(date'1990-01-01', int(id))"}
    df = split.range(0, 600).selectExpr("if(id % 3 = 0, 'hot', 'k' || id % 20) AS k", f"CAST({values[kind]} AS {kind}) AS at", "id").repartition(7)
    before = {}
    for r in sorted(df.collect(), key=lambda r: r.id):
        before.setdefault(r.k, []).append(r.id)
    expected = {i: (ids[n - 1] if n else None) for ids in before.values() for n, i in enumerate(ids)}
    assert {r.id: r.p and r.p.id for r in prior(df, ["k"], [F.col("at")], ["id"], "p").collect()} == expected


def test_null_order_and_null_keys_survive(split):
    data = [(None, None, i) for i in range(20)] + [("a", i, 100 + i) for i in range(20)]
    df = split.createDataFrame(data, "k string, at long, id long")
    assert prior(df, ["k"], [F.col("at"), F.col("id")], ["id"]).count() == 40


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(split, how):
    left = split.createDataFrame([("hot" if i % 2 else f"k{i % 40}", i) for i in range(500)], "k string, v int")
    right = split.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 4)], "k string, w int")
    plain = left.join(right, ["k"], how)
    assert sorted(map(str, skew_join(left, right, ["k"], how).collect())) == sorted(map(str, plain.collect()))


def test_skew_join_with_other_key_width(split):
    left = split.createDataFrame([(1, i) for i in range(50)], "k long, v int")
    right = split.createDataFrame([(1, "x")], "k int, w string")
    assert {r.w for r in skew_join(left, right, ["k"]).collect()} == {"x"}


event = st.tuples(st.sampled_from("ab"), st.integers(0, 40), st.one_of(st.none(), st.integers(0, 60)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=40), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60)), min_size=1, max_size=20))
def test_asof_with_two_clocks_matches_brute_force(split, quotes, asks):
    base = 1_700_000_000

    def stamp(name):
        return F.timestamp_seconds(F.col(name) + base)

    right = split.createDataFrame([(k, e, v, i) for i, (k, e, v) in enumerate(quotes)], "k string, e long, v long, id long").select(
        "k", "id", stamp("e").alias("event"), stamp("v").alias("visible"))
    left = split.createDataFrame([(k, t, i) for i, (k, t) in enumerate(asks)], "k string, t long, n long").select("k", "n", stamp("t").alias("at"))
    got = {r.n: (r.matched and r.matched.id) for r in C.asof_join(
        left, right, ["k"], "at", "event", "id", [], visible_ts="visible").collect()}
    for n, (k, t) in enumerate(asks):
        usable = [(e, i) for i, (qk, e, v) in enumerate(quotes) if qk == k and v is not None and max(e, v) <= t]
        assert got[n] == (max(usable)[1] if usable else None)


def test_forward_outcome_stops_at_the_segment(split):
    df = split.createDataFrame([("a", 1, i * 600, i) for i in range(20)] + [("a", 2, 50_000 + i * 600, 100 + i) for i in range(20)],
                               "s string, seg int, at long, id long").withColumn("ts", F.timestamp_seconds("at"))
    got = {(r.id, r.horizon_min): r.outcome for r in C.forward_outcome(df, ["s", "seg"], "ts", "id", "id", [15, 60]).collect()}
    for seg_ids, start in ((range(20), 0), (range(100, 120), 100)):
        for i in seg_ids:
            for h in (15, 60):
                j = (i - start) + -(-h * 60 // 600)
                assert got[(i, h)] == (start + j if j < 20 else None)


def test_latency_disorder_ignores_unknown_clocks(split):
    rows = [(i, (i * 7) % 50, i if i % 5 else None) for i in range(60)]
    df = split.createDataFrame(rows, "id long, e long, a long").select(
        F.lit("x").alias("k"), "id", F.timestamp_seconds("e").alias("event"), F.timestamp_seconds("a").alias("arrival"))
    got = {r.id: r.order_status for r in E.latency_disorder(df, ["k"], "event", "arrival", "id").collect()}
    newest = -1
    for i, e, a in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        assert got[i] == ("undetermined" if a is None else "out_of_order" if e < newest else "in_order")
        newest = max(newest, e) if a is not None else newest


def test_the_cut_is_only_physical(split):
    df = split.createDataFrame(rows_with_hot_key(), "k string, at long, id long, v long")
    order = [F.col("at"), F.col("id")]
    plain = sorted(map(tuple, ordinal(df, ["k"], order, whole=True).collect()))
    assert sorted(map(tuple, ordinal(df, ["k"], order).collect())) == plain


def test_empty_table(split):
    df = split.createDataFrame([], "k string, at long")
    assert ordinal(df, ["k"], [F.col("at")]).collect() == [] and ordinal(df, [], [F.col("at")]).collect() == []
