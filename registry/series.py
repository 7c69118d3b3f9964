"""Queries for windows, ranking, sets and functions (groups E to H and J)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import book as K
from plumbline.functions import scalars as S
from plumbline.functions import verdicts as V
from plumbline.operators import features as X
from plumbline.operators import ranking as R
from plumbline.operators import sets as G
from plumbline.operators import windows as E
from plumbline.ordering import in_blocks
from plumbline.rules import Rule, RuleSet
from plumbline.session import spread
from plumbline.sources import catalog
from registry.audits import EVENT_SHA, SUMS_SQL
from registry.base import bars, load, members, oi, order_days, query, session_sql, ticks, visibility


def r6(*names):
    """Doubles rounded on both sides so that summation order cannot show."""
    return [F.round(n, 6).alias(n) for n in names]


# ---- E: raw rows ----
@query("e01_key_order", """
SELECT trade_id, CASE WHEN p IS NULL OR user_id > p THEN 'ok' WHEN user_id = p THEN 'repeat' ELSE 'regression' END AS key_status
FROM (SELECT trade_id, user_id, lag(user_id) OVER (PARTITION BY symbol ORDER BY trade_id) AS p FROM ticks)""", ("ticks",))
def e01(spark, sf):
    return E.key_order(ticks(spark, sf).select("symbol", "trade_id", "user_id"), ["symbol"], "trade_id", "user_id").select("trade_id", "key_status")


@query("e02_time_regression", """
SELECT o_orderkey, CASE WHEN o_orderdate < p THEN 'regression' ELSE 'ok' END AS time_status
FROM (SELECT o_orderkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS p FROM orders)""")
def e02(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    return E.time_regression(rows, ["o_orderpriority"], "o_orderkey", "o_orderdate").select("o_orderkey", "time_status")


@query("e03_boundary_conflicts", """
WITH m AS (SELECT o_orderpriority, o_orderdate, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY ALL)
SELECT *, CASE WHEN first_key <= highest_before THEN 'conflict' ELSE 'ok' END AS boundary_status FROM
 (SELECT *, max(last_key) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest_before FROM m)""")
def e03(spark, sf):
    m = load(spark, sf, "orders").groupBy("o_orderpriority", "o_orderdate").agg(
        F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    return E.boundary_conflicts(m, ["o_orderpriority"], "o_orderdate", "first_key", "last_key")


@query("e04_latency_disorder", """
SELECT l_orderkey, l_linenumber, collected_at, CAST(epoch(collected_at) - epoch(event_ts) AS DOUBLE) AS latency_s,
 CASE WHEN event_ts < newest THEN 'out_of_order' ELSE 'in_order' END AS order_status FROM
 (SELECT *, max(event_ts) OVER (PARTITION BY l_returnflag ORDER BY collected_at, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM visibility)""", ("visibility",))
def e04(spark, sf):
    rows = visibility(spark, sf).withColumn("line_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return E.latency_disorder(rows, ["l_returnflag"], "event_ts", "collected_at", "line_id").select(
        "l_orderkey", "l_linenumber", "collected_at", "latency_s", "order_status")


@query("e05_segments", "SELECT grp, seg_start, seg_end, days FROM segs", ("segs",), seg_start="VARCHAR", seg_end="VARCHAR")
def e05(spark, sf):
    return E.segments(order_days(spark, sf), ["grp"], "day")


@query("e06_transition_audit", """
SELECT conv_id, turn, p AS from_state, CASE WHEN rn = 1 THEN (CASE WHEN role IN ('system', 'user') THEN 'start' ELSE 'illegal_start' END)
 WHEN p || '>' || role IN ('system>user', 'user>assistant', 'assistant>user') THEN 'ok' ELSE 'illegal' END AS step_status FROM
 (SELECT *, lag(role) OVER w AS p, row_number() OVER w AS rn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))""")
def e06(spark, sf):
    edges = [("system", "user"), ("user", "assistant"), ("assistant", "user")]
    rows = load(spark, sf, "conversations").select("conv_id", "turn", "role")
    return E.transition_audit(rows, "conv_id", "turn", "role", edges, ["system", "user"]).select("conv_id", "turn", "from_state", "step_status")


@query("e07_timeline_audit", """
SELECT l_orderkey, l_linenumber, intent, sent, ack, CASE WHEN sent < intent THEN 'sent' WHEN ack < sent THEN 'ack' END AS bad_step,
 CASE WHEN intent < TIMESTAMP '1993-01-01' THEN 'before_visible' WHEN sent < intent OR ack < sent THEN 'regression' ELSE 'ok' END AS timeline_status FROM
 (SELECT l_orderkey, l_linenumber, o_orderdate AS intent, l_shipdate AS sent, l_shipdate + to_days(CAST(l_linenumber - 2 AS INTEGER)) AS ack FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def e07(spark, sf):
    rows = visibility(spark, sf).select(
        "l_orderkey", "l_linenumber", F.col("event_ts").alias("intent"), F.col("collected_at").alias("sent"),
        (F.col("collected_at") + F.make_interval(days=F.col("l_linenumber") - 2)).alias("ack"),
        F.lit("1993-01-01").cast("timestamp_ntz").alias("visible"))
    return E.timeline_audit(rows, ["intent", "sent", "ack"], "visible").drop("visible")


# ---- E: bars ----
VOL_SQL = """, tr AS (SELECT symbol, bar_ts, greatest(h - l, abs(h - p), abs(l - p)) AS true_range, ln(c / p) AS lr FROM
 (SELECT symbol, bar_ts, CAST(high AS DOUBLE) AS h, CAST(low AS DOUBLE) AS l, CAST(close AS DOUBLE) AS c, lag(CAST(close AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY bar_ts) AS p FROM bars_1h)),
vf AS (SELECT symbol, bar_ts, true_range, CASE WHEN count(*) OVER f = 14 THEN avg(true_range) OVER f END AS atr, CASE WHEN count(*) OVER f = 14 THEN stddev_samp(lr) OVER f END AS rv FROM tr
 WINDOW f AS (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
vol AS (SELECT *, (atr < lag(atr, 14) OVER w AND rv < lag(rv, 14) OVER w) AS volatility_falling FROM vf WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts))"""


@query("e08_volatility", VOL_SQL + """ SELECT symbol, bar_ts, round(true_range, 6) AS true_range, round(atr, 6) AS atr, round(rv, 6) AS realised_vol, volatility_falling FROM vol""", ("bars_1h",))
def e08(spark, sf):
    return X.volatility(bars(spark, sf)).select("symbol", "bar_ts", *r6("true_range", "atr", "realised_vol"), "volatility_falling")


VOLUME_SQL = """, vr AS (SELECT symbol, bar_ts, CASE WHEN n = 20 THEN s / l END AS volume_ratio, fall, sum(1 - fall) OVER (PARTITION BY symbol ORDER BY bar_ts) AS run FROM
  (SELECT symbol, bar_ts, CASE WHEN volume < lag(volume) OVER (PARTITION BY symbol ORDER BY bar_ts) THEN 1 ELSE 0 END AS fall,
   count(*) OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS n,
   avg(volume) OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS s,
   avg(volume) OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS l FROM bars_1h))"""


@query("e09_volume_contraction", VOLUME_SQL + """ SELECT symbol, bar_ts, round(volume_ratio, 6) AS volume_ratio, CAST(sum(fall) OVER (PARTITION BY symbol, run ORDER BY bar_ts) AS BIGINT) AS fall_run FROM vr""", ("bars_1h",))
def e09(spark, sf):
    return X.volume_contraction(bars(spark, sf)).select("symbol", "bar_ts", *r6("volume_ratio"), "fall_run")


RECURSIVE = """, b AS (SELECT symbol, bar_ts, CAST(close AS DOUBLE) AS c, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS n FROM bars_1h),
e AS (SELECT symbol, bar_ts, n, c AS f, c AS s FROM b WHERE n = 1 UNION ALL
 SELECT b.symbol, b.bar_ts, b.n, f + (b.c - f) * 2 / 13.0::DOUBLE, s + (b.c - s) * 2 / 27.0::DOUBLE FROM e JOIN b ON b.symbol = e.symbol AND b.n = e.n + 1),
g AS (SELECT symbol, bar_ts, n, f - s AS macd, f - s AS sig FROM e WHERE n = 1 UNION ALL
 SELECT e.symbol, e.bar_ts, e.n, e.f - e.s, sig + (e.f - e.s - sig) * 2 / 10.0::DOUBLE FROM g JOIN e ON e.symbol = g.symbol AND e.n = g.n + 1)"""
BODY_SQL = """, body AS (SELECT *, avg(br) OVER (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS bm FROM
 (SELECT symbol, bar_ts, CASE WHEN high > low THEN abs(CAST(close AS DOUBLE) - CAST(open AS DOUBLE)) / (CAST(high AS DOUBLE) - CAST(low AS DOUBLE)) END AS br FROM bars_1h))"""
OI_SQL = """, oc AS (SELECT symbol, bar_ts, oi, oi - lag(oi, 5) OVER w AS oi_change, oi - lag(oi) OVER w AS oi_step, (oi - lag(oi) OVER w > 0 AND lag(oi) OVER w - lag(oi, 2) OVER w < 0) AS oi_turned_up
FROM oi WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts))"""


@query("e10_macd", RECURSIVE + " SELECT symbol, bar_ts, round(macd, 6) + 0.0 AS macd, round(sig, 6) + 0.0 AS macd_signal FROM g", ("bars_1h",))
def e10(spark, sf):
    return X.macd(bars(spark, sf)).select("symbol", "bar_ts", *[(F.round(n, 6) + F.lit(0.0)).alias(n) for n in ("macd", "macd_signal")])


@query("e11_body_ratio", BODY_SQL + " SELECT symbol, bar_ts, round(br, 6) AS body_ratio, round(bm, 6) AS body_mean FROM body", ("bars_1h",))
def e11(spark, sf):
    return X.body_ratio(bars(spark, sf)).select("symbol", "bar_ts", *r6("body_ratio", "body_mean"))


@query("e12_oi_change", OI_SQL + " SELECT symbol, bar_ts, oi, oi_change, oi_turned_up FROM oc", ("oi",))
def e12(spark, sf):
    return X.oi_change(oi(bars(spark, sf))).select("symbol", "bar_ts", "oi", "oi_change", "oi_turned_up")


BREAK_SQL = """, r AS (SELECT *, CASE WHEN count(*) OVER b = 20 THEN max(high) OVER b END AS range_high, CASE WHEN count(*) OVER b = 20 THEN min(low) OVER b END AS range_low FROM bars_1h
 WINDOW b AS (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, CASE WHEN close > range_high THEN 'up' WHEN close < range_low THEN 'down' END AS break_side,
 min(close) OVER f AS next_min, max(close) OVER f AS next_max, min(low) OVER f AS next_low, count(*) OVER f AS next_n FROM r
 WINDOW f AS (PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING))"""


@query("e13_range_break", BREAK_SQL + """ SELECT symbol, bar_ts, break_side, CASE break_side WHEN 'up' THEN next_min <= range_high WHEN 'down' THEN next_max >= range_low END AS false_break FROM k""", ("bars_1h",))
def e13(spark, sf):
    return X.range_break(bars(spark, sf)).select("symbol", "bar_ts", "break_side", "false_break")


@query("e13_session_break", f"""
, s AS (SELECT *, {session_sql('bar_ts')} AS session, CAST(bar_ts AS DATE) AS day FROM bars_1h),
r AS (SELECT symbol, day, max(high) AS rh, min(low) AS rl FROM s WHERE session = 'asia' GROUP BY ALL),
j AS (SELECT s.*, rh, rl, min(close) OVER f AS later_min, max(close) OVER f AS later_max, CASE WHEN close > rh THEN 'up' WHEN close < rl THEN 'down' END AS break_side
 FROM s LEFT JOIN r ON s.symbol = r.symbol AND s.day = r.day WHERE session = 'europe' WINDOW f AS (PARTITION BY s.symbol, s.day ORDER BY bar_ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT symbol, bar_ts, break_side, CASE break_side WHEN 'up' THEN later_min <= rh WHEN 'down' THEN later_max >= rl END AS false_break FROM j""", ("bars_1h",))
def e13s(spark, sf):
    rows = bars(spark, sf).withColumn("session", S.session_label("bar_ts")).withColumn("day", S.session_date("bar_ts"))
    return X.session_range_break(rows, "session", "day").select("symbol", "bar_ts", "break_side", "false_break")


@query("e14_retest_hold", BREAK_SQL + """ SELECT symbol, bar_ts, CASE WHEN break_side = 'up' AND next_n = 3 THEN next_low > range_high END AS retest_held FROM k""", ("bars_1h",))
def e14(spark, sf):
    return X.retest_hold(X.range_break(bars(spark, sf))).select("symbol", "bar_ts", "retest_held")


@query("e15_first_release", """
, s AS (SELECT *, lag(volume) OVER w AS pv, lag(volume, 2) OVER w AS pv2 FROM bars_1h WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)),
c AS (SELECT symbol, bar_ts, coalesce(volume < pv AND pv < pv2, false) AS compressed, coalesce(volume > 2 * pv, false) AS qualified FROM s),
n AS (SELECT *, sum(CASE WHEN compressed AND NOT pc THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY bar_ts) AS run FROM
 (SELECT *, coalesce(lag(compressed) OVER (PARTITION BY symbol ORDER BY bar_ts), false) AS pc FROM c)),
q AS (SELECT *, NOT compressed AND qualified AND run > 0 AS cand FROM n)
SELECT symbol, bar_ts, CAST(run AS BIGINT) AS compression_run, cand AND bar_ts = min(bar_ts) FILTER (cand) OVER (PARTITION BY symbol, run) AS is_first_release FROM q""", ("bars_1h",))
def e15(spark, sf):
    def flags(rows, keys):
        w = Window.partitionBy(*keys).orderBy("bar_no")
        v, p, p2 = F.col("volume"), F.lag("volume").over(w), F.lag("volume", 2).over(w)
        return rows.withColumn("compressed", F.coalesce((v < p) & (p < p2), F.lit(False))).withColumn("qualified", F.coalesce(v > 2 * p, F.lit(False)))

    rows = in_blocks(X.number_bars(bars(spark, sf)), ["symbol"], "bar_no", 2, 0, flags)
    return X.first_release(rows).select("symbol", "bar_ts", "compression_run", "is_first_release")


@query("e16_warm", """
SELECT trade_id, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS segment_row, row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) > 50 AS is_warm FROM ticks""", ("ticks",))
def e16(spark, sf):
    from plumbline.ordering import micros
    rows = ticks(spark, sf).select("symbol", "ts", "trade_id")
    return E.warm(rows, ["symbol"], [micros("ts"), F.col("trade_id")], 50).select("trade_id", "segment_row", "is_warm")


@query("e17_current_declaration", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, count(*) AS n_versions FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49) GROUP BY 1""")
def e17(spark, sf):
    facts = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    revoked = load(spark, sf, "lineitem").filter("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey")).join(
        facts.select("o_custkey", "o_orderkey"), "o_orderkey")
    return E.current_declaration(facts, ["o_custkey"], "o_orderkey", ["o_orderstatus"], revoked)


AS_OF = ["1994-01-01", "1996-06-01", "1999-01-01"]


@query("e17_declarations_as_of", f"""
WITH r AS (SELECT l_orderkey, min(l_shipdate) AS revoked FROM lineitem WHERE l_quantity >= 45 GROUP BY 1),
c AS (SELECT CAST(unnest({AS_OF}) AS TIMESTAMP) AS cutoff)
SELECT o_custkey, strftime(cutoff, '%Y-%m-%d') AS cutoff, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, count(*) AS n_versions
FROM orders LEFT JOIN r ON l_orderkey = o_orderkey CROSS JOIN c WHERE o_orderdate <= cutoff AND (revoked IS NULL OR revoked > cutoff) GROUP BY o_custkey, cutoff""")
def e17a(spark, sf):
    """Orders are versions, seen on their day; large lines revoke them when they are shipped."""
    facts = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    revoked = load(spark, sf, "lineitem").filter("l_quantity >= 45").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("revoked_at")).join(
        facts.select("o_custkey", "o_orderkey"), "o_orderkey")
    cutoffs = [F.lit(c).cast("timestamp_ntz") for c in AS_OF]
    out = E.declarations_as_of(facts, ["o_custkey"], "o_orderkey", ["o_orderstatus"], "o_orderdate", revoked, "revoked_at", cutoffs)
    return out.withColumn("cutoff", F.date_format("cutoff", "yyyy-MM-dd"))


@query("e18_revisions", """
SELECT l_returnflag, CASE WHEN p IS NULL THEN 'first' WHEN p = l_linestatus THEN 'repeat' ELSE 'revision' END AS seen_as, count(*) AS n FROM
 (SELECT *, lag(l_linestatus) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS p FROM lineitem) GROUP BY ALL""")
def e18(spark, sf):
    from plumbline.ordering import micros
    order = [micros("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice") * 100]
    return E.revisions(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order, F.col("l_linestatus")).groupBy(
        "l_returnflag", "seen_as").agg(F.count("*").alias("n"))


# ---- F ----
@query("f01_latest_n", """
SELECT symbol, trade_id, rank, 'unique' AS identity_status FROM (SELECT symbol, trade_id, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, trade_id DESC) AS rank
 FROM ticks WHERE ts <= TIMESTAMP '2024-01-20 00:00:00') WHERE rank <= 256""", ("ticks",))
def f01(spark, sf):
    top = R.latest_n(ticks(spark, sf), ["symbol"], "ts", "trade_id", 256, F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return top.select("symbol", "trade_id", F.col("rank").cast("bigint").alias("rank"), "identity_status")


@query("f02_canonical_order", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderstatus, o_totalprice / 7, o_orderdate, o_orderkey) AS ordinal FROM orders""")
def f02(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate")
    keys = [F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice") / 7, F.col("o_orderdate"), F.col("o_orderkey")]
    return R.canonical_order(rows, keys).select("o_orderkey", "ordinal")


@query("f03_daily_top", """
SELECT day, trade_id, price, rank FROM (SELECT CAST(ts AS DATE) AS day, trade_id, price, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY price DESC, trade_id) AS rank
 FROM ticks WHERE symbol = 'purchase' AND qty >= 90) WHERE rank <= 2""", ("ticks",), price="DOUBLE", day="VARCHAR")
def f03(spark, sf):
    rows = ticks(spark, sf).withColumn("day", F.to_date("ts"))
    top = R.daily_top(rows, ["day"], "price", "trade_id", (F.col("symbol") == "purchase") & (F.col("qty") >= 90))
    return top.select("day", "trade_id", "price", F.col("rank").cast("bigint").alias("rank"))


@query("f04_member_bounds", """
SELECT symbol, CAST(ts AS DATE) AS event_date, arg_min(ts, trade_id) AS first_ts, arg_min(price, trade_id) AS first_price, arg_max(ts, trade_id) AS last_ts, arg_max(price, trade_id) AS last_price,
 count(*) AS n_rows, count(*) FILTER (NOT ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-25 12:00:00') AS outside,
 CASE WHEN count(*) FILTER (NOT ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-25 12:00:00') = 0 THEN 'in_bounds' ELSE 'out_of_bounds' END AS bound_status FROM ticks GROUP BY 1, 2""", ("ticks",), first_price="DOUBLE", last_price="DOUBLE", event_date="VARCHAR")
def f04(spark, sf):
    rows = ticks(spark, sf).withColumn("event_date", F.to_date("ts"))
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-02 00:00:00", "2024-01-25 12:00:00"))
    return R.member_bounds(rows, ["symbol", "event_date"], ["trade_id"], ["ts", "price"], "ts", lo, hi)


@query("f05_rank_factors", """
SELECT symbol, bar_ts, round(percent_rank() OVER (PARTITION BY symbol ORDER BY volume) * 0.5 + percent_rank() OVER (PARTITION BY symbol ORDER BY n_trades) * 0.5, 6) AS score FROM bars_1h""", ("bars_1h",))
def f05(spark, sf):
    return R.rank_factors(bars(spark, sf), ["symbol"], {"volume": 0.5, "n_trades": 0.5}).select("symbol", "bar_ts", *r6("score"))


# ---- G ----
@query("g01_population", """
SELECT concat_ws('+', CASE WHEN a THEN 'adopted' END, CASE WHEN r THEN 'rejected' END, CASE WHEN o THEN 'observed' END) AS parts,
 CASE WHEN CAST(a AS INT) + CAST(r AS INT) + CAST(o AS INT) = 0 THEN 'unassigned' WHEN CAST(a AS INT) + CAST(r AS INT) + CAST(o AS INT) > 1 THEN 'overlap' ELSE 'assigned' END AS population_status, count(*) AS n_keys FROM
 (SELECT o_orderkey, o_orderstatus = 'F' AS a, o_orderstatus = 'P' AS r, o_orderstatus = 'O' AND o_totalprice > 1000 OR (o_orderstatus = 'P' AND o_custkey % 2 = 0) AS o FROM orders) GROUP BY ALL""")
def g01(spark, sf):
    orders = load(spark, sf, "orders")
    parts = {"adopted": orders.filter("o_orderstatus = 'F'"), "rejected": orders.filter("o_orderstatus = 'P'"),
             "observed": orders.filter("(o_orderstatus = 'O' AND o_totalprice > 1000) OR (o_orderstatus = 'P' AND o_custkey % 2 = 0)")}
    return G.population(orders, parts, ["o_orderkey"])


PAIR_SQL = """WITH a AS (SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem WHERE l_suppkey % 5 <> 0),
b AS (SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem WHERE l_suppkey % 7 <> 0)"""


def _pair(spark, sf):
    rows = load(spark, sf, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_linestatus"]
    return rows.filter("l_suppkey % 5 <> 0").select(*cols), rows.filter("l_suppkey % 7 <> 0").select(*cols), cols


@query("g02_replay_equal", PAIR_SQL + """ SELECT only_first, only_second, CASE WHEN only_first = 0 AND only_second = 0 THEN 'equal' ELSE 'different' END AS replay_status
FROM (SELECT count(*) AS only_first FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)), (SELECT count(*) AS only_second FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""")
def g02(spark, sf):
    a, b, cols = _pair(spark, sf)
    return G.replay_equal(a, b, cols)


@query("g03_verify_restore", """
WITH m AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE lang <> 'de'), f AS (SELECT doc_id, sha256(CASE WHEN doc_id % 10 = 0 THEN text || 'x' ELSE text END) AS h FROM documents WHERE source <> 'web' OR doc_id % 3 = 0)
SELECT coalesce(m.doc_id, f.doc_id) AS doc_id, CASE WHEN f.doc_id IS NULL THEN 'missing' WHEN m.doc_id IS NULL THEN 'undeclared' WHEN m.h = f.h THEN 'restored' ELSE 'hash_mismatch' END AS restore_status
FROM m FULL JOIN f ON m.doc_id = f.doc_id""")
def g03(spark, sf):
    docs = load(spark, sf, "documents")
    text = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return G.verify_restore(docs.filter("lang <> 'de'").select("doc_id", S.sha256("text").alias("h")),
                            docs.filter("source <> 'web' OR doc_id % 3 = 0").select("doc_id", S.sha256(text).alias("h")), ["doc_id"], "h")


@query("g04_replicate", f"""SELECT copy, count(*) AS n_rows, {SUMS_SQL} AS fingerprint
FROM (SELECT copy, {EVENT_SHA} FROM events, (SELECT unnest([1, 2, 3, 4]) AS copy)) GROUP BY copy""")
def g04(spark, sf):
    return G.replicated_fingerprints(load(spark, sf, "events"), ["event_id", "ts", "user_id", "event_type"], 4)


@query("g05_field_union", "SELECT 'k' AS field, count(*) AS n_records FROM events WHERE props LIKE '%\"k\"%'")
def g05(spark, sf):
    return G.field_union(load(spark, sf, "events"), "props")


@query("g06_append_only", PAIR_SQL + """ SELECT lost, added, CASE WHEN lost = 0 THEN 'append_only' ELSE 'rewritten' END AS append_status
FROM (SELECT count(*) AS lost FROM (SELECT * FROM a EXCEPT ALL SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem)),
(SELECT count(*) AS added FROM (SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem EXCEPT ALL SELECT * FROM a))""")
def g06(spark, sf):
    a, _, cols = _pair(spark, sf)
    return G.append_only(a, load(spark, sf, "lineitem").select(*cols), cols)


@query("g06_appended_text", """
SELECT doc_id, CASE WHEN starts_with(n, text) THEN 'append_only' ELSE 'rewritten' END AS append_status, CASE WHEN starts_with(n, text) THEN sha256(substr(n, length(text) + 1)) END AS suffix_sha
FROM (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN 'x' || text ELSE text || lang END AS n FROM documents)""")
def g06b(spark, sf):
    new = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x"), "text")).otherwise(F.concat("text", "lang"))
    return load(spark, sf, "documents").select("doc_id", G.appended_text(F.col("text"), new).alias("r")).select("doc_id", "r.*")


# ---- H ----
@query("h01_record_sha", f"SELECT event_id, {EVENT_SHA} FROM events")
def h01(spark, sf):
    return load(spark, sf, "events").select("event_id", S.record_sha(["event_id", "ts", "user_id", "event_type"]).alias("s"))


@query("h02_digests", "SELECT doc_id, sha256(text) AS sha, md5(text) AS md5 FROM documents")
def h02(spark, sf):
    return load(spark, sf, "documents").select("doc_id", S.sha256("text").alias("sha"), S.md5("text").alias("md5"))


def _sensitive_sql():
    from plumbline.contracts import SENSITIVE_PATTERNS
    return SENSITIVE_PATTERNS


def _nested_redaction():
    text = "text"
    for p in _sensitive_sql().values():
        text = f"regexp_replace({text}, '{p}', '[redacted]', 'g')"
    return text


@query("h03_redact", f"SELECT doc_id, sha256({_nested_redaction()}) AS redacted_sha, {_nested_redaction()} <> text AS changed FROM documents")
def h03(spark, sf):
    clean = S.redact("text")
    return spread(load(spark, sf, "documents").select("doc_id", "text")).select("doc_id", S.sha256(clean).alias("redacted_sha"), (clean != F.col("text")).alias("changed"))


@query("h04_sensitive_hits", " UNION ALL ".join(
    f"SELECT doc_id, '{rule}' AS rule, CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS hits FROM documents WHERE regexp_matches(text, '{p}')"
    for rule, p in _sensitive_sql().items()))
def h04(spark, sf):
    cells = F.array(*[F.struct(F.lit(r).alias("rule"), c.alias("hits")) for r, c in S.sensitive_counts("text").items()])
    return spread(load(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.inline(cells)).filter("hits > 0")


NUMBER_SQL = r"regexp_full_match(t, '-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?')"


@query("h05_strict_decimal", f"""
SELECT t, {NUMBER_SQL} AS is_number, CASE WHEN {NUMBER_SQL} THEN TRY_CAST(t AS DECIMAL(18,6)) END AS number, count(*) AS n FROM
 (SELECT CAST(event_id AS VARCHAR) || (CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.50' WHEN 2 THEN 'e3' ELSE '.' END) AS t FROM events) GROUP BY ALL""", number="DOUBLE")
def h05(spark, sf):
    tail = F.when(F.col("user_id") % 4 == 0, "").when(F.col("user_id") % 4 == 1, ".50").when(F.col("user_id") % 4 == 2, "e3").otherwise(".")
    rows = load(spark, sf, "events").select(F.concat(F.col("event_id").cast("string"), tail).alias("t"))
    n = S.strict_decimal("t", 18, 6)
    return rows.select("t", n.isNotNull().alias("is_number"), n.alias("number")).groupBy("t", "is_number", "number").agg(F.count("*").alias("n"))


@query("h06_strict_bool", """
SELECT raw, CASE lower(raw) WHEN 'true' THEN true WHEN 'false' THEN false END AS flag, count(*) AS n FROM
 (SELECT CASE user_id % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' WHEN 2 THEN '1' ELSE event_type END AS raw FROM events) GROUP BY ALL""")
def h06(spark, sf):
    m = F.col("user_id") % 4
    raw = F.when(m == 0, "TRUE").when(m == 1, "false").when(m == 2, "1").otherwise(F.col("event_type"))
    return load(spark, sf, "events").select(raw.alias("raw")).groupBy("raw", S.strict_bool("raw").alias("flag")).agg(F.count("*").alias("n"))


@query("h07_from_epoch", """
SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_ms, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_s FROM events""")
def h07(spark, sf):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ms, s = F.floor(us / 1000), F.floor(us / 1000000)
    return load(spark, sf, "events").select(
        "event_id", S.from_epoch(ms, "ms").cast("timestamp_ntz").alias("from_ms"), S.from_epoch(s, "s").cast("timestamp_ntz").alias("from_s"))


@query("h08_parse_zoned", """
SELECT event_id, CASE WHEN user_id % 3 = 0 AND date_trunc('second', ts) <= TIMESTAMP '2024-01-15 00:00:00' THEN date_trunc('second', ts)
 WHEN user_id % 3 = 1 AND date_trunc('second', ts) - INTERVAL 8 HOUR <= TIMESTAMP '2024-01-15 00:00:00' THEN date_trunc('second', ts) - INTERVAL 8 HOUR END AS parsed FROM events""")
def h08(spark, sf):
    m = F.col("user_id") % 3
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(m == 0, "Z").when(m == 1, "+08:00").otherwise(""))
    start = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return load(spark, sf, "events").select("event_id", S.parse_zoned(text, start).cast("timestamp_ntz").alias("parsed"))


@query("h09_date_matches", """
SELECT l_orderkey, l_linenumber, count(*) FILTER (CAST(source_visible_at AS DATE) = CAST(collected_at AS DATE)) AS n_match, count(*) AS n FROM visibility GROUP BY ALL""", ("visibility",))
def h09(spark, sf):
    return visibility(spark, sf, by_order=True).groupBy("l_orderkey", "l_linenumber").agg(
        F.count_if(S.date_matches("source_visible_at", F.to_date("collected_at"))).alias("n_match"), F.count("*").alias("n"))


@query("h10_parse_checksum", """
SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN sha256(text) END AS sha256, CASE WHEN doc_id % 4 <> 0 THEN 'd-' || doc_id || '.zip' END AS name FROM documents""")
def h10(spark, sf):
    gap = F.when(F.col("doc_id") % 4 == 0, " ").otherwise("  ")
    line = F.concat(S.sha256("text"), gap, F.lit("d-"), F.col("doc_id").cast("string"), F.lit(".zip"))
    return load(spark, sf, "documents").select("doc_id", S.parse_checksum(line).alias("c")).select("doc_id", "c.sha256", "c.name")


@query("h11_infer_symbols", """
SELECT p_partkey, concat_ws(',', CASE WHEN contains(upper(p_name || ' ' || p_type), 'ECONOMY') THEN 'ECONOMY' END, CASE WHEN contains(upper(p_name || ' ' || p_type), 'RING') THEN 'RING' END,
 CASE WHEN contains(upper(p_name || ' ' || p_type), 'SMALL') THEN 'SMALL' END) AS candidates FROM part""")
def h11(spark, sf):
    found = S.infer_symbols(F.concat_ws(" ", "p_name", "p_type"), ["small", "ring", "economy"])
    return load(spark, sf, "part").select("p_partkey", F.concat_ws(",", found).alias("candidates"))


@query("h12_time_candidates", """
SELECT 'orders' AS "table", 'o_orderdate' AS "column", 'typed' AS evidence, 'undetermined' AS time_contract, count(*) AS n_rows FROM orders
UNION ALL SELECT 'events', 'ts', 'typed', 'undetermined', count(*) FROM events UNION ALL SELECT 'lineitem', 'l_shipdate', 'typed', 'undetermined', count(*) FROM lineitem""")
def h12(spark, sf):
    columns = catalog.catalog_metadata(spark, {t: load(spark, sf, t) for t in ("orders", "events", "lineitem", "labels")})
    return catalog.time_candidates(columns).select("table", "column", "evidence", "time_contract", "n_rows")


@query("h13_unique_json_long", """
SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) END AS event_time FROM events""")
def h13(spark, sf):
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit('{"k":'), k, F.lit(',"E":'), k, F.lit("}"))).otherwise(F.col("props"))
    return load(spark, sf, "events").select("event_id", S.unique_json_long(text, ["$.k", "$.E"]).alias("event_time"))


def books(spark, sf):
    """Three levels a side around each line's price; zero discount or tax gives equal levels, which are not valid."""
    p, d, t = (F.col(c).cast("decimal(18,6)") for c in ("l_extendedprice", "l_discount", "l_tax"))
    q = F.col("l_quantity").cast("decimal(18,6)")

    def level(price, qty):
        return F.struct(price.cast("decimal(18,6)").alias("price"), qty.cast("decimal(18,6)").alias("qty"))

    bids = F.array(*[level(p - d * j, q - 2 * (j - 1)) for j in (1, 2, 3)])
    asks = F.array(*[level(p + t * j, q + j) for j in (1, 2, 3)])
    return load(spark, sf, "lineitem").select("*", bids.alias("bids"), asks.alias("asks"))


@query("h14_book_valid", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount > 0 AND l_tax > 0 AND l_quantity >= 4 AS valid FROM lineitem""")
def h14(spark, sf):
    return books(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", K.book_valid("bids", "asks").alias("valid"))


@query("h15_spread_depth_impact", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS p, l_discount AS d, l_tax AS t, l_quantity AS q, 50000.0 * (1 + l_orderkey % 40) AS n FROM lineitem),
w AS (SELECT *, least(n, (p + t) * (q + 1)) AS t1 FROM b), w2 AS (SELECT *, least(n - t1, (p + 2 * t) * (q + 2)) AS t2 FROM w), w3 AS (SELECT *, least(n - t1 - t2, (p + 3 * t) * (q + 3)) AS t3 FROM w2),
r AS (SELECT *, CASE WHEN n - t1 - t2 - t3 <= 1e-9 THEN t1 / (p + t) + t2 / (p + 2 * t) + t3 / (p + 3 * t) END AS depth FROM w3)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(t + d, 6) AS spread, round(depth, 5) AS depth, round((n / depth - p) / p, 8) + 0.0 AS impact FROM r""")
def h15(spark, sf):
    n = (1 + F.col("l_orderkey") % 40) * F.lit(50000.0)
    return books(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(K.spread("bids", "asks").cast("double"), 6).alias("spread"),
        F.round(K.depth("asks", n), 5).alias("depth"), (F.round(K.impact("asks", n, F.col("l_extendedprice")), 8) + F.lit(0.0)).alias("impact"))


@query("h16_session_label", f"SELECT event_id, {session_sql('ts')} AS session, CAST(ts AS DATE) AS session_date FROM events", session_date="VARCHAR")
def h16(spark, sf):
    return load(spark, sf, "events").select("event_id", S.session_label("ts").alias("session"), S.session_date("ts").alias("session_date"))


@query("h17_after_cutoff", """
SELECT event_id, CASE WHEN ts > c AND date_trunc('hour', ts) = date_trunc('hour', c) THEN 'after_ambiguous' WHEN ts > c THEN 'after' ELSE 'before' END AS side
FROM events, (SELECT TIMESTAMP '2024-01-10 10:20:00' AS c)""")
def h17(spark, sf):
    c = F.lit("2024-01-10 10:20:00").cast("timestamp_ntz")
    return load(spark, sf, "events").select("event_id", S.after_cutoff("ts", c, "hour").alias("side"))


@query("h18_schema_sha", """
SELECT sha256('0|doc_id|bigint|true' || chr(10) || '1|quality|int|true' || chr(10) || '2|toxic|int|true') AS schema_sha, count(*) AS n_rows FROM labels""")
def h18(spark, sf):
    labels = load(spark, sf, "labels")
    return labels.agg(F.count("*").alias("n_rows")).select(S.schema_sha(labels).alias("schema_sha"), "n_rows")


@query("h25_time_gate", """
SELECT o_orderkey, CASE WHEN n IS NOT NULL AND n > 1 THEN 'pass' ELSE 'unknown' END AS time_gate FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def h25(spark, sf):
    seen = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.when(F.count("*") > 1, F.max("l_shipdate")).alias("visible"))
    return load(spark, sf, "orders").join(seen, "o_orderkey", "left").select("o_orderkey", S.time_gate("o_orderdate", "visible").alias("time_gate"))


@query("h28_source_visible_at", """
SELECT o_orderkey, CASE WHEN s IS NOT NULL THEN greatest(o_orderdate, s) END AS source_visible_at FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS s FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def h28(spark, sf):
    seen = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("s"))
    return load(spark, sf, "orders").join(seen, "o_orderkey", "left").select(
        "o_orderkey", S.source_visible_at("o_orderdate", "s").alias("source_visible_at"))


@query("h29_input_version", r"""
SELECT o_orderkey, sha256(o_orderkey || chr(10) || o_orderstatus || chr(10) || coalesce(CAST(q AS VARCHAR), '\N')) AS version
FROM orders LEFT JOIN labels ON doc_id = o_orderkey LEFT JOIN (SELECT doc_id AS i, quality AS q FROM labels) ON i = o_orderkey""")
def h29(spark, sf):
    labels = load(spark, sf, "labels").select(F.col("doc_id").alias("o_orderkey"), "quality")
    return load(spark, sf, "orders").join(labels, "o_orderkey", "left").select(
        "o_orderkey", S.input_version(["o_orderkey", "o_orderstatus", "quality"]).alias("version"))


# ---- H: verdicts ----
@query("h19_compression_state", """
SELECT symbol, bar_ts, met, met >= 3 AS compressed FROM (SELECT symbol, bar_ts, CAST(volume < 300 AS INT) + CAST(n_trades < 5 AS INT) + CAST(high - low < 40 AS INT) + CAST(abs(close - open) < 10 AS INT) + CAST(taker_buy < taker_sell AS INT) AS met FROM bars_1h)""", ("bars_1h",))
def h19(spark, sf):
    c = F.col
    state = V.compression_state(c("volume") < 300, c("n_trades") < 5, c("high") - c("low") < 40, F.abs(c("close") - c("open")) < 10,
                                c("taker_buy") < c("taker_sell"), needed=3)
    return bars(spark, sf).select("symbol", "bar_ts", state.alias("s")).select("symbol", "bar_ts", "s.*")


@query("h20_release_direction", """
, s AS (SELECT *, lag(high) OVER w AS ph, lag(low) OVER w AS pl, lag(volume) OVER w AS pv, lead(low) OVER w AS nl FROM bars_1h WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)),
d AS (SELECT symbol, bar_ts, coalesce(close > ph AND volume > pv AND taker_buy > taker_sell AND n_trades > 2 AND nl > ph * 0.1, false) AS l, coalesce(close < pl AND volume > pv AND taker_sell > taker_buy AND n_trades > 3, false) AS s FROM s)
SELECT symbol, bar_ts, CASE WHEN l AND NOT s THEN 'long' WHEN s AND NOT l THEN 'short' ELSE 'none' END AS direction FROM d""", ("bars_1h",))
def h20(spark, sf):
    from pyspark.sql import Window as W
    w, c = W.partitionBy("symbol").orderBy("bar_ts"), F.col
    rows = bars(spark, sf).select("*", F.lag("high").over(w).alias("ph"), F.lag("low").over(w).alias("pl"), F.lag("volume").over(w).alias("pv"), F.lead("low").over(w).alias("nl"))
    side = V.release_direction(c("close") > c("ph"), c("close") < c("pl"), c("volume") > c("pv"), c("taker_buy") > c("taker_sell"),
                               c("taker_sell") > c("taker_buy"), c("n_trades") > 2, c("n_trades") > 3, c("nl") > c("ph") * 0.1)
    return rows.select("symbol", "bar_ts", side.alias("direction"))


@query("h21_risk_release", """
SELECT symbol, bar_ts, coalesce(close < open * 0.5 AND taker_sell > taker_buy AND low < 5 AND taker_sell < lag(taker_sell) OVER (PARTITION BY symbol ORDER BY bar_ts), false) AS risk_release FROM bars_1h""", ("bars_1h",))
def h21(spark, sf):
    from pyspark.sql import Window as W
    c = F.col
    rows = bars(spark, sf).withColumn("ps", F.lag("taker_sell").over(W.partitionBy("symbol").orderBy("bar_ts")))
    flag = V.risk_release(c("close") < c("open") * F.lit(0.5).cast("decimal(2,1)"), c("taker_sell") > c("taker_buy"), c("low") < 5, c("taker_sell") < c("ps"))
    return rows.select("symbol", "bar_ts", flag.alias("risk_release"))


@query("h22_permission", """
SELECT symbol, event_date, reason IS NULL AS allowed, reason FROM (SELECT symbol, event_date, CASE WHEN NOT n_rows > 40 THEN 'data' WHEN NOT n_rows > 50 THEN 'sample' WHEN NOT first_id % 2 = 0 THEN 'edge' WHEN NOT last_id % 3 <> 0 THEN 'cost'
 WHEN NOT n_rows % 2 = 0 THEN 'risk' END AS reason FROM members)""", ("members",), event_date="VARCHAR")
def h22(spark, sf):
    c, yes = F.col, F.lit(True)
    gates = {"data": c("n_rows") > 40, "sample": c("n_rows") > 50, "edge": c("first_id") % 2 == 0, "cost": c("last_id") % 3 != 0,
             "risk": c("n_rows") % 2 == 0, "execution": yes, "discipline": yes}
    return members(spark, sf).select("symbol", "event_date", V.permission(gates).alias("p")).select("symbol", "event_date", "p.*")


@query("h23_admission_layers", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'open' ELSE 'closed' END AS data_gate, CASE WHEN o_custkey % 2 = 0 THEN 'open' ELSE 'closed' END AS research,
 CASE WHEN q = 1 THEN 'open' ELSE 'closed' END AS trading, 'closed' AS real_money FROM orders LEFT JOIN (SELECT doc_id, quality AS q FROM labels) ON doc_id = o_orderkey""")
def h23(spark, sf):
    labels = load(spark, sf, "labels").select(F.col("doc_id").alias("o_orderkey"), "quality")
    rows = load(spark, sf, "orders").join(labels, "o_orderkey", "left")
    layers = V.admission_layers(F.when(F.col("o_orderstatus") == "F", "open").otherwise("conflict"), F.when(F.col("o_custkey") % 2 == 0, "open"),
                                F.when(F.col("quality") == 1, "open"), F.lit(None).cast("string"))
    return rows.select("o_orderkey", layers.alias("a")).select("o_orderkey", "a.*")


@query("h24_fill_verdict", """
WITH b AS (SELECT l_discount > 0 AND l_tax > 0 AND l_quantity >= 4 AS valid FROM lineitem),
g AS (SELECT unnest(['aggressive_market', 'aggressive_limit', 'passive_limit_cancel']) AS kind)
SELECT kind, valid, CASE WHEN kind LIKE 'passive%' THEN 'canceled' WHEN valid THEN 'filled' ELSE 'unknown' END AS terminal_state,
 CASE WHEN kind LIKE 'passive%' THEN 'QUEUE_IDENTITY_UNAVAILABLE' WHEN NOT valid THEN 'BOOK_INVALID' END AS reason, count(*) AS n FROM b CROSS JOIN g GROUP BY ALL""")
def h24(spark, sf):
    from plumbline.contracts import ORDER_KINDS
    from plumbline.operators.joins import with_grid
    rows = with_grid(books(spark, sf).select(K.book_valid("bids", "asks").alias("valid")), kind=ORDER_KINDS)
    return rows.select("kind", "valid", V.fill_verdict("kind", "valid").alias("v")).select("kind", "valid", "v.*").groupBy(
        "kind", "valid", "terminal_state", "reason").agg(F.count("*").alias("n"))


@query("h26_availability", """
SELECT d.doc_id, CASE WHEN toxic = 1 THEN 'unavailable' WHEN quality IS NULL THEN 'undetermined' WHEN n_chars < 500 THEN (CASE WHEN lang = 'en' THEN 'limited' ELSE 'undetermined' END)
 WHEN quality = 1 THEN 'available' ELSE 'undetermined' END AS availability FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def h26(spark, sf):
    rows = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left")
    verdict = V.availability(F.col("toxic") == 1, F.col("quality").isNull(), F.col("n_chars") < 500, F.col("lang") == "en", F.col("quality") == 1)
    return rows.select("doc_id", verdict.alias("availability"))


@query("h27_identity_verdict", """
SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'rejected' WHEN n_name IS NOT NULL AND s_acctbal > 500 THEN 'proven' ELSE 'undetermined' END AS identity
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 1""")
def h27(spark, sf):
    from plumbline.contracts import IDENTITY_FIELDS
    nation = load(spark, sf, "nation").filter("n_regionkey <> 1").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    rows = load(spark, sf, "supplier").join(nation, "s_nationkey", "left")
    fields = {n: F.col("s_name") for n in IDENTITY_FIELDS} | {"venue": F.col("n_name"), "contract": F.when(F.col("s_acctbal") > 500, F.col("s_name"))}
    return rows.select("s_suppkey", V.identity_verdict(fields, F.col("s_acctbal") < 0).alias("identity"))


# ---- J ----
LINE_RULES = RuleSet.freeze([
    Rule("q1", "l_quantity <= 0", "quantity_not_positive"),
    Rule("q2", "l_discount = 0", "no_discount"),
    Rule("q3", "l_extendedprice < 1000", "price_low"),
])


@query("j01_rule_set", f"""
SELECT reasons, '{LINE_RULES.sha}' AS rule_sha, count(*) AS n FROM (SELECT concat_ws(',', CASE WHEN l_quantity <= 0 THEN 'quantity_not_positive' END, CASE WHEN l_discount = 0 THEN 'no_discount' END,
 CASE WHEN l_extendedprice < 1000 THEN 'price_low' END) AS reasons FROM lineitem) GROUP BY ALL""")
def j01(spark, sf):
    return LINE_RULES.apply(load(spark, sf, "lineitem")).groupBy(F.concat_ws(",", "reasons").alias("reasons"), "rule_sha").agg(F.count("*").alias("n"))


@query("j03_ema", """
, b AS (SELECT symbol, bar_ts, CAST(close AS DOUBLE) AS c, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS n FROM bars_1d),
e AS (SELECT symbol, bar_ts, n, c AS f FROM b WHERE n = 1 UNION ALL SELECT b.symbol, b.bar_ts, b.n, f + (b.c - f) * 2 / 6.0::DOUBLE FROM e JOIN b ON b.symbol = e.symbol AND b.n = e.n + 1)
SELECT symbol, bar_ts, round(f, 6) AS ema FROM e""", ("bars_1d",))
def j03(spark, sf):
    return X.ema(X.number_bars(bars(spark, sf, "1 day")), {"ema": ("close", 5)}).select("symbol", "bar_ts", *r6("ema"))
