"""Streaming queries (I): each drives a stream over the given files and is compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.session import fresh_folder
from plumbline.streaming import revisions as V
from plumbline.streaming import streams as L
from registry.base import load, query, ticks

EDGES = [("system", "user"), ("user", "assistant"), ("assistant", "user")]


def source(spark, sf, table):
    """The table as a file stream; a glob, so that one file and a directory of parts both work."""
    schema = load(spark, sf, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{table[:-1]}[{table[-1]}].parquet")


def tick_stream(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return source(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").cast("decimal(18,6)").alias("price"), (k + 1).alias("qty"), (k % 2 == 0).alias("buyer_maker"), "user_id")


def finish(spark, stream, name):
    return L.run_to_files(stream, fresh_folder(spark, f"{name}-out"), fresh_folder(spark, f"{name}-state"))


def stepped(rows):
    """`rows` in four steps: thirds by id, and every eleventh trade held back until all others are in."""
    span = rows.agg(F.struct(F.min("trade_id").alias("lo"), F.max("trade_id").alias("hi"))).scalar()
    third = F.floor(3 * (F.col("trade_id") - span["lo"]) / (span["hi"] - span["lo"] + 1))
    return rows.withColumn("step", F.when(F.col("trade_id") % 11 == 0, 3).otherwise(third))


STEP_SQL = """, st AS (SELECT *, CASE WHEN trade_id % 11 = 0 THEN 3 ELSE CAST(floor(3 * (trade_id - lo) / (hi - lo + 1)) AS INTEGER) END AS step
 FROM ticks, (SELECT min(trade_id) AS lo, max(trade_id) AS hi FROM ticks)),
marks AS (SELECT step, (SELECT max(ts) FROM st WHERE st.step < s.step) - INTERVAL 1 HOUR AS mark FROM (SELECT DISTINCT step FROM st) s)"""


def revise(spark, sf, name, pieces, after_step=None):
    """Folder to which the ticks are published step by step, each as one micro-batch behind the watermark that the steps before it set."""
    source, root, state = (fresh_folder(spark, f"{name}-{k}") for k in ("in", "out", "state"))
    rows = stepped(ticks(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")))
    for step in range(4):
        rows.where(F.col("step") == step).write.mode("append").parquet(source)
        V.publish_revisions(spark.readStream.schema(rows.schema).parquet(source), root, state, "1 HOUR", pieces).awaitTermination()
        if after_step:
            after_step(step, root)
    return root


def finish_windows(spark, sf, name, windows):
    """All windows that `windows` makes of the ticks, also those that the input leaves open."""
    folder = fresh_folder(spark, f"{name}-end")
    ticks = tick_stream(spark, sf)
    end = spark.range(1).select(*[(F.lit("9000-01-01") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in ticks.schema])
    out = windows(L.with_closing(ticks, folder))
    return L.run_to_end(out, end, folder, fresh_folder(spark, f"{name}-out"), fresh_folder(spark, f"{name}-state"))


@query("i01_stream_quality", """
SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start, symbol, count(*) AS n_rows, count(*) FILTER (price <= 0.5) AS price_low, count(*) FILTER (qty > 90) AS qty_high
FROM ticks GROUP BY ALL""", ("ticks",))
def i01(spark, sf):
    rules = {"price_low": F.col("price") <= 0.5, "qty_high": F.col("qty") > 90}
    out = finish_windows(spark, sf, "i01", lambda ticks: L.stream_quality(ticks, "ts", "6 hours", "1 hour", ["symbol"], rules))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("i01_late_quality", STEP_SQL + """
SELECT window_start, symbol, count(*) AS n_rows, count(*) FILTER (price <= 0.5) AS price_low, count(*) FILTER (qty > 90) AS qty_high,
 count(DISTINCT step) FILTER (window_start + INTERVAL 6 HOUR <= mark) AS revision, CASE WHEN window_start + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM ticks) THEN 'published' ELSE 'open' END AS window_state
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start FROM st JOIN marks USING (step)) GROUP BY window_start, symbol""", ("ticks",))
def i01l(spark, sf):
    parts = V.quality_parts({"price_low": F.col("price") <= 0.5, "qty_high": F.col("qty") > 90})
    root = revise(spark, sf, "i01l", V.window_pieces("ts", "6 hours", ["symbol"], parts))
    return V.published_windows(spark, root, ["symbol"], parts).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("i02_stream_dedup", """SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM (SELECT DISTINCT user_id, symbol FROM ticks)""", ("ticks",))
def i02(spark, sf):
    unique = L.stream_dedup(tick_stream(spark, sf).select("user_id", "symbol", "ts", "trade_id"), ["user_id", "symbol"], "ts", "60 days",
                            spread=F.col("trade_id") % 8)
    return finish(spark, unique, "i02").agg(F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("n_users"))


@query("i03_stream_late_split", """
SELECT CASE WHEN qty > 48 THEN 'late' ELSE 'on_time' END AS arrival_status, symbol, count(*) AS n FROM ticks GROUP BY ALL""", ("ticks",))
def i03(spark, sf):
    rows = tick_stream(spark, sf).withColumn("arrived", F.col("ts") + F.make_interval(hours=F.col("qty").cast("int")))
    split = L.stream_late_split(rows, "ts", "arrived", "2 DAYS").select("symbol", "arrival_status")
    return finish(spark, split, "i03").groupBy("arrival_status", "symbol").agg(F.count("*").alias("n"))


@query("i04_stream_segments", """, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY symbol ORDER BY trade_id) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS cut FROM ticks),
s AS (SELECT *, sum(cut) OVER (PARTITION BY symbol ORDER BY trade_id) AS seg FROM g)
SELECT symbol, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows FROM s GROUP BY symbol, seg""", ("ticks",))
def i04(spark, sf):
    out = finish_windows(spark, sf, "i04", lambda ticks: L.stream_segments(ticks, "ts", "1 hour", "1 hour", ["symbol"]))
    return out.select("symbol", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_ts", "last_ts")], "n_rows")


@query("i04_late_segments", STEP_SQL + """, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY symbol ORDER BY ts, trade_id) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS cut FROM st JOIN marks USING (step)),
s AS (SELECT *, sum(cut) OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS seg FROM g)
SELECT symbol, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows, count(DISTINCT step) FILTER (ts + INTERVAL 1 HOUR <= mark) AS revision,
 CASE WHEN max(ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM ticks) THEN 'published' ELSE 'open' END AS window_state FROM s GROUP BY symbol, seg""", ("ticks",))
def i04l(spark, sf):
    root = revise(spark, sf, "i04l", V.segment_pieces("ts", "1 HOUR", ["symbol"]))
    return V.published_segments(spark, root, ["symbol"], "1 HOUR").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@query("i05_late_bars", STEP_SQL + """, r AS (SELECT symbol, date_trunc('hour', ts) AS bar_ts, count(DISTINCT step) FILTER (date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark) AS revision FROM st JOIN marks USING (step) GROUP BY ALL)
SELECT *, CASE WHEN bar_ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM ticks) THEN 'published' ELSE 'open' END AS window_state FROM bars_1h JOIN r USING (symbol, bar_ts)""",
       ("bars_1h",), open="DOUBLE", high="DOUBLE", low="DOUBLE", close="DOUBLE")
def i05l(spark, sf):
    """Compacted once on the way, which must not show."""
    parts = V.bar_parts()
    root = revise(spark, sf, "i05l", V.window_pieces("ts", "1 hour", ["symbol"], parts), lambda step, root: V.compact(spark, root, ["symbol"], parts) if step == 1 else None)
    return V.published_windows(spark, root, ["symbol"], parts).withColumnRenamed("window_start", "bar_ts").withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))


@query("i05_bar_history", STEP_SQL + """, p AS (SELECT *, date_trunc('hour', ts) AS bar_ts, date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark AS late FROM st JOIN marks USING (step)),
v AS (SELECT symbol, bar_ts, unnest(range(0, 1 + count(DISTINCT step) FILTER (late))) AS k, list(DISTINCT step ORDER BY step) FILTER (late) AS late_steps, count(*) FILTER (NOT coalesce(late, false)) AS early FROM p GROUP BY symbol, bar_ts)
SELECT v.symbol, v.bar_ts, k AS revision, CAST(CASE WHEN k = 0 THEN max(p.step) ELSE late_steps[k] END AS BIGINT) AS epoch, CAST(sum(qty) AS BIGINT) AS volume, count(*) AS n_trades
FROM v JOIN p ON p.symbol = v.symbol AND p.bar_ts = v.bar_ts AND (NOT coalesce(p.late, false) OR p.step <= late_steps[k]) WHERE k > 0 OR early > 0 GROUP BY v.symbol, v.bar_ts, k, late_steps""", ("ticks",))
def i05h(spark, sf):
    parts = V.bar_parts()
    root = revise(spark, sf, "i05h", V.window_pieces("ts", "1 hour", ["symbol"], parts))
    return V.window_history(spark, root, ["symbol"], parts).select("symbol", F.col("window_start").cast("timestamp_ntz").alias("bar_ts"), "revision", "epoch", "volume", "n_trades")


@query("i05_stream_bars", "SELECT * FROM bars_1h", ("bars_1h",), open="DOUBLE", high="DOUBLE", low="DOUBLE", close="DOUBLE")
def i05(spark, sf):
    return finish_windows(spark, sf, "i05", lambda ticks: L.stream_bars(ticks, "1 hour", "1 hour")).withColumn(
        "bar_ts", F.col("bar_ts").cast("timestamp_ntz"))


@query("i05_stream_bars_sliding", """
SELECT symbol, w AS bar_ts, CAST(sum(qty) AS BIGINT) AS volume, count(*) AS n_trades FROM (SELECT symbol, qty, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM ticks)
GROUP BY ALL""", ("ticks",))
def i05b(spark, sf):
    return finish_windows(spark, sf, "i05b", lambda ticks: L.stream_bars(ticks, "2 hours", "1 hour", "1 hour")).select(
        "symbol", F.col("bar_ts").cast("timestamp_ntz").alias("bar_ts"), "volume", "n_trades")


@query("i06_stream_lifecycle", """
SELECT CAST(conv_id AS VARCHAR) AS order_id, turn AS seq, p AS from_state, role AS state, CASE WHEN rn = 1 THEN (CASE WHEN role IN ('system', 'user') THEN 'start' ELSE 'illegal_start' END)
 WHEN p || '>' || role IN ('system>user', 'user>assistant', 'assistant>user') THEN 'ok' ELSE 'illegal' END AS step_status FROM
 (SELECT *, lag(role) OVER w AS p, row_number() OVER w AS rn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))""")
def i06(spark, sf):
    rows = source(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("order_id"), F.col("turn").alias("seq"), F.col("role").alias("state"))
    return finish(spark, L.stream_lifecycle(rows, EDGES, ["system", "user"]), "i06")


@query("i07_stream_gate", """
SELECT user_id % 1000 AS doc_id, coalesce(CASE quality WHEN 1 THEN 'adopted' ELSE 'rejected' END, 'undetermined') AS gate, count(*) AS n FROM
 (SELECT user_id, quality FROM events LEFT JOIN labels ON doc_id = user_id % 1000 WHERE quality IS NOT NULL) GROUP BY ALL
UNION ALL SELECT user_id % 1000, 'undetermined', count(*) FROM events WHERE user_id % 1000 NOT IN (SELECT doc_id FROM labels) GROUP BY 1""")
def i07(spark, sf):
    frozen = load(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "adopted").otherwise("rejected").alias("gate"))
    rows = tick_stream(spark, sf).select((F.col("user_id") % 1000).alias("doc_id"))
    return finish(spark, L.stream_gate(rows, frozen, ["doc_id"], "gate"), "i07").groupBy("doc_id", "gate").agg(F.count("*").alias("n"))


@query("i08_stream_publish", "SELECT symbol, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM ticks GROUP BY 1", ("ticks",))
def i08(spark, sf):
    root, state = fresh_folder(spark, "i08-out"), fresh_folder(spark, "i08-state")
    for _ in range(2):  # the second run finds nothing new and writes nothing twice
        L.stream_publish(tick_stream(spark, sf).select("symbol", "qty"), root, state).awaitTermination()
    return spark.read.parquet(f"{root}/batch_id=*/data").groupBy("symbol").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))
