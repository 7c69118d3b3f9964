"""Registration of queries and the shared views they stand on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.aggregates import ohlcv
from plumbline.ordering import over_order, upto
from plumbline.session import dealt

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The same views in SQL, in the order they build on one another.
VIEWS = {
    "ticks": (
        "SELECT event_type AS symbol, event_id AS trade_id, ts, CAST(value AS DECIMAL(18,6)) AS price, "
        "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) + 1 AS qty, "
        "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) % 2 = 0 AS buyer_maker, user_id FROM events"
    ),
    "members": (
        "SELECT symbol, CAST(ts AS DATE) AS event_date, min(trade_id) AS first_id, max(trade_id) AS last_id, "
        "min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows FROM ticks GROUP BY ALL"
    ),
    "bars_1h": (
        "SELECT symbol, date_trunc('hour', ts) AS bar_ts, arg_min(price, trade_id) AS open, max(price) AS high, min(price) AS low, "
        "arg_max(price, trade_id) AS close, CAST(sum(qty) AS BIGINT) AS volume, "
        "CAST(sum(CASE WHEN NOT buyer_maker THEN qty ELSE 0 END) AS BIGINT) AS taker_buy, "
        "CAST(sum(CASE WHEN buyer_maker THEN qty ELSE 0 END) AS BIGINT) AS taker_sell, count(*) AS n_trades FROM ticks GROUP BY ALL"
    ),
    "bars_1d": (
        "SELECT symbol, date_trunc('day', bar_ts) AS bar_ts, arg_min(open, b) AS open, max(high) AS high, min(low) AS low, "
        "arg_max(close, b) AS close, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(taker_buy) AS BIGINT) AS taker_buy, "
        "CAST(sum(taker_sell) AS BIGINT) AS taker_sell, CAST(sum(n_trades) AS BIGINT) AS n_trades "
        "FROM (SELECT symbol, bar_ts AS b, date_trunc('day', bar_ts) AS bar_ts, open, high, low, close, volume, taker_buy, taker_sell, n_trades FROM bars_1h) GROUP BY ALL"
    ),
    "oi": (
        "SELECT symbol, bar_ts, CAST(sum(taker_buy - taker_sell) OVER (PARTITION BY symbol ORDER BY bar_ts) AS BIGINT) AS oi FROM bars_1h"
    ),
    "visibility": (
        "SELECT l_orderkey, l_linenumber, l_returnflag, o_orderdate AS event_ts, l_shipdate AS collected_at, "
        "greatest(o_orderdate, l_shipdate) AS source_visible_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    ),
    "days": "SELECT DISTINCT o_orderpriority AS grp, CAST(o_orderdate AS DATE) AS day FROM orders",
    "segs": (
        "SELECT grp, min(day) AS seg_start, max(day) AS seg_end, count(*) AS days FROM (SELECT grp, day, "
        "day - CAST(row_number() OVER (PARTITION BY grp ORDER BY day) AS INTEGER) AS run FROM days) GROUP BY grp, run"
    ),
}


def ctes(*names: str) -> str:
    """`WITH` clause holding the named views and all views before them that they use."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        wanted.add(name)
        for other in VIEWS:
            if other != name and other not in wanted and f" {other}" in VIEWS[name] and list(VIEWS).index(other) < list(VIEWS).index(name):
                need(other)

    for n in names:
        need(n)
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted) + " "


def session_sql(ts: str) -> str:
    """The session of a UTC time: Asia and Europe by Beijing clock, the US opening by New York clock."""
    beijing = f"(hour({ts} + INTERVAL 8 HOUR) * 60 + minute({ts} + INTERVAL 8 HOUR))"
    york = f"timezone('America/New_York', timezone('UTC', {ts}))"
    return (f"CASE WHEN {beijing} >= 480 AND {beijing} < 900 THEN 'asia' "
            f"WHEN {beijing} >= 900 AND hour({york}) * 60 + minute({york}) < 570 THEN 'europe' ELSE 'us' END")


# Types in which values leave the queries: both engines print and hash these alike.
LEAVE_AS = {"DOUBLE": "double", "VARCHAR": "string"}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), **leave: str) -> Callable[[Query], Query]:
    """Register a query with its SQL; `leave` maps an output column to DOUBLE (decimals) or VARCHAR (dates)."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # part of the data contract
            return fn(spark, sf).withColumns({c: F.col(c).cast(LEAVE_AS[t]) for c, t in leave.items()})

        QUERIES[name] = run
        if sql is not None:
            text = (ctes(*views) + sql) if views else sql
            casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in leave.items())
            ORACLES[name] = f"SELECT * REPLACE ({casts}) FROM ({text})" if casts else text
        return fn

    return add


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return load(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"), "ts",
        F.col("value").cast("decimal(18,6)").alias("price"), (k + 1).alias("qty"), (k % 2 == 0).alias("buyer_maker"), "user_id")


def members(spark: SparkSession, sf: str) -> DataFrame:
    return ticks(spark, sf).groupBy("symbol", F.to_date("ts").alias("event_date")).agg(
        F.min("trade_id").alias("first_id"), F.max("trade_id").alias("last_id"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n_rows"))


def bars(spark: SparkSession, sf: str, width: str = "1 hour") -> DataFrame:
    return ohlcv(ticks(spark, sf), width)


def oi(bar_rows: DataFrame) -> DataFrame:
    change = F.col("taker_buy") - F.col("taker_sell")
    return over_order(bar_rows, ["symbol"], [F.col("bar_ts")], {"__change": (change, "sum")}, {"oi": lambda w: F.sum("__change").over(upto(w))}).select("symbol", "bar_ts", "oi")


def visibility(spark: SparkSession, sf: str, by_order: bool = False) -> DataFrame:
    """Lines with the times at which they could be seen; `by_order` deals them by order into partitions of bounded size."""
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("event_ts"))
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_shipdate").alias("collected_at"))
    if by_order:  # both sides in the same partitions: neither is held whole by a task
        lines, orders = dealt(lines, "l_orderkey"), orders.hint("merge")
    return lines.join(orders, "l_orderkey").withColumn("source_visible_at", F.greatest("event_ts", "collected_at"))


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("grp"), F.to_date("o_orderdate").alias("day")).distinct()
