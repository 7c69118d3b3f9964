"""Windows that are published once the watermark has passed them, and corrected when rows come late.

A stateful operator drops rows behind the watermark. Here every micro-batch is reduced to partial windows (counts, sums, extremes: whatever can
be merged) and appended as an epoch of its own; rows for windows that are published already leave as partials marked as
a revision. Reading merges the partials of a window: the result is that of one batch over all rows, however late they came, and `revision` says how
many epochs have corrected a window since it was published. Partials hold one row per window and epoch, and `compact` folds old epochs together.

An epoch is published by its manifest, written last. It carries the newest event time so far, from which the watermark of
the next epoch follows, so that an epoch done again after a failure marks the same rows as late.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.streaming import StreamingQuery

from plumbline.ordering import earlier, micros, over_order, upto

MANIFEST = "manifest"


@dataclass(frozen=True)
class Part:
    """A column of a window: how it comes from rows, and how from partials; one that is not `shown` only helps to merge."""

    name: str
    of: Column
    merged: Column
    shown: bool = True


def quality_parts(reasons: dict[str, Column]) -> list[Part]:
    """Rows and broken rules, as in `stream_quality`."""
    broken = [Part(n, F.count_if(F.coalesce(c, F.lit(True))), F.sum(n)) for n, c in reasons.items()]
    return [Part("n_rows", F.count("*"), F.sum("n_rows")), *broken]


def bar_parts(price: str = "price", qty: str = "qty", maker: str = "buyer_maker", row_id: str = "trade_id") -> list[Part]:
    """The columns of a bar, as in `stream_bars`; first and last trade go by the business key."""
    taker = {"taker_buy": ~F.col(maker), "taker_sell": F.col(maker)}
    return [
        Part("open", F.min_by(price, row_id), F.min_by("open", "first_id")), Part("first_id", F.min(row_id), F.min("first_id"), shown=False),
        Part("high", F.max(price), F.max("high")), Part("low", F.min(price), F.min("low")),
        Part("close", F.max_by(price, row_id), F.max_by("close", "last_id")), Part("last_id", F.max(row_id), F.max("last_id"), shown=False),
        Part("volume", F.sum(qty), F.sum("volume")), *[Part(n, F.sum(F.when(side, F.col(qty)).otherwise(0)), F.sum(n)) for n, side in taker.items()],
        Part("n_trades", F.count("*"), F.sum("n_trades")),
    ]


#: From the rows of an epoch and the watermark before it (microseconds, or null) to partials with `revision` (0 or 1) and `newest` (microseconds).
Pieces = Callable[[DataFrame, Column], DataFrame]


def window_pieces(ts: str, width: str, by: list[str], parts: list[Part], slide: str | None = None) -> Pieces:
    """Partials of tumbling or sliding windows."""
    def make(rows: DataFrame, mark: Column) -> DataFrame:
        window = F.window(ts, width, slide) if slide else F.window(ts, width)
        out = rows.groupBy(*by, window.alias("w")).agg(*[p.of.alias(p.name) for p in parts], F.max(micros(ts)).alias("newest"))
        late = F.coalesce(micros(F.col("w")["end"]) <= mark, F.lit(False))
        return out.select(*by, F.col("w")["start"].alias("window_start"), F.col("w")["end"].alias("window_end"), *[p.name for p in parts],
                          late.cast("int").alias("revision"), "newest")

    return make


def segment_pieces(ts: str, gap: str, by: list[str]) -> Pieces:
    """Partials of sessions that end after `gap` without a row."""
    def make(rows: DataFrame, mark: Column) -> DataFrame:
        over = micros(F.col(ts).cast("timestamp") + F.expr(f"INTERVAL {gap}"))
        out = rows.withColumn("__over", over).groupBy(*by, F.session_window(ts, gap).alias("w")).agg(
            F.count("*").alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.min("__over").alias("over"), F.max(micros(ts)).alias("newest"))
        return out.withColumn("revision", F.coalesce(F.col("over") <= mark, F.lit(False)).cast("int")).drop("w", "over")

    return make


def _manifests(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """(kind, value) of all that is published; None where there is nothing yet."""
    try:
        return spark.read.option("basePath", root).text(f"{root}/{kind}=*/{MANIFEST}").select(F.col(kind).cast("long").alias(kind), "value")
    except AnalysisException:
        return None


def _last(spark: SparkSession, root: str, kind: str) -> tuple[int, dict] | None:
    known = _manifests(spark, root, kind)
    row = None if known is None else known.orderBy(F.desc(kind)).first()
    return None if row is None else (row[kind], json.loads(row["value"]))


def _publish(df: DataFrame, target: str, facts: Callable[[DataFrame], dict]) -> None:
    """Write partials, then what is said of them; a target without a manifest was never published and is written anew."""
    df.write.mode("overwrite").parquet(f"{target}/data")
    said = json.dumps(facts(df.sparkSession.read.schema(df.schema).parquet(f"{target}/data")))
    df.sparkSession.range(1).select(F.lit(said).alias("value")).coalesce(1).write.mode("overwrite").text(f"{target}/{MANIFEST}")


def revision_writer(root: str, delay: str, pieces: Pieces) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of epochs. An epoch that is published is never written again."""
    def write(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        known = _last(spark, root, "epoch")
        if known and known[0] >= epoch:
            return
        newest = known[1]["newest"] if known else None
        mark = micros(F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {delay}")) if newest is not None else F.lit(None).cast("bigint")

        def facts(written: DataFrame) -> dict:
            top = written.agg(F.max("newest")).first()[0]
            return {"newest": max((v for v in (newest, top) if v is not None), default=None), "delay": delay}

        _publish(pieces(df, mark), f"{root}/epoch={epoch}", facts)

    return write


def publish_revisions(stream: DataFrame, root: str, checkpoint: str, delay: str, pieces: Pieces) -> StreamingQuery:
    """Publish everything available now; a later call with the same checkpoint goes on where this one stopped.

    One query writes to a root; only one runs at a time. Nothing is kept in a state store.
    """
    return stream.writeStream.foreachBatch(revision_writer(root, delay, pieces)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def partials(spark: SparkSession, root: str) -> DataFrame:
    """All published partials with `epoch`: the newest compacted table (as of the epoch it goes up to) and the epochs after it."""
    epochs = _manifests(spark, root, "epoch")
    if epochs is None:
        raise ValueError(f"nothing is published below {root}")
    base = _last(spark, root, "base")
    rows = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(f"{root}/epoch=*/data").withColumn("epoch", F.col("epoch").cast("long"))
    rows = rows.join(F.broadcast(epochs.select("epoch")), "epoch", "left_semi")  # one row per micro-batch
    if base is None:
        return rows
    return rows.where(F.col("epoch") > base[0]).unionByName(spark.read.parquet(f"{root}/base={base[0]}/data").withColumn("epoch", F.lit(base[0])))


def watermark(spark: SparkSession, root: str) -> Column:
    """Event time (microseconds) up to which windows are published by now."""
    _, facts = _last(spark, root, "epoch")
    return micros(F.timestamp_micros(F.lit(facts["newest"]).cast("bigint")) - F.expr(f"INTERVAL {facts['delay']}"))


def _state(end: Column, mark: Column) -> Column:
    return F.when(end <= mark, "published").otherwise("open")


def published_windows(spark: SparkSession, root: str, by: list[str], parts: list[Part]) -> DataFrame:
    """Every window as it stands: its columns over all rows so far, `revision` and `window_state` (open or published)."""
    merged = partials(spark, root).groupBy(*by, "window_start", "window_end").agg(*[p.merged.alias(p.name) for p in parts], F.sum("revision").alias("revision"))
    return merged.select(*by, "window_start", *[p.name for p in parts if p.shown], "revision", _state(micros("window_end"), watermark(spark, root)).alias("window_state"))


def window_history(spark: SparkSession, root: str, by: list[str], parts: list[Part]) -> DataFrame:
    """Every window as it was published (revision 0) and after each correction, with the epoch that made it so. Epochs that were compacted are one."""
    window = W.partitionBy(*by, "window_start").orderBy("epoch").rowsBetween(W.unboundedPreceding, 0)  # as many rows as epochs that touched the window
    then = partials(spark, root).select(*by, "window_start", "epoch", *[p.merged.over(window).alias(p.name) for p in parts], F.sum("revision").over(window).alias("revision"))
    shown = [p.name for p in parts if p.shown]
    return then.groupBy(*by, "window_start", "revision").agg(F.max("epoch").alias("epoch"), F.max_by(F.struct(*shown), "epoch").alias("w")).select(*by, "window_start", "revision", "epoch", "w.*")


def published_segments(spark: SparkSession, root: str, by: list[str], gap: str) -> DataFrame:
    """Every segment as it stands. A late row may lengthen a segment or join two; then their revisions count together."""
    mark = watermark(spark, root)
    wide = micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {gap}"))
    rows = partials(spark, root).withColumn("__lo", micros("first_ts")).withColumn("__hi", micros("last_ts"))
    order = [F.col("__lo"), F.col("__hi"), F.col("epoch")]
    met = over_order(rows, by, order, {"__reach": (F.col("__hi"), "max")}, {"__before": lambda w: F.max("__reach").over(earlier(w))})
    begins = (~F.coalesce(F.col("__lo") < F.col("__before") + wide, F.lit(False))).cast("bigint")
    runs = over_order(met, by, order, {"__begins": (begins, "sum")}, {"__segment": lambda w: F.sum("__begins").over(upto(w))})
    per_epoch = runs.groupBy(*by, "__segment", "epoch").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_rows").alias("n_rows"), F.max("revision").alias("revision"))
    out = per_epoch.groupBy(*by, "__segment").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_rows").alias("n_rows"), F.sum("revision").alias("revision"))
    return out.select(*by, "first_ts", "last_ts", "n_rows", "revision", _state(micros("last_ts") + wide, mark).alias("window_state"))


def compact(spark: SparkSession, root: str, by: list[str], parts: list[Part]) -> None:
    """Fold the partials of all published epochs of windows into one table. What is read stays the same; a base is published like an epoch."""
    last = _last(spark, root, "epoch")
    if last is None or (_last(spark, root, "base") or (-1,))[0] >= last[0]:
        return
    merged = partials(spark, root).groupBy(*by, "window_start", "window_end").agg(
        *[p.merged.alias(p.name) for p in parts], F.sum("revision").alias("revision"), F.max("newest").alias("newest"))
    _publish(merged, f"{root}/base={last[0]}", lambda written: {"epoch": last[0]})
