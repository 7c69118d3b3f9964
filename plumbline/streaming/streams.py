"""Streaming twins of the batch audits.

Event time must be `timestamp` (cast `timestamp_ntz` first). Stateful operators drop rows later than the watermark:
`stream_quality`, `stream_segments` and `stream_bars` publish a window once, without such rows, which `stream_late_split` can label before them.
`revisions` holds the same windows with late rows merged in as numbered corrections.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plumbline.operators.aggregates import bar_columns
from plumbline.sources.sinks import MANIFEST


def stream_quality(stream: DataFrame, ts: str, width: str, delay: str, by: list[str], reasons: dict[str, Column]) -> DataFrame:
    """Rows and broken rules per object and tumbling window."""
    out = stream.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), *by).agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(True))).alias(n) for n, c in reasons.items()])
    return out.select(F.col("w")["start"].alias("window_start"), *[c for c in out.columns if c != "w"])


def stream_dedup(stream: DataFrame, keys: list[str], ts: str, delay: str, spread: Column | None = None) -> DataFrame:
    """First row per key; state is dropped once the watermark has passed a key.

    With `spread` (any value that differs between copies, for example a row id modulo 64)
    copies of a hot key are first reduced in that many tasks, then once per key.
    """
    marked = stream.withWatermark(ts, delay)
    if spread is not None:
        marked = marked.withColumn("__spread", spread).dropDuplicatesWithinWatermark([*keys, "__spread"]).drop("__spread")
    return marked.dropDuplicatesWithinWatermark(keys)


def stream_late_split(stream: DataFrame, event: str, arrival: str, delay: str) -> DataFrame:
    """Label rows before any stateful step: on_time / late / undetermined. Stateless, so nothing is lost."""
    late = F.col(arrival) - F.col(event) > F.expr(f"INTERVAL {delay}")
    return stream.withColumn("arrival_status", F.when(late, "late").when(~late, "on_time").otherwise("undetermined"))


def stream_segments(stream: DataFrame, ts: str, gap: str, delay: str, by: list[str]) -> DataFrame:
    """Live coverage: sessions that end after `gap` without a row."""
    out = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(
        F.count("*").alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return out.select(*by, "first_ts", "last_ts", "n_rows")


def stream_bars(stream: DataFrame, width: str, delay: str, slide: str | None = None, ts: str = "ts") -> DataFrame:
    """Bars per symbol, tumbling or sliding, from the same aggregates as the batch bars."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = stream.withWatermark(ts, delay).groupBy("symbol", window.alias("w")).agg(*bar_columns())
    return out.select("symbol", F.col("w")["start"].alias("bar_ts"), *[c for c in out.columns if c not in ("symbol", "w")])


STEP_SCHEMA = "order_id string, seq long, from_state string, state string, step_status string"


def lifecycle_steps(edges: list[tuple[str, str]], starts: list[str], patience_ms: int | None) -> Callable:
    """State function per order: keeps the last state, emits each step with its verdict, and a timeout row."""
    allowed = set(edges)

    def steps(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, seen = state.get if state.exists else (None, -1)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], seen, last, last, "timeout")], columns=["order_id", "seq", "from_state", "state", "step_status"])
            return
        # The steps of one order are few (one per lifecycle state), so one order fits a task.
        rows = pd.concat(list(frames)).sort_values("seq", kind="stable")
        # A step that comes after a later one has been judged has no known predecessor: it is told apart and changes nothing.
        late, due = rows[rows["seq"] <= seen], rows[rows["seq"] > seen]
        before = [last, *due["state"]][: len(due)]
        verdicts = ["ok" if pair in allowed else "illegal" for pair in zip(before, due["state"], strict=True)]
        if last is None and verdicts:
            verdicts[0] = "start" if due["state"].iloc[0] in starts else "illegal_start"
        if len(due):
            last, seen = due["state"].iloc[-1], due["seq"].iloc[-1]
        state.update((last, int(seen)))
        if patience_ms:
            state.setTimeoutDuration(patience_ms)
        judged = pd.concat([due.assign(from_state=before, step_status=verdicts), late.assign(from_state=None, step_status="late")])
        yield judged.assign(order_id=key[0])[["order_id", "seq", "from_state", "state", "step_status"]]

    return steps


def stream_lifecycle(stream: DataFrame, edges: list[tuple[str, str]], starts: list[str], patience_ms: int | None = None) -> DataFrame:
    """stream(order_id string, seq long, state string) -> every step with its verdict."""
    timeout = GroupStateTimeout.ProcessingTimeTimeout if patience_ms else GroupStateTimeout.NoTimeout
    return stream.select("order_id", "seq", "state").groupBy("order_id").applyInPandasWithState(
        lifecycle_steps(edges, starts, patience_ms), STEP_SCHEMA, "last string, seq long", "append", timeout)


def stream_gate(stream: DataFrame, frozen: DataFrame, on: list[str], verdict: str, default: str = "undetermined") -> DataFrame:
    """Each row with the verdict of the frozen declaration table (unique on `on`); unlisted keys stay undetermined."""
    return stream.join(frozen.select(*on, verdict), on, "left").withColumn(verdict, F.coalesce(F.col(verdict), F.lit(default)))


def _completed(spark: SparkSession, target: str) -> bool:
    try:
        spark.read.text(f"{target}/{MANIFEST}").schema
        return True
    except AnalysisException:
        return False


def publish_epoch(root: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: one directory per epoch, manifest last. A completed epoch is never written again;
    one that broke before its manifest was never published and is written anew."""

    def write(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        target = f"{root}/batch_id=stream-{epoch:010d}"
        if _completed(spark, target):
            return
        df.write.mode("overwrite").parquet(f"{target}/data")
        spark.range(1).select(F.lit(f'{{"epoch":{epoch}}}').alias("value")).coalesce(1).write.mode("overwrite").text(f"{target}/{MANIFEST}")

    return write


def stream_publish(stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Publish everything available now; a later call with the same checkpoint goes on where this one stopped."""
    return stream.writeStream.foreachBatch(publish_epoch(root)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_closing(stream: DataFrame, folder: str) -> DataFrame:
    """The stream together with `folder`, through which `run_to_end` tells it that nothing more comes."""
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("append").parquet(folder)  # the folder has to be there
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))


def run_to_end(stream: DataFrame, closing: DataFrame, folder: str, path: str, checkpoint: str) -> DataFrame:
    """Drive an append stream over all of its input, then publish the windows still open.

    `closing` is one row for `folder` with an event time after all windows: it moves the watermark past them, and
    its own window stays open for good. It comes only after the input is used up, so it makes no row late.
    """
    run_to_files(stream, path, checkpoint)
    closing.write.mode("append").parquet(folder)
    return run_to_files(stream, path, checkpoint)


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drive an append stream over the available input into Parquet and read the result back."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(
        "append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
