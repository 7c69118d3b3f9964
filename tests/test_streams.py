"""Streams over small files."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.session import fresh_folder
from plumbline.streaming import streams as L


def finish(spark, stream):
    return L.run_to_files(stream, fresh_folder(spark, "t-out"), fresh_folder(spark, "t-state"))


def test_late_rows_are_kept_and_labelled(spark, tmp_path):
    spark.createDataFrame([(1, 0, 10), (2, 0, 10_000), (3, 0, None)], "id int, e long, a long").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, e long, a long").parquet(str(tmp_path / "in")).select(
        "id", F.timestamp_seconds("e").alias("event"), F.timestamp_seconds("a").alias("arrival"))
    got = finish(spark, L.stream_late_split(stream, "event", "arrival", "1 HOUR")).collect()
    assert {r.id: r.arrival_status for r in got} == {1: "on_time", 2: "late", 3: "undetermined"}


def test_spread_dedup_keeps_one_row_per_key(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("ts"), "id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, ts timestamp, id long").parquet(str(tmp_path / "in"))
    out = finish(spark, L.stream_dedup(stream, ["k"], "ts", "1 day", spread=F.col("id") % 16))
    assert sorted(r.k for r in out.collect()) == [0, 1, 2]


def test_publishing_resumes_without_repeating(spark, tmp_path):
    source, root, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def publish():
        L.stream_publish(spark.readStream.schema("id long").parquet(source), root, state).awaitTermination()

    spark.range(5).write.parquet(source)
    publish()
    publish()
    assert spark.read.parquet(f"{root}/batch_id=*/data").count() == 5
    spark.range(5, 8).write.mode("append").parquet(source)
    publish()
    assert sorted(r.id for r in spark.read.parquet(f"{root}/batch_id=*/data").collect()) == list(range(8))


def test_completed_epoch_is_not_written_again(spark, tmp_path):
    write = L.publish_epoch(str(tmp_path))
    write(spark.range(3), 0)
    write(spark.range(99), 0)
    assert spark.read.parquet(f"{tmp_path}/batch_id=*/data").count() == 3


def test_lifecycle_state_spans_batches(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "order_id string, seq long, state string"

    def step(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = L.stream_lifecycle(spark.readStream.schema(schema).parquet(source), [("created", "sent")], ["created"])
        return {(r.order_id, r.seq): r.step_status for r in L.run_to_files(stream, out, state).collect()}

    step([("a", 0, "created"), ("b", 0, "created")])
    got = step([("a", 1, "sent"), ("b", 1, "filled"), ("c", 0, "sent")])
    want = {("a", 0): "start", ("b", 0): "start", ("a", 1): "ok", ("b", 1): "illegal", ("c", 0): "illegal_start"}
    assert got == want
    got = step([("a", 3, "sent"), ("d", 5, "created")])
    got = step([("a", 2, "created"), ("d", 6, "sent")])  # a step that comes after a later one was judged
    assert got == {**want, ("a", 3): "illegal", ("d", 5): "start", ("a", 2): "late", ("d", 6): "ok"}


def test_open_windows_are_published_at_the_end(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "end")
    spark.range(100).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit("a").alias("k")).write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, k string").parquet(source)
    end = spark.sql("SELECT TIMESTAMP '9000-01-01' AS ts, CAST(NULL AS STRING) AS k")
    for make in (lambda s: L.stream_quality(s, "ts", "1 hour", "1 hour", ["k"], {}), lambda s: L.stream_segments(s, "ts", "5 minutes", "1 hour", ["k"])):
        out = L.run_to_end(make(L.with_closing(stream, folder)), end, folder, fresh_folder(spark, "t-out"), fresh_folder(spark, "t-state"))
        assert sum(r.n_rows for r in out.collect()) == 100
        folder += "-2"
