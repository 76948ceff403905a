"""Structured Streaming jobs: exactly-once landing and watermark semantics."""

import os

import pytest

from pyspark.sql import functions as F

from ferrum.operators.kpi import window_alarm
from ferrum.streaming.alarm import start_alarm
from ferrum.streaming.landing import land_messages, read_landed


def _queue(spark, path, rows):
    df = spark.createDataFrame(rows, "received_at string, body string").withColumn(
        "received_at", F.col("received_at").cast("timestamp"))
    df.coalesce(1).write.mode("append").json(path)


def test_landing_is_exactly_once_and_keeps_every_message(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, d) for d in ("in", "out", "ckpt"))
    _queue(spark, src, [("2024-01-01 10:00:00", '{"type": "PARTS", "n": 1}'),
                        ("2024-01-01 10:00:01", '{"type": "PARTS", "n": 2}'),
                        ("2024-01-02 09:00:00", '{"n": 3}')])
    land_messages(spark, src, sink, ckpt, max_files_per_trigger=1).awaitTermination()
    # a second run over the same input lands nothing new
    land_messages(spark, src, sink, ckpt, max_files_per_trigger=1).awaitTermination()
    got = read_landed(spark, sink)
    assert got.count() == 3
    counts = {(r.landing_date, r.msg_type): r["count"] for r in got.groupBy("landing_date", "msg_type").count().collect()}
    assert counts == {("2024-01-01", "PARTS"): 2, ("2024-01-02", "unknown"): 1}
    # new input is picked up incrementally
    _queue(spark, src, [("2024-01-03 00:00:00", '{"type": "CHECKPOINT"}')])
    land_messages(spark, src, sink, ckpt, max_files_per_trigger=1).awaitTermination()
    assert read_landed(spark, sink).count() == 4
    # bookmark disabled: everything again, into a separate sink
    full = os.path.join(tmp_dir, "full")
    land_messages(spark, src, full, ckpt, reprocess_all=True).awaitTermination()
    assert read_landed(spark, full).count() == 4
    with pytest.raises(ValueError, match="empty sink"):  # would lose what the sink's log has numbered already
        land_messages(spark, src, sink, ckpt, reprocess_all=True)


def test_streamed_alarm_equals_batch_on_closed_windows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "events")
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", float((h * 7 + m) % 11)) for h in range(0, 6) for m in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "ts string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.parquet(src)
    out, ckpt = os.path.join(tmp_dir, "alarms"), os.path.join(tmp_dir, "ckpt")
    q = start_alarm(spark, src, "ts timestamp_ntz, value double", out, ckpt, ts="ts", value="value",
                    period_seconds=900, threshold=2.0, delay="30 minutes")
    q.awaitTermination()
    streamed = {(str(r.window_start), r.stat, r.state) for r in spark.read.parquet(out).collect()}
    batch_df = window_alarm(df.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value",
                            period_seconds=900, threshold=2.0)
    cutoff = F.to_timestamp(F.lit("2024-01-01 05:56:00")) - F.expr("INTERVAL 30 MINUTES")
    batch = {(str(r.window_start), r.stat, r.state) for r in batch_df.filter(F.col("window_end") <= cutoff).collect()}
    assert streamed == batch
    assert len(batch) > 10


def test_late_row_after_watermark_does_not_reopen_a_window(spark, tmp_dir):
    import time
    src = os.path.join(tmp_dir, "ev")
    schema = "ts timestamp_ntz, value double"

    def write(rows, name):
        spark.createDataFrame(rows, "ts string, value double").withColumn(
            "ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(os.path.join(src, name))
    # The file source takes files in modification-time order, one per micro-batch here. Spark drops
    # a row as late when it is behind the watermark of the previous batch, so the late row comes third.
    write([("2024-01-01 08:05:00", 9.0), ("2024-01-01 10:20:00", 9.0)], "b1")
    time.sleep(1.1)
    write([("2024-01-01 10:30:00", 9.0)], "b2")
    time.sleep(1.1)
    write([("2024-01-01 08:06:00", 0.5), ("2024-01-01 10:40:00", 9.0)], "b3")  # 08:06 is behind 09:20
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    q = start_alarm(spark, src + "/*", schema, out, ckpt, ts="ts", value="value", period_seconds=900,
                    threshold=1.0, delay="1 hour", max_files_per_trigger=1)
    q.awaitTermination()
    rows = {str(r.window_start): (r.stat, r.state) for r in spark.read.parquet(out).collect()}
    assert rows["2024-01-01 08:00:00"] == (9.0, "OK")  # the late 0.5 was dropped, window stays closed
