"""Streaming metric alarm: tumbling-window statistic with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ferrum.operators.kpi import window_alarm


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need ``timestamp`` (with zone); parquet ``timestamp_ntz`` is cast
    in the (UTC) session zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def streaming_alarm(stream: DataFrame, ts: str, value: str, *, keys: list[str] | None = None,
                    period_seconds: int = 900, threshold: float = 0.0, statistic: str = "min",
                    comparison: str = "<=", delay: str = "1 hour") -> DataFrame:
    """Watermarked tumbling-window alarm. In append mode a window is emitted once
    the watermark (max event time - ``delay``) has passed its end. Rows behind the
    watermark of the previous micro-batch are dropped as late, so an emitted
    window is never changed afterwards."""
    s = event_time(stream, ts).withWatermark(ts, delay)
    return window_alarm(s, ts, value, period_seconds=period_seconds, threshold=threshold,
                        statistic=statistic, keys=keys, comparison=comparison)


def open_window_alarms(rows: DataFrame, ts: str, value: str, *, keys: list[str] | None = None, period_seconds: int = 900,
                       threshold: float = 0.0, statistic: str = "min", comparison: str = "<=",
                       delay: str = "1 hour") -> DataFrame:
    """The windows that a finished ``availableNow`` run has not emitted, from its input read as a batch.

    A window stays open while its end lies after the watermark (greatest event time - ``delay``);
    with the run's output these are all windows. For an input that has ended, not for one that goes on.
    """
    rows = event_time(rows, ts)
    mark = rows.agg((F.max(ts) - F.expr(f"INTERVAL {delay}")).alias("mark")).scalar()
    out = window_alarm(rows, ts, value, period_seconds=period_seconds, threshold=threshold, statistic=statistic,
                       keys=keys, comparison=comparison)
    return out.filter(F.col("window_end") > mark)


def start_alarm(spark: SparkSession, source_dir: str, schema: str, sink_dir: str, checkpoint_dir: str, *,
                ts: str, value: str, keys: list[str] | None = None, glob: str | None = None,
                max_files_per_trigger: int = 1, **kw) -> StreamingQuery:
    """File-source parquet stream -> alarm rows appended to a parquet sink."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    alarms = streaming_alarm(r.parquet(source_dir), ts, value, keys=keys, **kw)
    return (alarms.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start(sink_dir))
