"""Queue-message landing as a Structured Streaming job.

Each message is stored under ``country=/landing_date=/msg_type=`` by a file
sink. The checkpoint plus the file sink's commit log give exactly-once output
from an at-least-once, unordered input; ``maxFilesPerTrigger`` bounds the batch
size and ``availableNow`` processes everything present, then stops (incremental
re-processing bookmark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ferrum.operators.messages import route_messages

# One queued message: its processing (receive) time and the raw JSON body.
ENVELOPE_SCHEMA = "received_at timestamp, body string"
LANDING_PARTITIONS = ["country", "landing_date", "msg_type"]


def message_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 10) -> DataFrame:
    return (spark.readStream.schema(ENVELOPE_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir))


def land_messages(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, *,
                  country: str = "DE", max_files_per_trigger: int = 10,
                  available_now: bool = True, processing_time: str | None = None,
                  reprocess_all: bool = False, once_within: str | None = None) -> StreamingQuery:
    """Start the landing stream (every message stored, none dropped).

    An at-least-once queue may deliver a message again, in the same batch, a later one or after a restart.
    ``once_within`` (the queue's retention, e.g. "14 days") lands each message body once: its
    256-bit hash is kept in the stream's state until the watermark on ``received_at`` has passed it by that time.
    The state is keyed by the hash, so it spreads over all tasks; a message that comes later than ``once_within``
    behind the newest one is beyond the queue's retention and is not landed.

    The checkpoint is the bookmark: a restart continues after the last
    committed file. ``reprocess_all`` starts from a fresh checkpoint folder
    next to the given one (bookmark disabled: every input file again). It needs a
    sink folder of its own: the file sink numbers its batches from the checkpoint
    and would skip the batches that an earlier run has written to the same folder.
    """
    if reprocess_all:
        import uuid
        log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sink_dir.rstrip('/')}/_spark_metadata")  # noqa: SLF001
        if log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log):  # noqa: SLF001
            raise ValueError(f"reprocess_all needs an empty sink folder: {sink_dir} holds an earlier run")
        checkpoint_dir = f"{checkpoint_dir.rstrip('/')}-full-{uuid.uuid4().hex[:8]}"
    stream = message_stream(spark, source_dir, max_files_per_trigger)
    if once_within:
        stream = stream.withColumn("__print", F.sha2(F.coalesce("body", F.lit("")), 256)).withWatermark("received_at", once_within)
        stream = stream.dropDuplicatesWithinWatermark(["__print"])
    routed = route_messages(stream, country=country)
    # Each input split writes its own files: no shuffle, and a hot message type is
    # spread over as many tasks as its input has splits.
    out = routed.select("received_at", "body", "landing_key", *LANDING_PARTITIONS)
    w = (out.writeStream.format("json").outputMode("append")
         .option("checkpointLocation", checkpoint_dir).partitionBy(*LANDING_PARTITIONS))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start(sink_dir)


def read_landed(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Batch read of the landed messages (only files committed by the sink)."""
    return spark.read.schema(
        "received_at timestamp, body string, landing_key string, country string, landing_date string, "
        "msg_type string").json(sink_dir)
