"""Stream -> Bronze JSON lines partitioned by event date.

Structured Streaming with a checkpoint gives exactly-once files (offsets are committed
with the file sink log, unlike an auto-committing consumer that buffers in memory);
``availableNow`` drains what is there and stops. Replays are absorbed by the Silver
deduplication."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from aeris.functions import event_date_partition
from aeris.schemas import BRONZE_SCHEMA
from aeris.session import checkpoint_dir

METRICS = "bronze_stream"
MAX_RECORDS_PER_FILE = 1_000_000  # few large files; lower it for consumers that want small ones


def _parsed(messages: DataFrame, value_col: str) -> DataFrame:
    schema = StructType([*BRONZE_SCHEMA.fields, StructField("_corrupt", StringType())])
    value = F.col(value_col).cast("string")
    return messages.select(value.alias("value"), F.from_json(value, schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Message value (JSON text or bytes) -> Bronze record + ``date`` partition key. Every JSON object is a
    record, whichever fields it has; without a usable start date it lands under the unknown day. What
    is no object is left to :func:`reject_messages`."""
    return _records(_parsed(messages, value_col))


def _records(parsed: DataFrame) -> DataFrame:
    rec = parsed.filter(F.col("r").isNotNull() & F.col("r._corrupt").isNull()).select("r.*").drop("_corrupt")
    return rec.withColumn("date", event_date_partition(F.coalesce(F.col("date_debut"), F.lit(""))))


def reject_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """The messages :func:`parse_messages` can't read, as they are (``value``); null messages included."""
    return _parsed(messages, value_col).filter(F.col("r").isNull() | F.col("r._corrupt").isNotNull()).select("value")


def _counted(messages: DataFrame, value_col: str) -> DataFrame:
    """Parsed messages, counted on their way (E15 of the stream): read, records, rejects."""
    good = F.col("r").isNotNull() & F.col("r._corrupt").isNull()
    return _parsed(messages, value_col).observe(
        METRICS, F.count(F.lit(1)).alias("lues"), F.count_if(good).alias("posees"), F.count_if(~good).alias("rejetees"))


def stream_metrics(query: StreamingQuery) -> dict[str, int]:
    """Messages read, landed and rejected by a run of :func:`stream_to_bronze`, summed over its micro-batches (``lots``).

    They are observed inside the batches that write the files, so no message is read twice for them. Spark keeps the progress
    of the last ``spark.sql.streaming.numRecentProgressUpdates`` batches; a run with more raises instead of counting some."""
    progress = query.recentProgress
    most = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(progress) >= most:
        raise RuntimeError(f"{most} or more micro-batches: raise spark.sql.streaming.numRecentProgressUpdates")
    totals = {"lues": 0, "posees": 0, "rejetees": 0, "lots": 0}
    for batch in progress:
        seen = batch["observedMetrics"].get(METRICS)
        if seen is not None:
            totals["lots"] += 1
            for name in ("lues", "posees", "rejetees"):
                totals[name] += int(seen[name])
    return totals


def _checkpoint(messages: DataFrame, path: str, checkpoint: str | None) -> str:
    return checkpoint or f"{checkpoint_dir(messages.sparkSession).rstrip('/')}/bronze-sink-{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def _start(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def stream_to_bronze(messages: DataFrame, path: str, checkpoint: str | None = None, value_col: str = "value",
                     max_records_per_file: int = MAX_RECORDS_PER_FILE, available_now: bool = True) -> StreamingQuery:
    """Start the Bronze sink; returns the running query (``awaitTermination`` for batch-like use).

    Without an explicit ``checkpoint`` the query state lives under the shared
    ``spark.checkpoint.dir`` in a folder derived from the sink path, so a restart of the
    same sink resumes from its committed offsets."""
    w = (_records(_counted(messages, value_col)).writeStream.format("json")
         .option("path", path).option("checkpointLocation", _checkpoint(messages, path, checkpoint))
         .option("maxRecordsPerFile", max_records_per_file)
         .partitionBy("date").outputMode("append"))
    return _start(w, available_now)


def stream_rejects(messages: DataFrame, path: str, checkpoint: str | None = None, value_col: str = "value",
                   available_now: bool = True) -> StreamingQuery:
    """Start the sink of unreadable messages (text lines), with offsets of its own; its rows are their count."""
    w = (reject_messages(messages, value_col).filter(F.col("value").isNotNull()).writeStream.format("text")
         .option("path", path).option("checkpointLocation", _checkpoint(messages, path, checkpoint)).outputMode("append"))
    return _start(w, available_now)


def read_kafka(spark, servers: str, topic: str, starting_offsets: str = "earliest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """The topic as a stream (needs the Kafka connector on the classpath). Offsets are
    tracked by the sink's checkpoint, not committed by a consumer group."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def read_message_files(spark, path: str, fmt: str = "text") -> DataFrame:
    """Streaming file source standing in for the topic: one JSON message per line."""
    return spark.readStream.format(fmt).load(path)
