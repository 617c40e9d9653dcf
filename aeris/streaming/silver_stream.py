"""F1 on the stream: Silver without replays, straight from the messages.

A reading's key is remembered in the state store for ``delay`` of ingestion time. A replay within that time is dropped, whichever
micro-batch or run it comes in, since the state lives in the query's checkpoint. The first reading to arrive is
the one that stays, as in the batch rule (first ingested).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aeris.operators.silver import DEDUP_KEYS, typed, valid_only, with_exceedance
from aeris.schemas import SILVER_COLUMNS
from aeris.streaming.bronze_sink import _checkpoint, _start, parse_messages

DELAY = "2 days"


def deduplicate_stream(readings: DataFrame, delay: str = DELAY) -> DataFrame:
    """One reading per (site, pollutant, hour) among those ingested within ``delay`` of each other.

    ``readings``: typed, valid records of a stream (an invalid reading must not shadow a valid one). The watermark runs on ``_ingested_at``
    and not on the measured hour: readings of long ago are no late data. State is bounded by the keys of ``delay``. A record
    ingested more than ``delay`` before the newest one, or without a readable stamp, has no place in that order and isn't
    returned; Bronze has it, and the batch job or ``add_readings`` merges it."""
    arrival = F.try_to_timestamp("_ingested_at")
    return (readings.withColumn("_arrivee", arrival).where(F.col("_arrivee").isNotNull()).withWatermark("_arrivee", delay)
            .dropDuplicatesWithinWatermark(DEDUP_KEYS).drop("_arrivee"))


def stream_to_silver(messages: DataFrame, path: str, checkpoint: str | None = None, value_col: str = "value", delay: str = DELAY,
                     available_now: bool = True) -> StreamingQuery:
    """Messages -> Silver Parquet by day (B5-B9, C3, F1), with exactly-once files. State and offsets are in ``checkpoint`` (default: a
    folder for this sink under ``spark.checkpoint.dir``), so a restart goes on with the keys it has seen."""
    readings = valid_only(typed(parse_messages(messages, value_col)))
    silver = with_exceedance(deduplicate_stream(readings, delay)).select(*SILVER_COLUMNS)
    writer = (silver.writeStream.format("parquet").option("path", path).option("checkpointLocation", _checkpoint(messages, path, checkpoint))
              .partitionBy("date_mesure").outputMode("append"))
    return _start(writer, available_now)
