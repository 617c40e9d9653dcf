"""Records -> (key, value) messages; key = ``site|pollutant`` so a series stays in one
topic partition, value = the record as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.schemas import BRONZE_COLUMNS


def publish_frame(bronze: DataFrame) -> DataFrame:
    cols = [c for c in BRONZE_COLUMNS if c in bronze.columns]
    return bronze.select(F.concat_ws("|", "code_site", "code_polluant").alias("key"),
                         F.to_json(F.struct(*cols)).alias("value"))


def publish_kafka(bronze: DataFrame, servers: str, topic: str) -> None:
    """Batch write to a Kafka topic (needs the Kafka connector on the classpath)."""
    (publish_frame(bronze).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic)
     .option("kafka.acks", "all").save())
