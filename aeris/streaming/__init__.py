"""Stream side: publishing records keyed by series, landing the stream in Bronze."""

from aeris.streaming.publish import publish_frame, publish_kafka
from aeris.streaming.bronze_sink import (
    parse_messages, read_kafka, read_message_files, reject_messages, stream_metrics, stream_rejects, stream_to_bronze,
)
from aeris.streaming.silver_stream import deduplicate_stream, stream_to_silver

__all__ = ["publish_frame", "publish_kafka", "parse_messages", "read_kafka", "read_message_files", "reject_messages",
           "stream_metrics", "stream_rejects", "stream_to_bronze", "deduplicate_stream", "stream_to_silver"]
