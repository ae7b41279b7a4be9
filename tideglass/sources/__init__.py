from tideglass.sources.kafka import kafka_sink_options, kafka_source_options, read_topic_stream
from tideglass.sources.messages import decode_messages, publish_messages, to_messages, write_messages
from tideglass.sources.models import load_model, save_model
from tideglass.sources.tables import (
    read_bronze,
    read_raw_csv,
    read_table,
    read_table_or_none,
    read_typed_csv,
    rows_to_frame,
    steps_for,
    write_in_slices,
    write_table,
    write_version,
)

__all__ = [
    "decode_messages",
    "kafka_sink_options",
    "kafka_source_options",
    "load_model",
    "publish_messages",
    "read_bronze",
    "read_raw_csv",
    "read_table",
    "read_table_or_none",
    "read_topic_stream",
    "read_typed_csv",
    "rows_to_frame",
    "save_model",
    "steps_for",
    "to_messages",
    "write_in_slices",
    "write_messages",
    "write_table",
    "write_version",
]
