"""Where ticks and alerts come from."""

from tickloom.sources.events import messages_from_events, ticks_from_events
from tickloom.sources.tables import read_alerts, read_table, read_ticks
from tickloom.sources.topic import (
    kafka_options,
    kafka_sink_options,
    publish_ticks,
    read_topic_stream,
)
from tickloom.sources.wire import decode_ticks, encode_ticks, parse_messages

__all__ = [
    "decode_ticks",
    "encode_ticks",
    "kafka_options",
    "kafka_sink_options",
    "messages_from_events",
    "parse_messages",
    "publish_ticks",
    "read_alerts",
    "read_table",
    "read_ticks",
    "read_topic_stream",
    "ticks_from_events",
]
