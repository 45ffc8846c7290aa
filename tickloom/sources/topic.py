"""Topics: reading messages as an unbounded table, publishing ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.schema import TOPIC
from tickloom.sources.wire import encode_ticks


def kafka_options(
    servers: str, topic: str = TOPIC, starting: str = "latest", **more: str
) -> dict[str, str]:
    """Options that subscribe to one topic.

    ``starting`` counts only for a query without a checkpoint; with one, the
    query goes on where it stopped.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }


def kafka_sink_options(servers: str, topic: str = TOPIC, **more: str) -> dict[str, str]:
    """Options that publish to one topic."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **more}


def read_topic_stream(
    spark: SparkSession,
    options: dict[str, str],
    format: str = "kafka",
    schema: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Messages as a stream with a ``value`` column.

    ``format="kafka"`` needs Spark's connector package. File formats (``text``,
    ``json``, ``parquet``) read a folder of message files the same way.
    """
    reader = spark.readStream.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def publish_ticks(
    ticks: DataFrame,
    options: dict[str, str],
    format: str = "kafka",
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Send ticks to a topic as JSON: once for a table, or on and on for a stream."""
    messages = encode_ticks(ticks)
    if not ticks.isStreaming:
        messages.write.format(format).options(**options).mode("append").save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = messages.writeStream.format(format).options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
