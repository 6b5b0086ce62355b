"""Streams of messages and of landed poll responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.schemas import EVENT_TOPIC


def stream_options(
    fmt: str, topic: str, starting: str, servers: str | None, options: dict[str, object],
) -> dict[str, str]:
    """Reader options: the topic and start position for Kafka, nothing of its own for folders."""
    settings: dict[str, object] = {}
    if fmt == "kafka":
        if not servers:
            raise ValueError("a Kafka stream needs the bootstrap servers")
        if starting not in ("earliest", "latest"):
            raise ValueError("starting is 'earliest' or 'latest'")
        settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    settings.update(options)
    return {key: str(value) for key, value in settings.items()}


def read_event_stream(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, topic: str = EVENT_TOPIC,
    starting: str = "earliest", servers: str | None = None, **options: object,
) -> DataFrame:
    """Messages as a stream with at least a ``value`` column.

    ``fmt="kafka"`` subscribes to a topic; ``minPartitions`` and ``maxOffsetsPerTrigger`` among the options spread a
    topic of few partitions over many tasks and bound a batch. ``"text"`` reads a folder of files with one JSON
    document per line, ``"parquet"`` a folder of (key, value) files, both with ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(fmt).options(**stream_options(fmt, topic, starting, servers, options))
    if fmt == "parquet":
        reader = reader.schema("key binary, value binary")
    elif fmt not in ("kafka", "text"):
        raise ValueError("fmt is 'kafka', 'text' or 'parquet'")
    return reader.load() if path is None else reader.load(path)


def read_polls(spark: SparkSession, path: str, streaming: bool = True, **options: object) -> DataFrame:
    """Landed poll responses, one JSON document per file, in ``value``."""
    reader = (spark.readStream if streaming else spark.read).format("text").option("wholetext", "true")
    return reader.options(**{key: str(value) for key, value in options.items()}).load(path)
