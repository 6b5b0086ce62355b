"""Publishing (key, value) messages."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_messages(
    messages: DataFrame, fmt: str = "kafka", topic: str | None = None, path: str | None = None,
    mode: str = "append", **options: object,
) -> None:
    """Write a batch of messages: to a Kafka topic, or to a folder in another format."""
    writer = messages.write.format(fmt).options(**{key: str(value) for key, value in options.items()})
    if fmt == "kafka":
        if not topic:
            raise ValueError("a Kafka sink needs a topic")
        writer.option("topic", topic).save()
    else:
        writer.mode(mode).save(path)
