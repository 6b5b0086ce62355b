"""The running queries: their names, output modes and checkpoints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.functions import parse_utc
from contrail.operators.aggregates import airspace_grid_5m, telemetry_quality_5m, traffic_5m, traffic_hourly
from contrail.operators.counters import observe_ingest
from contrail.operators.dedupe import clock_seconds
from contrail.operators.ingest import explode_state_vectors, normalize_vectors, route_events
from contrail.operators.messages import parse_events, parse_readings, to_dead_letter_messages, to_event_messages
from contrail.schemas import DEDUPE_TTL_SECONDS, GRID_5M, QUALITY_5M, TRAFFIC_1H, TRAFFIC_5M, Table
from contrail.session import configure
from contrail.sources.tables import FolderTarget
from contrail.streaming.batches import (
    BatchWriter, Target, append_windows, best_effort, count_ingest, dedupe_stream, publish, replace_windows, upsert_state,
)
from contrail.streaming.layer import LATE, ParsedLayer


def _start(
    df: DataFrame, writer: BatchWriter, checkpoint: str, name: str, mode: str, trigger: dict[str, object] | None,
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(writer).option("checkpointLocation", f"{checkpoint}/{name}").outputMode(mode)
        .queryName(name).trigger(**(trigger or {"processingTime": "0 seconds"})).start()
    )


def _windows(target: Target, table: Table, mode: str) -> BatchWriter:
    """Closed windows are appended once; open ones, in update mode, replace their earlier emission."""
    return append_windows(target, table) if mode == "append" else replace_windows(target, table)


def _table_queries(
    valid: DataFrame, on_time: DataFrame, target: Target, checkpoint: str, mode: str, trigger: dict[str, object] | None,
) -> dict[str, StreamingQuery]:
    """The three tables: the newest row of a vehicle counts whenever it comes, windows take what comes in time."""
    return {
        "flight_state_upsert": _start(
            valid, upsert_state(target), checkpoint, "flight_state_upsert", "update", trigger
        ),
        "airspace_grid_5m": _start(
            airspace_grid_5m(on_time), _windows(target, GRID_5M, mode), checkpoint, "airspace_grid_5m", mode, trigger
        ),
        "quality_metrics_5m": _start(
            telemetry_quality_5m(on_time), _windows(target, QUALITY_5M, mode), checkpoint, "quality_metrics_5m", mode,
            trigger,
        ),
    }


def start_pipeline(
    raw: DataFrame, target: Target, checkpoint: str, mode: str = "append",
    dead_letters: Callable[[DataFrame, int], None] | None = None, trigger: dict[str, object] | None = None,
) -> dict[str, StreamingQuery]:
    """Run the event stream into the three tables, and unreadable messages into the dead-letter sink.

    ``mode="append"`` writes each window once, when it is closed; ``"update"`` keeps a live view. Every query has
    its own checkpoint, and ``trigger={"availableNow": True}`` works off what is there and stops.
    """
    if mode not in ("append", "update"):
        raise ValueError("mode is 'append' or 'update'")
    configure(raw.sparkSession)
    valid, dead = route_events(parse_events(raw))
    queries = _table_queries(valid, valid, target, checkpoint, mode, trigger)
    if dead_letters is not None:
        queries["dead_letters"] = _start(
            to_dead_letter_messages(dead), best_effort(dead_letters), checkpoint, "dead_letters", "append", trigger
        )
    return queries


def start_shared_pipeline(
    raw: DataFrame, target: FolderTarget, checkpoint: str, mode: str = "append",
    dead_letters: Callable[[DataFrame, int], None] | None = None, late: Callable[[DataFrame, int], None] | None = None,
    trigger: dict[str, object] | None = None,
) -> dict[str, StreamingQuery]:
    """As ``start_pipeline``, but messages are read and parsed once, into a ``ParsedLayer`` that the queries read.

    Rows whose window the layer's watermark has closed are marked and given to ``late``; the window queries then drop
    none unseen, since their own watermarks are never ahead of the layer's. With ``availableNow`` the layer is complete
    before the queries start.
    """
    if mode not in ("append", "update"):
        raise ValueError("mode is 'append' or 'update'")
    spark = configure(raw.sparkSession)
    layer = ParsedLayer(target)
    parsed = parse_events(raw)
    parsing = _start(parsed, layer.writer("event_ts", late), checkpoint, "parsed_layer", "append", trigger)
    if trigger and trigger.get("availableNow"):
        parsing.awaitTermination()
    rows = layer.stream(spark, parsed.schema)
    valid, dead = route_events(rows)
    queries = {"parsed_layer": parsing, **_table_queries(
        valid, valid.where(~F.col(LATE)), target, checkpoint, mode, trigger)}
    if dead_letters is not None:
        queries["dead_letters"] = _start(
            to_dead_letter_messages(dead), best_effort(dead_letters), checkpoint, "dead_letters", "append", trigger)
    return queries


def start_traffic(
    raw: DataFrame, target: Target, checkpoint: str, mode: str = "append", trigger: dict[str, object] | None = None,
) -> dict[str, StreamingQuery]:
    """Run the sensor stream into the hourly and the 5-minute table."""
    configure(raw.sparkSession)
    rows = parse_readings(raw)
    return {
        "hourly_aggregation": _start(
            traffic_hourly(rows), _windows(target, TRAFFIC_1H, mode), checkpoint, "hourly_aggregation", mode, trigger
        ),
        "realtime_aggregation": _start(
            traffic_5m(rows), _windows(target, TRAFFIC_5M, mode), checkpoint, "realtime_aggregation", mode, trigger
        ),
    }


def start_ingest(
    polls: DataFrame, events: BatchWriter, dead_letters: BatchWriter, checkpoint: str, bbox_id: str | None = None,
    dedupe_in: FolderTarget | None = None, ttl: int = DEDUPE_TTL_SECONDS, trigger: dict[str, object] | None = None,
    count_in: FolderTarget | None = None, now: Column | None = None,
) -> StreamingQuery:
    """Run landed poll responses through the normaliser and publish events and dead letters as messages.

    ``dedupe_in`` switches the removal of repeats on and says where its state lives. Counters are reported with the
    query's progress under the name ``ingest``; ``count_in`` also keeps them as a table, one row for each poll with the
    running total of skips (see ``count_ingest``), for polls that carry a ``poll_id``. ``now`` is the ingestion time,
    the batch's current time unless given.
    """
    configure(polls.sparkSession)
    normalized = observe_ingest(normalize_vectors(explode_state_vectors(polls), bbox_id, now))
    to_topic, to_dead = publish(events, to_event_messages), best_effort(publish(dead_letters, to_dead_letter_messages))
    count = None if count_in is None else count_ingest(count_in)

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)

        def deliver(passed: DataFrame, batch_id: int) -> None:
            if count is not None:
                count(kept, passed, batch_id)
            to_topic(passed, batch_id)

        try:
            valid, dead = route_events(kept)
            if dedupe_in is None or valid.isEmpty():
                deliver(valid, batch_id)
            else:
                clock = clock_seconds(parse_utc(F.col("ingestion_time_utc")))
                dedupe_stream(dedupe_in, deliver, ttl=ttl)(valid.withColumn("clock_s", clock), batch_id)
            to_dead(dead, batch_id)
        finally:
            kept.unpersist()

    return _start(normalized, write, checkpoint, "ingest", "append", trigger)


def late_rows(query: StreamingQuery) -> int:
    """Rows the query has dropped for being behind the watermark, over its recent batches."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress for operator in progress["stateOperators"]
    )


def await_any(spark: SparkSession) -> None:
    """Wait until any of the queries ends, and raise if it failed, so that no failure goes unseen."""
    spark.streams.awaitAnyTermination()
