"""Writers for ``foreachBatch``.

Each factory returns a ``(batch_df, batch_id)`` function. All of them may be called again with the same batch: what
they write is keyed by the batch id or merged by key. None brings rows to the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.operators.counters import poll_counters, running_total
from contrail.operators.dedupe import accepted_last, dedupe_ttl
from contrail.operators.ingest import route_events
from contrail.operators.latest import absent_rows, latest_state
from contrail.schemas import DEDUPE_KEYS, DEDUPE_TTL_SECONDS, STATE, Table
from contrail.sources.tables import FolderTarget, run_id

logger = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]


class Target(Protocol):
    """Where tables live: a folder or a database."""

    def read(self, spark: SparkSession, name: str) -> DataFrame: ...

    def append(self, rows: DataFrame, table: Table, batch_id: int) -> None: ...

    def replace(self, rows: DataFrame, table: Table, batch_id: int) -> None: ...

    def upsert(self, rows: DataFrame, table: Table, batch_id: int, updated_at: str = "now") -> None: ...


def upsert_state(target: Target, updated_at: str = "now") -> BatchWriter:
    """Keep one state row per vehicle: the batch is cut to its latest rows, then merged."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            target.upsert(latest_state(batch), STATE, batch_id, updated_at)

    return write


def _unless_empty(sink: BatchWriter) -> BatchWriter:
    """Leave empty batches out. A batch is kept while it is asked: else its aggregate, state store and all, would run
    once for the question and once more for the sink."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not kept.isEmpty():
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def append_windows(target: Target, table: Table) -> BatchWriter:
    """Add closed windows; nothing is written for an empty batch."""
    return _unless_empty(lambda batch, batch_id: target.append(batch, table, batch_id))


def replace_windows(target: Target, table: Table) -> BatchWriter:
    """Live view of open windows: a window's newer emission takes the place of the older."""
    return _unless_empty(lambda batch, batch_id: target.replace(batch, table, batch_id))


def insert_absent_windows(target: Target, table: Table) -> BatchWriter:
    """Add windows whose key the table does not hold yet.

    A folder is compared from the batch's first date on, and without what this batch wrote when it ran before. A
    database needs no comparison: its insert leaves stored keys as they are.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first = kept.agg(F.to_date(F.min(table.window))).first()[0]
            if first is None:
                return
            rows = kept
            if isinstance(target, FolderTarget):
                stored = target.read(batch.sparkSession, table.name, other_than=batch_id, since=first)
                rows = absent_rows(kept, stored, list(table.key))
            target.append(rows, table, batch_id)
        finally:
            kept.unpersist()

    return write


def write_routed(events: BatchWriter, dead_letters: BatchWriter) -> BatchWriter:
    """Send the valid half of a normalised batch, as event rows, to one sink and its dead letters to another."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, dead = route_events(kept)
            events(valid, batch_id)
            dead_letters(dead, batch_id)
        finally:
            kept.unpersist()

    return write


def publish(sink: BatchWriter, serialize: Callable[[DataFrame], DataFrame]) -> BatchWriter:
    """Turn rows into messages on their way to a sink."""

    def write(rows: DataFrame, batch_id: int) -> None:
        sink(serialize(rows), batch_id)

    return write


def best_effort(sink: BatchWriter) -> BatchWriter:
    """Log a failing write instead of failing the query, for dead letters that must not hold up the events."""

    def write(rows: DataFrame, batch_id: int) -> None:
        try:
            sink(rows, batch_id)
        except Exception:  # whatever the sink raises
            logger.exception("batch %d was not written", batch_id)

    return write


def dedupe_stream(
    target: FolderTarget, sink: BatchWriter, keys: Sequence[str] = DEDUPE_KEYS, ttl: int = DEDUPE_TTL_SECONDS,
    clock: str = "clock_s", name: str = "dedupe",
) -> BatchWriter:
    """Exact time-to-live de-duplication across batches.

    The last acceptance per key is a versioned table, so a hot key is split in the stream just as in a batch, the
    state survives restarts, and it is no larger than the keys accepted within one TTL. Passed rows are written
    once and read back, both for the sink and for the next state, so that no batch is worked out twice; they are
    removed when the sink has taken them. A row whose clock lies before its key's last acceptance is judged as if it
    had come in time; what has passed before it stays passed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        seen = target.keyed(spark, f"{name}_seen", before=batch_id)
        folder = f"{name}_passed/{run_id(spark)}/batch={batch_id}"
        dedupe_ttl(batch, keys, ttl, clock, seen=seen).write.mode("overwrite").parquet(target.path(folder))
        passed = spark.read.schema(batch.schema).parquet(target.path(folder))
        newest = passed.agg(F.max(clock)).first()[0]
        if newest is not None:
            target.write_version(accepted_last(passed, seen, keys, ttl, clock, newest), f"{name}_seen", batch_id)
        sink(passed, batch_id)
        target.drop(spark, folder)

    return write


def count_ingest(
    target: FolderTarget, poll: str = "poll_id", name: str = "ingest_counters",
) -> Callable[[DataFrame, DataFrame, int], None]:
    """Counters of every poll with the running total of skips, carried from batch to batch.

    Takes the normalised rows of a batch, those that went on, and the batch id. The total that a batch ends with is a
    version of its own, so a batch that runs again starts from the total before it and replaces its own rows: each
    poll counts once. Polls are numbered in their order, and one is never split over batches.
    """

    def count(normalized: DataFrame, passed: DataFrame, batch_id: int) -> None:
        spark = normalized.sparkSession
        stored = target.keyed(spark, f"{name}_total", before=batch_id)
        before = 0 if stored is None else stored.first()["total_skipped"]
        place = target.path(f"{name}/run={run_id(spark)}/batch={batch_id}")
        counted = f"{place}/polls"
        poll_counters(normalized, passed, poll).write.mode("overwrite").parquet(f"{counted}-alone")
        alone = spark.read.parquet(f"{counted}-alone")
        total = running_total(alone, poll, "dedupe_skipped", "total_skipped")
        total.withColumn("total_skipped", F.col("total_skipped") + before).write.mode("overwrite").parquet(counted)
        after = alone.agg((F.coalesce(F.sum("dedupe_skipped"), F.lit(0)) + before).alias("total_skipped"))
        target.write_version(after, f"{name}_total", batch_id)

    return count


def read_ingest_counts(spark: SparkSession, target: FolderTarget, name: str = "ingest_counters") -> DataFrame:
    """What ``count_ingest`` has written so far."""
    return spark.read.option("basePath", target.path(name)).parquet(f"{target.path(name)}/run=*/batch=*/polls").drop(
        "run", "batch")
