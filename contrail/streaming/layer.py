"""A parsed layer between the topic and the queries: messages are read and parsed once, whoever needs them.

Every batch of messages becomes one folder of parsed rows, moved into place as a whole when it is complete, so a reader
sees a batch entirely or not at all, and a batch that runs again finds its folder and leaves it as it is. Rows carry
``late``: their window had been closed by the layer's own watermark when they came. Readers that aggregate by time leave
late rows out, readers that keep the newest row take them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from contrail.sources.tables import FolderTarget, run_id

LATE = "late"


def closed(time_column: str, window_seconds: int, watermark: Column) -> Column:
    """Whether the tumbling window of a row's time had ended at ``watermark``; false where either is null."""
    seconds = F.unix_timestamp(time_column)
    end = F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(window_seconds)) + window_seconds)
    return F.coalesce(end <= watermark, F.lit(False))


@dataclass(frozen=True)
class ParsedLayer:
    """The layer ``name`` below a target's folder. Delay and window are those of the aggregates that read it."""

    target: FolderTarget
    name: str = "parsed"
    delay_seconds: int = 600
    window_seconds: int = 300

    @property
    def path(self) -> str:
        return self.target.path(self.name)

    # writing

    def writer(self, time_column: str = "event_ts", late: Callable[[DataFrame, int], None] | None = None):
        """A batch writer. ``late`` gets the late rows of each batch as well, for a table of their own.

        The watermark of a batch is the newest time of all batches before it less the delay, as in the engine, in whole
        milliseconds; it is kept as a versioned one-row table, so a batch that runs again has the watermark that it had before.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                before = self._newest(spark, batch_id)
                watermark = F.lit(before).cast("timestamp") - F.make_dt_interval(secs=F.lit(self.delay_seconds))
                marked = kept.withColumn(LATE, closed(time_column, self.window_seconds, watermark))
                if late is not None:
                    late(marked.where(LATE).drop(LATE), batch_id)
                newest = kept.agg(F.date_trunc("millisecond", F.max(time_column))).first()[0]
                self._bound(spark, batch_id, max((t for t in (before, newest) if t is not None), default=None))
                self._commit(marked, batch_id)
            finally:
                kept.unpersist()

        return write

    def _newest(self, spark: SparkSession, batch_id: int):
        bounds = self.target.keyed(spark, f"{self.name}_bounds", before=batch_id)
        return None if bounds is None else bounds.first()["newest"]

    def _bound(self, spark: SparkSession, batch_id: int, newest) -> None:
        row = spark.createDataFrame([(newest,)], "newest timestamp").coalesce(1)
        self.target.write_version(row, f"{self.name}_bounds", batch_id)

    def _commit(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        files, jvm_path = self.target._files(spark, self.name)
        name = f"{run_id(spark)}+{batch_id}"
        final = jvm_path(f"{self.path}/{name}")
        if files.exists(final):
            return
        staged = f"{self.path}_staged/{name}"
        rows.write.mode("overwrite").parquet(staged)
        files.mkdirs(jvm_path(self.path))
        if not files.rename(jvm_path(staged), final):
            raise OSError(f"{staged} could not be moved to {self.path}")

    # reading

    def stream(self, spark: SparkSession, schema: T.StructType, **options: object) -> DataFrame:
        """The parsed rows as a stream, with ``late``. ``schema`` is that of the rows as they were written."""
        files, jvm_path = self.target._files(spark, self.name)
        files.mkdirs(jvm_path(self.path))
        reader = spark.readStream.schema(T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType())]))
        reader = reader.option("recursiveFileLookup", "true").options(**{k: str(v) for k, v in options.items()})
        return reader.parquet(self.path)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The parsed rows that the layer still holds."""
        files, jvm_path = self.target._files(spark, self.name)
        whole = T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType())])
        if not files.exists(jvm_path(self.path)):
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).option("recursiveFileLookup", "true").parquet(self.path)

    def expire(self, spark: SparkSession, keep_hours: float) -> int:
        """Remove batches older than ``keep_hours``, which must be longer than any reader lags; returns how many."""
        files, jvm_path = self.target._files(spark, self.name)
        if not files.exists(jvm_path(self.path)):
            return 0
        limit, gone = (time.time() - keep_hours * 3600) * 1000, 0
        for status in files.listStatus(jvm_path(self.path)):
            if status.getModificationTime() <= limit:
                gone += bool(files.delete(status.getPath(), True))
        return gone
