"""What running queries have done, kept as a table: one row for each batch, and how each query ended."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "run string, name string, batch bigint, at string, rows bigint, rows_per_second double, millis bigint, "
    "watermark string, late_rows bigint, state_rows bigint, counters map<string, map<string, string>>"
)
ENDED = "run string, name string, error string"


class ProgressLog(StreamingQueryListener):
    """Writes the progress of all queries of a session below ``path``, one small file for each batch.

    A file is named by the query's run and the batch, so an event that is delivered twice is one row. ``counters`` are the
    metrics that a query observes, by name (see ``operators.observe_ingest``). What a query reports is at most a few
    kilobytes a batch, and is written by the driver, which has it anyway. A failing write is the log's own affair: it
    does not reach the queries.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._spark = spark
        self.names: dict[str, str | None] = {}

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        """Stop listening, when all events up to now have been written."""
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._write("batches", f"{p.runId}-{p.batchId}", {
            "run": str(p.runId), "name": p.name, "batch": p.batchId, "at": p.timestamp, "rows": p.numInputRows,
            "rows_per_second": p.processedRowsPerSecond, "millis": p.batchDuration,
            "watermark": (p.eventTime or {}).get("watermark"),
            "late_rows": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
            "state_rows": sum(o.numRowsTotal for o in p.stateOperators),
            "counters": {name: {k: str(v) for k, v in row.asDict().items()} for name, row in p.observedMetrics.items()},
        })

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        run = str(event.runId)
        error = event.exception
        self._write("ended", run, {
            "run": run, "name": self.names.get(run), "error": None if error is None else error.strip().splitlines()[0]})

    def _write(self, kind: str, name: str, row: dict) -> None:
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{name}.json")
        files = path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())
        out = files.create(path, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()

    # reading

    def _read(self, kind: str, schema: str) -> DataFrame:
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(path):
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).json(str(path))

    def batches(self) -> DataFrame:
        """One row for each batch with its rows, duration, watermark, late rows and observed counters."""
        return self._read("batches", PROGRESS)

    def ended(self) -> DataFrame:
        """One row for each ended run; ``error`` is null where it was stopped or had nothing left to do."""
        return self._read("ended", ENDED)

    def summary(self) -> DataFrame:
        """By query: batches with rows, rows, late rows and the number of runs that failed."""
        batches = self.batches().groupBy("name").agg(
            F.count_if(F.col("rows") > 0).alias("batches"), F.sum("rows").alias("rows"),
            F.sum("late_rows").alias("late_rows"))
        ended = self.ended().groupBy("name").agg(
            F.count("error").alias("failed_runs"), F.max("error").alias("error"))
        return batches.join(ended, "name", "full").fillna(0, ["batches", "rows", "late_rows", "failed_runs"])


class QueryFailed(RuntimeError):
    """A query of several has failed; the message names it."""


def await_queries(queries: dict[str, StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Wait until all queries have ended. When one fails, the others are stopped and ``QueryFailed`` names it, so that
    no query goes on behind a dead one unseen."""
    waiting = dict(queries)
    while waiting:
        for name, query in list(waiting.items()):
            try:
                over = query.awaitTermination(poll_seconds)
            except Exception as error:
                for other in waiting.values():
                    other.stop()
                raise QueryFailed(f"{name}: {str(error).strip().splitlines()[0]}") from error
            if over:
                del waiting[name]
