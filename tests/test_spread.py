"""Work is dealt over the cores though a table is one file, and a batch of windows is worked out once."""

import datetime

import pytest
from pyspark.sql import functions as F

from contrail.plans import projections as P
from contrail.plans import queries
from contrail.schemas import GRID_5M
from contrail.streaming import append_windows
from contrail.streaming.batches import replace_windows


class _Caught(Exception):
    pass


@pytest.fixture()
def tables(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(n, at + datetime.timedelta(seconds=n), n % 5, "view", 1.0, '{"k": 3}') for n in range(200)]
    rows += [rows[0], (None, None, None, None, None, None), (None, None, None, None, None, None)]
    spark.createDataFrame(rows, P.EVENTS_DDL).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def _dealt(df) -> bool:
    return "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()


def test_spread_keeps_the_rows(spark, tables):
    rows = P.events(spark, tables)
    dealt = P.spread(rows)
    assert rows.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))


def test_dedupe_ttl_is_dealt(spark, tables):
    assert _dealt(queries.registry()["dedupe_ttl"](spark, tables))


@pytest.mark.parametrize(("name", "feeder"), [
    ("dedupe_stateful", "_in_turns"), ("dedupe_stream", "_in_turns"), ("ingest_to_messages", "_in_turns"),
    ("ingest_counters_stream", "_in_turns"), ("stream_progress", "_fed")])
def test_streams_are_fed_from_all_cores(spark, tables, monkeypatch, name, feeder):
    fed = []

    def catch(rows, *_, **__):
        fed.append(rows)
        raise _Caught

    monkeypatch.setattr(queries, feeder, catch)
    with pytest.raises(_Caught):
        queries.registry()[name](spark, tables)
    assert _dealt(fed[0])


@pytest.mark.parametrize(("writer", "method"), [(append_windows, "append"), (replace_windows, "replace")])
def test_windows_are_worked_out_once(spark, writer, method):
    done, written = spark.sparkContext.accumulator(0), []

    def count(batches):
        for batch in batches:
            done.add(batch.num_rows)
            yield batch

    class Sink:
        def take(self, rows, table, batch_id):
            written.append((sorted(r.id for r in rows.collect()), batch_id))

    sink = Sink()
    setattr(sink, method, sink.take)
    rows = spark.range(20).coalesce(1).mapInArrow(count, "id long")
    writer(sink, GRID_5M)(rows, 3)
    assert written == [(list(range(20)), 3)] and done.value == 20
    writer(sink, GRID_5M)(rows.where(F.col("id") < 0), 4)
    assert len(written) == 1
