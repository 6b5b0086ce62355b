"""The bucketed keyed table against the merge in one go."""

import random

import pytest
from pyspark.sql import functions as F
from test_tables import at, state

from contrail.operators import merge_state
from contrail.schemas import STATE
from contrail.sources import BucketedTarget
from contrail.sources.buckets import STAMP


def rows_of(df):
    return sorted((r.icao24, r.altitude_m, r.last_event_time_utc, r.updated_at_utc) for r in df.collect())


@pytest.fixture
def target(tmp_path):
    return BucketedTarget(str(tmp_path), buckets=4)


def test_like_merging_whole_tables(spark, target):
    rng, current = random.Random(2), state(spark).limit(0)
    for batch_id in range(5):
        part = state(spark, *[(f"v{rng.randint(0, 9)}", float(n), 1.0, at(rng.randint(0, 30)), at(40, n)) for n in range(12)],
                     ("", 1.0, 1.0, at(1), at(1)))
        current = spark.createDataFrame(merge_state(current, part, "incoming").collect(), STATE.schema)
        target.upsert(part, STATE, batch_id, "incoming")
        if batch_id == 2:
            target.upsert(part, STATE, batch_id, "incoming")  # runs again
        assert target.compact(spark, STATE, least=3) == (batch_id == 2)
        assert rows_of(target.read(spark, STATE)) == rows_of(current)
    assert [(p.kind, p.number) for p in target.current(spark, STATE)] == [("base", 2), ("delta", 4)]


def test_no_stored_row_moves(spark, target):
    for batch_id in range(3):
        target.upsert(state(spark, ("a", 1.0, 1.0, at(batch_id), at(9))), STATE, batch_id, "incoming")
    assert target.compact(spark, STATE, 1)
    target.upsert(state(spark, ("b", 1.0, 1.0, at(5), at(9))), STATE, 3, "incoming")
    target.upsert(state(spark, ("c", 1.0, 1.0, at(5), at(9))), STATE, 4, "incoming")
    plan = target.read(spark, STATE)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    delta = target._part(spark, STATE, target.current(spark, STATE)[1])
    assert sorted(r.icao24 for r in delta.collect()) == ["b", "c"]  # what came since the base, and no more
    batch = state(spark, ("d", 1.0, 1.0, at(5), at(9))).withColumn(STAMP, F.current_timestamp()).repartition(4, "icao24")
    plan = target._merged(STATE, delta, batch)._jdf.queryExecution().executedPlan().toString()
    stored = plan[:plan.index("FileScan")]
    assert "Exchange" not in stored and plan.count("Exchange") == 1  # the batch, as it was dealt


def test_stamps(spark, target):
    """A first insert keeps its time, a row that takes another's place has that of its writing."""
    target.upsert(state(spark, ("a", 1.0, 1.0, at(1), at(2)), ("b", 1.0, 1.0, at(1), at(2))), STATE, 0)
    target.upsert(state(spark, ("a", 2.0, 1.0, at(1), at(3)), ("b", 2.0, 1.0, at(0), at(3))), STATE, 1)
    found = {r.icao24: r for r in target.read(spark, STATE).collect()}
    assert found["a"].altitude_m == 2.0 and found["a"].updated_at_utc.year > 2024
    assert found["b"].altitude_m == 1.0 and found["b"].updated_at_utc == at(2)


def test_empty_table_and_half_written_parts(spark, target, tmp_path):
    assert target.read(spark, STATE).count() == 0 and not target.compact(spark, STATE, 1)
    target.upsert(state(spark, ("a", 1.0, 1.0, at(1), at(2))), STATE, 0)
    (tmp_path / STATE.name / "delta+7+lost+7").mkdir()
    assert target.read(spark, STATE).count() == 1
    assert spark.catalog.currentDatabase() == "default" and target.read(spark, STATE).where(F.col("icao24") == "a").count() == 1
