import datetime as dt

import pytest
from conftest import SMALL
from pyspark.sql import Window, functions as F

from contrail.operators import (
    airspace_grid_5m, latest_state, telemetry_quality_5m, traffic_5m, traffic_hourly, with_key, with_position,
    within_bbox,
)
from contrail.plans import projections as P
from contrail.streaming import late_rows

DDL = "icao24 string, event_ts timestamp, ingestion_ts timestamp, lat double, lon double, altitude_m double, velocity_mps double"


def at(minute, second=0, micro=0):
    return dt.datetime(2024, 1, 1, 0, minute, second, micro)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_grid_counts_messages(spark):
    rows = [
        ("a", at(0), at(0), 41.84, -87.62, 100.0, 10.0), ("a", at(4, 59), at(5), 41.84, -87.62, None, 20.0),
        (None, at(1), at(1), 41.84, -87.62, 300.0, None), ("b", at(5), at(5), 41.84, -87.62, 7.0, 7.0),
        ("c", at(1), at(1), None, -87.62, 7.0, 7.0), ("d", None, at(1), 41.84, -87.62, 7.0, 7.0),
    ]
    got = airspace_grid_5m(spark.createDataFrame(rows, DDL))
    assert rows_of(got) == [
        (at(0), at(5), "41.8_-87.6", 2, 200.0, 15.0), (at(5), at(10), "41.8_-87.6", 1, 7.0, 7.0)]
    extra = airspace_grid_5m(spark.createDataFrame(rows, DDL), approx_distinct=True)
    assert {r.window_start: r.approx_distinct_aircraft for r in extra.collect()} == {at(0): 1, at(5): 1}


def test_quality(spark):
    rows = [
        ("a", at(0, 1, 100000), at(0, 1, 900000), 1.0, 1.0, None, None), (None, at(1), at(1, 3), 1.0, None, None, None),
        ("b", at(2), None, None, 1.0, None, None),
    ]
    got = telemetry_quality_5m(spark.createDataFrame(rows, DDL))
    assert rows_of(got) == [(at(0), at(5), 2, 1, 2, 1.5)]


def test_traffic(spark):
    rows = [(at(0), "x", 1), (at(3), "x", 4), (at(6), "x", None), (at(59, 59), "x", 7), (at(0), None, 2)]
    df = spark.createDataFrame(rows, "timestamp timestamp, location string, value int")
    hour = dt.datetime(2024, 1, 1, 1)
    assert rows_of(traffic_hourly(df)) == [(at(0), hour, "x", 4.0), (at(0), hour, None, 2.0)]
    assert rows_of(traffic_5m(df))[:2] == [(at(0), at(5), "x", 2.5, 4, 1, 2), (at(0), at(5), None, 2.0, 2, 2, 1)]
    assert (at(5), at(10), "x", None, None, None, 0) in rows_of(traffic_5m(df))


def test_filters(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("", 1.0, None), (None, 5.0, 2.0)], "icao24 string, lat double, lon double")
    assert with_position(df).count() == 2 and with_key(df).count() == 1
    assert within_bbox(df, 1.0, 4.0, 2.0, 3.0).count() == 1


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = spark.read.parquet(f"{SMALL}/events.parquet").select(F.col("value").alias("lat"), F.col("value").alias("lon"), "user_id")
    plan = within_bbox(df, 1.0, 4.0, 2.0, 3.0).select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,2.0)" in plan and "LessThanOrEqual(value,3.0)" in plan
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_windows_combine_before_the_shuffle(spark):
    plan = airspace_grid_5m(P.telemetry(P.events(spark, SMALL)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan


# streams

def stream(spark, folder, rows, name):
    """Land one parquet file."""
    spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(f"{folder}/{name}")


def run_once(spark, folder, aggregate, out, checkpoint, mode="append"):
    source = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    emitted = []

    def keep(batch, batch_id):
        emitted.extend(map(tuple, batch.collect()))

    query = (
        aggregate(source).writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    out.extend(emitted)
    return query


@pytest.mark.parametrize("name", ["airspace_grid_5m", "telemetry_quality_5m", "traffic_hourly", "traffic_5m"])
def test_stream_equals_batch(spark, tmp_path, name):
    """Over all closed windows, fed in four batches."""
    aggregate = {"airspace_grid_5m": airspace_grid_5m, "telemetry_quality_5m": telemetry_quality_5m,
                 "traffic_hourly": traffic_hourly, "traffic_5m": traffic_5m}[name]
    events = P.events(spark, SMALL)
    rows = P.readings(events) if name.startswith("traffic") else P.telemetry(events)
    time = "timestamp" if name.startswith("traffic") else "event_ts"
    parts = rows.select("*", F.ntile(4).over(Window.orderBy(time)).alias("part"))
    for part in range(1, 5):
        parts.where(F.col("part") == part).drop("part").coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    got = []

    def keep(batch, batch_id):
        got.extend(map(tuple, batch.collect()))

    aggregate(source).writeStream.foreachBatch(keep).outputMode("append").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    located = rows if "grid" not in name else with_position(rows)
    delay = dt.timedelta(hours=1) if name == "traffic_hourly" else dt.timedelta(minutes=10)
    newest = located.agg(F.max(time)).first()[0]
    expected = [r for r in map(tuple, aggregate(rows).collect()) if r[1] <= newest - delay]

    def rounded(rs):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rs), key=str)

    assert rounded(got) == rounded(expected) and expected


def test_late_rows_and_restart(spark, tmp_path):
    """Rows behind the watermark are dropped and counted; a restart goes on from the checkpoint, so that every
    window comes out once."""
    folder, checkpoint, out = f"{tmp_path}/in", f"{tmp_path}/c", []
    row = lambda key, minute: (key, at(minute), at(minute), 1.0, 1.0, 1.0, 1.0)
    stream(spark, folder, [row("a", 1), row("b", 8)], "1")
    run_once(spark, folder, airspace_grid_5m, out, checkpoint)
    assert out == []
    stream(spark, folder, [row("c", 3), row("d", 25)], "2")
    run_once(spark, folder, airspace_grid_5m, out, checkpoint)
    assert [(r[0], r[3]) for r in sorted(out)] == [(at(0), 2), (at(5), 1)]
    stream(spark, folder, [row("late", 4), row("e", 26)], "3")
    query = run_once(spark, folder, airspace_grid_5m, out, checkpoint)
    assert late_rows(query) == 1
    stream(spark, folder, [row("f", 59)], "4")
    run_once(spark, folder, airspace_grid_5m, out, checkpoint)
    assert [(r[0], r[3]) for r in sorted(out)] == [(at(0), 2), (at(5), 1), (at(25), 2)]


def test_update_mode_emits_a_window_each_time_it_changes(spark, tmp_path):
    folder, checkpoint, out = f"{tmp_path}/in", f"{tmp_path}/c", []
    for n in range(3):
        stream(spark, folder, [("a", at(n), at(n), 1.0, 1.0, 1.0, 1.0)], str(n))
    run_once(spark, folder, airspace_grid_5m, out, checkpoint, "update")
    assert sorted(r[3] for r in out) == [1, 2, 3]


def test_latest_state_does_not_depend_on_row_order(spark):
    rows = P.telemetry(P.events(spark, SMALL))
    shuffled = rows.repartition(7, F.hash("event_id")).orderBy(F.xxhash64("event_id"))
    assert rows_of(latest_state(rows)) == rows_of(latest_state(shuffled))
