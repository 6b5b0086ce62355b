import json
import os

from conftest import FULL, NULLS, event, put_lines

from contrail.operators import airspace_density, live_positions
from contrail.schemas import GRID_5M, QUALITY_5M, STATE, TRAFFIC_1H, TRAFFIC_5M
from contrail.sources import FolderTarget, read_event_stream, read_polls, write_messages
from contrail.streaming import start_ingest, start_pipeline, start_traffic

NOW = {"availableNow": True}


def finish(queries):
    for query in queries:
        query.awaitTermination()


def sink(path):
    """A message sink that is a folder, one sub-folder per batch."""
    return lambda messages, batch_id: write_messages(messages, "parquet", path=f"{path}/{batch_id}", mode="overwrite")


def iso(minute, second=0):
    return f"2024-01-01T00:{minute:02d}:{second:02d}Z"


def test_events_to_tables(spark, tmp_path):
    folder, target = f"{tmp_path}/in", FolderTarget(f"{tmp_path}/tables")
    put_lines(folder, "1", [event(icao24="a", event_time_utc=iso(1), altitude_m=1.0),
                            event(icao24="a", event_time_utc=iso(2), altitude_m=2.0),
                            event(icao24="b", event_time_utc=iso(3), lat=None), "not json", event(icao24=None)])
    start = lambda: start_pipeline(
        read_event_stream(spark, "text", folder), target, f"{tmp_path}/check", dead_letters=sink(f"{tmp_path}/dead"),
        trigger=NOW)
    queries = start()
    assert set(queries) == {"flight_state_upsert", "airspace_grid_5m", "quality_metrics_5m", "dead_letters"}
    finish(queries.values())
    put_lines(folder, "2", [event(icao24="a", event_time_utc=iso(1), altitude_m=9.0),
                            event(icao24="c", event_time_utc=iso(40))])
    finish(start().values())
    state = {r.icao24: r.altitude_m for r in target.keyed(spark, STATE).collect()}
    assert state == {"a": 2.0, "b": 10600.0, "c": 10600.0}
    grid = target.windows(spark, GRID_5M).collect()
    assert [(r.aircraft_count, r.avg_altitude_m) for r in grid] == [(3, 4.0)]
    quality = target.windows(spark, QUALITY_5M).collect()
    assert [(r.total_messages, r.messages_with_position, r.messages_missing_position) for r in quality] == [(4, 3, 1)]
    dead = [json.loads(r.value) for r in spark.read.parquet(f"{tmp_path}/dead/0").collect()]
    assert len(dead) == 2 and {d["error_type"] for d in dead} == {"schema_validation"}
    assert live_positions(target.keyed(spark, STATE)).count() == 2
    assert airspace_density(target.windows(spark, GRID_5M)).count() == 1


def test_live_windows(spark, tmp_path):
    """Update mode: open windows are visible, each once, with their newest values."""
    folder, target = f"{tmp_path}/in", FolderTarget(f"{tmp_path}/tables")
    for name, minute in (("1", 1), ("2", 2)):
        put_lines(folder, name, [event(event_time_utc=iso(minute))])
        finish(start_pipeline(
            read_event_stream(spark, "text", folder), target, f"{tmp_path}/check", "update", trigger=NOW).values())
    grid = target.windows(spark, GRID_5M, newest=True).collect()
    assert [r.aircraft_count for r in grid] == [2]


def test_readings_to_tables(spark, tmp_path):
    folder, target = f"{tmp_path}/in", FolderTarget(f"{tmp_path}/tables")
    reading = lambda time, value: {
        "timestamp": time, "location": "l", "sensor_type": "traffic", "value": value}
    put_lines(folder, "1", [reading("2024-01-01T00:01:00Z", 1), reading("2024-01-01T00:02:00Z", 4),
                            reading("2024-01-01T09:00:00Z", 7)])
    finish(start_traffic(read_event_stream(spark, "text", folder), target, f"{tmp_path}/check", trigger=NOW).values())
    assert [r.avg_traffic_count for r in target.windows(spark, TRAFFIC_1H).collect()] == [2.5]
    row, = target.windows(spark, TRAFFIC_5M).collect()
    assert (row.max_traffic_count, row.min_traffic_count, row.data_points) == (4, 1, 2)


def test_polls_to_messages(spark, tmp_path):
    """Two polls with the same vectors: one copy of each event, all dead letters; then back through the parser."""
    folder = f"{tmp_path}/polls"
    body = json.dumps({"time": 1, "states": [FULL, NULLS, [None] * 17, ["ABC123", "X", "Y"]]})
    os.makedirs(folder)
    query = None
    for name in ("1", "2"):
        with open(f"{folder}/{name}", "w") as file:
            file.write(body)
        query = start_ingest(
            read_polls(spark, folder), sink(f"{tmp_path}/events"), sink(f"{tmp_path}/dead"), f"{tmp_path}/check", "box",
            dedupe_in=FolderTarget(f"{tmp_path}/tables"), ttl=3600, trigger=NOW)
        query.awaitTermination()
    assert query.exception() is None
    counters = [p["observedMetrics"]["ingest"] for p in query.recentProgress if "ingest" in p["observedMetrics"]]
    assert (counters[-1]["states"], counters[-1]["dlq"]) == (4, 2)
    events = spark.read.parquet(f"{tmp_path}/events/*").collect()
    assert sorted(bytes(r.key) for r in events) == [b"a1b2c3", b"deadbe"]
    dead = spark.read.parquet(f"{tmp_path}/dead/*").collect()
    assert sorted(bytes(r.key) if r.key else b"" for r in dead) == [b"", b"", b"ABC123", b"ABC123"]

    target = FolderTarget(f"{tmp_path}/tables")
    raw = read_event_stream(spark, "parquet", f"{tmp_path}/events/*")
    finish(start_pipeline(raw, target, f"{tmp_path}/check2", trigger=NOW).values())
    assert sorted(r.icao24 for r in target.keyed(spark, STATE).collect()) == ["a1b2c3", "deadbe"]
