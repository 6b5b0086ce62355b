import json

from conftest import event
from pyspark.sql import functions as F

from contrail.operators import (
    dead_letter, parse_events, parse_readings, route_events, to_dead_letter_messages, to_event_messages,
)
from contrail.schemas import (
    DEAD_LETTER, DEAD_LETTER_TOPIC, EVENT_TOPIC, GRID_5M, QUALITY_5M, REQUIRED_FIELDS, SCHEMA_VERSION, STATE, TELEMETRY,
)


def messages(spark, items):
    rows = [(bytearray(json.dumps(i) if isinstance(i, dict) else i, "utf-8") if i is not None else None,)
            for i in items]
    return spark.createDataFrame(rows, "value binary")


def test_contract():
    assert (SCHEMA_VERSION, EVENT_TOPIC, DEAD_LETTER_TOPIC) == (1, "flight-telemetry-v1", "flight-telemetry-dlq")
    assert REQUIRED_FIELDS == ["schema_version", "event_time_utc", "source", "icao24", "ingestion_time_utc"]
    assert len(TELEMETRY) == 20 and all(TELEMETRY[f].nullable for f in TELEMETRY.fieldNames()[5:])
    assert set(STATE.columns) == {
        "icao24", "callsign", "lat", "lon", "altitude_m", "velocity_mps", "heading_deg", "vertical_rate_mps",
        "on_ground", "last_event_time_utc", "updated_at_utc", "source"}
    assert set(GRID_5M.columns) == {
        "window_start", "window_end", "grid_cell", "aircraft_count", "avg_altitude_m", "avg_velocity_mps"}
    assert set(QUALITY_5M.columns) == {
        "window_start", "window_end", "total_messages", "messages_with_position", "messages_missing_position",
        "avg_event_lag_seconds"}


def test_parse_events(spark):
    row, = parse_events(messages(spark, [event()])).collect()
    assert row.dead is None and row.icao24 == "a1b2c3" and row.altitude_m == 10600.0
    seconds = parse_events(messages(spark, [event()])).select(
        F.unix_timestamp("event_ts"), F.unix_timestamp("ingestion_ts")).first()
    assert tuple(seconds) == (1700000000, 1700000001)


def test_bad_messages_become_dead_letters(spark):
    missing = event()
    del missing["source"]
    items = [
        "not json", None, "[1]", event(icao24=None), event(icao24=""), missing, event(event_time_utc="yesterday"),
        event(event_time_utc="2023-11-14T22:13:20.5Z"), event(ingestion_time_utc="2023-11-14 22:13:20"),
    ]
    rows = parse_events(messages(spark, items)).collect()
    assert len(rows) == len(items)
    assert {r.dead.error_type for r in rows} == {"schema_validation"}
    kept, = parse_events(messages(spark, [event(lat="x")])).collect()
    assert kept.lat is None and kept.lon == -87.6298


def test_origin_is_carried(spark):
    raw = messages(spark, ["bad", event()]).withColumns({"topic": F.lit("t"), "partition": F.lit(3),
                                                          "offset": F.lit(7).cast("long")})
    valid, dead = route_events(parse_events(raw))
    assert valid.first().partition == 3
    assert (dead.first().topic, dead.first().offset) == ("t", 7)
    assert dead.columns == ["topic", "partition", "offset", *DEAD_LETTER.fieldNames()]


def test_event_messages_keep_nulls(spark):
    df = spark.createDataFrame([tuple(event(lat=None, squawk=None).values())], TELEMETRY)
    row, = to_event_messages(df).collect()
    assert row.key == b"a1b2c3"
    assert json.loads(row.value) == event(lat=None, squawk=None)


def test_dead_letter_messages(spark):
    df = spark.createDataFrame([("a1b2c3",), (None,), ("",)], "id string").select(dead_letter(
        F.lit(True), F.timestamp_seconds(F.lit(1700000000)), F.lit("lat_out_of_range"), F.col("id"), F.lit(17),
        F.lit("latitude is off the map")).alias("d")).select("d.*")
    rows = to_dead_letter_messages(df).collect()
    assert [r.key for r in rows] == [b"a1b2c3", None, None]
    assert json.loads(rows[1].value) == {
        "error_time_utc": "2023-11-14T22:13:20Z", "error_type": "lat_out_of_range", "raw_icao24": None,
        "raw_payload": {"state_len": 17}, "message": "latitude is off the map"}


def test_readings(spark):
    items = [
        {"timestamp": "2024-01-01T00:00:07Z", "location": "l1", "sensor_type": "traffic", "value": 5},
        {"timestamp": "2024-01-01T00:00:07Z", "location": "l1", "sensor_type": "air", "value": 5},
        {"timestamp": "2024-01-01T00:00:07Z", "location": "l1", "value": 5}, "not json",
        {"timestamp": "2024-01-01T00:00:08", "location": None, "sensor_type": "traffic", "value": None},
    ]
    rows = parse_readings(messages(spark, items)).collect()
    assert [(r.location, r.value) for r in rows] == [("l1", 5), (None, None)]
    assert [r.timestamp.second for r in rows] == [7, 8]


def test_a_filter_does_not_parse_messages_again(spark):
    raw = messages(spark, [event()])
    for df in (route_events(parse_events(raw))[0], parse_readings(raw)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "from_json" in line]
