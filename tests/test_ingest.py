import json

import pytest
from pyspark.sql import functions as F

from conftest import FULL
from contrail.operators import (
    dlq_counts, explode_state_vectors, normalize_vectors, observe_ingest, route_events, running_total, vector_from_text,
)
from contrail.schemas import TELEMETRY

BOX = "24.0_50.0_-125.0_-66.0"
NOW = "2023-11-14 22:14:00"


def normalize(spark, *vectors):
    """Event or dead letter of each vector, in order. Vectors are lists, or JSON text."""
    rows = [(i, v if isinstance(v, str) or v is None else json.dumps(v)) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "i int, text string")
    df = df.select("i", vector_from_text(F.col("text")).alias("state"))
    out = normalize_vectors(df, BOX, F.lit(NOW).cast("timestamp")).orderBy("i").collect()
    assert all((r.event is None) != (r.dead is None) for r in out)
    return [r.event or r.dead for r in out]


def changed(**positions):
    vector = list(FULL)
    for position, value in positions.items():
        vector[int(position[1:])] = value
    return vector


def test_full_vector(spark, full):
    event, = normalize(spark, full)
    assert event.asDict() == {
        "schema_version": 1, "event_time_utc": "2023-11-14T22:13:20Z", "source": "opensky", "icao24": "a1b2c3",
        "ingestion_time_utc": "2023-11-14T22:14:00Z", "callsign": "UAL123", "lat": 41.8781, "lon": -87.6298,
        "altitude_m": 10600.0, "velocity_mps": 245.3, "heading_deg": 90.0, "vertical_rate_mps": 1.5,
        "on_ground": False, "last_contact_utc": "2023-11-14T22:13:25Z", "origin_country": "United States",
        "geo_altitude_m": 10600.0, "squawk": "1234", "spi": False, "position_source": 0, "bbox_id": BOX,
    }
    assert list(event.asDict()) == TELEMETRY.fieldNames()


def test_null_vector(spark, nulls):
    event, = normalize(spark, nulls)
    assert (event.lat, event.lon, event.altitude_m, event.squawk) == (None,) * 4
    assert event.event_time_utc == "2023-11-14T22:13:30Z" and event.on_ground is True


def test_values(spark):
    cases = [
        (changed(p6=91.0), "lat", None), (changed(p6=-91.0), "lat", None), (changed(p6=90), "lat", 90.0),
        (changed(p5=181.0), "lon", None), (changed(p5=-180), "lon", -180.0),
        (changed(p1="  CSN302  "), "callsign", "CSN302"), (changed(p1=""), "callsign", None),
        (changed(p1="    "), "callsign", None), (changed(p1=None), "callsign", None),
        (changed(p7=-100.0, p13=-50.0), "altitude_m", None), (changed(p13=None), "altitude_m", 10500.0),
        (changed(p13=-50, p7=100), "altitude_m", None), (changed(p13=-50), "geo_altitude_m", -50.0),
        (changed(p13=0), "altitude_m", 0.0), (changed(p8=True, p13=5000.0), "altitude_m", None),
        (changed(p8=True, p13=100), "altitude_m", 100.0), (changed(p8=None, p13=5000.0), "altitude_m", 5000.0),
        (changed(p0="A1B2C3"), "icao24", "a1b2c3"), (changed(p0=123), "icao24", "123"),
        (changed(p3=None), "event_time_utc", "2023-11-14T22:13:25Z"),
        (changed(p3=None, p4=None), "event_time_utc", "2023-11-14T22:14:00Z"),
        (changed(p3=0), "event_time_utc", "1970-01-01T00:00:00Z"), (changed(p4=None), "last_contact_utc", None),
        (changed(p9="245.3"), "velocity_mps", 245.3), (changed(p9=True), "velocity_mps", 1.0),
        (changed(p8="false"), "on_ground", True), (changed(p8=0), "on_ground", False),
        (changed(p8=""), "on_ground", False), (changed(p8=[]), "on_ground", False), (changed(p8=[0]), "on_ground", True),
        (changed(p8=0.5), "on_ground", True), (changed(p15=None), "spi", None), (changed(p15=1), "spi", True),
        (changed(p2=5), "origin_country", "5"), (changed(p2=True), "origin_country", "True"),
        (changed(p14=1234), "squawk", "1234"), (changed(p16=1.7), "position_source", 1),
        (changed(p16=-1.7), "position_source", -1), (changed(p16="2"), "position_source", 2),
        (changed(p16=True), "position_source", 1), (changed(p16=10**12), "position_source", None),
        (changed(p12=[1, 2]), "squawk", "1234"), (FULL + ["extra"], "squawk", "1234"),
    ]
    for (vector, field, expected), event in zip(cases, normalize(spark, *[c[0] for c in cases])):
        assert event.asDict().get(field, "dead letter") == expected, (vector, field, event)


def test_dead_letters(spark):
    missing, shape = "missing_required_field", "schema_validation"
    cases = [  # vector, type, raw id, state_len
        ([None] * 17, missing, None, 17), ([""] + ["x"] * 16, missing, None, 17), (changed(p0=0), missing, None, 17),
        (changed(p0=False), missing, None, 17), (["", "X"], missing, None, 2),
        (["ABC123", "X", "Y"], shape, "ABC123", 3), (None, shape, None, 0), ("null", shape, None, 0),
        ([], shape, None, 0), ("not json", shape, None, 0), ('{"a": 1}', shape, None, 0),
        (changed(p6="41.8"), shape, "a1b2c3", 17), (changed(p5="x"), shape, "a1b2c3", 17),
        (changed(p6=[1]), shape, "a1b2c3", 17), (changed(p9="x"), shape, "a1b2c3", 17),
        (changed(p7="x"), shape, "a1b2c3", 17), (changed(p13={}), shape, "a1b2c3", 17),
        (changed(p4="x"), shape, "a1b2c3", 17), (changed(p3="1700000000"), shape, "a1b2c3", 17),
        (changed(p3=1e18), shape, "a1b2c3", 17), (changed(p1=123), shape, "a1b2c3", 17),
        (changed(p16="5.0"), shape, "a1b2c3", 17), (changed(p16=[]), shape, "a1b2c3", 17),
        (changed(p0="A1", p9="x"), shape, "A1", 17),
    ]
    for (vector, error_type, raw_id, length), dead in zip(cases, normalize(spark, *[c[0] for c in cases])):
        got = dead.asDict(recursive=True)
        assert got.get("error_type") == error_type, (vector, got)
        assert (got["raw_icao24"], got["raw_payload"]) == (raw_id, {"state_len": length}), (vector, got)
        assert got["error_time_utc"] == "2023-11-14T22:14:00Z" and got["message"]


def test_routing_and_counts(spark):
    vectors = [FULL, changed(p0=None), changed(p6="x"), changed(p8=True, p13=5000.0)]
    rows = [(i, json.dumps(v)) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "i int, text string").select("i", vector_from_text(F.col("text")).alias("state"))
    normalized = normalize_vectors(df)
    valid, dead = route_events(normalized)
    assert valid.columns == ["i", "altitude_suppressed", *TELEMETRY.fieldNames()]
    assert {r.i: r.altitude_suppressed for r in valid.collect()} == {0: False, 3: True}
    assert {r.i for r in dead.collect()} == {1, 2}
    assert {r.error_type: r.dead_letters for r in dlq_counts(dead).collect()} == {
        "missing_required_field": 1, "schema_validation": 1}


def test_routing_reads_each_vector_once(spark, full):
    """The filter on the outcome stays above the decoding; below it, every vector would be decoded twice."""
    df = spark.createDataFrame([(json.dumps(full),)], "text string")
    valid, _ = route_events(normalize_vectors(df.select(vector_from_text(F.col("text")).alias("state"))))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "variant" in line.lower()]
    assert filters == []


def test_polls(spark):
    polls = [
        (1, json.dumps({"time": 1, "states": [["a", 1], ["b", "1"]]})), (2, '{"states": null}'), (3, "{}"),
        (4, '{"states": []}'), (5, "no json"), (6, json.dumps({"states": [None, ["c", None]]})),
    ]
    rows = explode_state_vectors(spark.createDataFrame(polls, "poll_id int, value string"))
    got = rows.select("poll_id", "state_pos", F.to_json("state")).collect()
    assert sorted(map(tuple, got)) == [
        (1, 0, '["a",1]'), (1, 1, '["b","1"]'), (6, 0, "null"), (6, 1, '["c",null]')]


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_running_total(spark, block):
    rows = [(i, i % 4) for i in range(-7, 60, 3)]
    got = running_total(spark.createDataFrame(rows, "poll int, skipped int"), "poll", "skipped", "total", block)
    total = 0
    expected = {}
    for poll, skipped in rows:
        total += skipped
        expected[poll] = total
    assert {r.poll: r.total for r in got.collect()} == expected


def test_observed_counters(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(json.dumps(v),) for v in (FULL, [None] * 17)], "text string")
    normalized = normalize_vectors(df.select(vector_from_text(F.col("text")).alias("state")))
    assert observe_ingest(normalized).count() == 2
    seen = Observation("counters")
    normalized.observe(seen, F.count_if(F.col("dead").isNotNull()).alias("dlq")).collect()
    assert seen.get == {"dlq": 1}
