import pytest
from pyspark.sql import Row, functions as F

from contrail.functions import (
    bbox_id, clock_text, display_round, epoch_to_iso, event_key, grid_cell, in_range, lag_seconds, normalize_altitude,
    normalize_callsign, normalize_id, parse_utc, split_grid_cell,
)


def evaluate(spark, ddl, rows, *columns):
    df = spark.createDataFrame(rows, ddl)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_callsign(spark):
    given = [None, "", "   ", "  CSN302  ", "\tAB \n", "A B"]
    got = evaluate(spark, "c string", [(g,) for g in given], normalize_callsign(F.col("c")))
    assert [g[0] for g in got] == [None, None, None, "CSN302", "AB", "A B"]


@pytest.mark.parametrize("bound", [90.0, 180.0])
def test_range_is_inclusive(spark, bound):
    given = [bound, -bound, bound + 1, -bound - 1, 0.0, None, float("nan")]
    got = evaluate(spark, "x double", [(g,) for g in given], in_range(F.col("x"), bound))
    assert [g[0] for g in got] == [bound, -bound, None, None, 0.0, None, None]


def test_altitude(spark):
    cases = [  # geo, baro, on_ground, expected
        (10600.0, 10500.0, False, 10600.0), (None, 10500.0, False, 10500.0), (None, None, False, None),
        (-50.0, 100.0, False, None), (-50.0, -100.0, False, None), (5000.0, None, True, None),
        (50.0, None, True, 50.0), (100.0, None, True, 100.0), (100.1, None, True, None), (0.0, 5.0, False, 0.0),
        (5000.0, None, None, 5000.0), (float("nan"), None, True, None),
    ]
    got = evaluate(
        spark, "g double, b double, o boolean", [c[:3] for c in cases],
        normalize_altitude(F.col("g"), F.col("b"), F.col("o")),
    )
    assert [g[0] for g in got] == [c[3] for c in cases]


def test_times(spark):
    got = evaluate(spark, "e double", [(1700000000.0,), (0.0,), (-0.5,), (None,)], epoch_to_iso(F.col("e")))
    assert [g[0] for g in got] == ["2023-11-14T22:13:20Z", "1970-01-01T00:00:00Z", "1969-12-31T23:59:59Z", None]
    texts = ["2023-11-14T22:13:20Z", "2023-11-14T22:13:20.5Z", "rubbish", None]
    seconds = evaluate(spark, "t string", [(t,) for t in texts], F.unix_timestamp(parse_utc(F.col("t"))))
    assert [s[0] for s in seconds] == [1700000000, None, None, None]


def test_time_text_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = evaluate(spark, "t string", [("2023-11-14T22:13:20Z",)], F.unix_timestamp(parse_utc(F.col("t"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(1700000000,)]


def test_lag_truncates_each_side(spark):
    row = [("2023-11-14 22:13:21.9", "2023-11-14 22:13:21.1"), ("2023-11-14 22:13:22.0", "2023-11-14 22:13:21.9")]
    got = evaluate(spark, "a string, b string", row,
                   lag_seconds(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")),
                   clock_text(F.col("a").cast("timestamp")))
    assert got == [(0, "22:13:21 UTC"), (1, "22:13:22 UTC")]


def test_grid_cell(spark):
    rows = [(41.85, -87.6298), (0.25, -0.04), (None, 1.0), (1.0, None)]
    got = evaluate(spark, "a double, b double", rows, grid_cell(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == ["41.9_-87.6", "0.3_0.0", None, None]
    cells = [("41.9_-87.6",), ("rubbish",), (None,)]
    assert evaluate(spark, "c string", cells, *split_grid_cell(F.col("c"))) == [
        (41.9, -87.6), (None, None), (None, None)]
    assert bbox_id(24, 50.04, -125, -66.0) == "24.0_50.0_-125.0_-66.0"


def test_ids_and_keys(spark):
    got = evaluate(spark, "c string", [("A1B2C3",), ("",), (None,)], normalize_id(F.col("c")), event_key(F.col("c")))
    assert got == [("a1b2c3", bytearray(b"A1B2C3")), (None, None), (None, None)]


def test_display_rounding_is_half_even(spark):
    got = evaluate(spark, "x double", [(0.25,), (0.35,)], display_round(F.col("x"), "velocity_mps"))
    assert [round(g[0], 3) for g in got] == [0.2, 0.4]
    assert spark.createDataFrame([Row(x=2.5)]).select(display_round(F.col("x"), "altitude_m")).first()[0] == 2.0
