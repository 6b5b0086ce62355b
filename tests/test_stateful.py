"""Keyed state with timers, the parsed layer, the progress log and carried counters."""

import datetime
import decimal
import json
import random

import pytest
from conftest import event, put_lines
from pyspark.sql import functions as F
from test_dedupe import brute_force
from test_pipeline import NOW, iso

from contrail.operators import parse_events, telemetry_quality_5m
from contrail.sources import FolderTarget, read_event_stream
from contrail.streaming import (
    ParsedLayer, ProgressLog, QueryFailed, await_queries, count_ingest, dedupe_stateful, keep_live, live_changes,
    read_ingest_counts, read_live, start_shared_pipeline,
)


def in_batches(spark, batches, schema, transform, folder):
    """What a stream makes of row lists that come one after the other, with a restart before each."""
    got = []
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{folder}/in/{n}")
        source = spark.readStream.schema(schema).parquet(f"{folder}/in/*")
        query = (
            transform(source).writeStream.foreachBatch(lambda b, i: got.append([tuple(r) for r in b.collect()]))
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    return got


def test_stateful_equals_brute_force_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.choice("abcd") if t % 7 else None, t // 2, t) for t in range(-100, 300)]
    batches = [rows[:150], rows[150:220], rows[220:]]
    got = in_batches(spark, batches, "k string, t long, n int",
                     lambda s: dedupe_stateful(s, ["k"], 15, "t", ["n"]), tmp_path)
    assert sorted((r for part in got for r in part), key=str) == brute_force(rows, 15)


def test_stateful_takes_rows_that_come_after_newer_ones(spark, tmp_path):
    """100 passes; 95 lies before it and passes too, 105 is a repeat of both, 60 is too late, 111 follows 100."""
    batches = [[("a", 100, 0), ("b", 100, 0)], [("a", 95, 1), ("a", 105, 2)], [("a", 60, 3), ("a", 111, 4), ("c", 108, 5)]]
    got = in_batches(spark, batches, "k string, t long, n int",
                     lambda s: dedupe_stateful(s, ["k"], 10, "t", ["n"], lateness=20), tmp_path)
    assert sorted(r for part in got for r in part) == [
        ("a", 95, 1), ("a", 100, 0), ("a", 111, 4), ("b", 100, 0), ("c", 108, 5)]


LIVE_ROWS = "icao24 string, callsign string, lat double, lon double, altitude_m double, velocity_mps double, " \
            "heading_deg double, ingestion_ts timestamp"


def test_live_positions_appear_move_and_expire(spark, tmp_path):
    def row(key, second, lat=1.0):
        return (key, second, lat)

    # a is silent after 10; b loses its position at 20; c comes back after a gap; d keeps the time going.
    batches = [[row("a", 0), row("a", 10, 2.0), row("b", 5), row("c", 1)],
               [row("b", 20, None), row("d", 305)], [row("c", 400), row("d", 500), row("", 500)]]
    ddl = "icao24 string, s long, lat double"

    def transform(source):
        return live_changes(source.select(
            "icao24", F.lit("x").alias("callsign"), "lat", F.col("lat").alias("lon"),
            *[F.lit(1.0).alias(c) for c in ("altitude_m", "velocity_mps", "heading_deg")],
            F.timestamp_seconds("s").alias("ingestion_ts"))).select("icao24", "change", F.unix_timestamp("at"), "lat")

    got = in_batches(spark, batches, ddl, transform, tmp_path)
    events = sorted(r[:3] for part in got for r in part if r[1] != "moved")
    assert events == [
        ("a", "appeared", 0), ("a", "removed", 310), ("b", "appeared", 5), ("b", "removed", 20), ("c", "appeared", 1),
        ("c", "appeared", 400), ("c", "removed", 301), ("d", "appeared", 305)]
    assert ("a", "moved", 10, 2.0) in got[0]


def test_live_table(spark, tmp_path):
    target, names = FolderTarget(str(tmp_path)), ["icao24", "change", "at", "callsign", "lat", "lon", "altitude_m",
                                                 "velocity_mps", "heading_deg"]
    write = keep_live(target)

    def changes(*rows):
        df = spark.createDataFrame([(k, c, s, float(s)) for k, c, s in rows], "icao24 string, change string, s long, lat double")
        return df.withColumns({"at": F.timestamp_seconds("s"), "callsign": F.lit("x"), **{
            c: F.lit(0.0) for c in ("lon", "altitude_m", "velocity_mps", "heading_deg")}}).select(*names)

    write(changes(("a", "appeared", 1), ("a", "moved", 1), ("b", "appeared", 2)), 0)
    for _ in range(2):  # a batch that runs again changes nothing
        write(changes(("a", "removed", 5), ("a", "appeared", 5), ("b", "removed", 9)), 1)
    assert [(r.icao24, r.lat) for r in read_live(spark, target).collect()] == [("a", 5.0)]


@pytest.fixture
def late_feed(spark, tmp_path):
    """Two batches of messages, the second with three rows behind the watermark, in windows of their own."""
    folder = f"{tmp_path}/in"
    put_lines(folder, "1", [event(icao24="a", event_time_utc=iso(1)), event(icao24="a", event_time_utc=iso(40)), "junk"])
    batches = [None, [event(icao24="b", event_time_utc=iso(m)) for m in (2, 12, 24, 31, 45)]]
    return folder, batches


def test_late_rows_are_those_that_a_window_query_drops(spark, tmp_path, late_feed):
    folder, batches = late_feed
    target, late, dropped = FolderTarget(f"{tmp_path}/tables"), {}, []

    def keep(rows, batch_id):
        late[batch_id] = sorted(r.event_ts.minute for r in rows.collect())

    for n, lines in enumerate(batches):
        if lines:
            put_lines(folder, str(n + 1), lines)
        raw = read_event_stream(spark, "text", folder)
        with ProgressLog(spark, f"{tmp_path}/log{n}") as log:
            await_queries(start_shared_pipeline(raw, target, f"{tmp_path}/check", late=keep, trigger=NOW))
        assert log.batches().where("late_rows > 0").isEmpty()  # nothing vanishes behind the layer
        plain = telemetry_quality_5m(parse_events(raw).where("dead is null")).writeStream.foreachBatch(
            lambda b, i: b.collect()).option("checkpointLocation", f"{tmp_path}/plain").outputMode("append").trigger(**NOW)
        with ProgressLog(spark, f"{tmp_path}/plain-log{n}") as log:
            await_queries({"plain": plain.queryName("plain").start()})
        dropped.append(log.summary().first()["late_rows"])
    assert late == {0: [], 1: [2, 12, 24]} and dropped == [0, 3]  # the window of 24 ends at 25, less than 40 - 10
    parsed = parse_events(read_event_stream(spark, "text", folder)).schema
    layer = ParsedLayer(target).read(spark, parsed)
    assert layer.count() == 8 and layer.where("late").count() == 3 and layer.where("dead is not null").count() == 1


def test_a_batch_of_the_layer_that_runs_again_is_there_once(spark, tmp_path):
    layer = ParsedLayer(FolderTarget(str(tmp_path)))
    rows = spark.createDataFrame([("a", 0), ("b", 4000)], "k string, s long").select(
        "k", F.timestamp_seconds("s").alias("event_ts"))
    old = spark.createDataFrame([("c", 100), ("d", 3990)], "k string, s long").select(
        "k", F.timestamp_seconds("s").alias("event_ts"))
    write = layer.writer()
    for batch_id, part in ((0, rows), (0, rows), (1, old), (1, old)):
        write(part, batch_id)
    assert sorted((r.k, r.late) for r in layer.read(spark, rows.schema).collect()) == [
        ("a", False), ("b", False), ("c", True), ("d", False)]
    assert layer.expire(spark, 1.0) == 0 and layer.expire(spark, -1.0) == 2
    assert layer.read(spark, rows.schema).count() == 0


def test_a_failing_query_stops_the_others_and_is_named(spark, tmp_path):
    put_lines(f"{tmp_path}/in", "1", [event()])
    raw = read_event_stream(spark, "text", f"{tmp_path}/in")

    def broken(batch, batch_id):
        raise ValueError("full")

    with ProgressLog(spark, f"{tmp_path}/log") as log:
        queries = {name: raw.writeStream.queryName(name).foreachBatch(sink).option(
            "checkpointLocation", f"{tmp_path}/{name}").start()
            for name, sink in (("good", lambda b, i: b.count()), ("bad", broken))}
        with pytest.raises(QueryFailed, match="^bad: "):
            await_queries(queries)
    assert not any(q.isActive for q in queries.values())
    found = {r.name: (r.failed_runs, r.error) for r in log.summary().collect()}
    assert found["good"] == (0, None) and found["bad"][0] == 1 and json.dumps(found["bad"][1])


def test_counters_are_carried_and_a_batch_that_runs_again_counts_once(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    count = count_ingest(target)

    def batch(polls):
        rows = [(p, None if n % 4 else "x", False) for p, states in polls for n in range(states)]
        normalized = spark.createDataFrame(rows, "poll_id long, dead string, altitude_suppressed boolean")
        passed = normalized.where("dead is null").dropDuplicates(["poll_id"])
        return normalized, passed

    for batch_id, polls in ((0, [(1, 8), (2, 4)]), (1, [(3, 5)]), (1, [(3, 5)]), (2, [(4, 1)])):
        count(*batch(polls), batch_id)
    found = read_ingest_counts(spark, target).orderBy("poll_id").collect()
    assert [(r.poll_id, r.states, r.dlq, r.sent, r.dedupe_skipped, r.total_skipped) for r in found] == [
        (1, 8, 2, 1, 5, 5), (2, 4, 1, 1, 2, 7), (3, 5, 2, 1, 2, 9), (4, 1, 1, 0, 0, 9)]


def test_stateful_tells_keys_of_a_bucket_apart(spark, tmp_path):
    """Keys of a bucket are told apart: nulls are equal, so are the two zeros, and a microsecond makes a difference."""
    schema = "k string, x double, s timestamp_ntz, t long"
    at = datetime.datetime(2024, 1, 1)
    batches = [[(f"k{n}", 1.0, at, n) for n in range(100)], [(f"k{n}", 1.0, at, n + 5) for n in range(100)]]
    batches[0] += [(None, 0.0, at, 50), (None, -0.0, at, 51), (None, None, at, 52),
                   (None, 0.0, at + datetime.timedelta(microseconds=1), 53)]
    spark.createDataFrame(batches[0], schema).write.parquet(f"{tmp_path}/in/0")
    spark.createDataFrame(batches[1], schema).write.parquet(f"{tmp_path}/in/1")
    got = []
    query = (
        dedupe_stateful(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"), ["k", "x", "s"], 1000, "t", buckets=1)
        .drop("s").writeStream.foreachBatch(lambda b, i: got.extend(tuple(r) for r in b.collect()))
        .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(got, key=str) == sorted([
        *[(f"k{n}", 1.0, n) for n in range(100)], (None, 0.0, 50), (None, None, 52), (None, 0.0, 53)], key=str)


def test_stateful_asks_the_store_once_for_keys_of_a_bucket(spark, tmp_path):
    spark.createDataFrame([(f"k{n}", n) for n in range(100)], "k string, t long").write.parquet(f"{tmp_path}/in/0")
    query = (
        dedupe_stateful(spark.readStream.schema("k string, t long").parquet(f"{tmp_path}/in/*"), ["k"], 1000, "t", buckets=4)
        .writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True)
        .start())
    query.awaitTermination()
    # A value, and a timer in two orders, for each bucket.
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 3 * 4


def test_stateful_takes_clocks_after_2262(spark, tmp_path):
    """Clocks need not be times of our days, and event time lies later still; pandas' times end in 2262."""
    rng = random.Random(4)
    rows = [(rng.choice("abc"), 6_000_000_000 + t // 2, t) for t in range(200)] + [("z", 100_000_000_000, 0)]
    got = in_batches(spark, [[("a", 0, 0)], rows[:100], rows[100:]], "k string, t long, n int",
                     lambda s: dedupe_stateful(s, ["k"], 15, "t", ["n"]), tmp_path)
    assert sorted((r for part in got for r in part), key=str) == sorted([("a", 0, 0), *brute_force(rows, 15)], key=str)


def passed_once(spark, stream, folder):
    got = []
    query = stream.writeStream.foreachBatch(lambda b, i: got.extend(b.collect())).option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return got


def test_stateful_returns_rows_as_they_were(spark, tmp_path):
    """Keys come back from their text as they were, and large numbers beside nulls are not rounded."""
    schema = ("s string, f float, x double, d decimal(30,4), b binary, i int, ok boolean, day date, at timestamp, "
              "ntz timestamp_ntz, l array<int>, t int, n long")
    keys = ["s", "f", "x", "d", "b", "i", "ok", "day", "at", "ntz", "l"]
    at, number = datetime.datetime(2024, 1, 1, 0, 0, 0, 1), decimal.Decimal("12345678901234567890123456.7891")
    full = ("a\nb\"\\:-0.0,é\u0001", 0.1, 5e-324, number, bytearray(b"\x00\xff"), -7, True, at.date(), at, at, [1, None])
    rest = [None] * 8
    rows = [(*full, 5, (1 << 60) + 1), (*full, 60, 9), (*[None] * 11, 6, None),
            ("", -0.0, -0.0, *rest, 7, 1), ("", 0.0, 0.0, *rest, 200, 2),
            ("", float("inf"), float("nan"), *rest, 8, 3), ("", 1e38, 1e300, *rest, 9, 4)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    table = spark.read.parquet(f"{tmp_path}/in")
    out = dedupe_stateful(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), keys, 100, "t")
    assert out.dtypes == table.dtypes
    got = passed_once(spark, out, tmp_path)
    assert sorted(map(str, got)) == sorted(str(r) for r in table.collect() if r.t != 60)


@pytest.mark.parametrize("kind", ["double", "timestamp"])
def test_stateful_returns_other_clocks(spark, tmp_path, kind):
    """A clock that is not a whole number is judged by its whole seconds and returned as it was. Of one second the first
    by the tiebreak passes, NaN and then null last."""
    nan = float("nan")
    rows = [("a", 1.5, None), ("a", 1.25, nan), ("a", 1.75, 3.0), ("a", 11.5, 1.0), ("b", 2.0, nan), ("b", 2.5, None),
            ("a", 9.0, 0.0)]
    spark.createDataFrame(rows, "k string, t double, n double").selectExpr(
        "k", f"cast(t as {kind})", "n").repartition(3).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(f"k string, t {kind}, n double").parquet(f"{tmp_path}/in")
    out = dedupe_stateful(source, ["k"], 10, "t").selectExpr("k", "cast(t as double)", "cast(n as string)")
    assert sorted(map(tuple, passed_once(spark, out, tmp_path))) == [
        ("a", 1.75, "3.0"), ("a", 11.5, "1.0"), ("b", 2.0, "NaN")]
