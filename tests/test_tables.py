import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from contrail.operators import (
    absent_rows, airspace_density, insert_if_absent, latest_state, live_kpis, live_positions, merge_state,
    quality_headline, quality_history, to_imperial, top_k,
)
from contrail.schemas import GRID_5M, QUALITY_5M, STATE, TABLES
from contrail.session import work_dir
from contrail.sources import (
    FolderTarget, JdbcTarget, conform, ensure_table, export_snapshots, load_table, merge_statement, read_event_stream,
    read_snapshot, scan_options, stream_options, write_messages,
)
from contrail.streaming import append_windows, best_effort, insert_absent_windows, replace_windows


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 0, minute, second)


def state(spark, *rows):
    """(icao24, altitude, velocity, event time, update time) rows as state rows."""
    full = [(i, None, None if a is None else 1.0, 2.0, a, v, None, None, None, e, u, "s") for i, a, v, e, u in rows]
    columns = ["icao24", "callsign", "lat", "lon", "altitude_m", "velocity_mps", "heading_deg", "vertical_rate_mps",
               "on_ground", "last_event_time_utc", "updated_at_utc", "source"]
    ddl = ("icao24 string, callsign string, lat double, lon double, altitude_m double, velocity_mps double, "
           "heading_deg double, vertical_rate_mps double, on_ground boolean, last_event_time_utc timestamp, "
           "updated_at_utc timestamp, source string")
    return spark.createDataFrame(full, ddl).select(*columns)


def telemetry(spark, *rows):
    """(icao24, altitude, event time, ingestion time) rows as telemetry."""
    ddl = ("icao24 string, callsign string, lat double, lon double, altitude_m double, velocity_mps double, heading_deg "
           "double, vertical_rate_mps double, on_ground boolean, event_ts timestamp, ingestion_ts timestamp, source string")
    return spark.createDataFrame([(i, None, 1.0, 2.0, a, a, 0.0, 0.0, False, e, u, "s") for i, a, e, u in rows], ddl)


def test_latest_state(spark):
    df = telemetry(spark, ("a", 1.0, at(1), at(9)), ("a", 2.0, at(2), at(2)), ("a", 3.0, at(2), at(3)),
                   ("", 1.0, at(1), at(1)), (None, 1.0, at(1), at(1)), ("b", 5.0, None, at(1)))
    got = {r.icao24: (r.altitude_m, r.updated_at_utc) for r in latest_state(df).collect()}
    assert got == {"a": (3.0, at(3)), "b": (5.0, at(1))}


def test_upsert_keeps_one_row_with_the_newest_values(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    target.upsert(state(spark, ("a", 9000.0, 240.0, at(1), at(1))), STATE, 0)
    first = target.keyed(spark, STATE).first()
    assert first.updated_at_utc == at(1)
    target.upsert(state(spark, ("a", 11000.0, 260.0, at(2), at(2))), STATE, 1)
    row, = target.keyed(spark, STATE).collect()
    assert (row.altitude_m, row.velocity_mps) == (11000.0, 260.0) and row.updated_at_utc > dt.datetime(2025, 1, 1)
    target.upsert(state(spark, ("a", 1.0, 1.0, at(1), at(3))), STATE, 2)
    assert target.keyed(spark, STATE).first().altitude_m == 11000.0
    target.upsert(state(spark, *[(f"id{n}", 1.0, 1.0, at(1), at(1)) for n in range(5)]), STATE, 3)
    assert target.keyed(spark, STATE).count() == 6


def test_merge_takes_equal_times_and_incoming_stamps(spark):
    current = state(spark, ("a", 9.0, 9.0, at(1), at(5)), ("c", 1.0, 1.0, at(1), at(1)))
    incoming = state(spark, ("a", 1.0, 1.0, at(1), at(2)), ("b", 1.0, 1.0, at(1), at(1)), ("", 1.0, 1.0, at(1), at(1)))
    got = {r.icao24: (r.altitude_m, r.updated_at_utc) for r in merge_state(current, incoming, "incoming").collect()}
    assert got == {"a": (1.0, at(2)), "b": (1.0, at(1)), "c": (1.0, at(1))}
    with pytest.raises(ValueError):
        merge_state(current, incoming, "later")


def batches(target, spark, table):
    return [v.batch for v in target.versions(spark, table)]


def test_replayed_batches_and_versions(spark, tmp_path):
    target = FolderTarget(str(tmp_path), keep_hours=0)
    for batch_id in (0, 1, 2, 2):
        target.upsert(state(spark, ("a", float(batch_id), 1.0, at(batch_id), at(batch_id))), STATE, batch_id, "incoming")
    assert batches(target, spark, STATE) == [1, 2]
    assert target.keyed(spark, STATE).first().altitude_m == 2.0
    assert target.keyed(spark, STATE, before=2).first().altitude_m == 1.0
    (tmp_path / STATE.name / "v=9+direct+9").mkdir()  # an unfinished version does not count
    assert batches(target, spark, STATE) == [1, 2]
    assert FolderTarget(str(tmp_path / "none")).read(spark, STATE.name).count() == 0
    young = FolderTarget(str(tmp_path / "young"))
    for batch_id in range(5):
        young.upsert(state(spark, ("a", 1.0, 1.0, at(1), at(1))), STATE, batch_id)
    assert batches(young, spark, STATE) == [0, 1, 2, 3, 4]  # a reader may still hold any of them


def test_a_new_checkpoint_is_a_new_run(spark, tmp_path, monkeypatch):
    """Batches are numbered from 0 again; nothing stored may be overwritten or hidden."""
    target = FolderTarget(str(tmp_path))
    for run, minutes in (("one", 0), ("two", 30)):
        monkeypatch.setattr("contrail.sources.tables.run_id", lambda session, run=run: run)
        for batch_id in (0, 1):
            when = at(minutes + 5 * batch_id)
            target.upsert(state(spark, (f"{run}{batch_id}", 1.0, 1.0, when, when)), STATE, batch_id, "incoming")
            append_windows(target, GRID_5M)(grid(spark, (when, "a", minutes + batch_id)), batch_id)
    assert {r.icao24 for r in target.read(spark, STATE.name).collect()} == {"one0", "one1", "two0", "two1"}
    assert sorted(r.aircraft_count for r in target.windows(spark, GRID_5M).collect()) == [0, 1, 30, 31]
    replace_windows(target, GRID_5M)(grid(spark, (at(0), "a", 7)), 2)
    assert sorted(r.aircraft_count for r in target.read(spark, GRID_5M.name).collect()) == [1, 7, 30, 31]


def test_inserts_start_on_an_empty_folder_and_may_be_replayed(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    write = insert_absent_windows(target, GRID_5M)
    write(grid(spark), 0)
    for _ in range(2):
        write(grid(spark, (at(0), "a", 1), (at(0), "b", 2)), 1)
        assert sorted(r.aircraft_count for r in target.windows(spark, GRID_5M).collect()) == [1, 2]
    for _ in range(2):
        write(grid(spark, (at(0), "a", 9), (at(5), "a", 3)), 2)
        assert sorted(r.aircraft_count for r in target.windows(spark, GRID_5M).collect()) == [1, 2, 3]


def test_a_compaction_that_stops_loses_nothing(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    for batch_id, count in ((0, 1), (1, 2)):
        rows = spark.createDataFrame([(at(0), at(5), "1.0_1.0", count, 1.0, 1.0)], GRID_5M.schema)
        append_windows(target, GRID_5M)(rows, batch_id)
    settled = target.read(spark, GRID_5M.name).collect()
    target._place_compacted(spark, GRID_5M, dt.date(2024, 1, 1))  # and then the process is gone
    assert target.read(spark, GRID_5M.name).collect() == settled and len(settled) == 1
    target.compact(spark, GRID_5M, dt.date(2024, 1, 2))
    assert target.windows(spark, GRID_5M).collect() == settled
    assert len(list((tmp_path / GRID_5M.name / "window_date=2024-01-01").glob("run=*"))) == 1


def test_compacted_and_published_tables(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    for batch_id in range(3):
        append_windows(target, GRID_5M)(grid(spark, (at(5 * batch_id), "a", batch_id)), batch_id)
    target.upsert(state(spark, ("a", 1.0, 1.0, at(1), at(1))), STATE, 0)
    try:
        target.publish(spark, GRID_5M)
        target.publish(spark, STATE)
        assert spark.table(GRID_5M.name).count() == 3 and spark.table(STATE.name).count() == 1
        target.compact(spark, GRID_5M, dt.date(2030, 1, 1))
        assert sorted(r.aircraft_count for r in target.windows(spark, GRID_5M).collect()) == [0, 1, 2]
        day = tmp_path / GRID_5M.name / "window_date=2024-01-01"
        folder, = [p.name for p in day.iterdir() if p.is_dir()]
        assert folder.startswith("run=compacted-")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {GRID_5M.name}")
        spark.sql(f"DROP VIEW IF EXISTS {STATE.name}")


GRID_DDL = "window_start timestamp, window_end timestamp, grid_cell string, aircraft_count long, avg_altitude_m double, avg_velocity_mps double"


def grid(spark, *rows):
    return spark.createDataFrame([(s, s + dt.timedelta(minutes=5), c, n, 1.0, 1.0) for s, c, n in rows], GRID_DDL)


def test_insert_if_absent(spark):
    stored = grid(spark, (at(0), "a", 1), (at(5), "a", 2))
    new = grid(spark, (at(0), "a", 9), (at(0), "b", 8), (at(0), "b", 7), (at(10), "a", 6))
    key = list(GRID_5M.key)
    got = insert_if_absent(new, stored, key)
    assert sorted((r.window_start, r.grid_cell, r.aircraft_count) for r in got.collect()) == [
        (at(0), "a", 1), (at(0), "b", 7), (at(5), "a", 2), (at(10), "a", 6)]
    assert absent_rows(new, stored, key).count() == 2


def test_window_tables(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    append_windows(target, GRID_5M)(grid(spark, (at(0), "a", 1)), 0)
    append_windows(target, GRID_5M)(grid(spark), 1)
    for _ in range(2):
        append_windows(target, GRID_5M)(grid(spark, (at(5), "a", 2)), 2)
    rows = target.windows(spark, GRID_5M)
    assert rows.count() == 2 and rows.schema["aircraft_count"].dataType.simpleString() == "int"
    insert_absent_windows(target, GRID_5M)(grid(spark, (at(5), "a", 9), (at(10), "a", 3)), 3)
    assert sorted(r.aircraft_count for r in target.windows(spark, GRID_5M).collect()) == [1, 2, 3]
    replace_windows(target, GRID_5M)(grid(spark, (at(10), "a", 4)), 4)
    assert target.windows(spark, GRID_5M, since=dt.date(2024, 1, 2)).count() == 0
    recent = target.windows(spark, GRID_5M, since=dt.date(2024, 1, 1))
    assert "PartitionFilters: [isnotnull(window_date" in recent._jdf.queryExecution().executedPlan().toString()
    live = target.windows(spark, GRID_5M, newest=True).collect()
    assert sorted(r.aircraft_count for r in live) == [1, 2, 4]
    assert sorted(p.name for p in (tmp_path / GRID_5M.name).glob("*/*/*")) == ["batch=0", "batch=2", "batch=3", "batch=4"]


def test_snapshots(spark, tmp_path):
    old = dt.datetime(2020, 1, 1)
    tables = {STATE.name: state(spark, ("a", 1.0, 1.0, old, old)), GRID_5M.name: grid(spark, (at(0), "a", 1)),
              QUALITY_5M.name: spark.createDataFrame([], QUALITY_5M.schema)}
    for _ in range(2):
        export_snapshots(tables, str(tmp_path))
    for name in tables:
        assert set(read_snapshot(spark, str(tmp_path), name).columns) == set(tables[name].columns)
    loaded = load_table(spark, STATE.name, "snapshot", str(tmp_path))
    assert live_positions(loaded).count() == 1  # a snapshot is read whatever its age
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_snapshot(spark, str(tmp_path), "nothing")
    with pytest.raises(ValueError):
        load_table(spark, STATE.name, "file")


def test_snapshots_written_elsewhere(spark, tmp_path):
    """Counts as 64-bit integers and times with a zone, as other writers have them."""
    import pandas as pd

    moment = pd.Timestamp("2024-01-01T00:00:00Z")
    pd.DataFrame({"window_start": [moment], "window_end": [moment], "grid_cell": ["1.0_2.0"], "aircraft_count": [3],
                  "avg_altitude_m": [1.0], "avg_velocity_mps": [None]}).astype({"avg_velocity_mps": float}).to_parquet(
        tmp_path / f"{GRID_5M.name}.parquet", index=False)
    row, = read_snapshot(spark, str(tmp_path), GRID_5M.name).collect()
    assert row.aircraft_count == 3 and row.window_start == dt.datetime(2024, 1, 1)


def test_ensure_table(spark, tmp_path):
    table = TABLES["grid_5m"]
    try:
        for _ in range(2):
            ensure_table(spark, table, str(tmp_path / "t"))
        assert set(spark.table(table.name).columns) == {*table.columns, "window_date", "run", "batch"}
        assert spark.table(table.name).count() == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def test_live_positions_and_kpis(spark):
    rows = state(spark, ("a", 1.0, 1.0, at(1), at(10)), ("b", 1.0, 1.0, at(1), at(5)), ("c", 1.0, 1.0, at(1), at(4, 59)),
                 ("d", None, 1.0, at(1), at(10)))
    live = live_positions(rows, F.lit(at(10)))
    assert sorted(r.icao24 for r in live.collect()) == ["a", "b"]
    assert tuple(live_kpis(live).first()) == (2, at(10), "00:10:00 UTC")
    assert tuple(live_kpis(live.where("false")).first()) == (0, None, None)


def test_top_k(spark):
    nan = float("nan")
    rows = [(f"v{n:02d}", 1.0, v, at(1), at(1)) for n, v in enumerate([5.0, nan, 7.0, None, 7.0, -1.0])]
    got = [(r.icao24, r.velocity_mps) for r in top_k(state(spark, *rows), "velocity_mps", 5).collect()]
    assert got == [("v02", 7.0), ("v04", 7.0), ("v00", 5.0), ("v05", -1.0), ("v01", None)]
    assert len(top_k(state(spark, *rows), "altitude_m").collect()) == 6
    plan = top_k(state(spark, *rows), "velocity_mps")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_density_and_quality(spark):
    cells = airspace_density(grid(spark, (at(0), "1.0_2.0", 1), (at(5), "1.5_-2.5", 2), (at(5), "x", 3)))
    assert sorted((r.grid_cell, r.aircraft_count, r.grid_lat, r.grid_lon) for r in cells.collect()) == [
        ("1.5_-2.5", 2, 1.5, -2.5), ("x", 3, None, None)]
    ddl = "window_start timestamp, window_end timestamp, total_messages int"
    quality = spark.createDataFrame([(at(5 * n % 60), at(5 * n % 60 + 4), n) for n in range(12)] + [
        (dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 1, 5), 99)], ddl)
    history = quality_history(quality).collect()
    assert len(history) == 12 and history[0].total_messages == 99 and history[-1].window_start == at(5)
    assert quality_headline(quality).first().total_messages == 99


def test_imperial(spark):
    df = spark.createDataFrame([(100.0, 1000.0, 1.0)], "velocity_mps double, altitude_m double, vertical_rate_mps double")
    assert tuple(to_imperial(df).first()) == (223.7, 3281.0, 196.8)
    assert [round(v, 5) for v in to_imperial(df, rounded=False).first()] == [223.694, 3280.84, 196.85]


def test_jdbc_statements():
    """The texts sent to a database; none is opened here."""
    upsert = merge_statement(STATE, "stage", replace=True, stamp=True)
    assert upsert.startswith("MERGE INTO realtime_flight_state t USING stage s ON (t.icao24 = s.icao24)")
    assert "s.last_event_time_utc >= t.last_event_time_utc" in upsert
    assert "updated_at_utc = CURRENT_TIMESTAMP" in upsert and "icao24 = s.icao24," not in upsert.split("SET")[1]
    assert "updated_at_utc = s.updated_at_utc" in merge_statement(STATE, "stage", replace=True)
    insert = merge_statement(GRID_5M, "stage", replace=False)
    assert "WHEN MATCHED" not in insert
    assert "t.window_start = s.window_start AND t.grid_cell = s.grid_cell" in insert
    split = scan_options("jdbc:x", "t", {"user": "u"}, "id", 0, 100, 4)
    assert split["numPartitions"] == "4" and split["partitionColumn"] == "id" and split["user"] == "u"
    assert "partitionColumn" not in scan_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        scan_options("jdbc:x", "t", column="id")


def test_jdbc_batches(monkeypatch, spark):
    """Which statements follow the staging write, and that nothing but the staging table is written."""
    sent, staged = [], []
    monkeypatch.setattr(JdbcTarget, "_execute", lambda self, session, statements: sent.extend(statements))
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.save", lambda writer, *a, **k: staged.append(True))
    JdbcTarget("jdbc:x").append(grid(spark, (at(0), "a", 1)), GRID_5M, 7)
    assert staged == [True]
    assert "USING realtime_airspace_grid_5m_stage_7 s" in sent[0] and sent[1] == "DROP TABLE realtime_airspace_grid_5m_stage_7"
    for run in ("one", "two"):  # queries whose batches have the same number
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)
        JdbcTarget("jdbc:x").append(grid(spark, (at(0), "a", 1)), GRID_5M, 7)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert len({text for text in sent if text.startswith("DROP")}) == 3


def test_stream_options(spark):
    kafka = stream_options("kafka", "t", "latest", "h:1", {"maxOffsetsPerTrigger": 5})
    assert kafka == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
                     "maxOffsetsPerTrigger": "5"}
    assert stream_options("text", "t", "latest", None, {}) == {}
    for bad in ((None, "earliest"), ("h:1", "middle")):
        with pytest.raises(ValueError):
            stream_options("kafka", "t", bad[1], bad[0], {})
    with pytest.raises(ValueError):
        read_event_stream(spark, "socket")
    with pytest.raises(ValueError):
        write_messages(spark.createDataFrame([(b"k", b"v")], "key binary, value binary"))


def test_conform_casts_counts(spark):
    assert conform(grid(spark, (at(0), "a", 1)), GRID_5M).schema["aircraft_count"].dataType.simpleString() == "int"


def test_tables_by_mode(spark, tmp_path, monkeypatch):
    """The database branch asks the target for the table of that name."""
    monkeypatch.setattr(JdbcTarget, "read", lambda self, session, name: (self.url, name))
    assert load_table(spark, "t", "postgres", database=JdbcTarget("jdbc:x")) == ("jdbc:x", "t")


def test_best_effort(spark, caplog):
    def broken(rows, batch_id):
        raise OSError("sink is down")

    best_effort(broken)(grid(spark), 3)
    assert "batch 3 was not written" in caplog.text


def test_work_dirs_are_separate(spark):
    assert work_dir(spark, "a") != work_dir(spark, "a")
