"""DuckDB SQL for every registered query, over the same tables."""

from __future__ import annotations

from contrail.functions import bbox_id
from contrail.plans.projections import DUCK
from contrail.plans.queries import BOX

_STATE_COLUMNS = (
    "icao24, callsign, lat, lon, altitude_m, velocity_mps, heading_deg, vertical_rate_mps, on_ground, "
    "event_ts as last_event_time_utc, ingestion_ts as updated_at_utc, source"
)
_WINDOW = "time_bucket(interval '{size}', {time})"

_GRID = f"""
select {_WINDOW.format(size='5 minutes', time='event_ts')} as window_start,
  {_WINDOW.format(size='5 minutes', time='event_ts')} + interval '5 minutes' as window_end,
  concat(cast(round(lat, 1) + 0.0e0 as varchar), '_', cast(round(lon, 1) + 0.0e0 as varchar)) as grid_cell,
  count(icao24) as aircraft_count, round(avg(altitude_m), 6) as avg_altitude_m,
  round(avg(velocity_mps), 6) as avg_velocity_mps
from telemetry where lat is not null and lon is not null group by all
"""
_QUALITY = f"""
select {_WINDOW.format(size='5 minutes', time='event_ts')} as window_start,
  {_WINDOW.format(size='5 minutes', time='event_ts')} + interval '5 minutes' as window_end,
  count(icao24) as total_messages,
  count(*) filter (where lat is not null and lon is not null) as messages_with_position,
  count(*) filter (where lat is null or lon is null) as messages_missing_position,
  round(avg(floor(epoch(ingestion_ts)) - floor(epoch(event_ts))), 6) as avg_event_lag_seconds
from telemetry group by all
"""
_STATE = f"""
select {_STATE_COLUMNS} from telemetry where icao24 <> ''
qualify row_number() over (partition by icao24 order by event_ts desc, ingestion_ts desc, event_id desc) = 1
"""


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def _epoch_iso(seconds: str) -> str:
    return _iso(f"make_timestamp(cast(floor({seconds}) as bigint) * 1000000)")


def _field(position: int, how: str = "text") -> str:
    path = f"'$[{position}]'"
    return f"json_type(state, {path})" if how == "type" else f"json_extract_string(state, {path})"


_FIELDS = {
    "icao24": 0, "callsign": 1, "country": 2, "time_posn": 3, "contact": 4, "lon": 5, "lat": 6, "baro": 7,
    "ground": 8, "velocity": 9, "heading": 10, "rate": 11, "geo": 13, "squawk": 14, "spi": 15, "src": 16,
}
_CUT = "select event_id, poll_id, ingestion_ts, json_array_length(state) as n, " + ", ".join(
    f"{_field(position, 'type')} as {name}_t, {_field(position)} as {name}" for name, position in _FIELDS.items()
) + " from {source}"


def _strict(name: str) -> str:
    return f"{name}_t in ('VARCHAR', 'ARRAY', 'OBJECT')"


def _lenient(name: str) -> str:
    return f"({name}_t <> 'NULL' and {name}_t <> 'BOOLEAN' and try_cast({name} as double) is null)"


_MESSAGE = " ".join([
    "case when n > 0 and (icao24_t = 'NULL' or icao24 = '') then 'icao24 is null or empty'",
    "when coalesce(n, 0) < 17 then 'vector is shorter than 17 elements'",
    *[f"when {_strict(c)} then '{c} has the wrong type'" for c in ("lat", "lon", "time_posn")],
    f"when {_strict('contact')} then 'last_contact has the wrong type'",
    "when callsign_t not in ('VARCHAR', 'NULL') then 'callsign has the wrong type'",
    "when src_t = 'VARCHAR' and try_cast(src as int) is null then 'position_source has the wrong type'",
    *[
        f"when {_lenient(c)} then '{name} has the wrong type'" for c, name in (
            ("baro", "baro_altitude_m"), ("geo", "geo_altitude_m"), ("velocity", "velocity_mps"),
            ("heading", "heading_deg"), ("rate", "vertical_rate_mps"))
    ],
    "end",
])
_JUDGED = (
    f"select *, {_MESSAGE} as message, cast(coalesce(geo, baro) as double) as height, ground = 'true' as grounded "
    "from cut"
)
# Readable only where the message is null.
_VALID = f"""
select event_id, poll_id, ingestion_ts, coalesce(grounded and height > 100, false) as altitude_suppressed,
  1 as schema_version,
  coalesce({_epoch_iso('cast(time_posn as double)')}, {_epoch_iso('cast(contact as double)')}, {_iso('ingestion_ts')})
    as event_time_utc,
  'opensky' as source, lower(icao24) as icao24, {_iso('ingestion_ts')} as ingestion_time_utc,
  nullif(trim(callsign), '') as callsign,
  case when cast(lat as double) between -90 and 90 then cast(lat as double) end as lat,
  case when cast(lon as double) between -180 and 180 then cast(lon as double) end as lon,
  case when height >= 0 and not coalesce(grounded and height > 100, false) then height end as altitude_m,
  cast(velocity as double) as velocity_mps, cast(heading as double) as heading_deg,
  cast(rate as double) as vertical_rate_mps, grounded as on_ground,
  {_epoch_iso('cast(contact as double)')} as last_contact_utc, country as origin_country,
  cast(geo as double) as geo_altitude_m, squawk, spi = 'true' as spi, cast(src as int) as position_source,
  '{bbox_id(*BOX)}' as bbox_id
from judged where message is null
"""


def _with(*names: str, recursive: bool = False, **more: str) -> str:
    bodies = {**{n: _KNOWN[n] for n in names}, **more}
    return ("with recursive " if recursive else "with ") + ",\n".join(f"{n} as ({b})" for n, b in bodies.items()) + "\n"


_KNOWN = {
    **DUCK, "grid": _GRID, "quality": _QUALITY, "state": _STATE, "judged": _JUDGED, "valid": _VALID,
    "cut": _CUT.format(source="vectors"),
}
_REPLAY_KEYS = ("icao24", "last_contact", "lat", "lon", "altitude_m", "velocity_mps")
_EVENT_KEYS = ("icao24", "last_contact_utc", "lat", "lon", "altitude_m", "velocity_mps")


def _accepted(source: str, keys: tuple[str, ...]) -> str:
    """Step from each accepted clock to the first one at least 120 later."""
    names = ", ".join(keys)
    same = " and ".join(f"r.{k} is not distinct from s.{k}" for k in keys)
    return (
        f"select {names}, min(clock_s) as clock_s from {source} group by all union all "
        f"select {', '.join('s.' + k for k in keys)}, min(r.clock_s) from accepted s join {source} r "
        f"on {same} and r.clock_s >= s.clock_s + 120 "
        f"group by {', '.join('s.' + k for k in keys)}, s.clock_s"
    )


_TRAFFIC = "select * from readings where sensor_type = 'traffic'"


def _traffic(size: str, measures: str) -> str:
    bucket = _WINDOW.format(size=size, time="reading_ts")
    return (
        _with("readings", traffic=_TRAFFIC)
        + f"select {bucket} as start_time, {bucket} + interval '{size}' as end_time, location, {measures} "
        "from traffic group by all"
    )


def _top(metric: str) -> str:
    return _with("telemetry", "state") + (
        f"select icao24, callsign, {metric} from state order by {metric} desc nulls last, icao24 limit 10"
    )


_DAMAGE = (
    "case when event_id % 50 = 1 then 'message is not a JSON object of the event schema' "
    "when event_id % 50 = 3 then 'icao24 is absent' "
    "when event_id % 50 = 2 then 'event_time_utc is not a UTC time' end"
)


def _if_good(expression: str, name: str) -> str:
    return f"case when message is null then {expression} end as {name}"


def _counters(source: str) -> str:
    return (_with(
        "vectors", source, recursive=True, cut=_CUT.format(source=source), judged=_JUDGED, valid=_VALID,
        clocked="select *, cast(floor(epoch(ingestion_ts)) as bigint) as clock_s from valid",
        accepted=_accepted("clocked", _EVENT_KEYS),
        sent="select poll_id, count(*) as sent from (select poll_id from clocked r join accepted s on "
        + " and ".join(f"r.{k} is not distinct from s.{k}" for k in (*_EVENT_KEYS, "clock_s"))
        + " qualify row_number() over (partition by "
        + ", ".join(f"r.{k}" for k in (*_EVENT_KEYS, "clock_s")) + " order by r.event_id) = 1) group by all",
        polls="select poll_id, count(*) as states, count(message) as dlq, "
        "count(*) filter (where message is null and grounded and height > 100) as altitudes_suppressed "
        "from judged group by all",
        counted="select p.*, coalesce(sent, 0) as sent, states - dlq - coalesce(sent, 0) as dedupe_skipped "
        "from polls p left join sent using (poll_id)",
    ) + "select poll_id, states, dlq, altitudes_suppressed, sent, dedupe_skipped, "
    "cast(sum(dedupe_skipped) over (order by poll_id) as bigint) as total_skipped from counted")


ORACLES: dict[str, str] = {
    "parse_events": _with("telemetry", marked=f"select *, {_DAMAGE} as message from telemetry") + "select "
    + ", ".join(_if_good(c, c) for c in (
        "icao24", "callsign", "source", "lat", "lon", "altitude_m", "velocity_mps", "heading_deg",
        "vertical_rate_mps", "on_ground"))
    + ", " + ", ".join(_if_good(f"date_trunc('second', {c})", c) for c in ("event_ts", "ingestion_ts"))
    + ", case when message is not null then 'schema_validation' end as error_type, message from marked",
    "parse_readings": _with("readings")
    + "select date_trunc('second', reading_ts) as \"timestamp\", location, sensor_type, value from readings "
    "where sensor_type = 'traffic'",
    "event_messages": _with("telemetry")
    + "select icao24 as message_key, 20 as fields, 1 as schema_version, source, icao24, callsign, "
    f"{_iso('event_ts')} as event_time_utc, {_iso('ingestion_ts')} as ingestion_time_utc, lat, altitude_m, "
    "on_ground, cast(null as varchar) as squawk from telemetry",
    "explode_state_vectors": _with("vectors")
    + "select poll_id, row_number() over (partition by poll_id order by event_id) - 1 as state_pos, "
    f"{_field(0)} as icao24, cast({_field(5)} as double) as lon, cast({_field(6)} as double) as lat, "
    f"cast({_field(8)} as boolean) as on_ground, {_field(14)} as squawk, "
    f"{_field(6, 'type')} = 'VARCHAR' as lat_is_text from "
    "vectors",
    "normalize_vectors": _with("vectors", "cut", "judged", "valid")
    + "select * exclude (poll_id, ingestion_ts) from valid",
    "route_dlq": _with("vectors", "cut", "judged")
    + "select case when message <> 'icao24 is null or empty' then nullif(icao24, '') end as message_key, "
    f"{_iso('ingestion_ts')} as error_time_utc, "
    "case when message = 'icao24 is null or empty' then 'missing_required_field' else 'schema_validation' end "
    "as error_type, case when message <> 'icao24 is null or empty' then icao24 end as raw_icao24, "
    "cast(n as int) as state_len, message from judged where message is not null",
    "dlq_counts": _with("vectors", "cut", "judged")
    + "select case when message = 'icao24 is null or empty' then 'missing_required_field' "
    "else 'schema_validation' end as error_type, count(*) as dead_letters "
    "from judged where message is not null group by all",
    "ingest_counters": _counters("repolled"),
    "dedupe_ttl": _with("telemetry", "replays", recursive=True, accepted=_accepted("replays", _REPLAY_KEYS))
    + "select * from accepted",
    "within_bbox": _with("telemetry")
    + f"select event_id, icao24, event_ts, lat, lon from telemetry where lat between {BOX[0]} and {BOX[1]} "
    f"and lon between {BOX[2]} and {BOX[3]}",
    "airspace_grid_5m": _with("telemetry", "grid") + "select * from grid",
    "airspace_grid_5m_stream": _with("telemetry", "grid")
    + "select * from grid where window_end <= (select max(event_ts) from telemetry "
    "where lat is not null and lon is not null) - interval '10 minutes'",
    "telemetry_quality_5m": _with("telemetry", "quality") + "select * from quality",
    "traffic_hourly": _traffic("1 hour", "round(avg(value), 6) as avg_traffic_count"),
    "traffic_5m": _traffic(
        "5 minutes",
        "round(avg(value), 6) as avg_traffic_count, max(value) as max_traffic_count, min(value) as min_traffic_count, "
        "count(value) as data_points"),
    "latest_state": _with("telemetry", "state") + "select * from state",
    "upsert_state": _with("telemetry", "state") + "select * from state",
    "insert_if_absent": _with("telemetry", "grid")
    + "select window_start, window_end, grid_cell, case when hour(window_start) < 16 then aircraft_count "
    "else aircraft_count + 100 end as aircraft_count, avg_altitude_m, avg_velocity_mps from grid",
    "live_positions": _with("telemetry", "state")
    + "select icao24, callsign, lat, lon, altitude_m, velocity_mps, heading_deg, updated_at_utc from state "
    "where lat is not null and lon is not null "
    "and updated_at_utc >= (select max(updated_at_utc) from state) - interval '1 day'",
    "live_kpis": _with("telemetry", "state")
    + "select count(*) as tracked_aircraft, max(updated_at_utc) as last_update_utc, "
    "strftime(max(updated_at_utc), '%H:%M:%S UTC') as last_update_clock from state "
    "where lat is not null and lon is not null",
    "top_speed": _top("velocity_mps"),
    "top_altitude": _top("altitude_m"),
    "top_climb": _top("vertical_rate_mps"),
    "to_imperial": _with("telemetry", "state")
    + "select icao24, round(velocity_mps * 2.23694e0, 6) as velocity_mps, round(altitude_m * 3.28084e0, 6) "
    "as altitude_m, round(vertical_rate_mps * 196.85e0, 6) as vertical_rate_mps from state",
    "airspace_density": _with("telemetry", "grid")
    + "select grid_cell, aircraft_count, avg_altitude_m, cast(split_part(grid_cell, '_', 1) as double) as grid_lat, "
    "cast(split_part(grid_cell, '_', 2) as double) as grid_lon from grid "
    "where window_end = (select max(window_end) from grid)",
    "quality_history": _with("telemetry", "quality")
    + "select * from quality order by window_end desc nulls last, window_start limit 12",
    "quality_headline": _with("telemetry", "quality")
    + "select * from quality order by window_end desc nulls last, window_start limit 1",
    "export_snapshots": _with("telemetry", "state", "grid", "quality")
    + "select 'realtime_flight_state' as table_name, last_event_time_utc as at, icao24 as row_key, "
    "altitude_m as amount from state "
    "union all select 'realtime_airspace_grid_5m', window_start, grid_cell, cast(aircraft_count as double) from grid "
    "union all select 'telemetry_quality_5m', window_start, '', cast(total_messages as double) from quality",
}
ORACLES["dedupe_stream"] = ORACLES["dedupe_ttl"]
ORACLES["insert_absent_stream"] = ORACLES["airspace_grid_5m_stream"]
ORACLES["grid_live_view"] = ORACLES["airspace_grid_5m"]
ORACLES["pipeline_tables"] = (
    _with("telemetry", "grid", "quality")
    + "select 'realtime_flight_state' as table_name, date_trunc('second', max(event_ts)) as at, icao24 as row_key, "
    "1.0e0 as amount from telemetry group by icao24 "
    "union all select 'realtime_airspace_grid_5m', window_start, grid_cell, cast(aircraft_count as double) from grid "
    "where window_end <= (select max(event_ts) from telemetry where lat is not null and lon is not null) "
    "- interval '10 minutes' "
    "union all select 'telemetry_quality_5m', window_start, '', cast(total_messages as double) from quality "
    "where window_end <= (select max(event_ts) from telemetry) - interval '10 minutes'"
)
for _name, _delay in (("traffic_hourly", "1 hour"), ("traffic_5m", "10 minutes")):
    _head, _, _query = ORACLES[_name].rpartition("select ")
    ORACLES[f"{_name}_stream"] = (
        f"{_head}select * from (select {_query}) where end_time <= (select max(reading_ts) from traffic) "
        f"- interval '{_delay}'"
    )

# streams

ORACLES["upsert_state_buckets"] = ORACLES["upsert_state"]
ORACLES["dedupe_stateful"] = ORACLES["dedupe_ttl"]
ORACLES["pipeline_tables_shared"] = ORACLES["catalog_tables"] = ORACLES["pipeline_tables"]
ORACLES["ingest_counters_stream"] = _counters("polled")
ORACLES["ingest_to_messages"] = _with(
    "vectors", "polled", recursive=True, cut=_CUT.format(source="polled"), judged=_JUDGED, valid=_VALID,
    clocked="select *, cast(floor(epoch(ingestion_ts)) as bigint) as clock_s from valid",
    accepted=_accepted("clocked", _EVENT_KEYS),
    messages="select 'events' as topic, icao24 as message_key, "
    f"{_iso('make_timestamp(clock_s * 1000000)')} as at, icao24 as field_0, last_contact_utc as field_1, "
    f"'{bbox_id(*BOX)}' as field_2 from accepted "
    "union all select 'dead', case when message <> 'icao24 is null or empty' then nullif(icao24, '') end, "
    f"{_iso('ingestion_ts')}, case when message <> 'icao24 is null or empty' then icao24 end, "
    "case when message = 'icao24 is null or empty' then 'missing_required_field' else 'schema_validation' end, "
    "message from judged where message is not null",
) + 'select topic, message_key, "at", field_0, field_1, field_2, count(*) as messages from messages group by all'
_TURNS = (
    "select *, case when event_id % 40 = 7 then 2 else own end as turn from (select *, "
    "(s - min(s) over ()) // ((max(s) over () - min(s) over ()) // 3 + 1) as own "
    "from (select *, cast(floor(epoch(event_ts)) as bigint) as s from telemetry))"
)
_LATE = (
    "select t.*, s - s % 300 + 300 <= w.newest - 600 as late from turns t left join "
    "(select n.turn, max(p.s) as newest from (select distinct turn from turns) n join turns p on p.turn < n.turn "
    "group by n.turn) w using (turn)"
)
ORACLES["late_rows"] = _with("telemetry", turns=_TURNS, marked=_LATE) + (
    "select cast(turn as integer) as batch, icao24, callsign, make_timestamp(s * 1000000) as event_ts, lat, lon, "
    "altitude_m from marked where late"
)
ORACLES["stream_progress"] = _with("telemetry") + (
    "select name, runs, failed_runs, false as dropped_rows, case when name = 'parsed_layer' then cast(3 as bigint) end as batches, "
    "case when name = 'parsed_layer' then (select count(*) from telemetry) end as rows, failed_runs > 0 as reported "
    "from (values ('parsed_layer', cast(3 as bigint), cast(0 as bigint)), ('flight_state_upsert', 3, 0), "
    "('airspace_grid_5m', 3, 0), ('quality_metrics_5m', 3, 0), ('waiting_query', 1, 0), ('broken_query', 1, 1)) "
    "v(name, runs, failed_runs)"
)
_SECONDS = (
    "select *, cast(floor(epoch(ingestion_ts)) as bigint) as s, lat is not null and lon is not null as here "
    "from telemetry where icao24 <> '' qualify row_number() over "
    "(partition by icao24, cast(floor(epoch(ingestion_ts)) as bigint) order by event_ts desc, event_id desc) = 1"
)
_NEIGHBOURS = (
    "select *, lag(s) over w as before, lag(here) over w as was, lead(s) over w as next, lead(here) over w as stays, "
    "max(s) over () as last from seconds window w as (partition by icao24 order by s)"
)
_AT = "make_timestamp(({}) * 1000000) as at"
ORACLES["live_positions_stream"] = _with("telemetry", seconds=_SECONDS, neighbours=_NEIGHBOURS) + (
    f"select icao24, 'appeared' as change, {_AT.format('s')}, lat, lon, altitude_m from neighbours "
    "where here and (before is null or not was or s > before + 300) "
    f"union all select icao24, 'removed', {_AT.format('case when next <= s + 300 then next else s + 300 end')}, "
    "null, null, null from neighbours "
    "where here and case when next <= s + 300 then not stays when next is not null then true else last > s + 300 end "
    f"union all select icao24, 'live', {_AT.format('s')}, lat, lon, altitude_m from neighbours "
    "where here and next is null and last <= s + 300"
)

# views

_KNOWN["busy_state"] = _STATE.replace("from telemetry", "from busy")
_KNOWN["busy_grid"] = _GRID.replace("from telemetry", "from busy")
ORACLES["to_imperial_display"] = _with("telemetry", "state") + (
    "select icao24, round_even(velocity_mps * 2.23694e0, 1) as velocity_mps, round_even(altitude_m * 3.28084e0, 0) "
    "as altitude_m, round_even(vertical_rate_mps * 196.85e0, 1) as vertical_rate_mps from state"
)
ORACLES["live_positions_5m"] = _with("busy", state=_KNOWN["busy_state"]) + (
    "select icao24, callsign, lat, lon, altitude_m, velocity_mps, heading_deg, updated_at_utc from state "
    "where lat is not null and lon is not null "
    "and updated_at_utc >= (select max(updated_at_utc) from state) - interval '5 minutes'"
)
ORACLES["airspace_density_busy"] = _with("busy", grid=_KNOWN["busy_grid"]) + (
    "select grid_cell, aircraft_count, avg_altitude_m, cast(split_part(grid_cell, '_', 1) as double) as grid_lat, "
    "cast(split_part(grid_cell, '_', 2) as double) as grid_lon from grid "
    "where window_end = (select max(window_end) from grid)"
)
ORACLES["airspace_density_stored"] = ORACLES["airspace_density_busy"]
ORACLES["within_bbox_stored"] = ORACLES["within_bbox"]
