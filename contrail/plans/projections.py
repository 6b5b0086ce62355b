"""The ``events`` table seen as telemetry, raw vectors, polls, sensor readings and replays.

One text per projection, with the few spots where Spark and DuckDB differ filled in per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

_SPARK = {
    "K": "cast(get_json_object(props,'$.k') as int)",
    "EPOCH": "unix_timestamp(cast(ts as timestamp))",
    "ADD": "make_dt_interval(0,0,0,{n})",
    "STR": "string",
    "TS": "cast(ts as timestamp)",
    "BUSY_TS": "timestamp_seconds(1704067200 + event_id * 7919 % 900)",
}
_DUCK = {
    "K": "cast(json_extract_string(props,'$.k') as int)",
    "EPOCH": "cast(floor(epoch(ts)) as bigint)",
    "ADD": "to_seconds({n})",
    "STR": "varchar",
    "TS": "ts",
    "BUSY_TS": "make_timestamp((1704067200 + event_id * 7919 % 900) * 1000000)",
}

_TELEMETRY = """
select event_id, lower(lpad(hex(user_id),6,'0')) as icao24, concat('TST', cast(user_id as {STR})) as callsign,
  {TS} as event_ts, {TS} + {ADD_LAG} as ingestion_ts,
  case when event_type = 'error' then cast(null as double) else 24.0e0 + user_id * 0.173e0 end as lat,
  case when event_type = 'error' then cast(null as double) else -125.0e0 + {K} * 0.61e0 end as lon,
  case when event_type = 'signup' then cast(null as double) else value * 25.0e0 end as altitude_m,
  value as velocity_mps, cast(event_id % 360 as double) as heading_deg,
  cast({K} - 50 as double) as vertical_rate_mps, event_type = 'click' as on_ground, 'events' as source
from events
"""

_VECTORS = """
select event_id, cast(floor(event_id / 50) as bigint) as poll_id, {TS} as ingestion_ts,
  case when event_id % 101 = 0 then '["ABC123","X","Y"]' else concat('[',
    case when event_id % 97 = 0 then 'null' when event_id % 89 = 0 then '""'
         else concat('"', upper(lpad(hex(user_id),6,'0')), '"') end, ',',
    case when event_id % 5 = 0 then 'null' when event_id % 5 = 1 then '"   "'
         else concat('"  T', cast(user_id as {STR}), ' "') end, ',',
    '"Nowhere",',
    case when event_type = 'view' then 'null' else concat(cast({EPOCH} as {STR}), '.5') end, ',',
    case when event_id % 107 = 0 then 'null' else cast({EPOCH} + 5 as {STR}) end, ',',
    concat('-', cast(100 + {K} as {STR}), '.5'), ',',
    case when event_id % 103 = 0 then '"41.8"' else concat(cast(24 + user_id % 70 as {STR}), '.25') end, ',',
    concat(cast(event_id % 12000 as {STR}), '.0'), ',',
    case when event_type = 'click' then 'true' else 'false' end, ',',
    concat(cast(event_id % 280 as {STR}), '.5'), ',', cast(event_id % 360 as {STR}), ',',
    cast({K} - 50 as {STR}), ',null,',
    case when event_type = 'signup' then 'null' when event_type = 'error' then '-50'
         else concat(cast({K} * 10 as {STR}), '.0') end, ',',
    case when event_id % 11 = 0 then 'null' else concat('"', cast(1000 + user_id as {STR}), '"') end, ',false,0]')
  end as state
from events
"""

_READINGS = """
select {TS} as reading_ts, concat('loc_', cast(user_id % 10 as {STR})) as location,
  case when event_type = 'signup' then 'air' else 'traffic' end as sensor_type, cast(floor(value) as int) as value
from events
"""

# The same telemetry squeezed into a quarter of an hour and 200 grid cells, so that cells and windows hold many rows.
_BUSY = """
select event_id, lower(lpad(hex(user_id),6,'0')) as icao24, concat('TST', cast(user_id as {STR})) as callsign,
  {BUSY_TS} as event_ts, {BUSY_TS} + {ADD_LAG} as ingestion_ts,
  case when event_type = 'error' then cast(null as double) else 24.0e0 + (user_id % 20) * 0.173e0 end as lat,
  case when event_type = 'error' then cast(null as double) else -125.0e0 + ({K} % 10) * 0.61e0 end as lon,
  case when event_type = 'signup' then cast(null as double) else value * 25.0e0 end as altitude_m,
  value as velocity_mps, cast(event_id % 360 as double) as heading_deg,
  cast({K} - 50 as double) as vertical_rate_mps, event_type = 'click' as on_ground, 'events' as source
from events
"""

# Every row again at these clock offsets, which tell "since the last accepted" from "since the last seen".
REPLAY_OFFSETS = (0, 60, 119, 120, 200, 241)
# Every vector again in later polls: one repeat within the TTL, one after it.
REPOLL_OFFSETS = (0, 60, 130)


def _fill(text: str, engine: dict[str, str]) -> str:
    return text.format(
        **{k: engine[k] for k in ("K", "EPOCH", "STR", "TS", "BUSY_TS")}, ADD_LAG=engine["ADD"].format(n="event_id % 7")
    ).strip()


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table read as a stream. Given as a pattern, the path may be one file or a folder of files."""
    return spark.readStream.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet*")


def spread(rows: DataFrame) -> DataFrame:
    """The same rows dealt over all cores. A table of few files is read by as few tasks, and whatever is made of its rows
    before the first shuffle, often many rows of one, would be left to those."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, *rows.columns)


def _project(source: DataFrame, text: str) -> DataFrame:
    head, _, tail = _fill(text, _SPARK).rpartition("from events")
    return source.sparkSession.sql(f"{head} from {{source}} {tail}", source=source)


def telemetry(source: DataFrame) -> DataFrame:
    return _project(source, _TELEMETRY)


def busy(source: DataFrame) -> DataFrame:
    return _project(source, _BUSY)


def vectors(source: DataFrame) -> DataFrame:
    return _project(source, _VECTORS)


def readings(source: DataFrame) -> DataFrame:
    return _project(source, _READINGS).withColumnRenamed("reading_ts", "timestamp")


def replays(source: DataFrame) -> DataFrame:
    rows = telemetry(source)
    offsets = F.explode(F.array(*[F.lit(o).cast("bigint") for o in REPLAY_OFFSETS])).alias("sec")
    return rows.select("event_id", "icao24", "event_ts", "lat", "lon", "altitude_m", "velocity_mps", offsets).select(
        "icao24", F.col("event_ts").alias("last_contact"), "lat", "lon", "altitude_m", "velocity_mps",
        (F.col("event_id") * 1000 + F.col("sec")).alias("clock_s"),
    )


def repolled(source: DataFrame) -> DataFrame:
    """Vectors, each in three polls."""
    copies = F.posexplode(F.array(*[F.lit(o) for o in REPOLL_OFFSETS])).alias("n", "sec")
    return vectors(source).select("*", copies).select(
        (F.col("event_id") * 3 + F.col("n")).alias("event_id"),
        (F.col("poll_id") * 3 + F.col("n")).alias("poll_id"),
        (F.col("ingestion_ts") + F.make_dt_interval(secs=F.col("sec"))).alias("ingestion_ts"),
        "state",
    )


# Poll responses every ten seconds: new vectors, those of the poll before (within the TTL), and those of the 13th before
# (after it).
POLL_OFFSETS = (0, 1, 13)
POLL_SECONDS = 10
FIRST_POLL = 1_704_067_200


def polled(source: DataFrame) -> DataFrame:
    """The vectors of polls, each in three of them, with the time of the poll."""
    copies = F.posexplode(F.array(*[F.lit(o) for o in POLL_OFFSETS])).alias("n", "later")
    return vectors(source).select("event_id", "poll_id", "state", copies).select(
        (F.col("event_id") * 3 + F.col("n")).alias("event_id"), (F.col("poll_id") + F.col("later")).alias("poll_id"),
        F.timestamp_seconds(FIRST_POLL + POLL_SECONDS * (F.col("poll_id") + F.col("later"))).alias("ingestion_ts"), "state")


# The same for DuckDB, as the bodies of common table expressions.
DUCK = {
    "telemetry": _fill(_TELEMETRY, _DUCK),
    "vectors": _fill(_VECTORS, _DUCK),
    "readings": _fill(_READINGS, _DUCK),
    "busy": _fill(_BUSY, _DUCK),
}
DUCK["replays"] = (
    "select t.icao24, t.event_ts as last_contact, t.lat, t.lon, t.altitude_m, t.velocity_mps, "
    "t.event_id * 1000 + o.sec as clock_s from telemetry t cross join "
    f"(select unnest([{','.join(map(str, REPLAY_OFFSETS))}]) as sec) o"
)
DUCK["repolled"] = (
    "select v.event_id * 3 + o.n as event_id, v.poll_id * 3 + o.n as poll_id, "
    "v.ingestion_ts + to_seconds(o.sec) as ingestion_ts, v.state from vectors v cross join "
    "(values " + ", ".join(f"({n}, {sec})" for n, sec in enumerate(REPOLL_OFFSETS)) + ") o(n, sec)"
)
DUCK["polled"] = (
    "select v.event_id * 3 + o.n as event_id, v.poll_id + o.later as poll_id, "
    f"make_timestamp(({FIRST_POLL} + {POLL_SECONDS} * (v.poll_id + o.later)) * 1000000) as ingestion_ts, v.state "
    "from vectors v cross join (values " + ", ".join(f"({n}, {later})" for n, later in enumerate(POLL_OFFSETS))
    + ") o(n, later)"
)
