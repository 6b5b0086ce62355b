"""Row types of the messages and tables, and the keys of the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the message and table contract.
SCHEMA_VERSION = 1
SOURCE_LIVE = "opensky"
EVENT_TOPIC = "flight-telemetry-v1"
DEAD_LETTER_TOPIC = "flight-telemetry-dlq"
READING_TOPIC = "traffic-topic"
TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ssX"
MISSING_FIELD = "missing_required_field"
BAD_SHAPE = "schema_validation"
DEDUPE_KEYS = ("icao24", "last_contact_utc", "lat", "lon", "altitude_m", "velocity_mps")
DEDUPE_TTL_SECONDS = 120
# Positions in the raw vector; 12 is not read.
VECTOR_POSITIONS = {
    "icao24": 0, "callsign": 1, "origin_country": 2, "time_posn": 3, "last_contact": 4, "lon": 5, "lat": 6,
    "baro_altitude_m": 7, "on_ground": 8, "velocity_mps": 9, "heading_deg": 10, "vertical_rate_mps": 11,
    "geo_altitude_m": 13, "squawk": 14, "spi": 15, "position_source": 16,
}

# The columns of messages and tables, in their order. Key and required columns are never null.
TELEMETRY = (
    T.StructType()
    .add("schema_version", "integer", nullable=False)
    .add("event_time_utc", "string", nullable=False)
    .add("source", "string", nullable=False)
    .add("icao24", "string", nullable=False)
    .add("ingestion_time_utc", "string", nullable=False)
    .add("callsign", "string")
    .add("lat", "double")
    .add("lon", "double")
    .add("altitude_m", "double")
    .add("velocity_mps", "double")
    .add("heading_deg", "double")
    .add("vertical_rate_mps", "double")
    .add("on_ground", "boolean")
    .add("last_contact_utc", "string")
    .add("origin_country", "string")
    .add("geo_altitude_m", "double")
    .add("squawk", "string")
    .add("spi", "boolean")
    .add("position_source", "integer")
    .add("bbox_id", "string")
)
REQUIRED_FIELDS = [f.name for f in TELEMETRY if not f.nullable]

DEAD_LETTER = (
    T.StructType()
    .add("error_time_utc", "string")
    .add("error_type", "string")
    .add("raw_icao24", "string")
    .add("raw_payload", T.StructType().add("state_len", "integer"))
    .add("message", "string")
)

READING = (
    T.StructType()
    .add("timestamp", "timestamp")
    .add("location", "string")
    .add("sensor_type", "string")
    .add("value", "integer")
)


@dataclass(frozen=True)
class Table:
    """A target table: its columns, its key, and for window tables the column its partitions derive from."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    window: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


STATE = Table(
    "realtime_flight_state",
    (
        T.StructType()
        .add("icao24", "string", nullable=False)
        .add("callsign", "string")
        .add("lat", "double")
        .add("lon", "double")
        .add("altitude_m", "double")
        .add("velocity_mps", "double")
        .add("heading_deg", "double")
        .add("vertical_rate_mps", "double")
        .add("on_ground", "boolean")
        .add("last_event_time_utc", "timestamp")
        .add("updated_at_utc", "timestamp")
        .add("source", "string")
    ),
    ("icao24",),
)
GRID_5M = Table(
    "realtime_airspace_grid_5m",
    (
        T.StructType()
        .add("window_start", "timestamp", nullable=False)
        .add("window_end", "timestamp")
        .add("grid_cell", "string", nullable=False)
        .add("aircraft_count", "integer")
        .add("avg_altitude_m", "double")
        .add("avg_velocity_mps", "double")
    ),
    ("window_start", "grid_cell"),
    window="window_start",
)
QUALITY_5M = Table(
    "telemetry_quality_5m",
    (
        T.StructType()
        .add("window_start", "timestamp", nullable=False)
        .add("window_end", "timestamp")
        .add("total_messages", "integer")
        .add("messages_with_position", "integer")
        .add("messages_missing_position", "integer")
        .add("avg_event_lag_seconds", "double")
    ),
    ("window_start",),
    window="window_start",
)
TRAFFIC_1H = Table(
    "hourly_traffic_summary",
    (
        T.StructType()
        .add("start_time", "timestamp", nullable=False)
        .add("end_time", "timestamp")
        .add("location", "string", nullable=False)
        .add("avg_traffic_count", "double")
    ),
    ("start_time", "location"),
    window="start_time",
)
TRAFFIC_5M = Table(
    "realtime_traffic_summary",
    (
        T.StructType()
        .add("start_time", "timestamp", nullable=False)
        .add("end_time", "timestamp")
        .add("location", "string", nullable=False)
        .add("avg_traffic_count", "double")
        .add("max_traffic_count", "integer")
        .add("min_traffic_count", "integer")
        .add("data_points", "integer")
    ),
    ("start_time", "location"),
    window="start_time",
)
TABLES = {
    "state": STATE, "grid_5m": GRID_5M, "quality_5m": QUALITY_5M, "traffic_1h": TRAFFIC_1H, "traffic_5m": TRAFFIC_5M,
}
BY_NAME = {t.name: t for t in TABLES.values()}
