"""Messages to rows and rows to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from contrail.functions import event_key, parse_utc, to_iso
from contrail.schemas import BAD_SHAPE, DEAD_LETTER, READING, REQUIRED_FIELDS, TELEMETRY

# Message columns that say where a row came from; carried along when the source has them.
ORIGIN_COLUMNS = ("topic", "partition", "offset")
_CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, schema: T.StructType, derived: dict[str, Column] | None = None) -> DataFrame:
    """``value`` bytes to the fields of ``schema``, plus columns ``derived`` from the parsed struct ``d``.

    Unreadable text leaves the fields null and ``_corrupt_record`` filled. The fields are unpacked from a one-element
    array: a filter on them must not be moved below this point, where it would parse every message again.
    """
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema]).add(_CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    kept = [c for c in df.columns if c != "value"]
    parsed = df.select(*kept, F.from_json(F.col("value").cast("string"), nullable, options).alias("d"))
    unpacked = F.struct("d.*", *[column.alias(name) for name, column in (derived or {}).items()])
    return parsed.select(*kept, F.inline(F.array(unpacked)))


def parse_events(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Message bytes to telemetry rows with ``event_ts`` and ``ingestion_ts``, plus a ``dead`` struct.

    ``dead`` is null for a good row. It is a dead letter where the JSON is unreadable, a required field is absent,
    or one of the two times is not UTC text: such rows are neither dropped silently nor allowed to stop the query.
    """
    now = F.current_timestamp() if now is None else now
    origin = [c for c in ORIGIN_COLUMNS if c in raw.columns]
    parsed = parse_json(raw.select(*origin, "value"), TELEMETRY, {
        "event_ts": parse_utc(F.col("d.event_time_utc")),
        "ingestion_ts": parse_utc(F.col("d.ingestion_time_utc")),
        "_unreadable": F.col("d").isNull() | F.col(f"d.{_CORRUPT}").isNotNull(),
    })
    problem = F.when(F.col("_unreadable"), "message is not a JSON object of the event schema")
    for field in REQUIRED_FIELDS:
        problem = problem.when(F.col(field).isNull(), f"{field} is absent")
    problem = (
        problem.when(F.col("icao24") == "", "icao24 is absent")
        .when(F.col("event_ts").isNull(), "event_time_utc is not a UTC time")
        .when(F.col("ingestion_ts").isNull(), "ingestion_time_utc is not a UTC time")
    )
    no_length = F.lit(None).cast("int")
    dead = dead_letter(problem.isNotNull(), now, F.lit(BAD_SHAPE), F.col("icao24"), no_length, problem)
    return parsed.withColumn("dead", dead).drop("_unreadable", _CORRUPT)


def parse_readings(raw: DataFrame, sensor_type: str = "traffic") -> DataFrame:
    """Message bytes to sensor readings of one type; rows of another or of no type do not pass."""
    parsed = parse_json(raw.select("value"), READING)
    return parsed.where(F.col("sensor_type") == sensor_type).select(*READING.fieldNames())


def dead_letter(
    condition: Column, at: Column, error_type: Column, raw_id: Column, state_len: Column, message: Column,
) -> Column:
    """A dead-letter struct where ``condition`` holds, else null."""
    return F.when(
        condition,
        F.struct(
            to_iso(at).alias("error_time_utc"), error_type.alias("error_type"), raw_id.alias("raw_icao24"),
            F.struct(state_len.alias("state_len")).alias("raw_payload"), message.alias("message"),
        ),
    ).cast(DEAD_LETTER)


def _to_messages(df: DataFrame, fields: list[str], key: str) -> DataFrame:
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(event_key(F.col(key)).alias("key"), body.cast("binary").alias("value"))


def to_event_messages(df: DataFrame) -> DataFrame:
    """Telemetry rows to (key, value) bytes; every field is written, nulls included."""
    return _to_messages(df, TELEMETRY.fieldNames(), "icao24")


def to_dead_letter_messages(df: DataFrame) -> DataFrame:
    """Dead letters to (key, value) bytes, keyed by the raw id where there is one."""
    return _to_messages(df, DEAD_LETTER.fieldNames(), "raw_icao24")


def with_event_text(df: DataFrame, source: str, version: int) -> DataFrame:
    """Rows that carry timestamps get the text fields and constants of the message schema; missing fields are null."""
    derived = {
        "schema_version": F.lit(version).cast("int"),
        "source": F.lit(source),
        "event_time_utc": to_iso(F.col("event_ts")),
        "ingestion_time_utc": to_iso(F.col("ingestion_ts")),
    }
    for field in TELEMETRY:
        if field.name not in derived and field.name not in df.columns:
            derived[field.name] = F.lit(None).cast(field.dataType)
    return df.withColumns(derived)
