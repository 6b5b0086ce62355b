"""Polled vectors to events and dead letters, as one projection per row and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions import (
    coerce, epoch_to_iso, in_range, normalize_altitude, normalize_callsign, normalize_id, parse_utc,
    suspicious_altitude, to_iso,
)
from contrail.functions.rules import LAT_BOUND, LON_BOUND
from contrail.operators.messages import dead_letter
from contrail.schemas import BAD_SHAPE, MISSING_FIELD, SCHEMA_VERSION, SOURCE_LIVE, TELEMETRY, VECTOR_POSITIONS

NO_ID = "icao24 is null or empty"


def explode_state_vectors(polls: DataFrame, body: str = "value") -> DataFrame:
    """One row per vector of a poll response; a response without vectors gives no rows.

    The other columns are kept, ``state`` holds the vector as VARIANT so that element types survive, and
    ``state_pos`` its place in the response.
    """
    parsed = F.from_json(F.col(body).cast("string"), "states array<variant>")
    kept = [c for c in polls.columns if c != body]
    return polls.select(*kept, parsed.getField("states").alias("_states")).select(
        *kept, F.posexplode("_states").alias("state_pos", "state")
    )


def vector_from_text(text: Column) -> Column:
    """JSON text of one vector to VARIANT; unreadable text gives null, hence a dead letter."""
    return F.try_parse_json(text)


def vector_fields(state: Column) -> dict[str, Column]:
    """The read positions of a vector as variants; SQL null beyond its end, variant null for JSON null."""
    return {
        name: F.try_variant_get(state, f"$[{position}]", "variant") for name, position in VECTOR_POSITIONS.items()
    }


# Type each field is read as, and what makes it spoil the record; identifiers and flags never do.
_READ_AS = {
    "icao24": "string", "callsign": "string", "origin_country": "string", "squawk": "string",
    "time_posn": "double", "last_contact": "double", "lon": "double", "lat": "double",
    "baro_altitude_m": "double", "geo_altitude_m": "double", "velocity_mps": "double", "heading_deg": "double",
    "vertical_rate_mps": "double", "position_source": "int",
}
_WRONG = {
    "lat": coerce.not_a_json_number, "lon": coerce.not_a_json_number,
    "time_posn": coerce.not_an_epoch, "last_contact": coerce.not_an_epoch,
    "callsign": lambda value, kind: coerce.not_text(kind),
    "position_source": coerce.not_an_integer,
}
_LENIENT = ("baro_altitude_m", "geo_altitude_m", "velocity_mps", "heading_deg", "vertical_rate_mps")


def normalize_vectors(
    df: DataFrame, bbox_id: str | None = None, now: Column | None = None, state: str = "state",
    source: str = SOURCE_LIVE,
) -> DataFrame:
    """Add ``event`` (null for a dead letter), ``dead`` (null for an event) and ``altitude_suppressed``.

    ``now`` is the ingestion time, the batch's current time unless given. The raw vector is dropped.
    """
    now = F.current_timestamp() if now is None else now
    kept = [F.col(c) for c in df.columns if c != state]
    carried = [*kept, F.col("_now"), F.col("_vector")]

    # 1. cut the vector into its fields, look up their types, read their values: each step once per field
    raw = {name: F.col(f"_raw_{name}") for name in VECTOR_POSITIONS}
    v = {name: F.col(f"_{name}") for name in VECTOR_POSITIONS}
    kind = {name: F.col(f"_kind_{name}") for name in VECTOR_POSITIONS}
    cut = df.select(
        *kept, now.alias("_now"), F.col(state).alias("_vector"),
        *[field.alias(f"_raw_{name}") for name, field in vector_fields(F.col(state)).items()],
    )
    typed = cut.select(
        *carried, *raw.values(), *[coerce.json_type(raw[name]).alias(f"_kind_{name}") for name in kind]
    )
    valued = typed.select(
        *carried, *kind.values(), *[raw[name] for name in (*_LENIENT, "icao24")],
        *[(coerce.read_number(raw[name], kind[name]) if name in _LENIENT else coerce.read(raw[name], as_type)).alias(f"_{name}")
          for name, as_type in _READ_AS.items()],
        *[coerce.truth(raw[name], kind[name]).alias(f"_{name}") for name in ("on_ground", "spi")],
    )

    # 2. what is wrong with the record, if anything
    id_given = F.when(kind["icao24"] == "STRING", v["icao24"] != "").otherwise(
        coerce.truth(raw["icao24"], kind["icao24"])
    )
    no_id = kind["icao24"].isNotNull() & ~F.coalesce(id_given, F.lit(False))
    message = F.when(no_id, NO_ID).when(kind["position_source"].isNull(), "vector is shorter than 17 elements")
    for name in (*_WRONG, *_LENIENT):
        wrong = _WRONG[name](v[name], kind[name]) if name in _WRONG else coerce.not_a_number(v[name], raw[name])
        message = message.when(wrong, f"{name} has the wrong type")
    # Unpacked from a one-element array: a filter on the outcome must not be moved below this point, where it would
    # decode every vector a second time.
    judgement = F.struct(
        *[column for name, column in v.items() if name not in ("origin_country", "squawk")],
        *[coerce.text(v[name], kind[name]).alias(f"_{name}") for name in ("origin_country", "squawk")],
        message.alias("_message"),
    )
    judged = valued.select(*carried, F.inline(F.array(judgement)))
    error_type = F.when(F.col("_message") == NO_ID, MISSING_FIELD).otherwise(BAD_SHAPE)

    # 3. rules
    heights = (v["geo_altitude_m"], v["baro_altitude_m"], v["on_ground"])
    last_contact = epoch_to_iso(v["last_contact"])
    rules = {
        "schema_version": F.lit(SCHEMA_VERSION),
        "event_time_utc": F.coalesce(epoch_to_iso(v["time_posn"]), last_contact, to_iso(F.col("_now"))),
        "source": F.lit(source),
        "icao24": normalize_id(v["icao24"]),
        "ingestion_time_utc": to_iso(F.col("_now")),
        "callsign": normalize_callsign(v["callsign"]),
        "lat": in_range(v["lat"], LAT_BOUND),
        "lon": in_range(v["lon"], LON_BOUND),
        "altitude_m": normalize_altitude(*heights),
        "last_contact_utc": last_contact,
        "bbox_id": F.lit(bbox_id).cast("string"),
    }
    event = F.struct(*[rules.get(f.name, v.get(f.name)).cast(f.dataType).alias(f.name) for f in TELEMETRY])
    failed = F.col("_message").isNotNull()
    length = F.coalesce(F.size(F.try_variant_get(F.col("_vector"), "$", "array<variant>")), F.lit(0))
    raw_id = F.when(F.col("_message") != NO_ID, v["icao24"])
    return judged.select(
        *kept,
        F.when(~failed, event).alias("event"),
        dead_letter(failed, F.col("_now"), error_type, raw_id, length, F.col("_message")).alias("dead"),
        (~failed & suspicious_altitude(*heights)).alias("altitude_suppressed"),
    )


def route_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows with a ``dead`` struct into (valid, dead letters).

    Two narrow filters over one plan: ``persist()`` or write the input once where both halves are used.
    """
    is_event_struct = "event" in df.columns
    valid = df.where(F.col("dead").isNull()).drop("dead")
    if is_event_struct:
        rest = [c for c in valid.columns if c != "event"]
        valid = valid.select(*rest, "event.*")
    dead = df.where(F.col("dead").isNotNull())
    own = [c for c in dead.columns if c not in ("dead", "event", "altitude_suppressed")]
    if not is_event_struct:
        own = [c for c in own if c in ("topic", "partition", "offset")]
    return valid, dead.select(*own, "dead.*")


def with_event_times(df: DataFrame) -> DataFrame:
    """Events as they leave the normaliser get the two timestamps that a parsed message has."""
    return df.withColumns(
        {"event_ts": parse_utc(F.col("event_time_utc")), "ingestion_ts": parse_utc(F.col("ingestion_time_utc"))}
    )
