"""Normalisation rules of single fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the rules.
LAT_BOUND = 90.0
LON_BOUND = 180.0
GROUND_ALTITUDE_LIMIT_M = 100.0
WHITESPACE = (
    " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def normalize_id(text: Column) -> Column:
    """Lower-cased identifier; empty becomes null, which makes the record a dead letter."""
    return F.lower(F.nullif(text, F.lit("")))


def normalize_callsign(text: Column) -> Column:
    """All leading and trailing whitespace removed (tabs too); nothing left becomes null."""
    return F.nullif(F.btrim(text, F.lit(WHITESPACE)), F.lit(""))


def in_range(value: Column, bound: float) -> Column:
    """The value where it lies within +-bound inclusive, else null. NaN is outside."""
    return F.when(value.between(-bound, bound), value)


def suspicious_altitude(geo: Column, baro: Column, on_ground: Column) -> Column:
    """True for a vehicle that says it stands on the ground but reports a height above the limit."""
    return F.coalesce(on_ground & (F.coalesce(geo, baro) > GROUND_ALTITUDE_LIMIT_M), F.lit(False))


def normalize_altitude(geo: Column, baro: Column, on_ground: Column) -> Column:
    """Geometric height, else barometric. Below zero, or suspicious on the ground: null, with no second choice."""
    height = F.coalesce(geo, baro)
    return F.when((height >= 0) & ~suspicious_altitude(geo, baro, on_ground), height)


def has_position(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & lon.isNotNull()


def event_key(text: Column) -> Column:
    """Message key bytes; null and empty keys are both null."""
    return F.nullif(text, F.lit("")).cast("binary")
