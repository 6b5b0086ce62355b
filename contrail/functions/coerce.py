"""Reading typed fields out of a raw vector held as VARIANT.

Whether a field is acceptable depends on its JSON type, not only on its text: a latitude given as a string is an
error, a velocity given as a numeric string is not. A rule is therefore two steps over three columns: ``read`` takes
the value out of the element, ``wrong`` says from value and JSON type whether the field spoils the record. Where it
does, the value is not used. Keeping the steps in separate projections means that each element is decoded once.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The epochs that a four-digit year can show.
FIRST_EPOCH = -62135596800
END_EPOCH = 253402300800
# Fixed value: JSON numbers and containers that count as false.
FALSY_JSON = r"^(\[\]|\{\}|-?0(\.0*)?([eE].*)?)$"
# Text that only Java reads as a number.
JAVA_NUMBER = r"(?i)^\s*[+-]?(0x.*|.*[0-9.][df]\s*)$"


def json_type(raw: Column) -> Column:
    """``STRING``, ``BOOLEAN``, ``BIGINT``, ``DOUBLE``, ``DECIMAL(..)``, ``ARRAY<..>``, ``OBJECT<..>``, ``VOID`` for
    JSON null; SQL null where there is no such element."""
    return F.schema_of_variant(raw)


def read(raw: Column, type_name: str) -> Column:
    """The element as a type; null where it cannot be one."""
    return F.try_variant_get(raw, "$", type_name)


def read_number(raw: Column, kind: Column) -> Column:
    """A number, also from text. The engine takes Java's type suffixes and hexadecimal text for numbers; these are
    none here. Only text is looked at for that."""
    is_number = (kind != "STRING") | ~read(raw, "string").rlike(JAVA_NUMBER)
    return F.when(F.coalesce(is_number, F.lit(True)), read(raw, "double"))


def truth(raw: Column, kind: Column) -> Column:
    """Truthiness: any non-empty text is true, also ``"false"``; zero and empty containers are false."""
    return (
        F.when(kind == "BOOLEAN", read(raw, "boolean"))
        .when(kind == "STRING", read(raw, "string") != "")
        .when(kind != "VOID", ~F.to_json(raw).rlike(FALSY_JSON))
    )


def text(value: Column, kind: Column) -> Column:
    """Text of any value; booleans are capitalised."""
    return F.when(kind == "BOOLEAN", F.initcap(value)).otherwise(value)


def not_text(kind: Column) -> Column:
    return ~kind.isin("STRING", "VOID")


def not_a_number(value: Column, raw: Column) -> Column:
    """Anything present that cannot be read as a number. Booleans are 0 and 1, numeric text is a number."""
    return value.isNull() & ~F.is_variant_null(raw)


def not_a_json_number(value: Column, kind: Column) -> Column:
    """As ``not_a_number``, and text is never one."""
    return (kind == "STRING") | (value.isNull() & (kind != "VOID"))


def not_an_integer(value: Column, kind: Column) -> Column:
    """Text or containers that are no integer. Numbers always are: they are truncated, and beyond 32 bits null."""
    return value.isNull() & ~(kind.isin("VOID", "BIGINT", "DOUBLE", "BOOLEAN") | kind.startswith("DECIMAL"))


def not_an_epoch(value: Column, kind: Column) -> Column:
    """No JSON number, or outside the years 1 to 9999."""
    return not_a_json_number(value, kind) | ~F.coalesce(
        (value >= FIRST_EPOCH) & (value < END_EPOCH), F.lit(True)
    )
