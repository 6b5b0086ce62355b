"""Column expressions shared by the text operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word of the white-space tokenisation is a run of anything but these.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
# A word of the alphanumeric tokenisation is a run of digits, a-z and everything outside ASCII.
MARK_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def blank_words(text: Column) -> Column:
    """The words between blanks; an empty array for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS + "+"), "")


def alnum_words(text: Column) -> Column:
    """The words of digits, letters and non-ASCII characters, A-Z lower-cased; an empty array for a null text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), MARK_CLASS + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def fold(key: Column, parts: int) -> Column:
    """The fold of a row: crc32 of its key written as text, modulo ``parts``; a null key is in fold 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(1))


def only(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns and no others, so that extra columns of a caller's table cannot clash with working ones."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def unused(name: str, *tables: DataFrame) -> str:
    """``name``, with as many underscores behind it as no column of the tables has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name
