"""Text and number expressions with the exact semantics of the release format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Decimal numbers as text; casts accept more (suffixes, hexadecimal), so this is tested first.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
LIST_SEPARATOR = "\x1f"


def unicode_trim(c: Column) -> Column:
    """Without Unicode white space at both ends; trim() knows the space character alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(c, UPPER, LOWER)


def parse_number(c: Column) -> Column:
    """A trimmed text as a finite double, else null."""
    t = unicode_trim(c)
    return finite(F.when(t.rlike(NUMBER), t.try_cast("double")))


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def to_epoch(c: Column) -> Column:
    """A double as bigint, truncated and clamped to its range."""
    top, bottom = 9223372036854775807, -9223372036854775808
    return F.when(c >= float(top), F.lit(top)).when(c <= float(bottom), F.lit(bottom)).otherwise(c.try_cast("bigint"))


def hex_lower(c: Column) -> Column:
    return F.lower(F.hex(c))


def throughput(records: Column, seconds: Column) -> Column:
    """Records a second, 0 where no time has passed."""
    return F.coalesce(F.when(seconds > 0, records.cast("double") / seconds), F.lit(0.0))


def phase_name(c: Column) -> Column:
    """At most 32 characters of [A-Za-z0-9_-], others replaced; empty becomes unknown."""
    clean = F.regexp_replace(F.substring(c, 1, 32), "[^A-Za-z0-9_-]", "_")
    return F.when(F.coalesce(clean, F.lit("")) == "", F.lit("unknown")).otherwise(clean)
