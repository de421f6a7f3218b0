"""Access to schemaless JSON objects as map<string, variant>.

A key that is present with a JSON null differs from a missing key: aliases resolve to the first key that is present,
whatever its value. A map keeps that difference; a struct schema or coalesce() would lose it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import ascii_lower, finite, parse_number, unicode_trim

MAP = "map<string,variant>"


def parse_object(line: Column) -> Column:
    """One JSON value per line as variant; null if it isn't exactly one value.

    Wrapped in brackets, so that trailing text, blank lines and several values are told apart from one value.
    """
    array = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), line, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(array) == 1, F.get(array, F.lit(0)))


def as_map(v: Column) -> Column:
    """Keys and values of an object; null for anything else."""
    return F.try_variant_get(v, "$", MAP)


def present(m: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(m, F.lit(key)), F.lit(False))


def at(m: Column, key: str) -> Column:
    return F.try_element_at(m, F.lit(key))


def first_present(m: Column, keys: list[str]) -> Column:
    """The value of the first key that is present."""
    out = F.when(present(m, keys[0]), at(m, keys[0]))
    for k in keys[1:]:
        out = out.when(present(m, k), at(m, k))
    return out


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def raw_string(v: Column) -> Column:
    """The value if it is a JSON string, else null."""
    return F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _digits(v: Column) -> Column:
    k = kind(v)
    whole = k.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | k.rlike(r"^DECIMAL\((19|[2-9][0-9]),0\)$")
    number = k.rlike("^(DECIMAL|DOUBLE|FLOAT)")
    return F.when(whole, F.try_variant_get(v, "$", "string")).when(number, F.try_variant_get(v, "$", "double").cast("string"))


def string_value(m: Column, keys: list[str]) -> Column:
    """First present: a string trimmed, a number as text, '' for anything else or nothing."""
    return string_of(first_present(m, keys))


def string_of(v: Column) -> Column:
    return F.coalesce(unicode_trim(raw_string(v)), _digits(v), F.lit(""))


def number_of(v: Column) -> Column:
    """A JSON number, or a string that holds one, as a finite double; booleans are no numbers."""
    k = kind(v)
    number = k.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(number, finite(F.try_variant_get(v, "$", "double"))).otherwise(parse_number(raw_string(v)))


def number_value(m: Column, keys: list[str]) -> Column:
    return number_of(first_present(m, keys))


def non_negative(m: Column, keys: list[str]) -> Column:
    """First present, null if it is negative: a later key of the group is not tried."""
    x = number_value(m, keys)
    return F.when(x >= 0, x)


def items_of(v: Column) -> Column:
    """Strings and numbers of an array, the parts of a string; null for anything else."""
    texts = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.coalesce(raw_string(x), _digits(x))), lambda s: s.isNotNull())
    return F.when(kind(v).startswith("ARRAY"), texts).when(kind(v) == "STRING", F.split(raw_string(v), "[,;]", -1))


def first_items(found: list[Column]) -> Column:
    """Lower-cased, trimmed, sorted distinct items of the first list that has any."""
    raw = F.coalesce(*[F.when(F.size(x) > 0, x) for x in found], F.array().cast("array<string>"))
    clean = F.transform(raw, lambda s: ascii_lower(unicode_trim(s)))
    return F.array_sort(F.array_distinct(F.filter(clean, lambda s: s != "")))


def list_value(m: Column, keys: list[str]) -> Column:
    """Lower-cased, trimmed, sorted distinct items of the first key that gives any.

    Arrays give their strings and numbers, strings are split at commas and semicolons. A key counts as giving items
    before they are trimmed, so an empty string ends the search.
    """
    return first_items([items_of(at(m, k)) for k in keys])


def without_prefix(countries: Column) -> Column:
    """Items without a two-letter language prefix, sorted and distinct."""
    bare = F.transform(countries, lambda c: F.regexp_replace(c, r"^[a-z]{2}:(?=[\s\S])", ""))
    return F.array_sort(F.array_distinct(F.filter(bare, lambda s: s != "")))
