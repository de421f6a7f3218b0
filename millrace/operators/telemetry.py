"""Progress lines and heartbeat documents as data."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.variant import as_map, at, kind, parse_object, present, raw_string

#: A word with an equals sign that is not the first on its line: key and value.
WORD = "(?<= )([^ =]*)=([^ ]*)"
PROGRESS_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
#: The keys that each level of a heartbeat may have.
TOP = ["runId", "runAttempt", "timestamp", "state", "phase", "counters", "resources", "exitCode"]
COUNTERS = [
    "phase", "elapsed_ms", "throughput_records_per_sec", "compressed_bytes", "input_bytes", "input_lines", "raw_parsed", "accepted", "invalid_lines", "skipped",
    "skipped_invalid_barcode", "skipped_missing_name", "skipped_missing_nutrition", "skipped_validation", "sort_runs", "deduped_docs", "indexed_docs", "phase_bytes", "phase_files",
]
RESOURCES = ["elapsedSeconds", "diskFreeKb", "memoryTotalKb", "memoryUsedKb", "memoryAvailableKb", "cpuCount", "cpuPercent", "loadAverage", "processes"]
PROCESS = ["pid", "ppid", "state", "elapsed", "cpuPercent", "memoryPercent", "rssKb", "command"]
NAME, TIMESTAMP, STATE = r"^[A-Za-z0-9_.-]+\z", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z", r"^(running|success|failure|cancelled)\z"


def progress_fields(line: Column, prefix: str) -> Column:
    """key=value words after the prefix as a map of texts; the last of equal keys counts. Other lines give an empty map."""
    keys, values = (F.reverse(F.regexp_extract_all(line, F.lit(WORD), F.lit(g))) for g in (1, 2))
    names = F.array_distinct(keys)  # reversed, so that the first of equal keys is the last written
    found = F.map_from_arrays(names, F.transform(names, lambda k: F.get(values, F.array_position(keys, k).cast("int") - 1)))
    return F.when(line.startswith(prefix), found).otherwise(F.create_map().cast("map<string,string>"))


def progress_number(fields: Column, key: str) -> Column:
    """A field as a double, if it is written as a plain number."""
    text = F.try_element_at(fields, F.lit(key))
    return F.when(text.rlike(PROGRESS_NUMBER), text.cast("double"))


def unknown_keys(m: Column, allowed: list[str]) -> Column:
    return F.array_except(F.map_keys(m), F.array(*map(F.lit, allowed)))


def _closed(m: Column, allowed: list[str]) -> Column:
    return m.isNotNull() & (F.size(unknown_keys(m, allowed)) == 0)


def _number(v: Column) -> Column:
    return F.coalesce(kind(v).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def _number_or_null(v: Column) -> Column:
    return _number(v) | F.coalesce(kind(v) == "VOID", F.lit(False))


def _integer(v: Column) -> Column:
    x = F.try_variant_get(v, "$", "double")
    return _number(v) & F.coalesce(F.floor(x) == x, F.lit(False))


def _text(m: Column, key: str, pattern: str | None = None, most: int | None = None) -> Column:
    t = raw_string(at(m, key))
    ok = t.isNotNull()
    if pattern:
        ok = ok & t.rlike(pattern)
    if most is not None:
        ok = ok & (F.length(t) <= most)
    return F.coalesce(ok, F.lit(False))


def _process(v: Column) -> Column:
    m = as_map(v)
    whole = [_integer(at(m, k)) | ~F.coalesce(kind(at(m, k)) != "VOID", F.lit(False)) for k in ("pid", "ppid", "rssKb")]
    numbers = [_number_or_null(at(m, k)) | ~present(m, k) for k in ("cpuPercent", "memoryPercent")]
    texts = [_text(m, "state"), _text(m, "elapsed"), _text(m, "command", most=128)]
    return reduce(lambda a, b: a & b, [_closed(m, PROCESS), *whole, *numbers, *texts])


def heartbeat_valid(line: Column) -> Column:
    """Whether a JSON text is a heartbeat: known keys alone at each level, each of its type and pattern."""
    share = lambda v: F.coalesce(raw_string(v).rlike(r"^[0-9]+/[0-9]+\z"), F.lit(False))
    counter = lambda e: (e["key"] == "phase") | ((e["key"] == "compressed_bytes") & share(e["value"])) | _number_or_null(e["value"])
    resource = lambda e: e["key"].isin("loadAverage", "processes") | _number_or_null(e["value"])

    def checks(m: Column, counters: Column, resources: Column) -> Column:
        processes = F.try_variant_get(at(resources, "processes"), "$", "array<variant>")
        parts = [
            _closed(m, TOP), _text(m, "runId", NAME), _text(m, "runAttempt", NAME), _text(m, "timestamp", TIMESTAMP), _text(m, "state", STATE), _text(m, "phase", most=64),
            _closed(counters, COUNTERS), F.forall(F.map_entries(counters), counter), _closed(resources, RESOURCES), F.forall(F.map_entries(resources), resource),
            ~present(resources, "processes") | (processes.isNotNull() & F.forall(processes, _process)), ~present(m, "exitCode") | _integer(at(m, "exitCode")),
        ]
        return F.coalesce(reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in parts]), F.lit(False))

    return _let(as_map(parse_object(line)), lambda m: _let(as_map(at(m, "counters")), lambda c: _let(as_map(at(m, "resources")), lambda r: checks(m, c, r))))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
