"""Gzip JSON lines as rows: bounded lines, malformed-line accounting, nothing held whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.predicates import oversized
from millrace.functions.variant import as_map, parse_object


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """line_no, line of a (gzip) text file. line_no follows the order of one file; a gzip file is read by one task.

    Lines are dealt out again right after the scan, so that parsing is not bound to the one task that unzips.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    return lines.repartition(partitions or spark.sparkContext.defaultParallelism)


def parse_lines(lines: DataFrame, strict_utf8: bool = True) -> DataFrame:
    """line_no, bytes, parsed and object (map<string, variant>; null unless the line is a JSON object).

    Blank, malformed and oversized lines are not parsed. Invalid UTF-8 fails the run if strict. Duplicate keys keep
    the last value, which needs the session setting that ``prepare`` makes.
    """
    line = F.col("line")
    if strict_utf8:
        line = F.when(F.is_valid_utf8(line), line).otherwise(F.raise_error(F.lit("stream did not contain valid UTF-8")))
    checked = lines.select("line_no", line.alias("line"))
    value = F.when(~oversized(F.col("line")), parse_object(F.regexp_replace("line", r"(?U)\s+$", "")))
    parsed = checked.select("line_no", (F.octet_length("line") + 1).cast("long").alias("bytes"), value.alias("value"))
    return parsed.select("line_no", "bytes", F.col("value").isNotNull().alias("parsed"), as_map(F.col("value")).alias("object"))


def prepare(spark: SparkSession) -> None:
    """Settings the parser relies on."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
