"""Counters of an ingest, and checksums."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.normalize import REASONS

COUNTERS = ["input_lines", "raw_parsed", "accepted_products", "invalid_lines", "skipped_products", *[f"skipped_{r}" for r in REASONS]]


def ingest_counters(rows: DataFrame) -> DataFrame:
    """One row of counters from rows with parsed and skip_reason (null where not parsed or accepted)."""
    skipped = F.col("parsed") & F.col("skip_reason").isNotNull()
    return rows.agg(
        F.count("*").alias("input_lines"),
        F.count_if("parsed").alias("raw_parsed"),
        F.count_if(F.col("parsed") & F.col("skip_reason").isNull()).alias("accepted_products"),
        F.count_if(~F.col("parsed")).alias("invalid_lines"),
        F.count_if(skipped).alias("skipped_products"),
        *[F.count_if(F.col("parsed") & (F.col("skip_reason") == r)).alias(f"skipped_{r}") for r in REASONS],
    )


def sort_runs(accepted: int, chunk_size: int) -> int:
    """Runs that an external sort of this chunk size would write."""
    return -(-accepted // chunk_size)


def stream_sha256(lines: DataFrame, column: str = "canonical") -> str:
    """SHA-256 over the column's texts, each with a line feed, in the order of lines, fetched a partition at a time."""
    digest = hashlib.sha256()
    for row in lines.select(column).toLocalIterator(prefetchPartitions=True):
        digest.update(row[0].encode() + b"\n")
    return digest.hexdigest()


def files_sha256(files: list[dict]) -> str:
    """Checksum of checksums: path, size and SHA-256 of each file in list order."""
    digest = hashlib.sha256()
    for f in files:
        digest.update(f"{f['path']}\0{f['bytes']}\0{f['sha256']}\n".encode())
    return digest.hexdigest()
