"""Optional incremental ingest: new JSON-lines files are merged into a best-row-per-key table, a version a batch."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.dedupe import best_per_key
from millrace.operators.normalize import normalize, with_rank
from millrace.sources.jsonl import parse_lines, prepare


def current_version(table: str) -> str | None:
    """The newest finished version below a table's folder."""
    done = [d for d in os.listdir(table) if os.path.exists(f"{table}/{d}/_SUCCESS")] if os.path.isdir(table) else []
    return f"{table}/{max(done)}" if done else None


def merge_batch(products: DataFrame, table: str, batch_id: int) -> None:
    """Write version batch_id: the best of the version before and the batch. Repeating a batch overwrites its version."""
    spark = products.sparkSession
    before = [d for d in [f"{table}/{batch_id - 1:010d}"] if os.path.exists(f"{d}/_SUCCESS")]
    rows = with_rank(products)
    if before:
        rows = spark.read.schema(rows.schema).parquet(before[0]).unionByName(rows)
    best_per_key(rows).write.mode("overwrite").parquet(f"{table}/{batch_id:010d}")


def ingest_stream(spark: SparkSession, source: str, table: str, checkpoint: str) -> StreamingQuery:
    """Start merging files that appear below source (available now, then stop)."""
    prepare(spark)
    lines = spark.readStream.option("lineSep", "\n").text(source).select(F.lit(0).cast("long").alias("line_no"), F.col("value").alias("line"))

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = normalize(parse_lines(batch).where("parsed").select("object")).where("skip_reason is null").drop("skip_reason")
        merge_batch(rows, table, batch_id)

    return lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
