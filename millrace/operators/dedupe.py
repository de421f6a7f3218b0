"""Best row per key, ordered output and samples per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_per_key(rows: DataFrame, key: str = "barcode", rank: str = "rank", tie: str = "canonical") -> DataFrame:
    """The row with the highest rank of each key, ties to the least text; independent of input order.

    An aggregate, so that copies of a key shrink to a row for each task before they are shuffled.
    """
    others = [c for c in rows.columns if c != key]
    order = F.struct((-F.col(rank)).alias("r"), F.col(tie).alias("t"))
    best = rows.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("best"))
    return best.select(*[F.col(key) if c == key else F.col(f"best.{c}").alias(c) for c in rows.columns])


def ordered(rows: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Rows in global order: ranges dealt to partitions, each sorted (spilling) by itself."""
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def sort_key(key: Column, rank: Column, tie: Column) -> Column:
    """Key, rank from the best on, and the tie-breaker, as one sortable text."""
    down = F.lit("18446744073709551615").cast("decimal(20,0)") - rank
    return F.concat(key, F.lit("\x00"), F.lpad(down.cast("string"), 20, "0"), F.lit("\x00"), tie)


def first_per_group(rows: DataFrame, group: str, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows of each group in order; groups are cut down before the shuffle (WindowGroupLimit)."""
    place = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return rows.withColumn("_n", place).where(F.col("_n") <= n).drop("_n")
