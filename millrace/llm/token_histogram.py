"""Exact token-length histogram (operator 5).

Documents are aggregated by encoded length: each task counts lengths batch by batch, so what is shuffled is a row for
each length and batch at most. Prefix sums over the histogram then answer, for every context limit, how many documents
and tokens lie within it, how many documents are cut, and how many tokens remain after truncation; quantiles are the
first length at which enough documents are reached. The sums take two levels (within ranges of 128 lengths, then over
ranges), so the histogram itself is never in one task. It is written before it is read twice for that, so texts are
encoded once.

Null and empty texts have 0 tokens. Repeated rows count each time. An empty table has an empty histogram. Columns other
than text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import encoder, load, materialize, ship, slices, tokenizer_file

RANGE = 128


def histogram(docs: DataFrame, tokenizer: str | None = None, byte_level: bool = True, special_as_text: bool = False) -> DataFrame:
    """n_tokens, documents for every length that occurs. docs: text."""
    path = tokenizer or tokenizer_file("byte_bpe_50k.json")
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode, counts = encoder(path, byte_level, special_as_text), Counter()
        for batch in batches:
            for part in slices(batch):
                counts.update(len(ids) // 4 for ids in encode.encode_texts(part.column(0).cast(pa.binary()).to_pylist()))
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["n_tokens", "documents"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "n_tokens long, documents long")
    return counted.groupBy("n_tokens").agg(F.sum("documents").alias("documents"))


def limits(hist: DataFrame) -> DataFrame:
    """The histogram with, for each length as a context limit: documents_within, documents_cut, tokens_within, tokens_kept."""
    hist = materialize(hist, "token-lengths").withColumn("part", F.floor(F.col("n_tokens") / F.lit(RANGE)))
    tokens = F.col("n_tokens") * F.col("documents")
    parts = hist.groupBy("part").agg(F.sum("documents").alias("d"), F.sum(tokens).alias("t"))
    before = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each 128 lengths
    parts = parts.select("part", F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t"), F.sum("d").over(W.partitionBy(F.lit(0))).alias("all"))
    inside = W.partitionBy("part").orderBy("n_tokens").rowsBetween(W.unboundedPreceding, 0)
    summed = hist.withColumn("di", F.sum("documents").over(inside)).withColumn("ti", F.sum(tokens).over(inside)).join(parts, "part")
    within, cut = F.col("d") + F.col("di"), F.col("all") - F.col("d") - F.col("di")
    held = F.col("t") + F.col("ti")
    return summed.select("n_tokens", "documents", within.alias("documents_within"), cut.alias("documents_cut"), held.alias("tokens_within"), (held + F.col("n_tokens") * cut).alias("tokens_kept"))


def truncated_totals(table: DataFrame, context_limits: list[int]) -> DataFrame:
    """context_limit, documents_cut, tokens_kept for any limits, from the table of limits()."""
    asked = table.sparkSession.createDataFrame([(x,) for x in context_limits], "context_limit long")
    everything = table.agg(F.max(F.struct("n_tokens", "documents_within")).alias("m")).select(F.coalesce("m.documents_within", F.lit(0)).alias("all"))
    at = F.max(F.when(F.col("n_tokens") <= F.col("context_limit"), F.struct("n_tokens", "documents_within", "tokens_within")))
    # a few limits against a row for each length: one aggregation, the limits being sent to the histogram
    found = table.join(F.broadcast(asked), F.col("n_tokens") <= F.col("context_limit")).groupBy("context_limit").agg(at.alias("m"))
    out = asked.join(found, "context_limit", "left").join(F.broadcast(everything), F.lit(True))
    within = F.coalesce("m.documents_within", F.lit(0))
    return out.select("context_limit", (F.col("all") - within).alias("documents_cut"), (F.coalesce("m.tokens_within", F.lit(0)) + F.col("context_limit") * (F.col("all") - within)).alias("tokens_kept"))


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the least length that at least this share of the documents does not exceed."""
    asked = table.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    reached = F.col("documents_within") >= F.col("share") * (F.col("documents_within") + F.col("documents_cut"))
    return table.join(F.broadcast(asked), reached).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def op5_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits(histogram(load(spark, sf_dir, "documents")))
