"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a partial aggregation and an equi-join; labels never reach the driver. A node with very many links is a hot
key in those joins: its links are dealt over ``SALTS`` keys, and its least neighbour is sent to as many of them as it
has links under. The table of each step is written, and removed when the next one is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, materialize

SALTS = 64


def _least(edges: DataFrame, node: str, other: str, with_own: bool) -> DataFrame:
    """(node, salt, m) for each salt under which the node has links: its least neighbour, or itself if with_own."""
    some = edges.groupBy(node, _salt(other)).agg(F.min(other).alias("m"))
    each = some.groupBy(node).agg(F.min("m").alias("m"), F.collect_set("salt").alias("salts"))  # SALTS at most
    m = F.least(node, "m") if with_own else F.col("m")
    return each.select(node, F.explode("salts").alias("salt"), m.alias("m"))


def _salt(other: str) -> Column:
    return F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int").alias("salt")


def _steps(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (a > b): every edge comes to point at smaller nodes."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    larger = both.where("v > u").select("u", "v", _salt("v"))
    large = larger.join(_least(both, "u", "v", True), ["u", "salt"]).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    small = large.select("a", "b", _salt("b")).join(_least(large, "a", "b", False), ["a", "salt"])
    small = small.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
    return small.select("e.a", "e.b").where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b), in any direction, to (node, component): the least node of each component. Nodes without links are absent."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")
    before = None
    while True:
        digest = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if digest == before or not digest["n"]:
            break
        before = digest
        last, edges = edges, materialize(_steps(edges), "links")
        discard(last)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
