"""Approximate nearest neighbours by balanced posting lists (operator 2).

Distinct vectors are indexed once, with the smallest vec_ids that share them, which decides ties and makes copies free.
A sample, bounded in rows and bytes, is cut in halves again and again, each time at the median between two means, which gives lists of
nearly equal size; their normalised means are the centroids. Centroids are linked to near and to random ones, and this
small graph, broadcast at a bounded size, is searched in memory by a beam for all vectors of a batch at once. A vector
goes to its nearest list and, if it lies near a boundary, also to lists within ``replica_ratio`` of that distance. A
query reads the lists within a ratio of the distance to its nearest centroid, and enough of them to hold k + 1 distinct
vectors. This ratio is measured: the exact k + 1 nearest of a bounded sample of queries are found by brute force, and it
is the least one within which ``recall`` of these lie in lists read; the beam of the search is as wide as the most lists
that any of them has within it. Long lists are cut into parts by hash, so that no task
holds more than about ``part_rows`` vectors; parts return their best k + 1 for each query, which are merged by rank.

Scores are cosines in double precision of the vectors as stored. Equal queries are searched once.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do
rows with a null vec_id. A query's own candidates are all rows with another vec_id. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import load, materialize, ship


@dataclass
class Centroids:
    """Unit centroids (float32) with a search graph: neighbours of each, and entry points."""

    points: object
    neighbours: object
    entries: object

    def search(self, queries, beam: int):
        """(numbers, cosines) of about the ``beam`` nearest centroids for each unit query, nearest first; -1 for none.

        The graph is searched at every size. State is a beam and the neighbourhoods of the eight centroids opened in a
        step, for each query, however many centroids there are.
        """
        import numpy as np

        n, width = len(queries), min(beam, len(self.points))
        ids = np.repeat(self.entries[None].astype(np.int32), n, axis=0)
        cos = queries @ self.points[self.entries].T
        opened = np.zeros(ids.shape, bool)
        while True:
            if ids.shape[1] > width:
                best = np.argpartition(-cos, width - 1, axis=1)[:, :width]
                ids, cos, opened = (np.take_along_axis(x, best, 1) for x in (ids, cos, opened))
            fresh = np.where(opened, np.float32(-3), cos)
            pick = np.argpartition(-fresh, min(7, fresh.shape[1] - 1), axis=1)[:, :8]
            live = np.take_along_axis(fresh, pick, 1) > -2
            if not live.any():
                break
            np.put_along_axis(opened, pick, True, 1)
            nodes = np.take_along_axis(ids, pick, 1)
            near = np.where(live[:, :, None], self.neighbours[np.where(live, nodes, 0)], -1).reshape(n, -1)
            # of equal numbers the first counts: one that is held already, with its mark; the rest become -1
            every = np.concatenate([ids, near], 1)
            order = np.argsort(every, axis=1, kind="stable")
            line = np.take_along_axis(every, order, 1)
            again = np.zeros(every.shape, bool)
            np.put_along_axis(again, order[:, 1:], line[:, 1:] == line[:, :-1], 1)
            ids = np.where(again, -1, every).astype(np.int32)
            found = np.einsum("qd,qmd->qm", queries, self.points[np.maximum(near, 0)], optimize=True)
            cos = np.where(ids < 0, np.float32(-2), np.concatenate([cos, found], 1))
            opened = np.concatenate([opened, np.zeros(near.shape, bool)], 1) | (ids < 0)
        order = np.argsort(-cos, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)


def _halves(x, random):
    """Rows of x in two halves of equal size, at the median between two means."""
    import numpy as np

    a, b = x[random.choice(len(x), 2, replace=False)]
    side = None
    for _ in range(6):
        lean = x @ (a - b)
        side = np.argsort(lean, kind="stable")
        half = len(x) // 2
        a, b = x[side[half:]].mean(0), x[side[:half]].mean(0)
    return side[: len(x) // 2], side[len(x) // 2 :]


def build(sample, lists: int, links: int = 16, seed: int = 1) -> Centroids:
    """Centroids of balanced lists of a sample (unit rows), and their graph."""
    import numpy as np

    random = np.random.default_rng(seed)
    parts = [np.arange(len(sample))]
    while len(parts) < lists and len(parts[0]) >= 2:
        parts.sort(key=len, reverse=True)
        largest = parts.pop(0)
        parts += [largest[h] for h in _halves(sample[largest], random)]
        parts.sort(key=len, reverse=True)
    means = np.stack([sample[p].mean(0) for p in parts])
    norm = np.linalg.norm(means, axis=1, keepdims=True)
    points = np.where(norm > 1e-9, means / np.maximum(norm, 1e-9), sample[[p[0] for p in parts]]).astype(np.float32)
    c = len(points)
    near = np.empty((c, min(links, c)), np.int32)
    for at in range(0, c, 1024):
        cos = points[at : at + 1024] @ points.T
        near[at : at + 1024] = np.argsort(-cos, axis=1, kind="stable")[:, : min(links, c)]
    far = random.integers(0, c, (c, links // 2)).astype(np.int32)
    ring = ((np.arange(c) + 1) % c).astype(np.int32)[:, None]  # every centroid can be reached
    entries = random.permutation(c)[: min(c, 64)]
    return Centroids(points, np.concatenate([near, far, ring], 1), entries)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array<double>) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"))
    infinite = F.lit(float("inf"))
    rows = rows.where(~F.coalesce(F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite)), F.lit(False)))
    return rows.where(F.exists("embedding", lambda x: x != 0))


def _reach(reps: DataFrame, posted: DataFrame, queries, model: Centroids, k: int, recall: float) -> tuple[float, int]:
    """The distance ratio within which this share of the exact k nearest of the queries (rows) lies, and the most lists within it."""
    import numpy as np

    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)

    def best(batches: Iterator) -> Iterator:
        """The k best of the rows of a partition for each query."""
        import pyarrow as pa

        top, names = np.full((len(unit), k), -np.inf), np.full((len(unit), k), -1)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                v = part.column("embedding").flatten().to_numpy().reshape(part.num_rows, -1)
                cos = np.concatenate([top, unit @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T], 1)
                own = np.concatenate([names, np.broadcast_to(part.column("rep").to_numpy(), (len(unit), part.num_rows))], 1)
                pick = np.argpartition(-cos, k - 1, axis=1)[:, :k]
                top, names = np.take_along_axis(cos, pick, 1), np.take_along_axis(own, pick, 1)
        i, j = np.nonzero(np.isfinite(top))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(names[i, j], pa.int64()), pa.array(top[i, j])], names=["q", "rep", "score"])

    order = W.partitionBy("q").orderBy(F.desc("score"), "rep")
    exact = reps.select("rep", "embedding").mapInArrow(best, "q int, rep long, score double").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("q", "rep")
    held = posted.select("list", "rep").join(F.broadcast(exact), "rep").select("q", "rep", "list").collect()  # k times the lists of a vector for each query
    cos = unit.astype(np.float32) @ model.points.T
    distance = np.sqrt(np.maximum(2 - 2 * cos, 0))
    distance /= np.maximum(distance.min(1, keepdims=True), 1e-6)
    nearest: dict = {}
    for r in held:
        at = float(distance[r["q"], r["list"]])
        nearest[r["q"], r["rep"]] = min(at, nearest.get((r["q"], r["rep"]), at))
    needed = np.array(list(nearest.values()))
    ratio = float(np.quantile(needed, recall, method="higher")) + 1e-6
    return ratio, int((distance <= ratio).sum(1).max())


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    list_rows: int = 256,
    max_lists: int = 8192,
    sample_rows: int = 32_768,
    sample_bytes: int = 64 << 20,
    replica_ratio: float = 1.1,
    max_replicas: int = 4,
    part_rows: int = 4096,
    recall: float = 0.97,
    sample_queries: int = 256,
) -> DataFrame:
    """The k nearest of vectors (vec_id, embedding) found for each of queries: query_id, rank, vec_id, score."""
    import numpy as np

    ship(vectors.sparkSession)

    empty = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows = usable(vectors).withColumn("dim", F.size("embedding"))
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], empty)
    rows = rows.where(F.col("dim") == common["dim"]).drop("dim")
    asked = usable(queries).where(F.size("embedding") == common["dim"]).select(F.col("vec_id").alias("query_id"), "embedding")
    # the smallest k + 1 ids of each distinct vector: with ties by vec_id, no other can be among the k nearest
    first = W.partitionBy("embedding").orderBy("vec_id")
    ids = rows.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    reps = ids.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.get("ids", F.lit(0)).alias("rep"), "ids", "embedding")
    reps = materialize(reps, "ann-vectors")
    total = reps.count()
    sample_rows = max(64, min(sample_rows, sample_bytes // (8 * common["dim"])))
    sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("embedding").toArrow()
    x = sample.column(0).combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    model = spark.sparkContext.broadcast(build(x, max(1, min(max_lists, len(x) // 4, total // list_rows))))  # smaller than the sample

    def lists_of(ratio: float, most: int, least: int, names: tuple[str, ...], beam: int):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    v = np.array(part.column(part.num_columns - 1).to_pylist()).reshape(part.num_rows, -1)
                    unit = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
                    number, cos = model.value.search(unit, beam)
                    distance = np.sqrt(np.maximum(2 - 2 * cos, 0))
                    keep = (distance <= ratio * distance[:, :1] + 1e-6) | (np.arange(number.shape[1]) < least)
                    keep[:, most:] = False
                    keep &= number >= 0
                    i, j = np.nonzero(keep)
                    yield pa.RecordBatch.from_arrays([pa.array(number[i, j], pa.int32()), *[c.take(pa.array(i)) for c in part.columns]], names=["list", *names])

        return run

    posted = reps.select("rep", "embedding").mapInArrow(lists_of(replica_ratio, max_replicas, 1, ("rep", "embedding"), 8 * max_replicas), "list int, rep long, embedding array<double>")
    posted = materialize(posted, "ann-lists")
    wanted = asked.groupBy("embedding").agg(F.min("query_id").alias("asked"))
    tried = wanted.orderBy(F.xxhash64("asked"), "asked").limit(max(1, min(sample_queries, sample_rows))).select("embedding").collect()
    if not tried:
        return spark.createDataFrame([], empty)
    ratio, most = _reach(reps, posted, np.array([r["embedding"] for r in tried]), model.value, k + 1, recall)
    least = 2 * (k + 1)
    most = max(most, least)
    probes = wanted.select("asked", "embedding").mapInArrow(lists_of(ratio, most, least, ("asked", "embedding"), most), "list int, asked long, embedding array<double>")
    parts = posted.groupBy("list").agg(F.ceil(F.count("*") / F.lit(part_rows)).cast("int").alias("parts"))
    cut = posted.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).drop("parts")  # at most max_lists rows
    spread = probes.join(F.broadcast(parts), "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def nearest(members, asking):
        """A row for each query of a part: its k + 1 best there."""
        import pyarrow as pa

        schema = pa.schema([("asked", pa.int64()), ("reps", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
        if not members.num_rows or not asking.num_rows:
            return schema.empty_table()
        m = np.array(members["embedding"].to_pylist())
        names = members["rep"].to_numpy()
        order = np.argsort(names)
        m, names = m[order], names[order]
        norms = np.linalg.norm(m, axis=1)
        out = []
        for at in range(0, asking.num_rows, 512):
            part = asking.slice(at, 512)
            q = np.array(part["embedding"].to_pylist())
            cos = (q @ m.T) / (np.linalg.norm(q, axis=1)[:, None] * norms)
            # the stable sort leaves ties in order of rep
            top = np.argsort(-cos, axis=1, kind="stable")[:, : k + 1]
            out.append(pa.table([part["asked"], pa.array(list(names[top])), pa.array(list(np.take_along_axis(cos, top, 1)))], schema=schema))
        return pa.concat_tables(out)

    def merged(found):
        """The k + 1 best distinct vectors of all parts that one query read; a row for each of these at most."""
        import pyarrow as pa

        names, scores = (np.concatenate(found[c].to_pylist()) for c in ("reps", "scores"))
        names, at = np.unique(names, return_index=True)
        order = np.argsort(-scores[at], kind="stable")[: k + 1]
        return pa.table({"asked": pa.array(np.full(len(order), found["asked"][0].as_py()), pa.int64()), "rep": names[order], "score": scores[at][order]})

    hits = cut.groupBy("list", "part").cogroup(spread.groupBy("list", "part")).applyInArrow(nearest, "asked long, reps array<long>, scores array<double>")
    hits = hits.groupBy("asked").applyInArrow(merged, "asked long, rep long, score double")
    named = hits.join(reps.select("rep", "ids"), "rep").select("asked", "score", F.explode("ids").alias("vec_id"))
    by = W.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    tops = named.withColumn("n", F.row_number().over(by)).where(F.col("n") <= k + 1)
    tops = tops.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("top"))
    owners = asked.distinct().join(wanted, "embedding").select("query_id", "asked")
    answers = owners.join(tops, "asked").select("query_id", F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("query_id")), 1, k).alias("top"))
    return answers.select("query_id", F.posexplode("top").alias("at", "t")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "t.vec_id", "t.score")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 50 = 0"))
