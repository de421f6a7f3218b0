"""Exact Jaccard self-join on word n-gram sets by universe partitioning (operator 10).

Sets. A text's ASCII letters are lower-cased; its set holds the 64-bit hashes of its distinct n-word shingles (with
fewer words, of its whole sequence). Equal sets are one class, represented by its smallest doc_id.

Signatures. Sizes fall into bands wide enough that partners lie in one band or the next. Two sets of band b, or of bands
b and b + 1, that reach the threshold differ in at most H elements. The hash universe is cut into m = H + 1 + E ranges; a
set's part in a range is its segment. With at most H differences E + 1 segments are equal in both (pigeonhole), so each
set indexes its segments for its own band and probes with the segments of the band below where a partner may lie.

Allocation. A segment is given a distance of -1 (skipped), 0 (equal) or 1 (one deletion); any allocation with the sum of
(distance + 1) at least H + 1 stays complete. A set may skip up to E segments: its empty ones, then those whose signature
is in many sets; it skips all of a kind or none, so of E + 1 equal segments some is kept on both sides. From the group
sizes found, a (band, segment) whose pairs still cost more than the one-deletion neighbourhood of the band's cheapest
other segment is skipped for all in its favour; for those segments a second pass indexes the segment and all its
one-deletion neighbours.

Candidates. In a group of equal signatures every member is compared with the smallest one. Members that remain in
different components are then compared in blocks of at most ``block`` members a side: pairs must have enough equal
segments out of 2 m (each unequal one holds a difference; equal bytes prove nothing), and are listed in the first
group that they share, by the signatures themselves. Survivors, each once and only these, are verified on their whole sets. What a component already joins needs no more comparing, so groups of
thousands of near copies cost links in proportion to their members. No candidate or partner is dropped.

Null, empty and blank texts have empty sets and link with nothing. Rows with a null doc_id get a null component and
link with nothing. Rows that share a doc_id are one node, with a set each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import discard, forget_encoders, free_shuffles, load, materialize, mixed, multipliers, ship, slices, word_hashes
from millrace.llm.components import components

#: Bands of more segments are never reallocated, so that what allocate() collects is bounded.
MOST_SEGMENTS = 4096


def shingle_set(text: bytes, n: int):
    """The set as ascending unsigned 64-bit hashes."""
    import numpy as np

    h, k = word_hashes(text.lower()), multipliers(n)  # bytes.lower changes A-Z only
    if not len(h):
        return h
    if len(h) < n:
        return mixed((h * k[: len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total += h[i : len(h) - n + 1 + i] * k[i]
    return np.unique(mixed(total))


class Bands:
    """Size bands for a threshold of percent / 100, and the differences that it allows."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]
        # wide bands mean fewer probes, but smaller segments: two steps if segments of five elements remain
        largest = self.reach(self.reach(1000))
        self.steps = 2 if self.differences(largest + self.reach(largest)) * 5 <= 1000 else 1

    def reach(self, size: int) -> int:
        """The largest partner of a set of this size."""
        return size * 100 // self.percent

    def band(self, size: int) -> int:
        from bisect import bisect_right

        while self.edges[-1] <= size:
            top = self.edges[-1]
            for _ in range(self.steps):
                top = self.reach(top)
            self.edges.append(top + 1)
        return bisect_right(self.edges, size) - 1

    def differences(self, total: int) -> int:
        """The most elements in which linked sets of this many elements in all can differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def needed(self, band: int) -> int:
        """Segments that the pigeonhole argument needs: one more than the differences."""
        while len(self.edges) <= band + 1:
            self.band(self.edges[-1])
        largest = self.edges[band + 1] - 1
        return self.differences(largest + self.reach(largest)) + 1

    def spare(self, band: int) -> int:
        """E: about the empty segments that the band's smallest sets have."""
        from math import ceil, exp

        need, smallest = self.needed(band), self.edges[band]
        empty = need * exp(-smallest / need)
        return ceil(empty + 2 * empty**0.5) + 1 if smallest >= 16 else 0

    def segments(self, band: int) -> int:
        return self.needed(band) + self.spare(band)

    def probes_below(self, size: int) -> bool:
        b = self.band(size)
        return b > 0 and self.reach(self.edges[b] - 1) >= size


@lru_cache(256)
def _cuts(parts: int):
    import numpy as np

    return np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)


def segment_sums(s, parts: int):
    """Per range of the hash universe: the sum of its elements' mixed hashes, and the ranges' bounds in s."""
    import numpy as np

    bounds = np.concatenate([[0], np.searchsorted(s, _cuts(parts)), [len(s)]])
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(s + np.uint64(1)), dtype=np.uint64)])
    return running[bounds[1:]] - running[bounds[:-1]], bounds


def signatures(sums, band: int, segments):
    import numpy as np

    k = multipliers(4)
    return mixed(sums * k[3] + np.uint64(band << 32) + np.asarray(segments, np.uint64))


def deletions(s, band: int, segment: int, parts: int):
    """Signatures of a segment and of all its one-deletion neighbours."""
    import numpy as np

    sums, bounds = segment_sums(s, parts)
    inside = mixed(s[bounds[segment] : bounds[segment + 1]] + np.uint64(1))
    return np.unique(signatures(np.concatenate([sums[segment : segment + 1], sums[segment] - inside]), band, segment))


def linked(a, b, percent: int) -> bool:
    import numpy as np

    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# ---------------------------------------------------------------- passes over texts


def _posted(s, band: int, bands: Bands):
    """(signatures of a set's segments, which of them it emits, segments that it may still skip, a byte for each half segment).

    Bytes of empty halves are 0, of others 1 to 255: unequal bytes are unequal halves, and each of these holds a difference.
    """
    import numpy as np

    m, spare = bands.segments(band), bands.spare(band)
    halves, bounds = segment_sums(s, 2 * m)
    filled = np.diff(bounds) > 0
    kept = filled[0::2] | filled[1::2]
    left = spare - int(len(kept) - kept.sum())
    fine = np.where(filled, 1 + (mixed(halves) >> np.uint64(40)) % np.uint64(255), 0).astype(np.uint8)
    return signatures(halves[0::2] + halves[1::2], band, np.arange(m)).view(np.int64), kept if left >= 0 else np.ones(m, bool), left, fine.tobytes()


def _digests(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, digest and band of every row, and for its own band and the one below signatures (null: skipped) spare and fine."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        forget_encoders()
        bands = Bands(percent)
        nothing = (np.zeros(0, np.int64), np.zeros(0, bool), 0, b"")
        for batch in batches:
            for part in slices(batch, 512):
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    s = shingle_set(text or b"", n)
                    b, own, probe = -1, nothing, nothing
                    if len(s) and doc_id is not None:
                        b = bands.band(len(s))
                        own = _posted(s, b, bands)
                        if bands.probes_below(len(s)):
                            probe = _posted(s, b - 1, bands)
                    rows.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), b, own, probe))
                ids, sizes, digests, bs, *posts = zip(*rows)
                long, columns = pa.int64(), []
                for x in posts:
                    values, kept, left, fine = zip(*x)
                    flat = pa.array(np.concatenate(values), long, mask=~np.concatenate(kept))
                    columns += [pa.ListArray.from_arrays(np.cumsum([0, *map(len, values)]).astype(np.int32), flat), pa.array(left, pa.int32()), pa.array(fine, pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(ids, long), pa.array(sizes, long), pa.array(digests, pa.binary()), pa.array(bs, pa.int32()), *columns], names=["doc_id", "n_shingles", "digest", "band", "own", "own_spare", "fine", "probe", "probe_spare", "below"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, band int, own array<long>, own_spare int, fine binary, probe array<long>, probe_spare int, below binary")


def _deletion_rows(docs: DataFrame, n: int, percent: int, swapped: list[tuple[int, int]]) -> DataFrame:
    """sig, doc, own, digest for the segments that were given one deletion. swapped is bounded by the number of segments."""
    raised: dict[int, list[int]] = {}
    for band, segment in swapped:
        raised.setdefault(band, []).append(segment)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        bands = Bands(percent)
        for batch in batches:
            for part in slices(batch, 512):
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    s = shingle_set(text or b"", n)
                    if not len(s) or doc_id is None:
                        continue
                    b = bands.band(len(s))
                    for band, own in [(b, True)] + [(b - 1, False)] * bands.probes_below(len(s)):
                        for segment in raised.get(band, []):
                            sigs = deletions(s, band, segment, bands.segments(band)).view(np.int64).tolist()
                            digest = xxhash.xxh3_128_digest(s.tobytes())
                            rows += [{"sig": x, "doc": doc_id, "band": band, "segment": -1, "own": own, "digest": digest} for x in sigs]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("sig", pa.int64()), ("doc", pa.int64()), ("band", pa.int32()), ("segment", pa.int32()), ("own", pa.bool_()), ("digest", pa.binary())]))

    return docs.mapInArrow(run, "sig long, doc long, band int, segment int, own boolean, digest binary")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """doc, elements (the set, binary). docs: doc_id, text, digest; of rows that share a doc_id, the one with the digest."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        schema = pa.schema([("doc", pa.int64()), ("elements", pa.binary())])
        for batch in batches:
            for part in slices(batch, 512):
                rows = []
                for doc_id, text, digest in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                    s = shingle_set(text or b"", n)
                    if xxhash.xxh3_128_digest(s.tobytes()) == digest:
                        rows.append({"doc": doc_id, "elements": s.astype("<u8").tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.mapInArrow(run, "doc long, elements binary")


def _near_enough(pairs: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose halves of segments differ in no more places than linked sets may."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for (na, ba, fa, la), (nb, bb, fb, lb) in zip(zip(*[batch.column(c).to_pylist() for c in ("na", "ba", "fa", "la")]), zip(*[batch.column(c).to_pylist() for c in ("nb", "bb", "fb", "lb")])):
                if ba != bb:
                    fa, fb = (la, fb) if ba > bb else (fa, lb)
                unequal = np.count_nonzero(np.frombuffer(fa, np.uint8) != np.frombuffer(fb, np.uint8)) if len(fa) == len(fb) else 1 << 40
                keep.append(unequal <= (na + nb) * (100 - percent) // (100 + percent) and 100 * min(na, nb) >= percent * max(na, nb))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    side = lambda x: fine.select(F.col("doc").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("band").alias(f"b{x}"), F.col("fine").alias(f"f{x}"), F.col("below").alias(f"l{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 256):
                x, y = part.column(2).to_pylist(), part.column(3).to_pylist()
                keep = [linked(np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8"), percent) for p, q in zip(x, y)]
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in part.columns[:2]], names=["a", "b"])

    one = sets.select(F.col("doc").alias("a"), F.col("elements").alias("x"))
    two = sets.select(F.col("doc").alias("b"), F.col("elements").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _links(pairs: DataFrame, texts: DataFrame, digests: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that are links, verified on the whole sets of the texts they need."""
    needed = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct().join(digests, "doc_id")
    sets = materialize(_sets(texts.join(needed, "doc_id").select("doc_id", "text", "digest"), n), "ngram-sets")
    free_shuffles(pairs.sparkSession)
    links = materialize(_verified(pairs, sets, percent), "ngram-links")
    discard(sets)
    free_shuffles(pairs.sparkSession)
    return links


def _sharing(lists, p, q):
    """Whether the lists (an Arrow array, no value twice in one) of rows p and q have a value in common, for each such pair."""
    import numpy as np

    ends, shared = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)), np.zeros(len(p), bool)
    row = np.repeat(np.arange(len(lists)), np.diff(ends, prepend=0))
    used = np.zeros(len(lists), bool)
    used[p] = used[q] = True
    row, values = row[used[row]], lists.flatten().to_numpy()[used[row]]
    _, value, times = np.unique(values, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1  # values of one row are left out
    row, value = row[times[value] > 1], number[value[times[value] > 1]]
    wide = max(8, (1 << 22) // len(lists))
    for a in range(0, int((times > 1).sum()), wide):
        now = (value >= a) & (value < a + wide)
        bits = np.zeros((len(lists), min(wide, int(value.max()) + 1 - a)), bool)
        bits[row[now], value[now] - a] = True
        bits = np.packbits(bits, axis=1)
        step = max(1, (1 << 20) // bits.shape[1])
        for k in range(0, len(p), step):
            shared[k : k + step] |= (bits[p[k : k + step]] & bits[q[k : k + step]]).any(axis=1)
    return shared


def _block_pairs(members: DataFrame, percent: int, block: int) -> DataFrame:
    """Candidate pairs between components within groups of equal signatures, in the first group that a pair shares.

    members: sig, n (members of the group), doc, own, component, n_shingles and the bytes of its half segments in this band (sums).
    All groups in which a pair is compared are of one band, where each of the two is a member by its own band or by the one
    above: so a member takes along its lower signatures in that part, and a pair that shares one of them is listed there.
    """
    of = members.groupBy("doc", "own", "component", "n_shingles", "sums").agg(F.array_sort(F.collect_set(F.struct("sig", "n"))).alias("groups"))
    of = of.select("*", F.posexplode("groups").alias("at", "group")).withColumn("lower", F.slice("groups.sig", F.lit(1), F.col("at")))
    of = of.select("group.sig", "group.n", "doc", "own", "component", "n_shingles", "sums", "lower")
    # blocks by hash, so that no task holds or ranks a whole group
    sized = of.withColumn("blks", F.ceil(F.col("n") / F.lit(block)).cast("int")).withColumn("blk", F.pmod(F.xxhash64("doc"), F.col("blks")).cast("int"))
    sized = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blks") - 1)))
    sized = sized.withColumn("x", F.least("blk", "other")).withColumn("y", F.greatest("blk", "other")).drop("other", "blks")

    def compared(g: dict, begin: int, end: int):
        """The pairs in the rows begin to end, which are one pair of blocks."""
        import numpy as np

        side, doc, own, comp, size = (g[c][begin:end] for c in ("blk", "doc", "own", "component", "n_shingles"))
        here, there = np.flatnonzero(side == g["x"][begin]), np.flatnonzero(side == g["y"][begin])
        i, j = np.repeat(here, len(there)), np.tile(there, len(here))
        ok = (comp[i] != comp[j]) & (own[i] | own[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
        if g["x"][begin] == g["y"][begin]:
            ok &= i < j
        i, j = i[ok], j[ok]
        if not len(i):
            return None
        sums = np.frombuffer(b"".join(g["sums"][begin:end].to_pylist()), np.uint8).reshape(end - begin, -1)
        step, near = max(1, (1 << 20) // sums.shape[1]), np.zeros(len(i), bool)
        for k in range(0, len(i), step):
            p, q = i[k : k + step], j[k : k + step]
            near[k : k + step] = np.count_nonzero(sums[p] != sums[q], axis=1) <= (size[p] + size[q]) * (100 - percent) // (100 + percent)
        i, j = i[near], j[near]
        if not len(i):
            return None
        first = ~_sharing(g["lower"][begin:end], i, j)
        p, q = doc[i[first]], doc[j[first]]
        return np.minimum(p, q), np.maximum(p, q)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def listed(batch, last: bool):
            """The pairs of the batch's blocks, and the rows of its last ones, which may go on in the next batch."""
            g = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "x", "y", "width", "blk", "doc", "own", "component", "n_shingles")} | {c: batch.column(c) for c in ("sums", "lower")}
            new = np.zeros(batch.num_rows, bool)
            for c in ("sig", "x", "y", "width"):
                new[1:] |= g[c][1:] != g[c][:-1]
            bounds = [0, *np.flatnonzero(new).tolist(), *[batch.num_rows] * last]
            found = [f for f in (compared(g, p, q) for p, q in zip(bounds, bounds[1:])) if f]
            columns = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(2)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"]), batch.slice(bounds[-1])

        rest = None
        for batch in batches:
            if rest is not None and rest.num_rows:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            pairs, rest = listed(batch, False)
            yield pairs
        if rest is not None and rest.num_rows:
            yield listed(rest, True)[0]

    # halves of another number belong to another band, whose signature is equal by chance
    key = ["sig", "x", "y", "width"]
    sized = sized.withColumn("width", F.length("sums")).select(*key, "blk", "doc", "own", "component", "n_shingles", "sums", "lower")
    return sized.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- groups


def group_stats(members: DataFrame) -> DataFrame:
    """A row for each signature under which an indexed set meets another: sig, band, segment, low (least doc), n, size.

    Aggregated in part before the shuffle and written, so that members join it by plain scans, whose hot keys are split.
    """
    found = members.groupBy("sig").agg(F.min("band").alias("band"), F.min("segment").alias("segment"), F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("own").alias("indexed"), F.count("*").alias("n"), F.max("n_shingles").alias("size"))
    return materialize(found.where("low < high and indexed").drop("high", "indexed"), "ngram-sizes")


def allocate(groups: DataFrame, percent: int, pair_cost: float = 1 / 40, least_pairs: int = 1 << 16) -> tuple[list, list]:
    """(skipped, raised) lists of (band, segment) from the sizes of signature groups.

    groups: band, segment, members (own and probing) of groups of two or more. Costs are in signature rows; a pair
    compared in a block costs pair_cost of one. A segment is skipped only if it has least_pairs pairs or more, and only
    in bands of at most MOST_SEGMENTS segments, of which there are a few dozen (or, at 100 percent, as many as that with one
    segment each): that bounds what is collected.
    """
    bands, rows = Bands(percent), {}
    last = 0
    while last < MOST_SEGMENTS and bands.segments(last) <= MOST_SEGMENTS:
        last += 1
    loads = groups.where(F.col("band") < last).groupBy("band", "segment").agg(F.sum(F.col("n") * F.col("n")).alias("load"), F.max("docs").alias("docs"), F.max("size").alias("size"))
    heavy = loads.where(F.col("load") >= least_pairs).select("band").distinct()
    for r in loads.join(heavy, "band").collect():  # rows for each segment of the bands with heavy groups
        rows.setdefault(r["band"], []).append((r["load"], r["segment"], r["docs"], r["size"]))
    skipped, raised = [], []
    for band, found in rows.items():
        m = bands.segments(band)
        if m < 2:
            continue
        docs, size = max(x[2] for x in found), max(x[3] for x in found)
        load = dict.fromkeys(range(m), 0) | {x[1]: x[0] for x in found}
        order = sorted(load, key=load.get)
        near = docs * (1 + size / m)  # rows of one segment's neighbourhoods
        while len(order) >= 2 and load[order[-1]] >= least_pairs and load[order[-1]] * pair_cost > near + 2 * load[order[0]] * pair_cost:
            skipped.append((band, order.pop()))
            raised.append((band, order.pop(0)))
    return skipped, raised


# ---------------------------------------------------------------- join


def join_components(docs: DataFrame, n: int = 3, percent: int = 90, block: int = 512, frequent: int = 64, pair_cost: float = 1 / 40, least_pairs: int = 1 << 16) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = materialize(_digests(texts, n, percent), "ngram-signatures")
    rows = materialize(found.select("doc_id", "n_shingles", "digest", "band", "own_spare", "probe_spare"), "ngram-rows")
    known = rows.where("n_shingles > 0 and doc_id is not null")
    # classes of equal sets; a set of one row is its own class and needs no entry
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n")
    classes = materialize(classes, "ngram-classes")
    reps = known.join(classes, "digest", "left").where("rep is null or doc_id = rep")
    reps = materialize(reps.select(F.col("doc_id").alias("doc"), "n_shingles", "digest", "band", "own_spare", "probe_spare").distinct(), "ngram-sets")
    # place: band, segment and whether it is indexed (1) or probes (0), in one number
    place = lambda band, bit: F.shiftleft(band.cast("long"), 40) + F.shiftleft(F.col("segment").cast("long"), 1) + bit
    index = lambda: found.select("doc_id", "band", F.posexplode("own").alias("segment", "sig")).where("sig is not null")
    below = lambda: found.select("doc_id", "band", F.posexplode("probe").alias("segment", "sig")).where("sig is not null")
    # signatures of two rows or more, one of them indexed; partial aggregation keeps hot ones small
    met = index().select("sig", F.lit(True).alias("own")).unionByName(below().select("sig", F.lit(False).alias("own")))
    met = met.groupBy("sig").agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 and own").select("sig")
    met = materialize(met, "ngram-met")
    free_shuffles(spark)
    posted = index().select("sig", F.col("doc_id").alias("doc"), place(F.col("band"), 1).alias("place")).unionByName(below().select("sig", F.col("doc_id").alias("doc"), place(F.col("band") - 1, 0).alias("place")))
    shared = materialize(posted.join(met, "sig", "left_semi"), "ngram-shared")
    discard(met)
    free_shuffles(spark)
    own = F.col("place").bitwiseAND(F.lit(1)) == 1
    placed = shared.join(reps.drop("digest"), "doc").withColumn("own", own).withColumn("segment", F.shiftright("place", 1).bitwiseAND(F.lit((1 << 38) - 1)).cast("int"))
    placed = placed.where(F.col("band") == F.shiftright("place", 40).cast("int") + (~F.col("own")).cast("int"))  # of rows that share a doc_id, the right one
    placed = placed.withColumn("spare", F.when(F.col("own"), F.col("own_spare")).otherwise(F.col("probe_spare"))).withColumn("band", F.shiftright("place", 40).cast("int"))
    placed = materialize(placed.select("sig", "doc", "band", "segment", "own", "n_shingles", "spare"), "ngram-placed")
    discard(shared)
    # frequent signatures are skipped by the sets that can afford to skip all of theirs
    often = materialize(placed.groupBy("sig").agg(F.count("*").alias("n")).where(F.col("n") > frequent).select("sig", F.lit(True).alias("frequent")), "ngram-frequent")
    counted = placed.join(often, "sig", "left").withColumn("frequent", F.coalesce("frequent", F.lit(False)))
    of = W.partitionBy("doc", "band", "own", "n_shingles")  # a set's segments
    counted = counted.withColumn("afford", F.count_if("frequent").over(of) <= F.col("spare"))
    groups = materialize(counted.where("not (frequent and afford)").select("sig", "doc", "band", "segment", "own", "n_shingles"), "ngram-groups")
    discard(placed)
    free_shuffles(spark)
    sizes = group_stats(groups)
    volume = rows.groupBy("band").agg(F.count("*").alias("docs"))
    volume = volume.union(volume.withColumn("band", F.col("band") - 1)).groupBy("band").agg(F.sum("docs").alias("docs"))
    skipped, raised = allocate(sizes.join(volume, "band"), percent, pair_cost, least_pairs)
    if skipped:
        drop = spark.createDataFrame(skipped, "band int, segment int")
        near = _deletion_rows(texts, n, percent, raised).join(reps.select("doc", "digest", "n_shingles"), ["doc", "digest"]).drop("digest").distinct()
        groups = materialize(groups.join(F.broadcast(drop), ["band", "segment"], "left_anti").unionByName(near), "ngram-groups")
        sizes = group_stats(groups)
    lows = sizes.select("sig", "low")
    key = ["doc", "n_shingles", "digest"]
    needed = reps.join(groups.join(lows, "sig", "left_semi").select("doc", "n_shingles").distinct(), ["doc", "n_shingles"]).select(*key)
    fine = materialize(found.select(F.col("doc_id").alias("doc"), "n_shingles", "digest", "band", "fine", "below").join(needed, key).dropDuplicates(key), "ngram-halves")
    discard(found)
    free_shuffles(spark)
    digests = reps.select(F.col("doc").alias("doc_id"), "digest")
    stars = groups.join(lows, "sig").where("doc <> low").select(F.col("low").alias("a"), F.col("doc").alias("b")).distinct()
    links = _links(materialize(_near_enough(stars, fine, percent), "ngram-pairs"), texts, digests, n, percent)
    joined = components(links)
    labelled = groups.join(joined.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    labelled = materialize(labelled.select("sig", "doc", "own", "component", "n_shingles"), "ngram-labelled")
    apart = labelled.groupBy("sig").agg(F.min("component").alias("one"), F.max("component").alias("other"), F.count("*").alias("n")).where("one <> other and n > 2").select("sig", "n")
    rest = labelled.join(materialize(apart, "ngram-apart").join(lows, "sig", "left_semi"), "sig")
    halves = fine.select("doc", "n_shingles", "fine", "below")
    rest = rest.join(halves, ["doc", "n_shingles"]).withColumn("sums", F.when(F.col("own"), F.col("fine")).otherwise(F.col("below"))).drop("fine", "below")
    more = materialize(_block_pairs(rest, percent, block).distinct(), "ngram-pairs")
    if more.take(1):
        links = links.unionByName(_links(more, texts, digests, n, percent))
    # rows that share a doc_id join the classes of their sets
    several = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("doc_id")
    across = known.join(several, "doc_id", "left_semi").join(classes, "digest").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    joined = components(links.unionByName(across))
    labels = classes.join(joined, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("label"))
    named = rows.where("doc_id is not null").join(labels, "digest", "left").join(joined, F.col("doc_id") == F.col("node"), "left")
    out = named.select("doc_id", "n_shingles", F.coalesce("label", "component", "doc_id").alias("component_id"))
    return out.unionByName(rows.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(load(spark, sf_dir, "documents"))
