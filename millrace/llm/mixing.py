"""Mixing sources to target weights by a low-discrepancy schedule (operator 7), in DataFrame functions only.

Targets. All words are shared by weight; a source's target stops at ``max_epochs`` times its size and what is beyond is
shared anew among the others by weight. Ordered by size/weight the stopped sources come first, so one pass of prefix
sums over the source table finds the common rate.

Schedule. Each source's documents, in the order of a seeded hash, form a stream that is cut into blocks of equal size;
a source of target t needs the slots that cover t words, the last of them cut to fit. The N slots of all sources lie
side by side on a line, a source's share as long as its number of slots. Slot k of the mix takes the point k * g mod N
on that line, g being the integer coprime to N next to N divided by the golden ratio: a golden-ratio lattice, which
spreads every source evenly over the mix and meets each count exactly. Slots are ranked within their source and rank r
takes block r mod blocks, in epoch r div blocks, so no document is taken in one epoch more often than any other.

Scale. Word positions and ranks come from two-level prefix sums (a window within a bucket, then a window over buckets),
so a source with a third of all rows is spread over 4,096 hash buckets or rank chunks. Blocks are joined on (source,
block). The source table is one row a source and is not collected. Block size grows beyond 2**39 words in all, so that
products of slot numbers fit 64 bits.

Order. A pass over a document belongs to the slot where it begins. mix_documents deals passes by ranges of slots, which
hold equally many words, to partitions and sorts them there, so every stretch of its rows mixes the sources as the whole.

Null text has size 0 and is never taken; null source is a source, the last one. Ties in the hash (repeated rows) are
ordered by doc_id and size. An empty table gives no rows. Other columns are kept by mix_documents.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import as_row, load, materialize, word_array, word_count

WEIGHTS = (5, 2, 1)
GOLDEN = 0.6180339887498949
CHUNK = 1 << 12


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """A row for each source: number, source, source_size, target. sizes: source, size."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = W.partitionBy(F.lit(0))  # of the source table
    number = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("number", F.lit(len(weights))))
    per = per.withColumn("number", number).withColumn("weight", weight)
    before = everything.orderBy(F.col("source_size") / F.col("weight"), "number").rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - max_epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rate = F.col("left") / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("left", left).withColumn("rate", rate)
    per = per.withColumn("full", F.col("rate") * F.col("weight") > max_epochs * F.col("source_size"))
    # the first source that isn't stopped sees the rate that holds for all those after it
    per = per.withColumn("common", F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), "number", "rate"))).over(everything)["rate"])
    target = F.when(F.col("full"), (max_epochs * F.col("source_size")).cast("double")).otherwise(F.col("common") * F.col("weight"))
    return per.select("number", "source", "source_size", target.alias("target"))


def plan_sources(targets: DataFrame, block_words: int) -> DataFrame:
    """targets with words to take, blocks of the stream, slots, and where the slots start on the line."""
    words = F.round("target").cast("long")
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
    rest = F.when(F.col("source_size") > 0, F.pmod("words", "source_size")).otherwise(F.lit(0))
    epochs = F.when(F.col("source_size") > 0, ((F.col("words") - F.col("rest")) / F.col("source_size")).cast("long")).otherwise(F.lit(0))
    planned = targets.withColumn("words", words).withColumn("blocks", blocks).withColumn("rest", rest).withColumn("epochs", epochs)
    planned = planned.withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / F.lit(block_words)))
    before = W.partitionBy(F.lit(0)).orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    return planned.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0)))


def schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """The mix, a row for each slot: slot, number, rank, epoch, block, begin, end (words of the source's stream)."""
    spark = sources.sparkSession
    n = sources.agg(F.sum("slots")).first()[0] or 0
    g = next((x for d in range(n + 1) for x in (round(n * GOLDEN) + d, round(n * GOLDEN) - d) if 0 < x <= n and gcd(x, n) == 1), 1)
    inverse = pow(g, -1, n) if n > 1 else 0
    line = spark.range(n).select(F.col("id").alias("x"), F.floor(F.col("id") / F.lit(CHUNK)).alias("cell"), F.pmod(F.col("id") * F.lit(inverse), F.lit(max(n, 1))).alias("slot"))
    spans = sources.where("slots > 0").withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / F.lit(CHUNK)), F.floor((F.col("first") + F.col("slots") - 1) / F.lit(CHUNK)))))
    owned = line.join(spans, "cell").where("x >= first and x < first + slots").withColumn("chunk", F.floor(F.col("slot") / F.lit(CHUNK)))
    within = F.row_number().over(W.partitionBy("number", "chunk").orderBy("slot")) - 1
    counts = owned.groupBy("number", "chunk").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("number").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = owned.withColumn("within", within).join(counts.select("number", "chunk", before.alias("before")), ["number", "chunk"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within")).withColumn("block", F.pmod("rank", "blocks"))
    epoch = ((F.col("rank") - F.col("block")) / F.col("blocks")).cast("long")
    begin = F.col("block") * block_words
    end = F.least(begin + block_words, F.when(F.col("epoch") == F.col("epochs"), F.col("rest")).otherwise(F.col("source_size")))
    return ranked.withColumn("epoch", epoch).select("slot", "number", "rank", "epoch", "block", begin.alias("begin"), end.alias("end"))


def positions(sizes: DataFrame) -> DataFrame:
    """sizes (number, order, doc_id, size) with the first word's position in its source's stream."""
    sizes = sizes.withColumn("bucket", F.substring("order", 1, 3))
    inside = W.partitionBy("number", "bucket").orderBy("order", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    sums = sizes.groupBy("number", "bucket").agg(F.sum("size").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("number").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums.select("number", "bucket", before.alias("before")), ["number", "bucket"])
    return placed.withColumn("position", F.col("before") + F.col("inside")).drop("inside", "before", "bucket")


def _planned(docs: DataFrame, weights: tuple[int, ...], max_epochs: int, block_words: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(numbered documents, sources, takes, schedule); takes: a row for each document and epoch with words and the slot of the first."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("order")
    sizes = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order), "mix-sizes")
    targets = source_targets(sizes, weights, max_epochs)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    block_words = max(block_words, total >> 30)
    sources = materialize(plan_sources(targets, block_words), "mix-sources")
    slots = schedule(sources, block_words)
    named = sources.select("number", F.col("source").alias("_source"))
    numbered = sizes.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = positions(numbered)
    blocks = F.sequence(F.floor(F.col("position") / F.lit(block_words)), F.floor((F.col("position") + F.col("size") - 1) / F.lit(block_words)))
    cut = placed.where("size > 0").withColumn("block", F.explode(blocks))
    overlap = F.least(F.col("position") + F.col("size"), F.col("end")) - F.greatest("position", "begin")
    parts = cut.join(slots.drop("rank"), ["number", "block"], "left").withColumn("words", F.when(F.col("slot").isNull(), F.lit(0)).otherwise(F.greatest(overlap, F.lit(0))).cast("long"))
    # a document with words has its position to itself
    takes = parts.groupBy("number", "position", "doc_id", "source", "size", "epoch").agg(F.sum("words").alias("words"), F.min(F.when(F.col("words") > 0, F.col("slot"))).alias("slot"))
    return numbered, sources, takes, slots


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, block_words: int = 512, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, source, size, source_size, target, taken, first_slot; the schedule). docs: doc_id, text, source.

    first_slot is the slot of the mix in which a document is first taken, null if it is not.
    """
    numbered, sources, takes, slots = _planned(docs, weights, max_epochs, block_words, seed)
    taken = takes.groupBy("number", "position", "doc_id", "source", "size").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    zero, never = F.lit(0).cast("long"), F.lit(None).cast("long")
    empty = numbered.where("size = 0").select("number", zero.alias("position"), "doc_id", "source", "size", zero.alias("taken"), never.alias("first_slot"))
    known = sources.select("number", "source_size", "target")
    out = taken.unionByName(empty).join(known, "number")
    return out.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", F.col("taken").cast("long").alias("taken"), "first_slot"), slots


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, block_words: int = 512, seed: int = 0, partition_words: int = 1 << 24) -> DataFrame:
    """docs as the mix takes them, in slot order: a row for each whole pass over a document, and the first words where a pass ends inside one."""
    spark = docs.sparkSession
    _, sources, takes, _ = _planned(docs, weights, max_epochs, block_words, seed)
    n, words = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    # one key for the window and the join, so that texts are shuffled once for it; rows alike in doc_id, source and size share their takes in any order
    passes = F.sort_array(F.collect_list(F.struct("slot", "position", "words"))).alias("_takes")  # max_epochs + 1 at most
    plan = takes.where("words > 0").groupBy("number", "position", "doc_id", "source", "size").agg(passes)
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "position", "_takes")
    plan = plan.withColumn("_m", F.row_number().over(W.partitionBy("_id", "_source", "_size").orderBy("position"))).drop("position").withColumn("_key", F.xxhash64("_id", "_source", "_size"))
    left = docs.select(as_row(docs), word_count(F.col("text")).alias("_words")).where("_words > 0")
    own = [F.col("row.doc_id"), F.col("row.source"), F.col("_words")]
    left = left.withColumn("_lkey", F.xxhash64(*own)).repartition("_lkey")
    left = left.withColumn("_k", F.row_number().over(W.partitionBy("_lkey", *own).orderBy("_lkey")))
    same = (F.col("_lkey") == F.col("_key")) & own[0].eqNullSafe(F.col("_id")) & own[1].eqNullSafe(F.col("_source")) & (own[2] == F.col("_size")) & (F.col("_k") == F.col("_m"))
    joined = left.join(plan, same).select("row", "_size", F.explode("_takes").alias("_take"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // partition_words))
    dealt = joined.repartitionById(parts, F.floor(F.col("_take.slot") * F.lit(parts / max(n, 1))).cast("int")).sortWithinPartitions("_take.slot", "_take.position")
    whole, cut = F.col("_take.words") == F.col("_size"), F.array_join(F.slice(word_array(F.col("row.text")), F.lit(1), F.col("_take.words").cast("int")), " ")
    new = {"text": F.when(whole, F.col("row.text")).otherwise(cut)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(whole, F.col("row.n_chars")).otherwise(F.length(cut)).cast(docs.schema["n_chars"].dataType)
    return dealt.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mix(load(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


#: For up to 2**39 words, where blocks have 512.
ORACLE = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        md5('0:' || coalesce(doc_id::varchar, '')) as o from documents),
s as (select source, row_number() over (order by source nulls last) as number, sum(size)::bigint as source_size, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1)::int % 3 + 1]::double as weight from d group by source),
r as (select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as rate
        from s window before as (order by source_size / weight, number rows between unbounded preceding and 1 preceding)),
f as (select *, rate * weight > 3 * source_size as is_full from r),
t as (select number, source, source_size, case when is_full then 3 * source_size else (select arg_min(rate, source_size / weight) from f where not is_full) * weight end::double as target from f),
q as (select *, round(target)::bigint as words, (source_size + 511) // 512 as blocks, round(target)::bigint % source_size as rest, round(target)::bigint // source_size as epochs from t where source_size > 0),
l as (select *, epochs * blocks + (rest + 511) // 512 as slots, coalesce(sum(epochs * blocks + (rest + 511) // 512) over (order by number rows between unbounded preceding and 1 preceding), 0) as first from q),
n as (select sum(slots)::bigint as n from l),
g as (select x from (select unnest(range(1, n + 1)) as x, n from n) where gcd(x, n) = 1 order by abs(x - round(n * 0.6180339887498949)), x desc limit 1),
k as (select k, (k::hugeint * (select x from g) % n)::bigint as x from (select unnest(range(0, n)) as k, n from n)),
m as (select k.k as slot, l.*, row_number() over (partition by l.number order by k.k) - 1 as place from k join l on k.x >= l.first and k.x < l.first + l.slots),
b as (select slot, number, place % blocks as block, (place % blocks) * 512 as start, least((place % blocks) * 512 + 512, case when place // blocks = epochs then rest else source_size end) as stop from m),
p as (select row_number() over () as i, d.*, t.number, t.source_size, t.target,
        coalesce(sum(size) over (partition by d.source order by o, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as position
        from d join t on d.source is not distinct from t.source),
c as (select *, unnest(range(position // 512, (position + size - 1) // 512 + 1)) as block from p where size > 0),
o as (select c.i, sum(greatest(0, least(position + size, stop) - greatest(position, start))) as taken, min(slot) filter (least(position + size, stop) > greatest(position, start)) as first_slot
        from c join b on c.number = b.number and c.block = b.block group by c.i)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken, first_slot::bigint as first_slot from p left join o on p.i = o.i"""
