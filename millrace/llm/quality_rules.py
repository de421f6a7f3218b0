"""Quality rules with risk-controlled thresholds (operator 9), in DataFrame functions only.

Every document gets counts (words, symbols, repeated lines, repeated three-word windows) and from them four shares. A
document fails the base rules by too few words or too much repetition. The method's verdict rejects a document whose
share reaches its stratum's cutoff for any rule. Cutoffs come from labelled clean documents held out for this purpose:
the grid of candidate cutoffs is fixed beforehand, so no labelled row shapes the rules. In each stratum (language) a
cutoff is acceptable if the exact binomial test rejects "the true rate of false rejections exceeds the limit", that is
P(Binomial(n, limit) <= k) <= level, which is the same as the upper Clopper-Pearson bound lying below the limit.

Multiple testing: the level is divided by the number of (stratum, rule) pairs; within a pair, cutoffs are tested in a
fixed sequence from the loosest on, stopping at the first failure, which needs no further division. The limit on false
rejections is shared equally by the rules, so that all rules together keep it. A stratum with too few labels to prove
anything gets no cutoff, and its documents pass the method's verdict.

Null text has no words and fails the base rules. Null lang is a stratum of its own. Labels that are null, or of
documents that fail the base rules, take no part; a label repeated for a document counts once. Without labels, only
the base rules reject. Repeated doc_ids are separate rows; other columns are kept where rows are filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import as_row, load, materialize, word_array

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MAX_BROADCAST = 10_000  # strata
#: Cutoffs to test for each rule, loosest first. A document is rejected if its share is the cutoff or more.
GRID = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.015, 0.01),
    "repeat_share": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and the five counts, n_lines and n_upper. Each step is a projection of its own, so nothing is computed twice."""
    whole = F.coalesce(F.col(text), F.lit(""))
    size = F.greatest(F.size("_w") - 2, F.lit(0))
    base = docs.withColumn("_t", whole).withColumn("_w", word_array(F.col("_t")))
    base = base.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda x: F.octet_length(F.translate(x, SPACE, "")) > 0))
    windows = F.arrays_zip(F.slice("_w", F.lit(1), size).alias("a"), F.slice("_w", F.lit(2), size).alias("b"), F.slice("_w", F.lit(3), size).alias("c"), F.slice(F.sequence(F.lit(0), size), F.lit(1), size).alias("p"))
    base = base.withColumn("_s", F.sort_array(F.when(size > 1, windows)))
    same = lambda x, y: (x["b"] == y["b"]) & (x["c"] == y["c"]) & (x["a"] == y["a"])
    twice = F.filter("_s", lambda x, i: F.coalesce(same(x, F.get("_s", i - 1)), F.lit(False)) | F.coalesce(same(x, F.get("_s", i + 1)), F.lit(False)))
    base = base.withColumn("_p", F.sort_array(twice["p"]))
    step = lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(3), p - acc["last"])).alias("total"))
    covered = F.aggregate("_p", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total")), step)["total"]
    return base.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACE, "")).cast("long").alias("word_chars"),
        (F.octet_length("_t") - F.octet_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.octet_length("_t") - F.octet_length(F.translate("_t", UPPER, ""))).cast("long").alias("n_upper"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def shares() -> dict[str, Column]:
    of = lambda x, y: F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(y).cast("double")), F.lit(0.0))
    return {"symbol_share": of("n_symbols", "word_chars"), "repeat_share": of("n_repeat_words", "n_words"), "dup_line_share": of("n_dup_lines", "n_lines"), "upper_share": of("n_upper", "word_chars")}


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(Binomial(n, rate) <= k), summed in logarithms; 1 from the mean on, where no test could succeed."""
    from math import log

    odds = log(rate) - log(1 - rate)
    first = n * log(1 - rate)
    add = lambda a, b: F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))

    def step(acc, j):
        term = acc["term"] + F.log((n - j + 1) / j) + odds
        return F.struct(term.alias("term"), add(acc["total"], term).alias("total"))

    total = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), F.struct(first.alias("term"), first.alias("total")), step)["total"]
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.exp(total))


def thresholds(counted: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = 0.02, level: float = 0.05) -> DataFrame:
    """A row for each stratum: its cutoff for every rule, null where none is proven. counted: documents with counts."""
    clean = labels.where("quality = 1").select("doc_id").distinct()
    # conditions inside the counts: a filter would be pushed below the projections that compute them, and compute them anew
    held = counted.select("doc_id", F.col(stratum).alias("stratum"), (~base_failed()).alias("sound"), *[v.alias(k) for k, v in shares().items()])
    hits = [F.count_if(F.col("sound") & (F.col(rule) >= c)).alias(f"{rule}_{i}") for rule, grid in GRID.items() for i, c in enumerate(grid)]
    # partial aggregation before the shuffle: at most a row for each stratum and task
    counts = held.join(clean, "doc_id", "left_semi").groupBy("stratum").agg(F.count_if("sound").alias("n"), *hits).where("n > 0")
    tests = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{rule}_{i}").alias("k")) for rule, grid in GRID.items() for i, c in enumerate(grid)])
    strata = counts.agg(F.count("*").alias("strata"))  # one row
    tested = counts.join(F.broadcast(strata), F.lit(True))
    tested = tested.select("stratum", "n", "strata", F.explode(tests).alias("t")).select("stratum", "n", "strata", "t.*")
    passed = tested.where(binomial_tail(F.col("n"), F.col("k"), limit / len(GRID)) <= level / (len(GRID) * F.col("strata")))
    # k grows as cutoffs tighten, so what passes is what a fixed sequence reaches
    return passed.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"{r}_cut") for r in GRID])


def verdict(counted: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """counted with base_failed and kept."""
    rejected = F.lit(False)
    for rule, share in shares().items():
        rejected = rejected | F.coalesce(share >= F.col(f"{rule}_cut"), F.lit(False))
    cuts = materialize(cuts.withColumnRenamed("stratum", "_stratum"), "quality-cuts")
    small = cuts.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST  # a row for each stratum with a proven cutoff
    joined = counted.join(F.broadcast(cuts) if small else cuts, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    # one expression over both sides of the join: as a filter it stays above the counts
    return joined.select(*counted.columns, base_failed().alias("base_failed"), F.when(rejected, F.lit(False)).otherwise(~base_failed()).alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, lang, text and others) that the rules keep. Counts are written with the texts, not joined to them."""
    counted = materialize(with_counts(docs.select(as_row(docs), "doc_id", "lang"), "row.text"), "quality-documents")
    return verdict(counted, thresholds(counted, labels)).where("kept").select("row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = materialize(with_counts(load(spark, sf_dir, "documents").select("doc_id", "lang", "text")).drop("text"), "quality-counts")
    cuts = thresholds(counted, load(spark, sf_dir, "labels"))
    return verdict(counted, cuts).select("doc_id", *COUNTS, "base_failed", "kept")


def _sql() -> str:
    rules = {"symbol_share": "n_symbols / word_chars", "repeat_share": "n_repeat_words / n_words", "dup_line_share": "n_dup_lines / n_lines", "upper_share": "n_upper / word_chars"}
    grid = ", ".join(f"('{r}', {c}::double)" for r, g in GRID.items() for c in g)
    share = "case t.rule " + " ".join(f"when '{r}' then coalesce({e}, 0)" for r, e in rules.items()) + " end"
    rate = 0.02 / len(GRID)
    return rf"""
with d as (select doc_id, lang, coalesce(text, '') as t from documents),
w as (select doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
tri as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from w, unnest(range(1, len(w) - 1)) as r(i)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from tri) where n > 1),
covered as (select doc_id, count(distinct i + o) as n from twice, range(3) as r(o) group by doc_id),
counted as (select w.doc_id, lang, len(w)::bigint as n_words,
        coalesce(len(array_to_string(w, '')), 0)::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
        len(l)::bigint as n_lines, (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::bigint as n_upper
        from w left join covered on w.doc_id = covered.doc_id),
based as (select *, (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) as base_failed from counted),
clean as (select * from based where not base_failed and doc_id in (select doc_id from labels where quality = 1)),
grid as (select * from (values {grid}) as g(rule, cutoff)),
k as (select lang, t.rule, t.cutoff, count(*) as n, count(*) filter ({share} >= t.cutoff) as k from clean, grid t group by all),
tail as (select *, case when k >= n * {rate!r} then 1 else
        list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - case when j = 0 then 0 else lgamma(j + 1) end - lgamma(n - j + 1) + j * ln({rate!r}) + (n - j) * ln(1 - {rate!r})))) end as p,
        (select count(distinct coalesce(lang, chr(0))) from clean) as strata from k),
cuts as (select lang, rule, min(cutoff) as cutoff from tail where p <= 0.05 / ({len(GRID)} * strata) group by all),
bad as (select b.doc_id from based b join cuts t on b.lang is not distinct from t.lang where {share} >= t.cutoff group by b.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    (not base_failed and doc_id not in (select doc_id from bad)) as kept from based"""


ORACLE = _sql()
