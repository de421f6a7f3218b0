"""Named queries over the driver's tables, each with its SQL oracle.

Raw product lines, progress lines and the like are derived from the tables by SQL expressions that both engines read,
so that a query and its oracle start from the same text.
"""

from __future__ import annotations

import io
import tarfile
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import release
from millrace.functions import predicates as P
from millrace.functions import text as T
from millrace.functions.variant import as_map, at, list_value, non_negative, number_value, parse_object, string_value, without_prefix
from millrace.operators import dedupe, index, metrics, telemetry
from millrace.operators import normalize as N
from millrace.plans import raw
from millrace.sources import jsonl
from millrace.sources.files import list_files
from millrace.streaming.progress import Progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt to all cores if a scan of one small file would leave most of them idle; large scans stay as they are."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder that driver and executors share, removed after use: below spark.checkpoint.dir, or a temporary one in local mode."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = f"{root or 'file://' + tempfile.mkdtemp(prefix='millrace-')}/plans-{uuid.uuid4().hex[:12]}"
    try:
        yield folder
    finally:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ranked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as rows with a key, a rank and a canonical text."""
    rank = " + ".join(f"cast(({c}) as int)" for c in raw.RANK)
    return table(spark, sf_dir, "lineitem").selectExpr(f"{raw.KEY} as barcode", f"{rank} as rank", f"{raw.CANONICAL} as canonical")


_RANKED = f"select {raw.KEY} as barcode, {' + '.join(f'cast(({c}) as int)' for c in raw.RANK)} as rank, {raw.CANONICAL} as canonical from lineitem"
_BEST = f"select barcode, rank, canonical from (select *, row_number() over (partition by barcode order by rank desc, canonical) as n from ({_RANKED})) where n = 1"


@query(_BEST)
def best_per_key(spark, sf_dir):
    return dedupe.best_per_key(ranked_lines(spark, sf_dir))


@query(f"select sha256(string_agg(canonical || chr(10), '' order by barcode)) as normalized_sha256, count(*) as records from ({_BEST})")
def ordered_stream_sha256(spark, sf_dir):
    best = dedupe.ordered(best_per_key(spark, sf_dir), "barcode")
    best.persist()
    try:
        return spark.createDataFrame([(metrics.stream_sha256(best), best.count())], "normalized_sha256 string, records long")
    finally:
        best.unpersist()


@query(f"select barcode, barcode || chr(0) || lpad(cast(18446744073709551615 - rank as varchar), 20, '0') || chr(0) || canonical as sort_key from ({_BEST})")
def sort_keys(spark, sf_dir):
    best = best_per_key(spark, sf_dir)
    return best.select("barcode", dedupe.sort_key(F.col("barcode"), F.col("rank"), F.col("canonical")).alias("sort_key"))


@query("select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders")
def range_sorted_export(spark, sf_dir):
    return dedupe.ordered(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")


@query("select event_type, event_id, user_id from (select *, row_number() over (partition by event_type order by event_id) as n from events) where n <= 10")
def reject_samples(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id")
    return dedupe.first_per_group(rows, "event_type", ["event_id"], 10)


# ---------------------------------------------------------------- values of schemaless JSON


def _events(spark: SparkSession, sf_dir: str, line: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "events").selectExpr("event_id", f"{line} as line"))
    return rows.select("event_id", parse_object(F.col("line")).alias("value")).select("event_id", "value", as_map(F.col("value")).alias("m"))


_FIRST = f"""
with l as (select event_id, {raw.ALIASES} as line from events),
v as (select event_id, json_valid(line) as ok, case when json_valid(line) and json_type(line) = 'OBJECT' then line::json end as j from l),
f as (select event_id, ok, case when json_exists(j, '$.a') then j -> '$.a' when json_exists(j, '$.k') then j -> '$.k' end as x from v),
t as (select event_id, ok, json_type(x) as k, x ->> '$' as s from f)
select event_id, ok as parsed,
    case when k = 'VARCHAR' then trim(s) when k in ('UBIGINT', 'BIGINT') then s else '' end as text,
    case when k in ('UBIGINT', 'BIGINT', 'DOUBLE') then s::double when k = 'VARCHAR' and regexp_full_match(trim(s), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then trim(s)::double end as number
from t""".replace("\\\\", "\\")


@query(_FIRST)
def json_first_present(spark, sf_dir):
    rows = _events(spark, sf_dir, raw.ALIASES)
    m = F.col("m")
    return rows.select("event_id", F.col("value").isNotNull().alias("parsed"), string_value(m, ["a", "k"]).alias("text"), number_value(m, ["a", "k"]).alias("number"))


_NONNEG = f"""
with l as (select event_id, ({raw.AMOUNTS})::json as j from events),
g as (select event_id, case when json_exists(j, '$.a') then j ->> '$.a' when json_exists(j, '$.b') then j ->> '$.b' end as g1, j ->> '$.kj' as g2, j ->> '$.c' as g3 from l)
select event_id, coalesce(case when try_cast(g1 as double) >= 0 then g1::double end, case when try_cast(g2 as double) >= 0 then g2::double end / 4.184, case when try_cast(g3 as double) >= 0 then g3::double end) as amount
from g"""


@query(_NONNEG)
def json_nonneg_fallback(spark, sf_dir):
    m = F.col("m")
    amount = F.coalesce(non_negative(m, ["a", "b"]), non_negative(m, ["kj"]) / N.KJ_PER_KCAL, non_negative(m, ["c"]))
    return _events(spark, sf_dir, raw.AMOUNTS).select("event_id", amount.alias("amount"))


_SPLIT = "list_sort(list_distinct(list_filter(list_transform(string_split_regex({}, '[,;]'), lambda x: trim(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))), lambda x: x <> '')))"
_LISTS = "p_type || ', ' || p_brand || ';' || lower(p_type) || ';; en:' || p_brand || ', fr:'"


@query(f"""
with l as (select p_partkey, {_SPLIT.format(_LISTS)} as t from part)
select p_partkey, array_to_string(t, '|') as items, array_to_string(list_sort(list_distinct(list_filter(list_transform(t, lambda x: regexp_replace(x, '^[a-z][a-z]:(.)', '\\1')), lambda x: x <> ''))), '|') as countries from l""")
def list_normalize(spark, sf_dir):
    line = F.to_json(F.struct(F.expr(_LISTS).alias("t")))
    rows = table(spark, sf_dir, "part").select("p_partkey", as_map(parse_object(line)).alias("m"))
    items = rows.select("p_partkey", list_value(F.col("m"), ["missing", "t"]).alias("t"))
    return items.select("p_partkey", F.array_join("t", "|").alias("items"), F.array_join(without_prefix(F.col("t")), "|").alias("countries"))


_UNIT = "case l_linenumber % 7 when 0 then '' when 1 then ' G ' when 2 then 'mg' when 3 then 'µg' when 4 then 'UG' when 5 then 'kg' else 'kcal' end"


@query(f"""
with l as (select l_orderkey, l_linenumber, l_quantity as v, trim(lower({_UNIT})) as u from lineitem)
select l_orderkey, l_linenumber, case when u in ('', 'g') then v when u = 'mg' then v / 1000 when u in ('µg', 'ug') then v / 1000000 when u = 'kg' then v * 1000 end as grams,
    case when u in ('', 'kcal') then v else case when l_linenumber % 2 = 0 then v / 4.184 end end as kcal from l""")
def unit_convert(spark, sf_dir):
    unit, v = F.expr(_UNIT), F.col("l_quantity")
    kj_unit = F.when(F.col("l_linenumber") % 2 == 0, F.lit("KJ")).otherwise(F.lit("g"))
    kcal = N.kilocalories(v, T.unicode_trim(unit), v, kj_unit)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.grams(v, unit).alias("grams"), kcal.alias("kcal"))


_PER = "case o_orderkey % 5 when 0 then '100g' when 1 then '100ml' when 2 then 'serving' when 3 then '100G' end"
_SERVING = "case o_custkey % 3 when 0 then 'g' when 1 then 'ml' else '' end"


@query(f"""
with l as (select o_orderkey, {_PER} as p, {_SERVING} as s from orders)
select o_orderkey, coalesce(case p when '100g' then 'g' when '100ml' then 'ml' when 'serving' then case when s in ('g', 'ml') then s end end, '') as unit from l""")
def basis_unit(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(N.legacy_basis(F.expr(_PER), F.expr(_SERVING)), F.lit("")).alias("unit"))


@query("""
select c_custkey, (cast(trim(c_name) <> '' as int) + cast(c_nationkey % 2 = 0 as int) + cast(c_acctbal is not null as int) + len(string_split(c_mktsegment, 'I'))::int) as rank from customer""")
def quality_rank(spark, sf_dir):
    texts = [F.col("c_name"), F.when(F.col("c_nationkey") % 2 == 0, F.lit("x")).otherwise(F.lit(" "))]
    rank = N.quality_rank(texts, [F.split("c_mktsegment", "I")], [F.col("c_acctbal")])
    return table(spark, sf_dir, "customer").select("c_custkey", rank.alias("rank"))


@query("""
select p_partkey, case p_partkey % 4 when 0 then -9223372036854775808 when 1 then 9223372036854775807 when 2 then trunc(p_retailprice)::bigint else 0 end as epoch from part""")
def epoch_clamp(spark, sf_dir):
    x = F.when(F.col("p_partkey") % 4 == 0, F.lit(-1e300)).when(F.col("p_partkey") % 4 == 1, F.lit(1e300)).when(F.col("p_partkey") % 4 == 2, F.col("p_retailprice")).otherwise(F.lit(-0.5))
    return table(spark, sf_dir, "part").select("p_partkey", T.to_epoch(x).alias("epoch"))


# ---------------------------------------------------------------- whole products


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_no, parsed, object of the derived product lines."""
    lines = spread(table(spark, sf_dir, "part").selectExpr("p_partkey as line_no", f"{raw.PRODUCT} as line"))
    value = lines.select("line_no", parse_object(F.col("line")).alias("value"))
    return value.select("line_no", F.col("value").isNotNull().alias("parsed"), as_map(F.col("value")).alias("object"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize(product_lines(spark, sf_dir))


_SHOWN = ["line_no", "barcode", "name", "brand", "generic_name", *N.NUMBERS, "nutrition_basis_unit", "off_last_modified", "skip_reason"]


def _shown(rows: DataFrame, *more) -> DataFrame:
    return rows.select(*_SHOWN, F.array_join("category_tags", "|").alias("tags"), F.array_join("countries", "|").alias("countries"), *more)


_SHOWN_SQL = f"select {', '.join(_SHOWN)}, tags, countries from ({raw.NORMALIZED}) where parsed"


@query(_SHOWN_SQL)
def normalize_products(spark, sf_dir):
    return _shown(products(spark, sf_dir).where("parsed"))


@query(f"select coalesce(skip_reason, case when parsed then 'accepted' else 'invalid' end) as outcome, count(*) as n from ({raw.NORMALIZED}) group by 1")
def skip_reason_counts(spark, sf_dir):
    rows = products(spark, sf_dir)
    outcome = F.when(~F.col("parsed"), F.lit("invalid")).otherwise(F.coalesce("skip_reason", F.lit("accepted")))
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query(f"""
select count(*) as input_lines, count(*) filter (parsed) as raw_parsed, count(*) filter (parsed and skip_reason is null) as accepted_products, count(*) filter (not parsed) as invalid_lines,
    count(*) filter (skip_reason is not null) as skipped_products, {", ".join(f"count(*) filter (skip_reason = '{r}') as skipped_{r}" for r in N.REASONS)} from ({raw.NORMALIZED})""")
def ingest_counters(spark, sf_dir):
    rows = products(spark, sf_dir)
    return metrics.ingest_counters(rows.withColumn("skip_reason", F.when(F.col("parsed"), F.col("skip_reason"))))


@query(f"""
select count(*) as input_lines, sum(strlen({raw.PRODUCT}) + 1)::bigint as input_bytes, count(*) filter (p_partkey % 17 <> 0 and p_partkey % 19 <> 0) as raw_parsed,
    count(*) filter (p_partkey % 17 = 0 or p_partkey % 19 = 0) as invalid_lines, count(*) filter (p_partkey % 17 <> 0 and p_partkey % 19 <> 0 and p_partkey % 23 <> 0) as objects from part""")
def gzip_ingest_counts(spark, sf_dir):
    """The product lines written as gzip JSON lines and read back through the source."""
    with scratch(spark) as folder:
        spread(table(spark, sf_dir, "part").selectExpr(f"{raw.PRODUCT} as value")).write.option("compression", "gzip").text(folder)
        rows = jsonl.parse_lines(jsonl.read_lines(spark, folder))
        counts = rows.agg(F.count("*").alias("input_lines"), F.sum("bytes").alias("input_bytes"), F.count_if("parsed").alias("raw_parsed"), F.count_if(~F.col("parsed")).alias("invalid_lines"), F.count_if(F.col("object").isNotNull()).alias("objects"))
        return spark.createDataFrame(counts.collect(), counts.schema)  # one row


@query(f"""
with a as (select * from ({raw.NORMALIZED}) where parsed and skip_reason is null)
select (select count(*) from part) as input_lines, (select count(*) from a) as accepted, (select count(distinct barcode) from a) as records, (select count(distinct barcode) from a) as verified, true as files_listed, true as archived""")
def release_build(spark, sf_dir):
    """A release of the product lines: built, verified against its manifest, listed, packaged and unpacked."""
    with scratch(spark) as folder:
        spread(table(spark, sf_dir, "part").selectExpr(f"{raw.PRODUCT} as value")).coalesce(1).write.option("compression", "gzip").text(f"{folder}/lines")  # a release reads one file
        (written,) = [f.removeprefix("file://").replace("//", "/") for f in spark.read.text(f"{folder}/lines").inputFiles()]
        local = folder.removeprefix("file://")
        options = release.BuildOptions(written, f"{local}/release", "2026-01-17", artifact=f"{local}/release.tar.zst")
        manifest = release.build_release(spark, options, Progress(output=io.StringIO()))
        verified = release.verify_release(spark, f"{local}/release", Progress(output=io.StringIO()))["recordCount"]
        listed = list_files(spark, f"{local}/release/{release.INDEX}").select("path", "bytes", "sha256").collect()  # a row for each file
        with open(options.artifact, "rb") as raw_file, zstandard.ZstdDecompressor().stream_reader(raw_file) as plain, tarfile.open(fileobj=plain, mode="r|") as tar:
            names = tar.getnames()
        row = (manifest["inputLines"], manifest["acceptedProducts"], manifest["recordCount"], verified, [f["path"] for f in manifest["files"]] == [f["path"] for f in listed], names == [*(f["path"] for f in manifest["files"]), release.MANIFEST])
        return spark.createDataFrame([row], "input_lines long, accepted long, records long, verified long, files_listed boolean, archived boolean")


@query(f"""
select barcode, name, rank from (select *, row_number() over (partition by barcode order by rank desc, line_no) as n
    from (select *, {raw.RANK_OF_PRODUCT} as rank from ({raw.NORMALIZED}) where parsed and skip_reason is null)) where n = 1""")
def dedupe_products(spark, sf_dir):
    # ties go to the first line here, which the oracle can state; releases break them by the canonical text
    rows = N.with_rank(products(spark, sf_dir).where("parsed and skip_reason is null"))
    best = dedupe.best_per_key(rows.select("barcode", "name", "rank", "line_no"), tie="line_no")
    return best.select("barcode", "name", "rank")


@query(f"select line_no, {raw.SHAPE} as shape from ({raw.NORMALIZED}) where parsed")
def rejection_shapes(spark, sf_dir):
    rows = product_lines(spark, sf_dir).where("parsed")
    return rows.select("line_no", N.rejection_shape(F.col("object")).alias("shape"))


@query("""
select n_nationkey, '{"key":' || n_nationkey || ',"name":"' || n_name || '","amount":' || case when n_nationkey % 2 = 0 then 'null' else n_nationkey || '.5' end || ',"tags":["' || lower(n_name) || '"]}' as canonical from nation""")
def canonical_json(spark, sf_dir):
    half = F.when(F.col("n_nationkey") % 2 == 1, F.col("n_nationkey") + F.lit(0.5))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), half.alias("amount"), F.array(F.lower("n_name")).alias("tags"))
    return rows.select("n_nationkey", N.canonical_json(["key", "name", "amount", "tags"]).alias("canonical"))


_AGGREGATED = f"""
with l as (select l_orderkey, l_linenumber, ({raw.AGGREGATED})::json as j, l_linenumber % 7 as k from lineitem),
x as (select *, (j ->> '$.nutrition_data_per') as legacy, (j ->> '$.nutrition.aggregated_set.per') as per, (j ->> '$.nutrition.aggregated_set.nutrients.proteins.value')::double as v, (j ->> '$.nutrition.aggregated_set.nutrients.proteins.unit') as u from l)
select l_orderkey, l_linenumber, case when per in ('100g', '100ml') and (legacy is null or legacy = per) then case when coalesce(u, '') in ('', 'g') then v when u = 'mg' then v / 1000 end end as protein_100g,
    coalesce(case legacy when '100g' then 'g' when '100ml' then 'ml' end, case per when '100g' then 'g' when '100ml' then 'ml' end, '') as unit from x"""


@query(_AGGREGATED)
def aggregated_nutrients(spark, sf_dir):
    lines = spread(table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{raw.AGGREGATED} as line"))
    rows = lines.select("l_orderkey", "l_linenumber", as_map(parse_object(F.col("line"))).alias("object"))
    return N.normalize(rows).select("l_orderkey", "l_linenumber", "protein_100g", F.col("nutrition_basis_unit").alias("unit"))


# ---------------------------------------------------------------- lookups

_STORE = f"select * from ({raw.NORMALIZED}) where parsed and skip_reason is null"


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = products(spark, sf_dir).where("parsed and skip_reason is null")
    return index.documents(accepted)


@query(f"select barcode, name, lower(name) as name_exact, brand, lower(brand) as brand_exact, replace(tags, '|', chr(31)) as category_tags, replace(countries, '|', chr(31)) as countries, nutrition_basis_unit from ({_STORE})")
def index_documents(spark, sf_dir):
    return store(spark, sf_dir).select("barcode", "name", "name_exact", "brand", "brand_exact", "category_tags", "countries", "nutrition_basis_unit")


@query(f"select barcode, name, brand from ({_STORE}) where barcode = '00000007'")
def exact_lookup(spark, sf_dir):
    return index.term_lookup(store(spark, sf_dir), "barcode", "00000007").select("barcode", "name", "brand")


@query(f"select barcode, name from ({_STORE}) where list_contains(string_split(countries, '|'), 'india') and list_contains(string_split(countries, '|'), 'brand#11')")
def country_terms(spark, sf_dir):
    found = store(spark, sf_dir).where(F.array_contains("countries_index", "brand#11"))
    return index.term_lookup(found, "countries_index", "india").select("barcode", "name")


@query(f"select count(*) as documents from ({_STORE})")
def match_all_count(spark, sf_dir):
    return store(spark, sf_dir).agg(F.count("*").alias("documents"))


_TOKENS = r"""list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '' and strlen(t) < 40)"""


@query(f"with t as (select doc_id, {_TOKENS} as t from documents) select doc_id, t[i] as token, (i - 1)::int as position from t, unnest(range(1, len(t) + 1)) as r(i)")
def token_postings(spark, sf_dir):
    return index.postings(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"with t as (select doc_id, unnest({_TOKENS}) as token from documents) select token, count(distinct doc_id) as documents, count(*) as occurrences from t group by token")
def term_df(spark, sf_dir):
    return index.term_statistics(index.postings(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id")


_QUERY = ["the", "license", "version"]
_BM25 = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * size / mean))" for i in range(3))


@query(f"""
with t as (select doc_id, {_TOKENS} as t from documents), c as (select doc_id, len(t) as size, {", ".join(f"len(list_filter(t, lambda x: x = '{w}')) as tf{i}" for i, w in enumerate(sorted(_QUERY)))} from t),
s as (select *, count(*) over () as n, avg(size) over () as mean, {", ".join(f"count(*) filter (tf{i} > 0) over () as df{i}" for i in range(3))} from c)
select doc_id, round({_BM25}, 6) as score from s where greatest(tf0, tf1, tf2) > 0 order by {_BM25} desc, doc_id limit 10""")
def bm25_topk(spark, sf_dir):
    return index.bm25(table(spark, sf_dir, "documents"), "doc_id", "text", _QUERY, 10).select("doc_id", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- validity, files, telemetry


@query(r"""
select doc_id, regexp_extract(text, '[0-9]+') as digits, regexp_full_match(regexp_extract(text, '[0-9]+'), '[0-9]{8,32}') as valid from documents""")
def barcode_filter(spark, sf_dir):
    digits = F.regexp_extract("text", "[0-9]+", 0)
    return table(spark, sf_dir, "documents").select("doc_id", digits.alias("digits"), P.valid_barcode(digits).alias("valid"))


@query(rf"""
with l as (select p_partkey, {raw.PATHS} as path, {raw.VERSIONS} as version, case p_partkey % 3 when 0 then sha256(p_name) when 1 then upper(sha256(p_name)) else substr(sha256(p_name), 2) end as sha from part)
select p_partkey, not (path like '/%' or regexp_matches(path, '(^|/)\.\.(/|$)') or regexp_matches(path, '^\.(/|$)')) as safe_path, regexp_full_match(version, '[A-Za-z0-9][A-Za-z0-9_.-]*') and length(version) <= 64 as version_ok, length(sha) = 64 as sha_ok,
    not regexp_matches(path, '^(\.git|target|\.build)/|\.jsonl$|\.jsonl\.gz$|\.tar\.zst$') as exported from l""")
def path_checks(spark, sf_dir):
    sha = F.sha2(F.col("p_name"), 256)
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(raw.PATHS).alias("path"), F.expr(raw.VERSIONS).alias("version"), F.when(F.col("p_partkey") % 3 == 0, sha).when(F.col("p_partkey") % 3 == 1, F.upper(sha)).otherwise(F.substring(sha, 2, 64)).alias("sha"))
    return rows.select("p_partkey", P.safe_relative_path(F.col("path")).alias("safe_path"), P.valid_dataset_version(F.col("version")).alias("version_ok"), P.valid_sha256(F.col("sha")).alias("sha_ok"), P.exported(F.col("path")).alias("exported"))


@query("""
with f as (select 'index/part-' || lpad(cast(p_partkey as string), 6, '0') as path, strlen(p_name) as bytes, sha256(p_name) as sha256 from part)
select sha256(string_agg(path || chr(0) || bytes || chr(0) || sha256 || chr(10), '' order by path)) as index_sha256, count(*) as files from f""")
def files_checksum(spark, sf_dir):
    files = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("index/part-"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("path"), F.octet_length("p_name").alias("bytes"), F.sha2("p_name", 256).alias("sha256"))
    # lpad cuts keys from 1,000,000 on, and several share a path: the SQL leaves their order open, here it is that of keys
    lines = dedupe.ordered(files, "path", "p_partkey", "bytes", "sha256").select(F.concat_ws("\x00", "path", F.col("bytes").cast("string"), "sha256").alias("line"))
    lines.persist()
    try:
        return spark.createDataFrame([(metrics.stream_sha256(lines, "line"), lines.count())], "index_sha256 string, files long")
    finally:
        lines.unpersist()


@query("""
with m as (select p_partkey, strlen(p_name) as bytes, sha256(case when p_partkey % 10 = 0 then upper(p_name) else p_name end) as sha from part),
f as (select p_partkey, strlen(p_name) as bytes, sha256(p_name) as sha from part where p_partkey % 7 <> 0)
select m.p_partkey, case when f.p_partkey is null then 'missing' when f.bytes <> m.bytes then 'size' when f.sha <> m.sha then 'checksum' else 'ok' end as state from m left join f on m.p_partkey = f.p_partkey""")
def manifest_check(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 10 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    manifest = part.select("p_partkey", F.octet_length("p_name").alias("bytes"), F.sha2(name, 256).alias("sha"))
    files = part.where("p_partkey % 7 <> 0").select("p_partkey", F.octet_length("p_name").alias("_bytes"), F.sha2("p_name", 256).alias("_sha"))
    state = F.when(F.col("_sha").isNull(), F.lit("missing")).when(F.col("_bytes") != F.col("bytes"), F.lit("size")).when(F.col("_sha") != F.col("sha"), F.lit("checksum")).otherwise(F.lit("ok"))
    return manifest.join(files, "p_partkey", "left").select("p_partkey", state.alias("state"))


@query(r"select doc_id, regexp_matches(text, '(BEGIN (RSA|OPENSSH|EC|DSA) PRIVATE KEY)|(gho_[A-Za-z0-9_]+)|(github_pat_[A-Za-z0-9_]+)') as found, regexp_matches(text, '(?i)token') as named from documents")
def secret_scan(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", P.has_secret(F.col("text")).alias("found"), P.has_secret(F.col("text"), ("(?i)token",)).alias("named"))


_LINE = "case event_id % 9 when 0 then 'other phase=x' else 'P  phase=' || event_type || ' records=' || cast(user_id as string) || ' rate=-' || cast(event_id as string) || '.50 flag bytes=' || cast(event_id as string) || '/9 records=' || cast(event_id as string) || ' eq=a=b' end"


@query(f"""
with l as (select event_id, event_type, {_LINE} as line from events)
select event_id, case when line like 'P%' then event_type end as phase, case when line like 'P%' then event_id::double end as records, case when line like 'P%' then -(event_id + 0.5)::double end as rate, case when line like 'P%' then event_id || '/9' end as bytes, case when line like 'P%' then 'a=b' end as eq,
    case when line like 'P%' then 5 else 0 end as fields from l""")
def progress_parse(spark, sf_dir):
    lines = spread(table(spark, sf_dir, "events").select("event_id", F.expr(_LINE).alias("line")))
    rows = lines.select("event_id", telemetry.progress_fields(F.col("line"), "P").alias("f"))
    text = lambda k: F.try_element_at("f", F.lit(k))
    return rows.select("event_id", text("phase").alias("phase"), telemetry.progress_number(F.col("f"), "records").alias("records"), telemetry.progress_number(F.col("f"), "rate").alias("rate"), text("bytes").alias("bytes"), text("eq").alias("eq"), F.size("f").alias("fields"))


@query("select event_id, case event_type when '' then 'unknown' else regexp_replace(substr(event_type || ' ' || props, 1, 32), '[^A-Za-z0-9_-]', '_', 'g') end as phase, coalesce(user_id::double / nullif(event_id % 4, 0), 0) as throughput from events")
def phase_names(spark, sf_dir):
    phase = T.phase_name(F.concat_ws(" ", "event_type", "props"))
    return table(spark, sf_dir, "events").select("event_id", phase.alias("phase"), T.throughput(F.col("user_id"), F.col("event_id") % 4).alias("throughput"))


@query(f"select event_id, len(list_filter(json_keys(({raw.EXTRA})::json), lambda k: k not in ('k', 'a'))) as unknown from events")
def closed_schema_check(spark, sf_dir):
    rows = _events(spark, sf_dir, raw.EXTRA)
    return rows.select("event_id", F.size(telemetry.unknown_keys(F.col("m"), ["k", "a"])).cast("long").alias("unknown"))


@query("select event_id, event_id % 6 = 0 as valid from events")
def heartbeat_checks(spark, sf_dir):
    lines = spread(table(spark, sf_dir, "events").select("event_id", F.expr(raw.HEARTBEAT).alias("line")))
    return lines.select("event_id", telemetry.heartbeat_valid(F.col("line")).alias("valid"))


@query("select sha256(string_agg(path || ' ' || bytes, ',' order by path)) as listing, sum(bytes)::bigint as bytes from (select 'a/' || r_regionkey as path, strlen(r_name) as bytes from region)")
def directory_listing(spark, sf_dir):
    rows = table(spark, sf_dir, "region").select(F.concat(F.lit("a/"), F.col("r_regionkey").cast("string")).alias("path"), F.octet_length("r_name").alias("bytes"))
    listed = rows.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "bytes"))), lambda x: F.concat_ws(" ", x["path"], x["bytes"].cast("string"))), ","), 256).alias("listing"), F.sum("bytes").cast("long").alias("bytes"))
    return listed


__all__ = ["ORACLE_SQL", "QUERIES", "at"]
