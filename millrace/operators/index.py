"""The release's lookup tables: a store with exact terms, and postings for full-text fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import LIST_SEPARATOR, ascii_lower, unicode_trim
from millrace.operators.normalize import COLUMNS

LISTS = ("category_tags", "countries", "languages")
TEXTS = ("name", "brand", "generic_name")
EXACT = ("product_id", "barcode", "name_exact", "brand_exact", "off_product_id", "source")
#: The stored columns, then the searchable country terms, which are never shown.
FIELDS = ["product_id", "barcode", "name", "name_exact", "brand", "brand_exact", *[c for c in COLUMNS if c not in ("product_id", "barcode", "name", "brand")], "countries_index"]
REQUIRED = [f for f in FIELDS if f not in ("category_tags", "nutrition_basis_unit", "countries_index")]
MAX_TOKEN_BYTES = 40
K1, B = 1.2, 0.75


def documents(products: DataFrame) -> DataFrame:
    """Index rows of products: lists as delimited texts, exact terms in lower case, country terms as an array."""
    special: dict[str, Column] = {c: F.array_join(c, LIST_SEPARATOR) for c in LISTS}
    special |= {"name_exact": ascii_lower(F.col("name")), "brand_exact": ascii_lower(F.col("brand")), "countries_index": F.transform("countries", lambda c: ascii_lower(unicode_trim(c)))}
    return products.select(*[special[f].alias(f) if f in special else F.col(f) for f in FIELDS])


def term_lookup(store: DataFrame, field: str, value: str) -> DataFrame:
    """Stored columns of the rows with this exact term."""
    hit = F.array_contains(field, value) if field == "countries_index" else F.col(field) == value
    return store.where(hit).drop("countries_index")


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of under 40 bytes."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: (t != "") & (F.octet_length(t) < MAX_TOKEN_BYTES))


def occurrences(found: Column, token: str) -> Column:
    return F.size(F.filter(found, lambda t: t == token))


def postings(rows: DataFrame, key: str, text: str) -> DataFrame:
    """token, key, position of every token."""
    return rows.select(key, F.posexplode(tokens(F.col(text))).alias("position", "token")).select("token", key, "position")


def term_statistics(posted: DataFrame, key: str) -> DataFrame:
    """token, documents, occurrences."""
    per = posted.groupBy("token", key).agg(F.count("*").alias("n"))
    return per.groupBy("token").agg(F.count("*").alias("documents"), F.sum("n").alias("occurrences"))


def bm25(rows: DataFrame, key: str, text: str, query: list[str], k: int = 10) -> DataFrame:
    """key, score of the k best rows for a query's distinct terms (an extension: the release format only builds the field)."""
    counted = rows.select(key, tokens(F.col(text)).alias("t"))
    terms = sorted(set(query))
    counted = counted.select(key, F.size("t").alias("size"), *[occurrences(F.col("t"), w).alias(f"tf{i}") for i, w in enumerate(terms)])
    totals = counted.agg(F.count("*").alias("n"), F.avg("size").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    joined = counted.join(F.broadcast(totals), F.lit(True))  # one row
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("size") / F.col("mean")))
    hits = joined.where(F.greatest(*[F.col(f"tf{i}") for i in range(len(terms))], F.lit(0)) > 0)
    return hits.select(key, score.alias("score")).orderBy(F.desc("score"), key).limit(k)
