"""A corpus pipeline over documents: quality rules, near copies, repeated passages, source mix, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next one's docs. All stages but the last return the columns of documents:

1. quality_rules drops the documents that operator 9 rejects, with thresholds learned from labels for what it is given.
2. near_copies keeps the document with the smallest doc_id of each component that operator 10 finds: documents whose
   five-word shingle sets have a Jaccard similarity of 0.8 or more, and whatever such links join.
3. repeated_passages removes from texts what operator 4 finds repeated from earlier documents. Texts that lose all
   their words stay as empty ones.
4. source_mix takes documents as operator 7 mixes their sources: repeated for whole passes, cut where a pass ends, left
   out where the mix has no room; in the order of its slots, each partition a range of slots. Empty texts have no words
   to take.
5. packed cuts the mix into sequences with operator 1, and returns their pieces with their token ids.

Each stage writes tables that its lazy result reads. run() removes them when the stage's rows are written. Called one by
one, a stage removes what the latest call of the stage before it on the same sf_dir has left, so that result must have
been written by then.

Null and repeated doc_ids, null texts and empty tables are handled as the operators state: a document with a null
doc_id, if it passes the rules, is in no component and stays. Each stage keeps other columns as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import as_row, discard, load, materialize, recording, remove
from millrace.llm.mixing import mix_documents
from millrace.llm.ngram_join import join_components
from millrace.llm.packing import pack
from millrace.llm.quality_rules import filter_documents
from millrace.llm.substring_dedup import strip_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_documents(docs, load(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = join_components(docs, n=5, percent=80)
    # a document goes if its component has a smaller doc_id; of rows that share a doc_id all stay or go
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.select(as_row(docs)).join(gone, F.col("row.doc_id") == gone["doc_id"], "left_anti").select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return strip_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


_FUNCTIONS = (quality_rules, near_copies, repeated_passages, source_mix, packed)
_left: dict[tuple[str, str, int], list[str]] = {}  # by application, sf_dir and stage: tables of its latest call


def _stage(number: int):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        for path in _left.pop((application, sf_dir, number - 1), []):
            remove(spark, path)
        with recording() as made:
            out = _FUNCTIONS[number](spark, docs, sf_dir)
        _left[application, sf_dir, number] = made
        return out

    return run_stage


STAGES = [(f.__name__, _stage(k)) for k, f in enumerate(_FUNCTIONS)]

#: SQL has neither the tokenizer's ids nor the choice of cuts, so the rows are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents."""
    docs, before = load(spark, sf_dir, "documents"), None
    for function in _FUNCTIONS:
        with recording() as made:
            out = function(spark, docs, sf_dir)
        docs = materialize(out, f"pipeline-{function.__name__}")
        for path in made:
            remove(spark, path)
        if before is not None:
            discard(before)
        before = docs
    return docs
