import pytest
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.functions import text as T
from millrace.operators import index, telemetry


def values(spark, expr, *xs):
    frame = spark.createDataFrame(list(enumerate(xs)), "i int, x string").select("i", expr(F.col("x")).alias("y"))
    return [r.y for r in frame.orderBy("i").collect()]


def test_paths_and_versions(spark):
    assert values(spark, P.safe_relative_path, "a/b", "a..b", "a/./b", "", "../a", "/a", "./a", ".", "a/..", None) == [True, True, True, True, False, False, False, False, False, False]
    assert values(spark, P.valid_dataset_version, "2026-01-17", "fixture_1.0", "../x", "", "a" * 64, "a" * 65, None) == [True, True, False, False, True, False, False]
    assert values(spark, P.valid_sha256, "a" * 64, "A" * 64, "g" * 64, "a" * 63, None) == [True, True, False, False, False]


def test_barcodes(spark):
    assert values(spark, P.valid_barcode, "12345678", " 12345678 ", "1234567", "1" * 32, "1" * 33, "1234567٠", "12345678\n1", None) == [True, True, False, True, False, False, False, False]


def test_secrets_and_exports(spark):
    assert values(spark, P.has_secret, "-----BEGIN RSA PRIVATE KEY-----", "gho_abc", "ghp_abc", "", None) == [True, True, False, False, False]
    assert values(spark, P.exported, "a.py", ".git/x", "x.jsonl", "tests/fixtures/products.jsonl.gz", "o/b.tar.zst", "target/a") == [True, False, False, True, False, False]


def test_text(spark):
    assert values(spark, T.unicode_trim, "\t a b　", "", None) == ["a b", "", None]
    assert values(spark, T.ascii_lower, "ÉA") == ["Éa"]
    assert values(spark, T.parse_number, " 1.5 ", "1d", "0x1p3", ".5", "5.", "+1e2", "1e999", "nan", "") == [1.5, None, None, 0.5, 5.0, 100.0, None, None, None]
    assert values(spark, T.phase_name, "a b", "", None, "x" * 40) == ["a_b", "unknown", "unknown", "x" * 32]


def test_progress_line(spark):
    line = "P phase=a n=-1.5 share=1/2 eq=a=b n=2 junk"
    fields = values(spark, lambda c: telemetry.progress_fields(c, "P"), line, "other n=1", "P", None)
    assert fields[0] == {"phase": "a", "share": "1/2", "eq": "a=b", "n": "2"} and fields[1] == {} and fields[2] == {}


def test_tokens(spark):
    assert values(spark, index.tokens, "A-b Été, x9 " + "y" * 40, "", None) == [["a", "b", "été", "x9"], [], []]


GOOD = '{"runId":"r","runAttempt":"1","timestamp":"2026-01-01T00:00:00Z","state":"running","phase":"p","counters":{"input_lines":1,"compressed_bytes":"1/2"},"resources":{"cpuCount":8}}'


@pytest.mark.parametrize("change, ok", [(None, True), (('"1/2"', '"x"'), False), (('"cpuCount":8', '"cpuCount":"8"'), False), (('"cpuCount":8', '"processes":3'), False), (('"phase":"p"', '"phase":5'), False), (("}}", '},"exitCode":1.5}'), False), (("}}", '},"exitCode":1}'), True), (("}}", '},"more":1}'), False)])
def test_heartbeat(spark, change, ok):
    assert values(spark, telemetry.heartbeat_valid, GOOD.replace(*change) if change else GOOD) == [ok]


def test_bm25_prefers_rarer_terms(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, "a"), (4, None)], "k int, t string")
    assert [r.k for r in index.bm25(rows, "k", "t", ["a", "b"], 3).collect()] == [1, 3, 2]
    assert index.bm25(rows.limit(0), "k", "t", ["a"], 3).collect() == []
