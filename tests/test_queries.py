import pytest

from millrace.plans import catalog
from tests.helpers import DATA, duck, same


@pytest.fixture(scope="module")
def oracle():
    return duck("sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    found = catalog.QUERIES[name](spark, f"{DATA}/sf0.001")
    same(found, oracle, catalog.ORACLE_SQL[name])


def test_entry_returns_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_best_per_key_shrinks_before_the_shuffle(spark):
    plan = catalog.QUERIES["best_per_key"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_parse_happens_once(spark):
    plan = catalog.products(spark, f"{DATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") <= 2


def test_files_checksum_orders_shared_paths_by_key(spark, tmp_path):
    import hashlib

    keys = [*range(99_990, 100_010), *range(1_000_000, 1_000_100)]  # lpad makes index/part-100000 of 1000000 to 1000009
    rows = [(k, f"name {k * 7919 % 1000}") for k in keys]
    digest = hashlib.sha256()
    for key, name in sorted(rows, key=lambda r: (str(r[0]).zfill(6)[:6], r[0])):
        digest.update(f"index/part-{str(key).zfill(6)[:6]}\0{len(name)}\0{hashlib.sha256(name.encode()).hexdigest()}\n".encode())
    part = spark.createDataFrame(rows, "p_partkey long, p_name string")
    part.coalesce(1).sortWithinPartitions("p_partkey").write.parquet(f"{tmp_path}/a/part.parquet")
    part.repartition(5).sortWithinPartitions(-part.p_partkey).write.parquet(f"{tmp_path}/b/part.parquet")
    for stored in "ab":
        assert [tuple(r) for r in catalog.QUERIES["files_checksum"](spark, f"{tmp_path}/{stored}").collect()] == [(digest.hexdigest(), len(rows))]
