import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.variant import as_map, parse_object
from millrace.operators import dedupe, metrics
from millrace.operators import normalize as N
from millrace.sources.jsonl import parse_lines

BASE = {"code": "12345678", "product_name": "Oats", "brands": "Mill", "nutriments": {"energy-kcal_100g": 370, "proteins_100g": 13}}


def run(spark, *lines):
    lines = [x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines]
    frame = spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")
    rows = N.normalize(parse_lines(frame)).orderBy("line_no").collect()
    return rows if len(rows) > 1 else rows[0]


def test_base_row(spark):
    r = run(spark, BASE)
    assert (r.skip_reason, r.barcode, r.name, r.brand, r.energy_kcal_100g, r.protein_100g, r.product_id, r.source) == (None, "12345678", "Oats", "Mill", 370.0, 13.0, "12345678", N.SOURCE)
    assert (r.category_tags, r.countries, r.nutrition_basis_unit, r.off_last_modified) == ([], [], "", None)


@pytest.mark.parametrize(
    "change, column, expected",
    [
        ({"product_name": None, "product_name_en": "Tea"}, "skip_reason", "missing_name"),
        ({"product_name": "", "generic_name": " Tea "}, "name", "Tea"),
        ({"product_name": " 　Tea\t"}, "name", "Tea"),
        ({"code": 123456789}, "barcode", "123456789"),
        ({"code": "123"}, "skip_reason", "invalid_barcode"),
        ({"code": "12345678x"}, "skip_reason", "invalid_barcode"),
        ({"code": True}, "skip_reason", "invalid_barcode"),
        ({"nutriments": {}}, "skip_reason", "missing_nutrition"),
        ({"nutriments": None, "fat_100g": 1}, "skip_reason", "missing_nutrition"),
        ({"nutriments": {"proteins_100g": "n/a", "protein_100g": 5, "fat": 1}}, "protein_100g", None),
        ({"nutriments": {"fat_100g": -1, "fat_prepared_100g": 2}}, "fat_100g", 2.0),
        ({"nutriments": {"salt": " 1e-1 "}}, "salt_100g", 0.1),
        ({"nutriments": {"salt": "1d", "fat": 1}}, "salt_100g", None),
        ({"nutriments": {"energy-kj_100g": 418.4}}, "energy_kcal_100g", 100.0),
        ({"nutriments": {"energy-kcal_100g": "x", "energy-kj": 418.4}}, "energy_kcal_100g", 100.0),
        ({"countries_tags": "", "countries": "France"}, "countries", []),
        ({"countries_tags": [], "countries": "France"}, "countries", ["france"]),
        ({"countries_tags": ["en:India", "en:United States", "x", 5, None]}, "countries", ["5", "india", "united states", "x"]),
        ({"categories_hierarchy": "b, a;B"}, "category_tags", ["a", "b"]),
        ({"countries_tags": [f"c{i}" for i in range(257)]}, "skip_reason", "validation"),
        ({"nutrition_data_per": "100ml"}, "nutrition_basis_unit", "ml"),
        ({"nutrition_data_per": "serving", "serving_size": "30 ml"}, "nutrition_basis_unit", ""),
        ({"nutrition_data_per": "serving", "serving_quantity_unit": "ml"}, "nutrition_basis_unit", "ml"),
        ({"last_modified_t": 1.9}, "off_last_modified", 1),
        ({"last_modified_t": 1e300}, "off_last_modified", 9223372036854775807),
        ({"serving_quantity": "30.5"}, "serving_quantity", 30.5),
        ({"_id": "", "id": "other"}, "off_product_id", "12345678"),
    ],
)
def test_cases(spark, change, column, expected):
    found = run(spark, BASE | change)[column]
    assert found == (pytest.approx(expected) if isinstance(expected, float) else expected)


def test_top_level_facts_without_nutriments(spark):
    r = run(spark, {"code": "12345678", "product_name": "x", "fat_100g": 1})
    assert (r.skip_reason, r.fat_100g) == (None, 1.0)


def aggregated(per, nutrients, **more):
    return {"code": "12345678", "product_name": "x", "nutrition": {"aggregated_set": {"per": per, "nutrients": nutrients}}} | more


def test_aggregated_set(spark):
    r = run(spark, aggregated("100ml", {"salt": {"value": 270, "unit": "mg"}, "proteins": {"value_computed": 2}, "fat": {"value": 1, "unit": "l"}, "energy-kj": {"value": 418.4, "unit": "KJ"}}))
    assert (r.salt_100g, r.protein_100g, r.fat_100g, r.energy_kcal_100g, r.nutrition_basis_unit) == (pytest.approx(0.27), 2.0, None, pytest.approx(100), "ml")
    assert run(spark, aggregated("100ml", {"proteins": {"value": 2}}, nutrition_data_per="100g")).skip_reason == "missing_nutrition"
    assert run(spark, aggregated("100g", {"energy-kj": {"value": 1, "unit": "kcal"}, "energy": {"value": 418.4, "unit": "kJ"}, "fat": {"value": 1}})).energy_kcal_100g is None
    assert run(spark, aggregated("serving", {"proteins": {"value": 2}})).skip_reason == "missing_nutrition"
    assert run(spark, aggregated("100g", {"salt": {"value": 5, "unit": "μg"}, "sugars": {"value": 5, "unit": " µG"}})).salt_100g == pytest.approx(5e-6)


def test_lines(spark):
    rows = run(spark, "", "{", "[]", "null", "3", '{"a":1} x', '{"code":"1","code":"12345678","product_name":"x","fat_100g":1}', "x" * 10, "  " + json.dumps(BASE) + " \r")
    assert [r.parsed for r in rows] == [False, False, True, True, True, False, True, False, True]
    assert rows[2].skip_reason == "invalid_barcode" and rows[6].skip_reason is None and rows[8].skip_reason is None


def test_oversized_line_is_invalid(spark):
    big = json.dumps(BASE | {"pad": "x" * (16 * 1024 * 1024)})
    rows = run(spark, big, BASE)
    assert [r.parsed for r in rows] == [False, True]


def test_counters(spark):
    frame = spark.createDataFrame([(0, json.dumps(BASE)), (1, "{"), (2, json.dumps(BASE | {"code": "1"})), (3, json.dumps(BASE | {"nutriments": {}})), (4, "")], "line_no long, line string")
    rows = N.normalize(parse_lines(frame)).withColumn("skip_reason", F.when(F.col("parsed"), F.col("skip_reason")))
    c = metrics.ingest_counters(rows).first()
    assert (c.input_lines, c.raw_parsed, c.accepted_products, c.invalid_lines, c.skipped_products) == (5, 3, 1, 2, 2)
    assert (c.skipped_invalid_barcode, c.skipped_missing_name, c.skipped_missing_nutrition, c.skipped_validation) == (1, 0, 1, 0)


def test_empty_input(spark):
    frame = spark.createDataFrame([], "line_no long, line string")
    assert N.normalize(parse_lines(frame)).count() == 0


def test_winner_does_not_depend_on_order(spark):
    lines = [json.dumps(BASE | {"brands": b, "quantity": q}) for b, q in (("", ""), ("B", ""), ("B", "1 kg"), ("A", "1 kg"))]
    winners = set()
    for order in (lines, lines[::-1], lines[2:] + lines[:2]):
        frame = spark.createDataFrame(list(enumerate(order)), "line_no long, line string").repartition(3)
        best = dedupe.best_per_key(N.with_rank(N.normalize(parse_lines(frame)).drop("line_no", "bytes", "parsed"))).collect()
        winners.add((len(best), best[0].brand, best[0].quantity))
    assert winners == {(1, "A", "1 kg")}


def test_rejection_shape(spark):
    line = json.dumps({"nutriments": {"a": 1, "b": 2}, "product_name_fr": "x", "nutrition": {"aggregated_set": {"per": "100g", "nutrients": {"c": 1}}}})
    frame = spark.createDataFrame([(line,), ("[]",)], "line string").select(N.rejection_shape(as_map(parse_object(F.col("line")))).alias("s"))
    assert [r.s for r in frame.collect()] == ["legacy_nutrients=2 aggregate_per=100g aggregate_nutrients=1 localized_names=1", "legacy_nutrients=0 aggregate_per=none aggregate_nutrients=0 localized_names=0"]


def test_canonical_json_keeps_nulls_and_order(spark):
    r = N.with_rank(N.normalize(parse_lines(spark.createDataFrame([(0, json.dumps(BASE))], "line_no long, line string")))).first()
    assert list(json.loads(r.canonical)) == N.COLUMNS and json.loads(r.canonical)["fat_100g"] is None
    assert r["rank"] == 4
