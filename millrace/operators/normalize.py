"""Raw product objects to the fixed product row, or the first reason for leaving them out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import valid_barcode
from millrace.functions.text import LIST_SEPARATOR, ascii_lower, to_epoch, unicode_trim
from millrace.functions.variant import as_map, at, first_items, first_present, items_of, kind, number_of, present, raw_string, string_of, without_prefix

SOURCE = "openfoodfacts"  # fixed value of the source column
MAX_LIST = 256
KJ_PER_KCAL = 4.184

#: The keys of each nutrient, in groups that are tried in order, and its name in the aggregated set.
NUTRIENTS = {
    "protein_100g": ([["proteins_100g", "protein_100g", "proteins"], ["proteins_prepared_100g", "protein_prepared_100g"]], "proteins"),
    "carbohydrates_100g": ([["carbohydrates_100g", "carbohydrates_value", "carbohydrates"], ["carbohydrates_prepared_100g"]], "carbohydrates"),
    "fat_100g": ([["fat_100g", "fat_value", "fat"], ["fat_prepared_100g"]], "fat"),
    "fiber_100g": ([["fiber_100g", "fiber"], ["fiber_prepared_100g"]], "fiber"),
    "sugars_100g": ([["sugars_100g", "sugars"], ["sugars_prepared_100g"]], "sugars"),
    "saturated_fat_100g": ([["saturated-fat_100g", "saturated_fat_100g", "saturated-fat"], ["saturated-fat_prepared_100g", "saturated_fat_prepared_100g"]], "saturated-fat"),
    "salt_100g": ([["salt_100g", "salt"], ["salt_prepared_100g"]], "salt"),
}
NUMBERS = ["energy_kcal_100g", *NUTRIENTS]
#: The product row, in the order of its canonical JSON.
PRODUCT = (
    "product_id string, barcode string, name string, brand string, generic_name string, category_tags array<string>, energy_kcal_100g double, protein_100g double, "
    "carbohydrates_100g double, fat_100g double, fiber_100g double, sugars_100g double, saturated_fat_100g double, salt_100g double, nutrition_basis_unit string, "
    "serving_size string, serving_quantity double, quantity string, countries array<string>, languages array<string>, image_url string, off_product_id string, off_last_modified bigint, source string"
)
COLUMNS = [part.split(" ")[0] for part in PRODUCT.split(", ")]
REASONS = ("invalid_barcode", "missing_name", "missing_nutrition", "validation")


def basis_of(unit: Column) -> Column:
    return F.when(unit == "100g", F.lit("g")).when(unit == "100ml", F.lit("ml"))


def legacy_basis(data_per: Column, serving_unit: Column) -> Column:
    """g, ml or null from the legacy fields; a serving counts with its explicit unit alone."""
    return F.when(data_per == "serving", F.when(serving_unit.isin("g", "ml"), serving_unit)).otherwise(basis_of(data_per))


def grams(value: Column, unit: Column) -> Column:
    """An amount in grams; null in a unit that is no mass."""
    u = ascii_lower(unicode_trim(unit))
    return F.when(u.isin("", "g"), value).when(u == "mg", value / 1e3).when(u.isin("µg", "μg", "ug"), value / 1e6).when(u == "kg", value * 1e3)


def kilocalories(kcal: Column, kcal_unit: Column, kj: Column, kj_unit: Column) -> Column:
    """Energy from an amount in kcal, else from one in kJ; a kJ amount in another unit gives null."""
    return F.coalesce(F.when(ascii_lower(kcal_unit).isin("", "kcal"), kcal), F.when(ascii_lower(kj_unit) == "kj", kj / KJ_PER_KCAL))


def quality_rank(texts: list[Column], lists: list[Column], numbers: list[Column]) -> Column:
    """How much of a product is filled in."""
    parts = [F.when(F.coalesce(unicode_trim(t), F.lit("")) != "", 1).otherwise(0) for t in texts]
    parts += [F.greatest(F.size(x), F.lit(0)) for x in lists] + [n.isNotNull().cast("int") for n in numbers]
    return reduce(lambda a, b: a + b, parts)


def canonical_json(columns: list[str] = COLUMNS) -> Column:
    """The product as one JSON text, keys in declared order, nulls printed."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def rejection_shape(m: Column) -> Column:
    """What a rejected object holds, as a line of counts."""
    aggregate = as_map(at(as_map(at(m, "nutrition")), "aggregated_set"))
    keys = lambda c: F.coalesce(F.size(F.map_keys(c)), F.lit(0))
    size = lambda c: F.when(c.isNull(), F.lit(0)).otherwise(keys(c))
    names = F.coalesce(F.size(F.filter(F.map_keys(m), lambda k: k.startswith("product_name_"))), F.lit(0))
    names = F.when(m.isNull(), F.lit(0)).otherwise(names)
    return F.format_string(
        "legacy_nutrients=%d aggregate_per=%s aggregate_nutrients=%d localized_names=%d",
        size(as_map(at(m, "nutriments"))), F.coalesce(raw_string(at(aggregate, "per")), F.lit("none")), size(as_map(at(aggregate, "nutrients"))), names,
    )


class _Steps:
    """Columns that later steps build on, by step: picked values, then what they are as texts, numbers and lists."""

    def __init__(self):
        self.picked: dict[str, Column] = {}
        self.typed: dict[str, Column] = {}

    def pick(self, m: Column, keys: list[str]) -> Column:
        self.picked[name := f"_v{len(self.picked)}"] = first_present(m, keys)
        return F.col(name)

    def type(self, value: Column) -> Column:
        self.typed[name := f"_t{len(self.typed)}"] = value
        return F.col(name)

    def string(self, m: Column, *keys: str) -> Column:
        return self.type(string_of(self.pick(m, list(keys))))

    def text(self, m: Column, key: str) -> Column:
        return self.type(raw_string(self.pick(m, [key])))

    def amount(self, m: Column, *keys: str) -> Column:
        """First present, null if it is negative."""
        x = self.type(number_of(self.pick(m, list(keys))))
        return F.when(x >= 0, x)

    def items(self, m: Column, *keys: str) -> Column:
        return first_items([self.type(items_of(self.pick(m, [k]))) for k in keys])

    def aggregated(self, name: str) -> tuple[Column, Column]:
        """Value and unit of a nutrient of the aggregated set; value is null where it doesn't apply."""
        nutrient = F.col(f"_a_{name}")
        return F.when(F.col("_usable"), self.amount(nutrient, "value", "value_computed")), F.coalesce(self.text(nutrient, "unit"), F.lit(""))


def normalize(objects: DataFrame, source: str = SOURCE) -> DataFrame:
    """objects (object: map<string, variant>, other columns) to other columns, the product's columns and skip_reason.

    Steps are projections of their own: values are picked from the object once, then typed once, and only plain columns
    leave this operator. The keys below, and the order in which they are tried, are fixed values.
    """
    m = F.col("object")
    keep = [c for c in objects.columns if c != "object"]
    one = objects.withColumns({"_facts": F.when(present(m, "nutriments"), as_map(at(m, "nutriments"))).otherwise(m), "_set": as_map(at(as_map(at(m, "nutrition")), "aggregated_set"))})
    one = one.withColumns({"_nutrients": as_map(at(F.col("_set"), "nutrients")), "_per": raw_string(at(F.col("_set"), "per"))})
    names = ["energy-kcal", "energy-kj", "energy", *[name for _, name in NUTRIENTS.values()]]
    one = one.withColumns({f"_a_{name}": as_map(at(F.col("_nutrients"), name)) for name in names})
    f, steps = F.col("_facts"), _Steps()
    legacy = steps.type(legacy_basis(raw_string(steps.pick(m, ["nutrition_data_per"])), raw_string(steps.pick(m, ["serving_quantity_unit"]))))
    kcal, kcal_unit = steps.aggregated("energy-kcal")
    (kj, kj_unit), (energy, energy_unit) = steps.aggregated("energy-kj"), steps.aggregated("energy")
    some_kj, some_unit = F.coalesce(kj, energy), F.when(kj.isNotNull(), kj_unit).otherwise(energy_unit)
    columns = {
        "barcode": steps.string(m, "code", "barcode", "_id"),
        "_name": steps.string(m, "product_name", "product_name_en", "product_name:en", "name"),
        "brand": steps.string(m, "brands", "brand_owner", "brand"),
        "generic_name": steps.string(m, "generic_name", "generic_name_en"),
        "category_tags": steps.items(m, "categories_tags", "categories_hierarchy"),
        "energy_kcal_100g": F.coalesce(
            steps.amount(f, "energy-kcal_100g", "energy-kcal_value", "energy-kcal"),
            steps.amount(f, "energy-kj_100g", "energy-kj") / KJ_PER_KCAL,
            steps.amount(f, "energy-kcal_prepared_100g", "energy-kcal_prepared_value", "energy-kcal_prepared"),
            steps.amount(f, "energy-kj_prepared_100g", "energy-kj_prepared") / KJ_PER_KCAL,
            kilocalories(kcal, kcal_unit, some_kj, some_unit),
        ),
        **{c: F.coalesce(*[steps.amount(f, *g) for g in groups], grams(*steps.aggregated(name))) for c, (groups, name) in NUTRIENTS.items()},
        "nutrition_basis_unit": F.coalesce(legacy, basis_of(F.col("_per")), F.lit("")),
        "serving_size": steps.string(m, "serving_size", "serving_size_en"),
        "serving_quantity": steps.amount(m, "serving_quantity", "serving_quantity_value"),
        "quantity": steps.string(m, "quantity"),
        "countries": without_prefix(steps.items(m, "countries_tags", "countries")),
        "languages": steps.items(m, "languages_codes", "languages"),
        "image_url": steps.string(m, "image_front_url", "image_front_small_url"),
        "_off": steps.string(m, "_id", "id", "code"),
        "off_last_modified": to_epoch(steps.type(number_of(steps.pick(m, ["last_modified_t", "last_modified"])))),
    }
    picked = one.select(*keep, "_per", *[v.alias(k) for k, v in steps.picked.items()])
    typed = picked.select(*keep, "_per", *[v.alias(k) for k, v in steps.typed.items()])
    usable = basis_of(F.col("_per")).isNotNull() & F.coalesce(legacy == basis_of(F.col("_per")), F.lit(True))
    two = typed.withColumn("_usable", usable).select(*keep, *[v.alias(k) for k, v in columns.items()])
    own = F.when(F.col("_off") == "", F.col("barcode")).otherwise(F.col("_off"))
    name = F.when(F.col("_name") == "", F.col("generic_name")).otherwise(F.col("_name"))
    three = two.withColumn("name", name).withColumn("off_product_id", own).withColumn("product_id", own).withColumn("source", F.lit(source))
    lists = reduce(lambda a, b: a | b, [F.size(c) > MAX_LIST for c in ("category_tags", "countries", "languages")])
    infinite = reduce(lambda a, b: a | b, [F.coalesce(F.isnan(c) | (F.col(c) == float("inf")), F.lit(False)) for c in [*NUMBERS, "serving_quantity"]])
    reason = (
        F.when(~valid_barcode(F.col("barcode")), F.lit(REASONS[0]))
        .when(F.col("name") == "", F.lit(REASONS[1]))
        .when(F.coalesce(*NUMBERS).isNull(), F.lit(REASONS[2]))
        .when(lists | infinite, F.lit(REASONS[3]))
    )
    # one struct for each row through a generator: filters on the result stay above it, instead of being pushed down with all
    # these expressions inlined into them
    return three.select(F.inline(F.array(F.struct(*keep, *COLUMNS, reason.alias("skip_reason")))))


def with_rank(products: DataFrame) -> DataFrame:
    """products with rank and canonical, which order the rows of a barcode."""
    texts = ["name", "brand", "generic_name", "serving_size", "quantity", "image_url"]
    rank = quality_rank([F.col(c) for c in texts], [F.col("countries"), F.col("languages")], [F.col(c) for c in NUMBERS])
    return products.withColumn("rank", rank).withColumn("canonical", canonical_json())


__all__ = ["COLUMNS", "LIST_SEPARATOR", "PRODUCT", "first_present", "kind", "normalize", "number_of", "with_rank"]
