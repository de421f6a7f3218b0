"""SQL expressions, read alike by Spark and the oracle, that derive raw texts from the tables."""

from __future__ import annotations

KEY = "lpad(cast(l_partkey as string), 8, '0')"
RANK = ("l_quantity > 25", "l_discount > 0.05", "l_returnflag = 'N'", "l_linestatus = 'O'")
CANONICAL = "concat_ws('|', cast(l_orderkey as string), cast(l_linenumber as string), l_returnflag)"

#: Aliases that are missing, null, of another type, or numbers as text; a line that is no object, and one that is no JSON.
ALIASES = """case event_id % 9
    when 0 then props
    when 1 then '{"a": null, "k": ' || cast(user_id as string) || '}'
    when 2 then '{"k": " x' || cast(user_id as string) || ' "}'
    when 3 then '{"a": " 12.5 ", "k": 3}'
    when 4 then '{"a": true, "k": 3}'
    when 5 then '{"b": 1}'
    when 6 then '[1]'
    when 7 then '{"k": 1} x'
    else '{"a": "1e3", "k": ' || cast(event_id as string) || '}' end"""

AMOUNTS = """case event_id % 5
    when 0 then '{"a": -1, "b": ' || cast(user_id as string) || ', "kj": ' || cast(event_id as string) || '}'
    when 1 then '{"b": ' || cast(user_id as string) || ', "kj": 1}'
    when 2 then '{"a": "n/a", "b": 5, "c": ' || cast(event_id as string) || '}'
    when 3 then '{"kj": -4, "c": 2.5}'
    else '{"c": -1}' end"""

EXTRA = """case event_id % 4
    when 0 then props
    when 1 then '{"a": 1, "k": 2}'
    when 2 then '{"k": 1, "x": 2, "y": null}'
    else '{}' end"""

#: One line of six is a valid heartbeat; the others break one rule each.
HEARTBEAT = """'{"runId": "r-' || cast(event_id as string) || '", "runAttempt": "1", "timestamp": "2026-01-0' || case event_id % 6 when 1 then 'x' else '1' end
    || 'T00:00:00Z", "state": "' || case event_id % 6 when 2 then 'done' else 'running' end || '", "phase": "ingest", "counters": {"input_lines": ' || case event_id % 6 when 3 then '"5"' else '5' end
    || ', "compressed_bytes": "3/4", "phase": "x"}, "resources": {"cpuCount": 8, "loadAverage": "1 2 3", "processes": [{"pid": 1, "ppid": null, "state": "R", "elapsed": "01:00", "cpuPercent": 1.5, "memoryPercent": null, "rssKb": '
    || case event_id % 6 when 4 then '1.5' else '10' end || ', "command": "x"}]}' || case event_id % 6 when 5 then ', "extra": 1' else '' end || '}'"""

AGGREGATED = """'{"code": "12345678", "product_name": "x"' || case l_linenumber % 3 when 0 then ', "nutrition_data_per": "100g"' when 1 then ', "nutrition_data_per": "100ml"' else '' end
    || ', "nutrition": {"aggregated_set": {"per": "' || case l_orderkey % 3 when 0 then '100g' when 1 then '100ml' else 'serving' end || '", "nutrients": {"proteins": {"value": ' || cast(l_partkey as string)
    || case l_orderkey % 4 when 0 then ', "unit": "g"' when 1 then ', "unit": "mg"' when 2 then ', "unit": "l"' else '' end || '}}}}}'"""

PATHS = """case p_partkey % 8 when 0 then 'a/b' when 1 then '../a' when 2 then '/a' when 3 then './a' when 4 then 'a/./b' when 5 then '.git/x' when 6 then 'x/dump.jsonl' else 'a..b' end"""
VERSIONS = """case p_partkey % 5 when 0 then '2026-01-17' when 1 then 'fixture_1.0' when 2 then '../unsafe' when 3 then '' else repeat('a', 65) end"""

#: Product lines: malformed, blank and short-coded ones, null and blank names, and nutrients in every state.
PRODUCT = """case when p_partkey % 17 = 0 then '{"code": ' when p_partkey % 19 = 0 then '' when p_partkey % 23 = 0 then '[]' else
    '{"code": "' || case when p_partkey % 11 = 0 then '123' else lpad(cast(p_partkey % 500 as string), 8, '0') end || '", "product_name": '
    || case p_partkey % 7 when 0 then 'null' when 1 then '"  "' else '" ' || p_name || ' "' end
    || ', "generic_name": ' || case p_partkey % 14 when 0 then '""' else '"' || p_type || '"' end
    || ', "brands": "' || p_brand || '", "categories_tags": ["' || p_type || '", 7, null, " X "], "countries": "en:India; ' || p_brand || ',fr:France", "nutrition_data_per": "'
    || case p_partkey % 4 when 0 then '100g' when 1 then '100ml' else 'other' end || '", "last_modified_t": ' || cast(p_partkey * 1000 as string) || ', "nutriments": '
    || case p_partkey % 6 when 0 then '{}' when 1 then '{"proteins_100g": "n/a", "protein_100g": 5, "salt": " 0.5 "}' when 2 then '{"fat_100g": -1, "fat_prepared_100g": ' || cast(p_size as string) || '}'
        when 3 then '{"energy-kj_100g": ' || cast(p_size as string) || ', "sugars_100g": true}' when 4 then 'null' else '{"energy-kcal_100g": ' || cast(p_size as string) || ', "fiber": "2", "saturated-fat_100g": 1.5}' end || '}' end"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The oracle's own normalisation of those lines, from the columns they were made of.
NORMALIZED = f"""
select *, case when not parsed then null when barcode is null or not regexp_full_match(barcode, '[0-9]{{8,32}}') then 'invalid_barcode' when name = '' then 'missing_name'
    when coalesce(energy_kcal_100g, protein_100g, fat_100g, fiber_100g, saturated_fat_100g, salt_100g) is null then 'missing_nutrition' end as skip_reason
from (select line_no, parsed, is_object, kind, p_type, p_size,
    case when is_object then code else '' end as barcode, case when not is_object then '' when own = '' then generic else own end as name, case when is_object then p_brand else '' end as brand, case when is_object then generic else '' end as generic_name,
    case when is_object and kind = 3 then p_size / 4.184 when is_object and kind = 5 then p_size::double end as energy_kcal_100g, null::double as protein_100g, null::double as carbohydrates_100g,
    case when is_object and kind = 2 then p_size::double end as fat_100g, case when is_object and kind = 5 then 2.0::double end as fiber_100g, null::double as sugars_100g,
    case when is_object and kind = 5 then 1.5::double end as saturated_fat_100g, case when is_object and kind = 1 then 0.5::double end as salt_100g,
    case when not is_object then '' when line_no % 4 = 0 then 'g' when line_no % 4 = 1 then 'ml' else '' end as nutrition_basis_unit, case when is_object then line_no * 1000 end as off_last_modified,
    case when is_object then array_to_string(list_sort(list_distinct([{_LOWER.format('p_type')}, '7', 'x'])), '|') else '' end as tags,
    case when is_object then array_to_string(list_sort(list_distinct(['india', {_LOWER.format('p_brand')}, 'france'])), '|') else '' end as countries
    from (select p_partkey as line_no, p_partkey % 17 <> 0 and p_partkey % 19 <> 0 as parsed, p_partkey % 17 <> 0 and p_partkey % 19 <> 0 and p_partkey % 23 <> 0 as is_object, p_partkey % 6 as kind, p_type, p_brand, p_size,
        case when p_partkey % 11 = 0 then '123' else lpad(cast(p_partkey % 500 as string), 8, '0') end as code, case when p_partkey % 7 < 2 then '' else trim(p_name) end as own, case when p_partkey % 14 = 0 then '' else trim(p_type) end as generic from part))"""

RANK_OF_PRODUCT = "(cast(name <> '' as int) + cast(brand <> '' as int) + cast(generic_name <> '' as int) + len(string_split(countries, '|'))::int + (energy_kcal_100g is not null)::int + (fat_100g is not null)::int + (fiber_100g is not null)::int + (saturated_fat_100g is not null)::int + (salt_100g is not null)::int)"

SHAPE = "'legacy_nutrients=' || case when not is_object then 0 else case kind when 0 then 0 when 1 then 3 when 2 then 2 when 3 then 2 when 4 then 0 else 3 end end || ' aggregate_per=none aggregate_nutrients=0 localized_names=0'"
