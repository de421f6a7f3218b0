"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from millrace.llm.ngram_join import op10_ngram_join
from millrace.llm.packing import op1_pack
from millrace.llm import license_scan, mixing, quality_rules
from millrace.llm.ann import op2_ann
from millrace.llm.license_scan import op8_license_scan
from millrace.llm.mixing import op7_mixing
from millrace.llm.quality_gam import op3_quality_gam
from millrace.llm.quality_rules import op9_quality_rules
from millrace.llm.substring_dedup import op4_substring_dedup
from millrace.llm.token_histogram import op5_token_histogram
from millrace.llm.token_ids import op6_token_ids

QUERIES = {
    "op1_pack": op1_pack,
    "op2_ann": op2_ann,
    "op3_quality_gam": op3_quality_gam,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_histogram": op5_token_histogram,
    "op6_token_ids": op6_token_ids,
    "op7_mixing": op7_mixing,
    "op10_ngram_join": op10_ngram_join,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
}

_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP4 = f"""
with w as (select doc_id, {_WORDS.format("coalesce(text, '')")} as words from documents),
windows as (
    select doc_id, i, array_to_string(words[i : i + 49], ' ') as passage
    from (select doc_id, words, unnest(range(1, len(words) - 48)) as i from w where len(words) >= 50)),
firsts as (select passage, min(doc_id) as first_doc from windows group by passage),
gone as (
    select distinct doc_id, i + unnest(range(0, 50)) as i
    from windows join firsts using (passage) where doc_id > first_doc),
kept as (
    select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n
    from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from w) anti join gone using (doc_id, i)
    group by doc_id)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join kept using (doc_id)
"""

OP10 = f"""
with recursive w as (
    select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as words from documents),
elements as (
    select distinct doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as shingle
    from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w where len(words) >= 3)
    union all select doc_id, array_to_string(words, ' ') from w where len(words) between 1 and 2),
sizes as (select doc_id, count(*) as n from elements group by doc_id),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as n
    from elements x join elements y on x.shingle = y.shingle and x.doc_id < y.doc_id group by all),
links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * shared.n >= 90 * (x.n + y.n - shared.n)),
edges as (select a, b from links union all select b, a from links),
reached as (select a, b from edges union select r.a, e.b from reached r join edges e on r.b = e.a)
select w.doc_id, coalesce(any_value(sizes.n), 0) as n_shingles, least(w.doc_id, coalesce(min(reached.b), w.doc_id)) as component_id
from w left join sizes using (doc_id) left join reached on reached.a = w.doc_id group by w.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": OP4,
    "op7_mixing": mixing.ORACLE,
    "op8_license_scan": license_scan.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op10_ngram_join": OP10,
}
