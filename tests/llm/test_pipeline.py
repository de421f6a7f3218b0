"""Each stage of the pipeline against a plain version of what it must do to its own input."""

import corpus_pipeline
from millrace.llm import common
from tests.helpers import DATA
from tests.llm import brute

SF = f"{DATA}/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    outputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outputs.append(common.materialize(stage(spark, outputs[-1], SF), name))
    raw, sound, single, stripped, mixed, packed = outputs
    assert all(o.columns == names for o in outputs[:-1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, kept = ({r.doc_id: r.text for r in o.collect()} for o in (raw, sound))
    assert all(len(brute.words(t)) >= 50 for t in kept.values())
    clean = [d for d, q in labels.items() if q == 1 and len(brute.words(before[d])) >= 50]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)
    want = brute.components(list(kept.items()), 5, 80)
    one = {r.doc_id: r.text for r in single.collect()}
    assert one == {d: t for d, t in kept.items() if want[d][1] == d}
    cut = brute.strip(list(one.items()))
    less = {r.doc_id: r.text for r in stripped.collect()}
    assert less == {d: cut[d][2].decode() if cut[d][1] else t for d, t in one.items()}
    sizes, taken = {d: len(brute.words(t)) for d, t in less.items()}, {}
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(brute.words(r.text))
    assert all(n <= 3 * sizes[d] for d, n in taken.items()) and abs(sum(taken.values()) - sum(sizes.values())) < 50
    spans = {}
    for r in packed.collect():
        spans[r.sequence_id] = spans.get(r.sequence_id, 0) + r.length
        assert len(r.ids) == 4 * r.length
    assert max(spans.values()) <= 2048
