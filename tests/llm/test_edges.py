"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import ann, common, license_scan, mixing, ngram_join, packing, quality_gam, quality_rules, substring_dedup, token_histogram, token_ids
from millrace.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th long, _w string, row string, n_words string, taken int"


def text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(("alpha", "beta", "gamma", "delta", "rho")) + str(r.randrange(400)) + r.choice(("", "", "", ".")) for _ in range(n))


PASSAGE = text(99, 60)
TEXTS = [
    (1, text(1, 120)), (2, text(1, 120)), (3, text(1, 119) + " changed"), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "ONE"), (9, "one two"), (10, "a b  c\x1cd\n\n e"),
    (11, text(2, 80) + " " + PASSAGE), (12, PASSAGE + " " + text(3, 70)), (13, PASSAGE.replace(" ", "\n")), (14, text(4, 30) + " " + PASSAGE + " " + PASSAGE), (15, "x" * 5000), (16, text(5, 4000)),
    (17, "same same same same " * 30), (18, "Ünïcode — “quoted” naïve Straße ΑΣ 日本語 emoji 😀 it's we'll 3.14 #@!"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], len(t or ""), 0, "w", "r", "n", 1) for i, t in TEXTS]
    rows.append((None, text(1, 120), "en", "a", 1, 0, "w", "r", "n", 1))
    rows.append((None, None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def ids(name, t, end):
    """By the library, with nothing configured."""
    return library(name).encode(t or "", add_special_tokens=False).ids + end


@lru_cache
def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def test_encoders_equal_the_library():
    odd = [t for _, t in TEXTS] + ["a  b", " a", "a ", "\n", "\n\nx", "a\tb", "a \nb", "\r\n", "tab\t.", "end.", "　a", "a  b", "A.B. c!", "İstanbul ǅ", "é a", "<|endoftext|> x", "a<|endoftext|>b\n<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "\x1c", "Σ."]
    odd += ["word!!! a$$$ é*** 9%%% a_ a'! it's' x" + "!" * 20, "ŉ ǅ ß ẞ ﬁ!!", "e\u0301lan E\u0301 ÉLAN élan!!", "a<|ENDOFTEXT|>!!"]
    odd += ["".join(random.Random(i).choices("ab zé\u0301ÉİſΣ'!$_9<|>\n\t \u2003", k=1 + i % 60)) for i in range(500)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        e = common.Encoder(common.tokenizer_file(name), "byte" in name, keep=50)
        for _ in range(3):
            got = e.encode_texts([None if t is None else t.encode() for t in odd])
            assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids(name, t, []) for t in odd]


def test_stops_mark_where_sentences_and_lines_end():
    path, break_ = common.tokenizer_file("word_bpe_49k.json"), b" " + common.Encoder.BREAK + b" "
    odd = ["", "\n", "one. two", 'he said "no." (yes!) [3.14] 5.', "...\n\n?! a.b c", "." * 80, "x" * 80 + ".", "é. ß! word... word...'", "<|endoftext|>. end<|endoftext|>", "')", "'a' b)"] + [t for _, t in TEXTS if t]
    odd += ["".join(random.Random(i).choices("ab é.!?'\")]} \n", k=1 + i % 60)) for i in range(300)]
    marking, plain = common.Encoder(path, False, keep=50, stops=True), common.Encoder(path, False)
    for _ in range(2):
        for a in range(0, len(odd), 16):
            lists = [plain.lowered(t.encode()).replace(b"\n", break_).split() for t in odd[a : a + 16]]
            for words, marked, parts in zip(lists, marking.encode(lists), plain.encode(lists)):
                places, here = [], 0
                for w, part in zip(words, parts):
                    here += len(part) // 4
                    if w == common.Encoder.BREAK or w.rstrip(b"\"')]}").endswith((b".", b"!", b"?")):
                        places.append(here)
                assert packing.without_stops(b"".join(marked)) == (b"".join(parts), places)


def test_packing(spark, docs, none):
    rows = packing.pack(docs.where("doc_id is not null"), block_tokens=3000).select("doc_id", "start", "length", F.crc32("ids"), "doc_tokens", "sequence_id", "offset").collect()
    brute.packing_ok([tuple(r) for r in rows], {i: ids("word_bpe_49k.json", t, [1]) for i, t in TEXTS})
    assert packing.pack(docs).where("doc_id is null").count() >= 2
    assert packing.pack(none).count() == 0


def test_plan_is_optimal():
    r = random.Random(3)
    for _ in range(30):
        position = [0]
        while len(position) < 25:
            position.append(position[-1] + r.randrange(1, 17))
        penalty = [r.randrange(0, 9) for _ in position]
        best = [0] + [None] * 24
        for j in range(1, 25):
            costs = []
            for i in range(j):
                n = position[j] - position[i]
                if n <= 16:
                    costs.append(best[i] + (0 if n & (n - 1) == 0 else 16 - n) + penalty[j] + 3)
            best[j] = min(costs)
        cuts = packing.plan_windows(position, penalty, 16, 3)
        cost = 0
        for a, b in zip(cuts, cuts[1:]):
            n = position[b] - position[a]
            assert n <= 16
            cost += (0 if n & (n - 1) == 0 else 16 - n) + penalty[b] + 3
        assert cost == best[-1]


def test_elias_fano():
    r = random.Random(1)
    for values in ([], [0], [5], [0, 0, 0], sorted(r.randrange(10**6) for _ in range(3000)), list(range(1000)), [10**12, 10**12 + 1]):
        e = token_ids.EliasFano.parse(token_ids.EliasFano.of(values).dump())
        assert [e.select(i) for i in range(0, len(values), 7)] == values[::7]
        for a, b in ((0, len(values)), (len(values) // 3, len(values) // 2), (0, 0)):
            assert e.range(a, b).tolist() == values[a:b]
    dense = token_ids.EliasFano.of(sorted(r.randrange(10**7) for _ in range(100_000)))
    assert 8 * len(dense.dump()) / 100_000 < 2.7 + np.log2(100)


def test_token_shards(spark, docs, none, tmp_path):
    manifest = token_ids.write_token_ids(docs, f"file://{tmp_path}/t")
    rows = token_ids.read_token_ids(spark, manifest).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, *[i for i, _ in TEXTS]]
    at = 0
    for r in rows:
        assert r.start == at
        at += len(r.ids) // 4
    for r, (_, t) in zip(rows[2:], TEXTS):
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids("byte_bpe_50k.json", t, [0])
    reader = token_ids.ShardReader(manifest[-1]["path"])
    assert reader.doc_id(reader.n_docs - 1) == 18 and reader.span(reader.n_docs - 1)[1] == reader.n_ids
    assert token_ids.write_token_ids(none, f"file://{tmp_path}/n") == []
    assert token_ids.read_token_ids(spark, []).count() == 0


def test_histogram(spark, docs, none):
    table = token_histogram.limits(token_histogram.histogram(docs))
    sizes = [len(ids("byte_bpe_50k.json", t, [])) for _, t in TEXTS] + [len(ids("byte_bpe_50k.json", text(1, 120), [])), 0]
    cuts = {r.context_limit: (r.documents_cut, r.tokens_kept) for r in token_histogram.truncated_totals(table, [0, 1, 100, 10**6]).collect()}
    assert cuts == {n: (sum(s > n for s in sizes), sum(min(s, n) for s in sizes)) for n in (0, 1, 100, 10**6)}
    got = {r.share: r.n_tokens for r in token_histogram.quantiles(table, [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: 0, 0.5: sorted(sizes)[(len(sizes) + 1) // 2 - 1], 1.0: max(sizes)}
    assert token_histogram.limits(token_histogram.histogram(none)).count() == 0


def test_ann(spark):
    r = np.random.default_rng(0)
    base = {i: r.normal(size=8).tolist() for i in range(1, 400)}
    base |= {400 + i: base[3] for i in range(30)} | {500: [2 * x for x in base[3]], 501: base[3]}
    rows = list(base.items()) + [(600, None), (601, [0.0] * 8), (602, [1.0, None, *[0.0] * 6]), (603, [float("nan")] * 8), (604, [float("inf")] + [1.0] * 7), (605, [1.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for x in ann.search(frame, frame.where("vec_id % 10 = 0 or vec_id is null"), list_rows=20, part_rows=16).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    assert set(got) == {i for i in base if i % 10 == 0}
    hits = 0
    for q, found in got.items():
        want = brute.nearest(base, q)
        found = [(v, s) for _, v, s in sorted(found)]
        hits += len({v for v, _ in want} & {v for v, _ in found})
        if q in range(400, 430):
            assert [v for v, _ in found if v != 500] == [v for v, _ in want if v != 500] or abs(found[0][1] - 1) < 1e-12
    assert hits >= 0.9 * 5 * len(got)
    assert ann.search(frame.limit(0), frame.limit(0)).count() == 0
    few = frame.where("vec_id in (1, 2, 10)")
    assert sorted((x.vec_id) for x in ann.search(few, few.where("vec_id = 10")).collect()) == [1, 2]


def test_graph_search_finds_near_centroids():
    r = np.random.default_rng(2)
    x = r.normal(size=(6000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = ann.build(x, 512)
    sizes = np.bincount((x @ model.points.T).argmax(1), minlength=len(model.points))
    assert len(model.points) == 512 and sizes.max() < 12 * sizes.mean()
    number, cos = model.search(x[:200], 64)
    assert (number[:, 0] == (x[:200] @ model.points.T).argmax(1)).mean() > 0.9 and (np.diff(cos, axis=1) <= 1e-6).all()


def test_classifier(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 19)] + [(1, None, 0), (None, 1, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality_gam.train(docs, labels)
    rows = quality_gam.score(docs, model).collect()
    assert len(rows) == 20 and all(0 <= r.score <= 1 for r in rows)
    assert sorted(r.score for r in quality_gam.score(docs.repartition(1), quality_gam.train(docs.repartition(2), labels)).collect()) == sorted(r.score for r in rows)
    empty = quality_gam.train(docs, labels.limit(0))
    assert {r.score for r in quality_gam.score(docs, empty).collect()} == {0.5}
    assert quality_gam.score(none, model).count() == 0
    assert spark.range(1).select(quality_gam.held_out(F.lit(3)).alias("h")).first().h == (zlib.crc32(b"3") % 3 == 1)


def test_classifier_learns_interactions():
    r = np.random.default_rng(0)
    x = r.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_repeats(spark, docs, none):
    want = brute.strip(TEXTS)
    rows, changed = substring_dedup.find_repeats(docs, shard_words=100)
    got = {r.doc_id: (r.n_removed, r.kept) for r in changed.collect()}
    assert got == {d: (gone, kept.decode()) for d, (_, gone, kept) in want.items() if gone}
    assert rows.count() == 20 and want[2][1] == 120 and want[13][1] == 60
    out = substring_dedup.strip_repeats(docs)
    assert out.columns == docs.columns and out.count() == 20
    assert out.where("doc_id is null and text is not null").first()["text"] == text(1, 120)
    assert out.where("doc_id = 2").first()["text"] == "" and out.where("doc_id = 10").first()["text"] == TEXTS[9][1]
    assert substring_dedup.find_repeats(none)[1].count() == 0


def test_repeats_random(spark):
    r = random.Random(5)
    pool = [text(100 + i, r.randrange(5, 30)) for i in range(12)]
    rows = [(i, " ".join(r.choice(pool) for _ in range(r.randrange(1, 9)))) for i in range(60)]
    want = brute.strip(rows, 20)
    _, changed = substring_dedup.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window=20, seed=8, shard_words=500)
    assert {x.doc_id: (x.n_removed, x.kept) for x in changed.collect()} == {d: (g, k.decode()) for d, (_, g, k) in want.items() if g}


def test_repeats_with_one_doc_id(spark):
    rows = [(1, PASSAGE), (1, PASSAGE + " x"), (2, PASSAGE + " y")]
    _, changed = substring_dedup.find_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [(r.doc_id, r.kept) for r in changed.collect()] == [(2, "y")]


def test_mixing(spark, docs, none):
    mixed, slots = mixing.mix(docs, block_words=16)
    rows = mixed.collect()
    assert len(rows) == 20 and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    for source in ("a", "b", None):
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == round(own[0].target) and sum(r["size"] for r in own) == own[0].source_size
    places = [r.slot for r in slots.orderBy("slot").collect()]
    assert places == list(range(len(places)))
    out = mixing.mix_documents(docs, block_words=16)
    assert out.columns == docs.columns
    taken = {}
    for r in out.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(brute.words(r.text))
    assert {d: n for d, n in taken.items() if d} == {r.doc_id: r.taken for r in rows if r.taken and r.doc_id}
    assert mixing.mix(none)[0].count() == 0 and mixing.mix_documents(none).count() == 0
    assert mixing.mix(docs.where("text is null"))[0].select("taken").distinct().collect()[0][0] == 0


def test_targets_stop_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), ("d", 50), (None, 5)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    size, weight = {"a": 10, "b": 100, "c": 1000, "d": 50, None: 5}, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    target, full = {}, set()
    while True:
        rate = (1165 - sum(3 * size[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        target = {s: 3 * size[s] if s in full else rate * weight[s] for s in size}
        over = {s for s in size if target[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    assert got == {s: pytest.approx(t) for s, t in target.items()}


def test_sources_are_spread(spark):
    docs = spark.createDataFrame([(i, "w " * 50, "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    _, slots = mixing.mix(docs, block_words=50)
    order = [r.number for r in slots.orderBy("slot").collect()]
    share = {s: order.count(s) / len(order) for s in set(order)}
    for s in share:
        for n in range(1, len(order) + 1):
            assert abs(order[:n].count(s) - share[s] * n) < 6


def test_mixed_rows_follow_the_schedule(spark):
    """Sources mix in every stretch of the rows; with a step of 1 instead of the golden ratio's, one source would follow the other."""
    docs = spark.createDataFrame([(i, "w " * 50, "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    rows = [r.source for r in mixing.mix_documents(docs, block_words=50).collect()]
    share = {x: rows.count(x) / len(rows) for x in "abc"}
    for n in range(20, len(rows) + 1):
        assert all(abs(rows[:n].count(x) - share[x] * n) < 8 for x in "abc")
    mixed, _ = mixing.mix(docs, block_words=50)
    firsts = [r.source for r in mixed.where("first_slot is not null").orderBy("first_slot").collect()]
    assert len(set(firsts[:12])) == 3


def test_join_of_groups_without_a_star(spark):
    """Chains of near copies whose smallest document is near none of the others."""
    r, rows = random.Random(8), []
    for g in range(12):
        w = text(700 + g, 80).split()
        far = w[:40] + text(900 + g, 40).split()
        near = [list(w) for _ in range(4)]
        for k, copy in enumerate(near):
            copy[r.randrange(80)] = f"edit{g}x{k}"
        rows += [(10 * g + k, " ".join(x)) for k, x in enumerate([far, *near])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for n, percent in ((3, 90), (5, 80), (1, 95)):
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.join_components(frame, n, percent, block=3).collect()}
        assert got == brute.components(rows, n, percent)


def test_block_pairs_of_groups_cut_by_batches(spark):
    """Groups longer and shorter than a batch, and one whose signature two bands have by chance."""
    r = random.Random(12)
    rows = [(sig, n, 100 * sig + k, r.random() < 0.7, r.randrange(4), r.choice((20, 21, 40)), bytes(r.randrange(3) for _ in range(6))) for sig, n in enumerate((2, 3, 40, 5, 1, 17)) for k in range(n)]
    rows.append((3, 5, 900, True, 9, 20, bytes(8)))
    want = set()
    for s, _, a, own, c, size, x in rows:
        for t, _, b, other, d, large, y in rows:
            if s == t and a < b and c != d and (own or other) and len(x) == len(y) and 100 * min(size, large) >= 80 * max(size, large):
                if sum(p != q for p, q in zip(x, y)) <= (size + large) * 20 // 180:
                    want.add((a, b))
    frame = spark.createDataFrame(rows, "sig long, n long, doc long, own boolean, component long, n_shingles long, sums binary").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        for block in (2, 7, 512):
            got = [(p.a, p.b) for p in ngram_join._block_pairs(frame, 80, block).collect()]
            assert sorted(got) == sorted(want) and len(want) > 50
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_block_pairs_are_listed_in_one_group(spark):
    """Members of two bands that share many groups: every pair once, also those that meet elsewhere as two that only probe."""
    r = random.Random(13)
    docs = [(d, r.randrange(6), r.choice((20, 21)) + 3 * (d % 2)) for d in range(60)]
    halves = {(d, band): bytes(r.randrange(2) for _ in range(4 + 2 * band)) for d, _, _ in docs for band in range(3)}
    rows = []
    for sig in range(40):
        band = sig % 2 + 1  # even doc_ids are of band 1 and probe band 0, odd ones are of band 2 and probe band 1
        low = sig % 5 == 0
        found = [(sig, d, d % 2 + 1 == band - low, c, size, halves[d, band - low]) for d, c, size in docs if r.random() < 0.5 and d % 2 + 1 - (band - low) in (0, 1)]
        rows += [(sig, len(found), *x[1:]) for x in found]
    want = set()
    for s, _, a, own, c, size, x in rows:
        for t, _, b, other, d, large, y in rows:
            if s == t and a < b and c != d and (own or other) and 100 * min(size, large) >= 80 * max(size, large):
                if sum(p != q for p, q in zip(x, y)) <= (size + large) * 20 // 180:
                    want.add((a, b))
    frame = spark.createDataFrame(rows, "sig long, n long, doc long, own boolean, component long, n_shingles long, sums binary").repartition(3)
    for block in (7, 512):
        got = [(p.a, p.b) for p in ngram_join._block_pairs(frame, 80, block).collect()]
        assert sorted(got) == sorted(want) and len(want) > 500


def test_join_of_rows_that_share_a_doc_id(spark):
    a, b = text(1, 60), text(2, 60)
    rows = [(1, a), (2, a), (2, b), (3, b), (2, ""), (4, text(3, 60)), (4, text(3, 60))]
    got = sorted((x.doc_id, x.component_id) for x in ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1), (2, 1), (2, 1), (2, 1), (3, 1), (4, 4), (4, 4)]


def test_very_long_text(spark):
    """Two million words: hashed in pieces, and alike in its parts."""
    words = [f"w{i % 70_001}" for i in range(2_000_000)]
    raw = " ".join(words).encode()
    hashes = common.word_hashes(raw)
    assert len(hashes) == len(words) and (hashes[:70_001] == hashes[70_001:140_002]).all() and len(np.unique(hashes)) == 70_001
    assert (substring_dedup.run_hashes(np.concatenate([hashes, hashes[:400_000]]), 25)[: len(hashes) - 24] == substring_dedup.run_hashes(hashes, 25)).all()
    assert common.word_hashes(b"x" * 3_000_000).tolist() == common.word_hashes(b" " + b"x" * 3_000_000 + b"\n").tolist()


def test_licences(spark, none):
    mit = license_scan.KNOWN["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2020 Me\n\n" + mit.upper().replace(" ", "  ").replace(",", " -- ")), (3, mit + " more"), (4, None), (5, ""), (6, "Copyright 2000 X"), (7, license_scan.KNOWN["ISC"].replace("license", "licence")), (None, mit), (8, mit.replace("MERCHANTABILITY", "MERCHANTIBILITY"))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.licence for r in license_scan.scan(frame, license_scan.known_licences(spark)).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: None, 7: "ISC", None: "MIT", 8: "MIT"}
    assert license_scan.scan(none, license_scan.known_licences(spark)).count() == 0
    assert license_scan.scan(frame, license_scan.known_licences(spark, {})).where("licence is not null").count() == 0


def test_quality_counts(spark, docs, none):
    got = {r.doc_id: r for r in quality_rules.with_counts(docs.select("doc_id", "lang", "text")).collect()}
    for d, t in TEXTS:
        w = (t or "").encode().split()
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        twice = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 1000 else None
        r = got[d]
        assert r.n_words == len(w) and r.word_chars == sum(len(x.decode()) for x in w) and r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert twice is None or r.n_repeat_words == len(twice)
    assert quality_rules.with_counts(none.select("doc_id", "lang", "text")).count() == 0


def test_binomial_tail(spark):
    from math import comb

    for n, k, rate in ((100, 3, 0.1), (1000, 0, 0.01), (50, 5, 0.05), (2000, 4, 0.005)):
        exact = 1.0 if k >= n * rate else sum(comb(n, j) * rate**j * (1 - rate) ** (n - j) for j in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), rate).alias("p")).first().p
        assert got == pytest.approx(exact, rel=1e-9)


def test_thresholds_keep_the_limit(spark):
    r = random.Random(1)
    clean = [(i, r.choice(["en", "fr"]), r.random() * 0.05 + (0.2 if r.random() < 0.001 else 0)) for i in range(8000)]
    junk = [(10_000 + i, "en", 0.2 + r.random() / 2) for i in range(300)]
    rows = [(i, g, 100, 1000, int(1000 * s), 0, 0, 5, 0) for i, g, s in clean + junk]
    counted = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in clean] + [(10_000 + i, 0) for i in range(300)], "doc_id long, quality int")
    cuts = {c.stratum: c for c in quality_rules.thresholds(counted, labels).collect()}
    assert cuts["en"].symbol_share_cut is not None and 0.04 < cuts["en"].symbol_share_cut <= 0.2
    kept = {x.doc_id for x in quality_rules.verdict(counted, quality_rules.thresholds(counted, labels)).where("kept").collect()}
    assert sum(i in kept for i, _, _ in clean) > 0.99 * len(clean) and sum(i in kept for i, _, _ in junk) < 0.1 * len(junk)
    few = quality_rules.thresholds(counted, labels.limit(100))
    assert few.select("symbol_share_cut").where("symbol_share_cut is not null").count() == 0


def test_filter_keeps_columns(spark, docs, none):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    out = quality_rules.filter_documents(docs, labels)
    assert out.columns == docs.columns and 1 in {r.doc_id for r in out.collect()} and out.where("doc_id = 17").count() == 0
    assert quality_rules.filter_documents(none, labels).count() == 0


def test_join(spark, docs, none):
    want = brute.components(TEXTS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(docs).where("doc_id is not null").collect()}
    assert got == want and want[2][1] == 1 and want[3][1] == 1 and want[8][1] == 7
    assert {r.component_id for r in ngram_join.join_components(docs).where("doc_id is null").collect()} == {None}
    assert ngram_join.join_components(none).count() == 0


@pytest.mark.parametrize("n, percent, options", [(3, 90, {}), (3, 70, {}), (5, 80, {"block": 4, "frequent": 2}), (1, 60, {"frequent": 1}), (2, 85, {"pair_cost": 50.0, "least_pairs": 1}), (3, 100, {})])
def test_join_random(spark, n, percent, options):
    r = random.Random(n * percent)
    rows = []
    for g in range(25):
        base = text(200 + g, r.choice([3, 8, 15, 40, 90])).split()
        for _ in range(r.choice([1, 2, 12])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                w[r.randrange(len(w))] = f"edit{r.randrange(30)}"
            rows.append((len(rows), " ".join(w + (["common tail of many texts"] if r.random() < 0.3 else []))))
    want = brute.components(rows, n, percent)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.join_components(frame, n, percent, **options).collect()}
    assert got == want


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (60, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 60: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages_on_odd_rows(spark, docs, none, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, none):
        frame = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = common.materialize(stage(spark, frame, str(tmp_path)), "t")
            assert frame.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).count()


def test_pairs_with_equal_bytes_of_unequal_segments(spark):
    """Two near copies whose bytes agree by chance in their one unequal segment, in groups whose smallest member is no copy."""
    bands = ngram_join.Bands(90)
    base, band = [], bands.band(101)
    m = bands.segments(band)
    first = []  # words of segment 0, by byte
    for w in (f"{a}{b}{c}{d}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij" for d in "abcdefghij"):
        h = ngram_join.shingle_set(w.encode(), 1)
        halves = ngram_join.segment_sums(h, 2 * m)[1]
        if halves[1]:
            first.append((ngram_join._posted(h, band, bands)[3][0], w))
        elif halves[2] == 0 and len(base) < 100:
            base.append(w)
    seen = {}
    one, two = next((seen[byte], w) for byte, w in first if seen.setdefault(byte, w) != w)
    more = [w for _, w in first if w not in (one, two)][:13]
    rows = [(1, " ".join(base + more)), (2, " ".join([*base, one])), (3, " ".join([*base, two]))]
    got = {x.doc_id: x.component_id for x in ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 90).collect()}
    assert got == {i: c for i, (_, c) in brute.components(rows, 1, 90).items()} == {1: 1, 2: 2, 3: 2}


def test_ann_reads_enough_of_many_lists(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(5000, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = ann.search(frame, frame.where("vec_id % 50 = 0"), list_rows=8).collect()  # 625 lists
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = unit[::50] @ unit.T
    cos[np.arange(100), np.arange(0, 5000, 50)] = -2
    want = {(50 * q, int(v)) for q, row in enumerate(np.argsort(-cos, axis=1)[:, :5]) for v in row}
    assert len(want & {(a.query_id, a.vec_id) for a in got}) >= 0.93 * len(want)


def test_licences_with_headings_and_published_texts(spark):
    c = "Copyright (c) 2020 Me\n"
    rows = {f"{n}/{i}": f"{h}\n\n{c}{a}\n{license_scan.KNOWN[n]}" for n in ("MIT", "ISC", "BSD-2-Clause") for i, h in enumerate(license_scan.HEADINGS[n]) for a in ("", "All rights reserved.\n")}
    files = {f.name.removesuffix(".txt"): f.read_text() for f in license_scan.PUBLISHED.glob("*.txt")}
    rows |= {f"{n}/full": t for n, t in files.items()}
    rows |= {"Apache-2.0/filled": files["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Me"), "Apache-2.0/terms": files["Apache-2.0"].split("   APPENDIX")[0]}
    rows |= {"BSD-3-Clause/bullets": "BSD 3-Clause License\n\n" + c + "All rights reserved.\n\n" + files["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")}
    frame = spark.createDataFrame([*rows.items(), ("/none", files["MPL-2.0"] + " more")], "doc_id string, text string")
    got = {r.doc_id: r.licence for r in license_scan.scan(frame, license_scan.known_licences(spark)).collect()}
    assert got == {k: k.split("/")[0] or None for k in got} | {"/none": None} and len(files) == 16 and len(got) == len(rows) + 1
