"""Removal of passages that repeat across documents, by sharded Aho-Corasick automata over words (operator 4).

A window is ``window`` consecutive words of a document. Every word covered by a window whose word sequence also starts
in a document with a smaller doc_id is removed; windows are judged on the input.

1. Seeds. Of the ``seed``-word runs inside a window, the one with the least hash stands for the window; equal windows
   have equal seeds, and about one run in fourteen is a seed. Documents that are word for word equal are one class:
   copies of a class's smallest doc_id go whole, if they have a window at all.
2. Confirming. Only windows whose seed occurs in documents with different doc_ids are hashed (96 bits); those found under
   two doc_ids or more recur, and belong to the smallest one.
3. Passages. In that document, recurring windows that follow each other form a passage, kept as text with its seeds, in
   pieces of at most ``passage_windows`` windows (which overlap by a window less one word, so each window is in one piece).
4. Automata. Documents with a recurring seed are dealt into shards of bounded size; a shard gets the pieces with a window
   that a later document of the shard holds, compiles their seeds into one automaton over word numbers (pyahocorasick),
   and streams its documents through it. Each occurrence is extended to the longest agreement with its piece, word by
   word, so what is removed is exact; agreements shorter than a window are left alone.

Only hashes of 1 word run in 14 are shuffled for all documents, window hashes for recurring seeds alone, and texts only of
documents with such seeds. Hot seeds, windows and classes of copies are aggregated in part before they are shuffled, and
what is kept of them is written, so that joins with it are of plain scans, whose hot keys Spark splits. What a shard gets
is bounded by its own words: a piece for each window of its documents at most.

Null text has no words. Rows with a null doc_id are left alone and do not count as earlier documents. Rows that share a
doc_id don't repeat each other. Empty tables give no rows. Other columns are kept by strip_repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import Powers, as_row, discard, free_shuffles, load, materialize, mixed, multipliers, ship, slices, word_hashes


_powers: list[Powers] = []
_RUN = 1 << 20  # words hashed at a time


def run_hashes(hashes, length: int, which: int = 0):
    """Hash of every run of ``length`` words."""
    import numpy as np

    if not _powers:
        _powers.extend(Powers(int(b)) for b in multipliers(8)[6:8])
    n = len(hashes)
    if n > 2 * _RUN:
        return np.concatenate([run_hashes(hashes[a : a + _RUN + length - 1], length, which) for a in range(0, n - length + 1, _RUN)])
    up, down = _powers[which].of(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)])
    return mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])


def window_seeds(hashes, window: int, seed: int):
    """The seed of each window: the least hash of a run of ``seed`` words in it; empty if there is no window."""
    import numpy as np

    if len(hashes) < window:
        return np.zeros(0, np.uint64)
    least, size, runs = run_hashes(hashes, seed), 1, window - seed + 1
    while 2 * size <= runs:  # minima over runs twice as many
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    left = runs - size
    return np.minimum(least[:-left], least[left:]) if left else least


def seed_places(hashes, window: int, seed: int):
    """(position of each window's seed, hashes of all seed-length runs) of a text with a window."""
    import numpy as np

    runs = run_hashes(hashes, seed)
    least = np.lib.stride_tricks.sliding_window_view(runs, window - seed + 1).argmin(axis=1)
    return least + np.arange(len(least)), runs


def _survey(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, th (hash of the text), n_words, sha (of all words), seeds of every row."""

    def run(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                out = []
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    hashes = word_hashes(text or b"")
                    out.append((len(hashes), sha256(b" ".join((text or b"").split())).digest(), np.unique(window_seeds(hashes, window, seed)).view(np.int64)))
                n, sha, seeds = zip(*out)
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, seeds)]).astype(np.int32), pa.array(np.concatenate(seeds)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(sha, pa.binary()), lists], names=["doc_id", "th", "n_words", "sha", "seeds"])

    return docs.select("doc_id", "th", "text").mapInArrow(run, "doc_id long, th long, n_words long, sha binary, seeds array<long>")


def _windows(flagged: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, th and, as arrays, hashes (w) and checks (c) of the windows whose seed recurs."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 64):
                w, c = [], []
                for text, seeds in zip(part.column(2).cast(pa.binary()).to_pylist(), part.column(3)):
                    hashes = word_hashes(text)
                    hit = np.isin(window_seeds(hashes, window, seed), seeds.values.to_numpy().view(np.uint64))
                    w.append(run_hashes(hashes, window)[hit].view(np.int64))
                    c.append((run_hashes(hashes, window, 1)[hit] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                offsets = np.cumsum([0, *map(len, w)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (w, c)]], names=["doc_id", "th", "w", "c"])

    return flagged.select("doc_id", "th", "text", "seeds").mapInArrow(run, "doc_id long, th long, w array<long>, c array<int>")


def _passages(owned: DataFrame, window: int, seed: int, most: int) -> DataFrame:
    """Pieces of recurring passages of the documents that own them: owner, th, start, passage, places (of seeds, in words) and windows (hashes)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("owner", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("passage", pa.binary()), ("places", pa.list_(pa.int32())), ("windows", pa.list_(pa.int64()))])
        for batch in batches:
            for part in slices(batch, 64):
                rows = []
                for doc_id, th, text, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).cast(pa.binary()).to_pylist(), part.column(3)):
                    words = text.split()
                    hashes = word_hashes(text)
                    if len(words) < window:
                        continue
                    at, _ = seed_places(hashes, window, seed)
                    own = run_hashes(hashes, window)
                    hit = np.flatnonzero(np.isin(own, found.values.to_numpy().view(np.uint64)))
                    for whole in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
                        for piece in (whole[k : k + most] for k in range(0, len(whole), most)):
                            a, b = int(piece[0]), int(piece[-1]) + window
                            rows.append({"owner": doc_id, "th": th, "start": a, "passage": b" ".join(words[a:b]), "places": (np.unique(at[piece]) - a).tolist(), "windows": own[piece].view(np.int64).tolist()})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return owned.select("doc_id", "th", "text", "found").mapInArrow(run, "owner long, th long, start long, passage binary, places array<int>, windows array<long>")


def covered_spans(words: list[int], hits: list[tuple[int, list]], passages: list, doc_id: int, window: int) -> list[tuple[int, int]]:
    """Spans of words in agreements of at least ``window`` words with passages of smaller doc_ids; hits are (place, [(passage, place in it)])."""
    import numpy as np

    spans, done, doc = [], {}, np.asarray(words, np.int32)
    for place, owners in hits:
        for number, inside in owners:
            owner, other = passages[number]
            if owner >= doc_id or done.get((number, place - inside), -1) >= place:
                continue
            n = min(place, inside)
            unlike = np.flatnonzero(doc[place - n : place] != other[inside - n : inside])
            a = place - n + (int(unlike[-1]) + 1 if len(unlike) else 0)
            n = min(len(doc) - place, len(other) - inside)
            unlike = np.flatnonzero(doc[place : place + n] != other[inside : inside + n])
            b = place + (int(unlike[0]) if len(unlike) else n)
            done[number, place - inside] = b - 1
            if b - a >= window:
                spans.append((a, b))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def word_codes(n: int) -> tuple[list[str], int]:
    """Strings of one width for the numbers below n, and that width; 0, for words of no passage, is in no pattern.

    Nodes of the automaton search their edges one by one, so words are spelled with 64 symbols rather than being one
    symbol each. First symbols are a set of their own: a match can only start where a word does.
    """
    width = 1
    while 64**width < n:
        width += 1
    codes = []
    for i in range(n):
        digits = [(i >> 6 * k) & 63 for k in range(width)]
        codes.append(chr(0x30 + digits[0]) + "".join([chr(0x80 + d) for d in digits[1:]]))
    return codes, width


def _scan(window: int, seed: int):
    def run(documents, passages):
        """One shard: its documents and the passages that may occur in them."""
        import ahocorasick
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("n_removed", pa.int64()), ("kept", pa.string())])
        numbers: dict[bytes, int] = {}
        known, patterns = [], {}
        for owner, text, places in zip(passages["owner"].to_pylist(), passages["passage"].to_pylist(), passages["places"].to_pylist()):
            ids = [numbers.setdefault(w, len(numbers) + 1) for w in text.split()]
            for p in places:
                patterns.setdefault(tuple(ids[p : p + seed]), []).append((len(known), p))
            known.append((owner, np.asarray(ids, np.int32)))
        codes, width = word_codes(len(numbers) + 1)
        machine = ahocorasick.Automaton()
        for pattern, owners in patterns.items():
            machine.add_word("".join([codes[i] for i in pattern]), owners)
        rows = []
        if patterns:
            machine.make_automaton()
            get = numbers.get
            for doc_id, th, text in zip(documents["doc_id"].to_pylist(), documents["th"].to_pylist(), documents["text"].cast(pa.binary()).to_pylist()):
                words = text.split()
                ids = [get(w, 0) for w in words]
                hits = [((end + 1) // width - seed, owners) for end, owners in machine.iter("".join([codes[i] for i in ids]))]
                spans = covered_spans(ids, hits, known, doc_id, window) if hits else []
                if spans:
                    kept, at = [], 0
                    for a, b in spans:
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                    rows.append({"doc_id": doc_id, "th": th, "spans": [{"start": a, "end": b} for a, b in spans], "n_removed": len(words) - len(kept), "kept": b" ".join(kept).decode()})
        return pa.Table.from_pylist(rows, schema)

    return run


def find_repeats(docs: DataFrame, window: int = 50, seed: int = 25, shard_words: int = 400_000, passage_windows: int = 512) -> tuple[DataFrame, DataFrame]:
    """(survey of all rows: doc_id, th, n_words, sha; changed rows: doc_id, th, spans, n_removed, kept). docs: doc_id, text.

    th is xxhash64(text): a row is known by (doc_id, th). ``spans`` are the word spans removed and ``kept`` the rest.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("th", F.xxhash64("text"))
    rows = materialize(_survey(texts, window, seed), "repeat-seeds")
    named = rows.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    # classes of two rows or more that are word for word equal
    classes = named.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    classes = materialize(classes, "repeat-classes")
    reps = named.select("doc_id", "th", "sha").join(classes, "sha", "left").where("first is null or doc_id = first").select("doc_id", "th")
    # seeds of two different texts
    met = named.select(F.xxhash64("sha").alias("of"), F.explode("seeds").alias("seed")).groupBy("seed").agg(F.min("of").alias("low"), F.max("of").alias("high"))
    met = materialize(met.where("low < high").select("seed"), "repeat-met")
    posted = named.select("doc_id", "th", F.explode("seeds").alias("seed"))
    shared = posted.join(met, "seed", "left_semi").groupBy("doc_id", "th").agg(F.collect_set("seed").alias("seeds"))
    shared = materialize(shared.join(reps, ["doc_id", "th"], "left_semi"), "repeat-shared")
    discard(met)
    free_shuffles(spark)
    flagged = materialize(texts.join(shared, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]), "repeat-texts")
    free_shuffles(spark)
    windows = materialize(_windows(flagged, window, seed), "repeat-windows").select("doc_id", "th", F.explode(F.arrays_zip("w", "c")).alias("x")).select("doc_id", "th", "x.w", "x.c")
    recurring = windows.groupBy("w", "c").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    recurring = materialize(recurring, "repeat-recurring")
    found = recurring.groupBy(F.col("low").alias("doc_id")).agg(F.collect_list("w").alias("found"))  # windows of the document itself
    passages = materialize(_passages(flagged.join(found, "doc_id"), window, seed, passage_windows), "repeat-passages")
    words = rows.join(shared.select("doc_id", "th"), ["doc_id", "th"], "left_semi").agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-words // shard_words))
    shard = F.pmod(F.xxhash64("doc_id", "th"), F.lit(shards)).alias("shard")
    wanted = windows.join(recurring, ["w", "c"]).where("low < doc_id").select(shard, F.col("low").alias("owner"), "w").distinct()
    key = ["owner", "th", "start"]
    routes = passages.select(*key, F.explode("windows").alias("w")).join(wanted, ["owner", "w"]).select("shard", *key).distinct()
    routed = materialize(routes.join(passages.select(*key, "passage", "places"), key).select("shard", "owner", "passage", "places"), "repeat-routed")
    free_shuffles(spark)
    dealt = flagged.select(shard, "doc_id", "th", "text")
    changed = dealt.groupBy("shard").cogroup(routed.groupBy("shard")).applyInArrow(_scan(window, seed), "doc_id long, th long, spans array<struct<start:long,end:long>>, n_removed long, kept string")
    whole = named.select("doc_id", "th", "sha", "n_words").join(classes, "sha").where("doc_id > first")
    whole = whole.select("doc_id", "th", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))).alias("spans"), F.col("n_words").alias("n_removed"), F.lit("").alias("kept"))
    return rows, changed.unionByName(whole.dropDuplicates(["doc_id", "th"]))


def strip_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with repeated passages removed from text; texts without any stay as they are. n_chars, if there, follows."""
    _, changed = find_repeats(docs, **options)
    keyed = docs.select(as_row(docs)).withColumn("th", F.xxhash64(F.col("row.text").cast("string")))
    edits = changed.select("doc_id", "th", "kept")
    out = keyed.join(edits, (F.col("row.doc_id") == edits["doc_id"]) & (keyed["th"] == edits["th"]), "left")
    new = {"text": F.coalesce("kept", "row.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, changed = find_repeats(load(spark, sf_dir, "documents"))
    digests = changed.select("doc_id", "th", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    out = rows.select("doc_id", "th", "n_words", "sha").join(digests, ["doc_id", "th"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"))
