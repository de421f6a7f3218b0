"""Quality classifier: a generalised additive model with pairwise interactions (operator 3).

Each feature of a text is cut into bins; a lookup table gives every bin a weight. Tables are learned by cyclic boosting:
round after round, each feature in turn gets a shallow tree (at most three leaves) on the gradient of the log loss over
its bins, added to its table at a small rate. Then the pairs that explain most of what is left get two-way tables from
trees with one cut on either side. A score is the logistic of the summed table entries, found by vectorised look-ups.

The model is fitted on the driver on at most ``max_rows`` labelled rows, chosen by a hash of doc_id, so the fit is the
same for any partitioning; only their features are collected. Scoring is one pass over the texts without a shuffle.

Null and empty texts have all features 0 and get a score like any other. Labels that are not 0 or 1 are left out; a
doc_id with both labels counts with each. Without labels every score is 0.5. A null doc_id counts as an empty one for
folds and never has a label. Empty tables give no rows. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import load, slices

FEATURES = (
    "log_words", "word_length", "word_length_spread", "longest_word", "distinct_words", "distinct_triples", "same_as_previous", "top_word",
    "upper", "digits", "marks", "symbols", "exclamations", "bars", "other_ascii", "not_ascii", "byte_entropy", "short_words", "marked_words",
    "distinct_lines", "line_words", "sentence_words", "capitalised", "all_capitals",
)


def features(text: bytes) -> list[float]:
    """The features of one text, in the order of FEATURES; none of them depends on its language, source or number."""
    import numpy as np

    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = max(1, int(counts.sum() - counts[[9, 10, 11, 12, 13, 32]].sum()))
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = set(words)
    triples = len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 1.0
    upper = int(counts[65:91].sum())
    share = counts[counts > 0] / counts.sum()
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = int(counts[[33, 46, 63]].sum())
    firsts = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    lasts = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    same = sum(a == b for a, b in zip(words, words[1:]))
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    symbols = int(counts[[35, 36, 37, 38, 42, 60, 62, 64, 94, 126]].sum())
    # words whose last byte is neither a letter nor beyond ASCII
    marked = float(((lasts < 65) | ((lasts > 90) & (lasts < 97)) | ((lasts > 122) & (lasts < 128))).mean())
    return [
        float(np.log1p(n)), float(lengths.mean()), float(lengths.std()), float(np.log1p(lengths.max())), len(distinct) / n, triples, same / n, 0.0 if len(distinct) == n else _top(words, distinct) / n,
        upper / chars, int(counts[48:58].sum()) / chars, marks / chars, symbols / chars, int(counts[33]) / chars, int(counts[124]) / chars, int(counts[:9].sum() + counts[14:32].sum()) / chars, int(counts[128:].sum()) / chars,
        float(-(share * np.log2(share)).sum()), float((lengths <= 3).mean()), marked,
        len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), float(np.log1p(n / (ends + 1))), float(((firsts >= 65) & (firsts <= 90)).mean()), upper / max(1, int(counts[97:123].sum()) + upper),
    ]


def _top(words: list[bytes], distinct: set[bytes]) -> int:
    from collections import Counter

    return Counter(words).most_common(1)[0][1]


@dataclass
class Additive:
    """Cuts, tables and pair tables; score() needs nothing else."""

    cuts: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (feature, feature, cuts, cuts, table)
    bias: float = 0.0

    def score(self, x):
        import numpy as np

        z = np.full(len(x), self.bias)
        for f, (cut, table) in enumerate(zip(self.cuts, self.tables)):
            z += table[np.searchsorted(cut, x[:, f], side="right")]
        for a, b, ca, cb, table in self.pairs:
            z += table[np.searchsorted(ca, x[:, a], side="right"), np.searchsorted(cb, x[:, b], side="right")]
        return 1 / (1 + np.exp(-z))


def _quantile_cuts(x, bins: int):
    import numpy as np

    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g, h, ridge: float):
    """Steps of a tree of at most three leaves over bins with gradient sums g and curvature sums h."""
    import numpy as np

    def cut(lo: int, hi: int):
        if hi - lo < 2:
            return 0.0, lo
        gs, hs = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        left = gs[:-1] ** 2 / (hs[:-1] + ridge)
        right = (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + ridge)
        gain = left + right - gs[-1] ** 2 / (hs[-1] + ridge)
        k = int(gain.argmax())
        return float(gain[k]), lo + k + 1

    n = len(g)
    gain, first = cut(0, n)
    edges = [0, n]
    if gain > 0:
        (ga, ca), (gb, cb) = cut(0, first), cut(first, n)
        edges = sorted({0, first, n, *([ca] if ga >= gb and ga > 0 else [cb] if gb > 0 else [])})
    out = np.zeros(n)
    for a, b in zip(edges, edges[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def fit(x, y, rounds: int = 250, rate: float = 0.1, bins: int = 32, n_pairs: int = 6, pair_bins: int = 8, pair_rounds: int = 60, ridge: float = 5.0) -> Additive:
    """Learn the tables from features x (rows, features) and labels y (0 or 1)."""
    import numpy as np

    model = Additive()
    if not len(y):
        return model
    prior = (y.sum() + 1) / (len(y) + 2)
    model.bias = float(np.log(prior / (1 - prior)))
    n = x.shape[1]
    model.cuts = [_quantile_cuts(x[:, f], bins) for f in range(n)]
    binned = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    z = np.full(len(y), model.bias)
    for _ in range(rounds):
        for f in range(n):
            p = 1 / (1 + np.exp(-z))
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(binned[f], y - p, size), np.bincount(binned[f], p * (1 - p), size), ridge)
            model.tables[f] += step
            z += step[binned[f]]
    coarse = [_quantile_cuts(x[:, f], pair_bins) for f in range(n)]
    small = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse)]
    p = 1 / (1 + np.exp(-z))
    found = []
    for a in range(n):
        for b in range(a):
            shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
            cell = small[a] * shape[1] + small[b]
            g, h = np.bincount(cell, y - p, shape[0] * shape[1]), np.bincount(cell, p * (1 - p), shape[0] * shape[1])
            found.append((float((g**2 / (h + ridge)).sum()), a, b, cell, shape))
    found.sort(key=lambda t: (-t[0], t[1], t[2]))
    chosen = [(a, b, cell, shape, np.zeros(shape)) for _, a, b, cell, shape in found[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, cell, shape, table in chosen:
            p = 1 / (1 + np.exp(-z))
            g = np.bincount(cell, y - p, shape[0] * shape[1]).reshape(shape)
            h = np.bincount(cell, p * (1 - p), shape[0] * shape[1]).reshape(shape)
            step = rate * _quarters(g, h, ridge)
            table += step
            z += step.ravel()[cell]
    model.pairs = [(a, b, coarse[a], coarse[b], table) for a, b, _, _, table in chosen]
    return model


def _quarters(g, h, ridge: float):
    """Steps of the best tree with one cut on either feature: four leaves."""
    import numpy as np

    gs, hs = (np.pad(t, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for t in (g, h))
    best, out = -1.0, np.zeros_like(g)
    for i in range(1, g.shape[0] + 1):
        for j in range(1, g.shape[1] + 1):
            parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, None)), (slice(i, None), slice(0, j)), (slice(i, None), slice(j, None))]
            G = (gs[i, j], gs[i, -1] - gs[i, j], gs[-1, j] - gs[i, j], gs[-1, -1] - gs[i, -1] - gs[-1, j] + gs[i, j])
            H = (hs[i, j], hs[i, -1] - hs[i, j], hs[-1, j] - hs[i, j], hs[-1, -1] - hs[i, -1] - hs[-1, j] + hs[i, j])
            gain = sum(a * a / (b + ridge) for a, b in zip(G, H))
            if gain > best:
                best, out = gain, np.zeros_like(g)
                for part, a, b in zip(parts, G, H):
                    out[part] = a / (b + ridge)
    return out


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never learned from: crc32 of the number's text, modulo 3, is 1."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _with_features(docs: DataFrame, keep: str, names: list[str], model: Additive | None) -> DataFrame:
    """names (the columns before text) and either the features or the model's score of the last column, text."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                x = np.array([features(t or b"") for t in part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()]).reshape(-1, len(FEATURES))
                if model is None:
                    last = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32), pa.array(x.ravel()))
                else:
                    last = pa.array(model.score(x))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], last], names=[*names, "features" if model is None else "score"])

    return docs.select(*names, F.col("text").cast("string")).mapInArrow(run, keep)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, **options) -> Additive:
    """Fit on labelled rows outside the held-out fold, at most ``max_rows`` of them (those with the least hash of doc_id)."""
    import numpy as np

    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("long").alias("quality")).where("quality in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"))).distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows
    found = _with_features(rows, "doc_id long, quality long, features array<double>", ["doc_id", "quality"], None).collect()
    found.sort(key=lambda r: (r["doc_id"], r["quality"], r["features"]))
    x = np.array([r["features"] for r in found]).reshape(-1, len(FEATURES))
    return fit(x, np.array([float(r["quality"]) for r in found]), **options)


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """doc_id and score of every row."""
    return _with_features(docs, "doc_id long, score double", ["doc_id"], model)


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    scored = score(docs, train(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
