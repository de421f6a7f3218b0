"""Order-preserving packing of documents into fixed windows by dynamic programming (operator 1).

Documents keep their stored order. Candidate cuts are document ends, sentence ends and, inside a sentence longer than
``max_gap`` tokens, every ``max_gap`` tokens. Over the candidates of one block (whole documents of about
``block_tokens``) the cheapest chain of windows is found:

    best[j] = min over i of best[i] + padding(position[j] - position[i]) + penalty[j] + sequence_cost

with windows of at most ``window`` tokens. Padding is window - length, so the transition is a sliding-window minimum of
best[i] + position[i], kept in a monotone queue; lengths that are powers of two are not padded and are looked up
directly. Penalties are 0 at a document's end, more at a sentence's end and most inside a sentence, in tokens of padding.

Nothing is shuffled: each input partition is packed by itself, a block at a time, so memory holds one block and its
batch. A rerun of a task gives the same windows, since a scan yields the same rows in the same order.

Null text counts as empty: one piece that holds the end id alone. Repeated or null doc_ids are separate documents.
Empty tables give no rows. Other columns are ignored. Special tokens that a text spells out get their own ids, as the
library's default is; with ``special_as_text`` they are ordinary text.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Encoder, encoder, load, ship, slices, tokenizer_file

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def without_stops(ids: bytes) -> tuple[bytes, list[int]]:
    """A document's ids without the encoder's marks, and the ascending places (in ids) where sentences and lines end."""
    import numpy as np

    marked = np.frombuffer(ids, "<u4")
    stop = marked == 0xFFFFFFFF
    at = np.flatnonzero(stop)
    return marked[~stop].tobytes(), (at - np.arange(len(at))).tolist()


def plan_windows(position: list[int], penalty: list[int], window: int = 2048, sequence_cost: int = 32) -> list[int]:
    """Indexes of the chosen cuts, from 0 to the last candidate. position ascends; gaps are at most ``window``."""
    import numpy as np

    n = len(position)
    at = np.asarray(position)
    pairs_j, pairs_i = [], []
    size = 1
    while size < window:
        i = np.searchsorted(at, at - size)
        hit = np.flatnonzero(at[np.minimum(i, n - 1)] == at - size)
        pairs_j.append(hit)
        pairs_i.append(i[hit])
        size *= 2
    j_all, i_all = np.concatenate(pairs_j), np.concatenate(pairs_i)
    order = np.argsort(j_all, kind="stable")
    exact_j, exact_i = j_all[order].tolist() + [n], i_all[order].tolist()
    best, come, key, queue, p = [0] * n, [0] * n, [0] * n, deque(), 0
    key[0] = position[0]
    queue.append(0)
    for j in range(1, n):
        here = position[j]
        while here - position[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        cost = key[i] + window - here
        while exact_j[p] == j:
            k = exact_i[p]
            if best[k] < cost:
                cost, i = best[k], k
            p += 1
        cost += penalty[j] + sequence_cost
        best[j], come[j], key[j] = cost, i, cost + here
        last = key[j]
        while queue and key[queue[-1]] >= last:
            queue.pop()
        queue.append(j)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(come[cuts[-1]])
    return cuts[::-1]


class _Block:
    """Whole documents in order, with their candidate cuts."""

    def __init__(self, window: int, max_gap: int, sentence_penalty: int, inner_penalty: int):
        self.window, self.max_gap, self.sentence_penalty, self.inner_penalty = window, max_gap, sentence_penalty, inner_penalty
        self.docs: list[tuple[int | None, bytes]] = []
        self.starts = [0]
        self.position, self.penalty = [0], [0]

    @property
    def tokens(self) -> int:
        return self.starts[-1]

    def add(self, doc_id, ids: bytes, ends: list[int]) -> None:
        """A document's ids with its end id, and the ascending places (in ids) where sentences end."""
        here, total, before = self.starts[-1], len(ids) // 4, 0
        position, penalty = [], []
        for cut in ends:
            if before < cut < total - 1:
                if cut - before > self.max_gap:
                    inner = range(before + self.max_gap, cut, self.max_gap)
                    position += inner
                    penalty += [self.inner_penalty] * len(inner)
                position.append(cut)
                penalty.append(self.sentence_penalty)
                before = cut
        inner = range(before + self.max_gap, total, self.max_gap)
        position += [*inner, total]
        penalty += [self.inner_penalty] * len(inner)
        penalty.append(0)
        self.position += [here + p for p in position]
        self.penalty += penalty
        self.docs.append((doc_id, ids))
        self.starts.append(here + total)

    def pieces(self, sequence: int, sequence_cost: int) -> tuple[int, list[tuple]]:
        out = []
        cuts = [self.position[k] for k in plan_windows(self.position, self.penalty, self.window, sequence_cost)]
        d = 0
        for a, b in zip(cuts, cuts[1:]):
            while d < len(self.docs) and self.starts[d] < b:
                doc_id, ids = self.docs[d]
                first, last = self.starts[d], self.starts[d + 1]
                lo, hi = max(a, first), min(b, last)
                out.append((doc_id, lo - first, hi - lo, ids[4 * (lo - first) : 4 * (hi - first)], last - first, sequence, lo - a))
                if last > b:
                    break
                d += 1
            sequence += 1
        return sequence, out


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 1,
    window: int = 2048,
    block_tokens: int = 1 << 20,
    max_gap: int = 128,
    sentence_penalty: int = 8,
    inner_penalty: int = 48,
    sequence_cost: int = 32,
    special_as_text: bool = False,
) -> DataFrame:
    """Pieces of packed sequences with their ids: see the module's text. docs: doc_id, text."""
    path = tokenizer or tokenizer_file("word_bpe_49k.json")
    max_gap = min(max_gap, window)
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        line_end = b" " + Encoder.BREAK + b" "
        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
        )
        encode, end = encoder(path, False, special_as_text, stops=True), end_id.to_bytes(4, "little")
        new = lambda: _Block(window, max_gap, sentence_penalty, inner_penalty)
        block, sequence = new(), TaskContext.get().partitionId() << 40

        def flush():
            nonlocal block, sequence
            sequence, rows = block.pieces(sequence, sequence_cost)
            block = new()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                words = [encode.lowered(t or b"").replace(b"\n", line_end).split() for t in texts]
                for doc_id, marked in zip(part.column(0).to_pylist(), encode.encode(words)):
                    ids, places = without_stops(b"".join(marked))
                    block.add(doc_id, ids + end, places)
                    if block.tokens >= block_tokens:
                        yield flush()
        if block.docs:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)




def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(load(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
