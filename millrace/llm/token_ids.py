"""Token ids as binary shards with Elias-Fano document boundaries (operator 6).

Shard file: all ids of its documents in ascending doc_id order (2 bytes each if the vocabulary allows, else 4), then
three sections and a fixed footer. The sections are Elias-Fano sequences: document ends (in ids), and doc_ids less the
shard's first one, plus a bitmap of null doc_ids. An Elias-Fano sequence keeps the low bits of each value packed, the
high bits in unary, and the position of every 256th one as select samples: about 2 + log2(universe / n) bits a value.

Documents are range-partitioned by (doc_id, hash of text), so a repeated doc_id doesn't gather in one task, and sorted
within partitions; each task streams its shard to a temporary name and renames it, so that a repeated task overwrites
the same bytes. The driver learns a row for each shard. Null doc_ids come first, null text counts as empty, repeated
doc_ids are separate documents in order of their texts' hashes. An empty table gives no rows. Special tokens
that a text spells out get their own ids, as the library's default is; with ``special_as_text`` they are ordinary text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import encoder, load, shared_path, ship, slices, tokenizer_file

SAMPLE = 256
_FOOTER = struct.Struct("<8sIIQQQQQq")
_MAGIC = b"MRTIDS01"


class EliasFano:
    """A non-decreasing sequence of integers from 0, with select."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples):
        import numpy as np

        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = samples

    @classmethod
    def of(cls, values) -> EliasFano:
        import numpy as np

        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        universe = int(v[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 1) if n else 0, np.uint8)
        bits[ones] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(n, low_bits, np.packbits(low, bitorder="little").tobytes(), np.packbits(bits, bitorder="little").tobytes(), ones[::SAMPLE].astype("<i8"))

    def select(self, i: int) -> int:
        """Value i, from the sample before it."""
        import numpy as np

        here, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = here >> 3
        bits = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        bits[: here & 7] = 0
        while (count := int(bits.sum())) <= left:
            left -= count
            byte += 1
            bits = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        one = (byte << 3) + int(np.flatnonzero(bits)[left])
        value = one - i
        low = 0
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            low |= (int(self.low[at >> 3]) >> (at & 7) & 1) << k
        return value << self.low_bits | low

    def range(self, a: int, b: int):
        """Values a to b - 1 as int64."""
        import numpy as np

        if a >= b:
            return np.zeros(0, np.int64)
        first, end = int(self.samples[a // SAMPLE]), (b - 1) // SAMPLE + 1
        last = int(self.samples[end]) if end < len(self.samples) else len(self.high) * 8
        byte = first >> 3
        ones = np.flatnonzero(np.unpackbits(self.high[byte : (last >> 3) + 1], bitorder="little")) + (byte << 3)
        ones = ones[np.searchsorted(ones, first) :][a % SAMPLE :][: b - a]
        value = (ones - np.arange(a, b)) << self.low_bits
        if self.low_bits:
            from_bit = a * self.low_bits
            packed = self.low[from_bit >> 3 : (b * self.low_bits + 7) >> 3]
            bits = np.unpackbits(packed, bitorder="little")[from_bit & 7 :][: (b - a) * self.low_bits]
            value |= bits.reshape(-1, self.low_bits).astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return value

    def dump(self) -> bytes:
        return struct.pack("<QIQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def parse(cls, data: bytes) -> EliasFano:
        import numpy as np

        head = struct.calcsize("<QIQQ")
        n, low_bits, low, high = struct.unpack_from("<QIQQ", data)
        return cls(n, low_bits, data[head : head + low], data[head + low : head + low + high], np.frombuffer(data[head + low + high :], "<i8"))


def _open(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


class ShardWriter:
    def __init__(self, uri: str, id_bytes: int, attempt: int):
        self.fs, self.path = _open(uri)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        self.temporary = f"{folder}/.{name}.{attempt}"
        self.out = self.fs.open_output_stream(self.temporary)
        self.id_bytes, self.ids, self.ends, self.doc_ids = id_bytes, 0, [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit. doc_ids ascend, nulls first."""
        import numpy as np

        self.ids += len(ids) // 4
        self.ends.append(self.ids)
        self.doc_ids.append(doc_id)
        self.out.write(ids if self.id_bytes == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())

    def close(self) -> None:
        nulls = sum(x is None for x in self.doc_ids)
        known = self.doc_ids[nulls:]
        first = known[0] if known else 0
        ends, doc_ids = EliasFano.of(self.ends).dump(), EliasFano.of([x - first for x in known]).dump()
        self.out.write(ends)
        self.out.write(doc_ids)
        self.out.write(_FOOTER.pack(_MAGIC, self.id_bytes, 0, self.ids, len(self.ends), len(ends), len(doc_ids), nulls, first))
        self.out.close()
        self.fs.move(self.temporary, self.path)


class ShardReader:
    """Reads boundaries at once and ids on demand."""

    def __init__(self, uri: str):
        self.fs, path = _open(uri)
        self.file = self.fs.open_input_file(path)
        size = self.file.size()
        magic, self.id_bytes, _, self.n_ids, self.n_docs, ends, doc_ids, self.nulls, self.first = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != _MAGIC:
            raise ValueError(f"not a token shard: {uri}")
        at = size - _FOOTER.size - doc_ids
        self.doc_ids = EliasFano.parse(self.file.read_at(doc_ids, at))
        self.ends = EliasFano.parse(self.file.read_at(ends, at - ends))

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.doc_ids.select(i - self.nulls) + self.first

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, a: int, b: int):
        """Ids a to b - 1 of the shard as unsigned 32-bit."""
        import numpy as np

        return np.frombuffer(self.file.read_at((b - a) * self.id_bytes, a * self.id_bytes), f"<u{self.id_bytes}").astype("<u4")

    def documents(self, most: int = 1024) -> Iterator[tuple[int | None, int, object]]:
        """(doc_id, start, ids) of every document, reading a run of documents at a time."""
        for a in range(0, self.n_docs, most):
            b = min(a + most, self.n_docs)
            ends = [self.span(a)[0], *self.ends.range(a, b).tolist()]
            names = [None] * max(0, min(b, self.nulls) - a) + (self.doc_ids.range(max(a, self.nulls) - self.nulls, max(b, self.nulls) - self.nulls) + self.first).tolist()
            run = self.ids(ends[0], ends[-1])
            for k in range(b - a):
                yield names[k], ends[k], run[ends[k] - ends[0] : ends[k + 1] - ends[0]]


def write_token_ids(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = 0, byte_level: bool = True, special_as_text: bool = False) -> list[dict]:
    """Write docs (doc_id, text) as shards below out; returns a manifest row for each shard with its first id's place."""
    path = tokenizer or tokenizer_file("byte_bpe_50k.json")
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, end, writer = encoder(path, byte_level, special_as_text), end_id.to_bytes(4, "little"), None
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        id_bytes = 2 if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            for part in slices(batch):
                writer = writer or ShardWriter(f"{out}/shard-{shard:08d}.tids", id_bytes, attempt)
                for doc_id, ids in zip(part.column(0).to_pylist(), encode.encode_texts(part.column(1).cast(pa.binary()).to_pylist())):
                    writer.add(doc_id, ids + end)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": f"{out}/shard-{shard:08d}.tids", "n_docs": len(writer.ends), "n_ids": writer.ids}])

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keys = [F.col("doc_id"), F.xxhash64("text")]
    shards = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, "shard long, path string, n_docs long, n_ids long")
    manifest, start = [], 0
    for row in sorted(shards.collect(), key=lambda r: r["shard"]):  # a row for each shard
        manifest.append(row.asDict() | {"start": start})
        start += row["n_ids"]
    return manifest


def read_token_ids(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """Every document of the shards: doc_id, start (ids before it), ids (binary, little-endian unsigned 32-bit)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                size = 0
                for doc_id, start, ids in ShardReader(row["path"]).documents():
                    rows.append({"doc_id": doc_id, "start": row["start"] + start, "ids": ids.tobytes()})
                    size += len(rows[-1]["ids"])
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    ship(spark)
    shards = spark.createDataFrame([(m["path"], m["start"]) for m in manifest], "path string, start long")
    return shards.repartition(max(1, len(manifest))).mapInArrow(run, "doc_id long, start long, ids binary")




def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_ids(load(spark, sf_dir, "documents"), shared_path(spark, "token-ids"))
    back = read_token_ids(spark, manifest)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
