"""Helpers shared by the training-data operators: words, tokenizers, shared storage."""

from __future__ import annotations

import atexit
import gc
import json
import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import compress, repeat
from operator import is_
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are not ASCII white space; in bytes this is what bytes.split() yields.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_BYTE_CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_MOST_SYMBOLS = 8
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_WIDE_GAPS = (b"  ", b"\n\n", b" \n", b"\n ", b"\t", b"\r", b"\x0b", b"\x0c")
#: White space that is not ASCII: with it in a text, byte-level pieces do not end where ASCII white space starts.
_ODD_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


#: Text of these characters alone is in normal form C, as none of them combines with another.
_LATIN = re.compile("[\x00-\u024f]*")
#: A normalizer that leaves the ids of such a text alone if it is in lower case (white space gives no ids).
_FOLDING = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]


def word_array(text: Column) -> Column:
    """The words of a text as array<string>; null and blank texts give an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words (0 for null) without an interpreted lambda."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each context, so that their Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    context._millrace_shipped = True
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("millrace", os.path.relpath(path, root)))
    context.addPyFile(archive)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: How the UTF-8 of such characters begins.
_ODD_BYTES = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")

def as_row(docs: DataFrame) -> Column:
    """All columns of a table as one struct named row, so that helper columns can't clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


# ---------------------------------------------------------------- shared storage

_made: dict[str, SparkSession] = {}
_recorders: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one of our own where unset.

    A folder of our own is on the driver's disk, so that is an error where executors are other processes.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared root; removed when the driver ends.

    All of an application's folders lie in millrace/<application id>, so what a killed driver leaves can be told.
    """
    path = f"{shared_root(spark)}/millrace/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    if not _made:
        atexit.register(_clean)
    _made[path] = spark
    for recorder in _recorders:
        recorder.append(path)
    return path


@contextmanager
def recording() -> Iterator[list[str]]:
    """The list of folders made in the meantime."""
    recorder: list[str] = []
    _recorders.append(recorder)
    try:
        yield recorder
    finally:
        _recorders[:] = [r for r in _recorders if r is not recorder]


def remove(spark: SparkSession, path: str) -> None:
    _made.pop(path, None)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _clean() -> None:
    for path, spark in list(_made.items()):
        if spark.sparkContext._jsc is None:
            return
        remove(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that materialize() made and nothing needs any more."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        # as Spark prints them, paths of local files may have more slashes than when they were made
        known = next((p for p in _made if re.sub("^file:/+", "/", p) == re.sub("^file:/+", "/", path)), path)
        remove(table.sparkSession, known)


def free_shuffles(spark: SparkSession) -> None:
    """Asks for a collection on the driver, after which Spark's cleaner drops the shuffle files of what has been written.

    Only disk space depends on it, and when it happens is up to the JVM; without it the files go with the application.
    The scheduler holds on to its latest job, so a small one goes first.
    """
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- hashes

_MASK = (1 << 64) - 1


@lru_cache(16)
def multipliers(n: int):
    """n odd 64-bit constants from splitmix64."""
    import numpy as np

    out, x = [], 0
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & _MASK
        z = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out.append((z ^ (z >> 31)) | 1)
    return np.array(out, np.uint64)


def mixed(x):
    """splitmix64's finalizer on unsigned 64-bit integers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        import numpy as np

        self.base, self.inverse = np.uint64(base), np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int):
        import numpy as np

        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, self.base)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, self.inverse)]), dtype=np.uint64)
        return self.up, self.down


_state: list = []
_LONG_WORD = 64
_PIECE = 1 << 20  # bytes hashed at a time


def _piece_hashes(text: bytes):
    """Words by a polynomial over random numbers for their bytes, from prefix sums; long words by xxhash."""
    import numpy as np

    if not _state:
        odd = multipliers(257)
        blank = np.zeros(256, bool)
        blank[[9, 10, 11, 12, 13, 32]] = True
        _state.extend([odd[:256], Powers(int(odd[256])), blank])
    table, powers, blank = _state
    b = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(blank[b], prepend=True, append=True))
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers.of(len(b) + 1)
    sums = np.empty(len(b) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[b] * up[: len(b)], dtype=np.uint64, out=sums[1:])
    out = mixed((sums[ends] - sums[starts]) * down[starts])
    for i in np.flatnonzero(ends - starts > _LONG_WORD).tolist():
        import xxhash

        out[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]])
    return out


_BLANK = re.compile(rb"[ \t-\r]")


def word_hashes(text: bytes):
    """A 64-bit hash of each word of a text (UTF-8) of any length."""
    import numpy as np

    if len(text) <= _PIECE:
        return _piece_hashes(text)
    parts, at = [], 0
    while at < len(text):
        gap = _BLANK.search(text, at + _PIECE)
        end = gap.start() if gap else len(text)
        parts.append(_piece_hashes(text[at:end]))
        at = end
    return np.concatenate(parts)


# ---------------------------------------------------------------- tokenizers


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_AFTER_END = b"\"')]}"
_LAST = bytes(1 if chr(c) in ".!?" else 2 if c in _AFTER_END else 0 for c in range(256))


def ends_sentence(word: bytes) -> bool:
    """Whether a word ends in . ! or ?, closing quotes or brackets aside."""
    last = _LAST[word[-1]]
    return last == 1 or last == 2 and word.rstrip(_AFTER_END)[-1:] in (b".", b"!", b"?")


class Encoder:
    """Whole-text encoding through the tokenizers library, remembering the ids of each distinct chunk.

    A text's ids are the ids of its chunks in order: neither kind of vocabulary merges across the places where
    chunks are cut (byte level: before white space that follows other characters; word level: at white space).
    Byte-level texts with white space outside ASCII are one chunk. New chunks go to the library joined, many at a time,
    and their ids are told apart by the tokens' lengths in bytes; where the ends don't agree, each chunk goes by itself.
    Word-level vocabularies are taken to ignore the case of A-Z.
    Special tokens that a text spells out get their own ids, as the library gives them, and part the text around them;
    with ``special_as_text`` they are ordinary text.
    New chunks that are lower-case Latin text skip a normalizer that would not change them.
    At most ``keep`` chunks of at most ``keep_bytes`` are remembered.
    With ``stops`` (word level) STOP follows the ids of words that end a sentence, and stands for a line break.

    Byte-level keys stand for " " + key, for key itself if it starts with a line feed, and for the rest after FIRST.
    """

    FIRST = b"\xff"
    BREAK = b"\xfe"  # a key without ids, for places between words
    SPECIAL = b"\xfd"  # begins the key of a special token
    STOP = b"\xff\xff\xff\xff"  # no id: follows the ids of keys that end a sentence, if these are asked for

    def __init__(self, path: str, byte_level: bool, keep: int = 1_300_000, keep_bytes: int = 64, special_as_text: bool = False, stops: bool = False):
        import numpy as np

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # those that count are keys of their own
        self.tokenizer.model._resize_cache(0)  # chunks come here once
        self.bare = self.tokenizer
        if self.tokenizer.normalizer and json.loads(self.tokenizer.normalizer.__getstate__()).get("normalizers") == _FOLDING:
            self.bare = Tokenizer.from_file(path)
            self.bare.encode_special_tokens = True
            self.bare.model._resize_cache(0)
            self.bare.normalizer = None
        self.byte_level, self.keep, self.keep_bytes = byte_level, keep, keep_bytes
        self.stops = stops
        self.fixed: dict[bytes, bytes] = {self.BREAK: self.STOP if stops else b""}
        self.special: dict[bytes, bytes] = {}  # token to key
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            if special_as_text and token.special:
                continue
            if token.normalized or token.lstrip or token.rstrip or token.single_word:
                raise ValueError(f"added token {token.content!r} is matched in a way that is not supported")
            key = self.special[token.content.encode()] = self.SPECIAL + str(i).encode()
            self.fixed[key] = i.to_bytes(4, "little")
        found = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile(b"(" + b"|".join(map(re.escape, found)) + b")")
        self.known: dict[bytes, bytes] = dict(self.fixed)
        self.marks: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)  # characters of a token stand for bytes
        for token, i in vocabulary.items():
            self.width[i] = len(token if byte_level else token.removesuffix("</w>"))

    def lowered(self, text: bytes) -> bytes:
        """A text for word-level vocabularies: special tokens replaced by their keys, A-Z lower-cased as the vocabulary does itself."""
        if any(s in text for s in self.special):
            text = self.special_at.sub(lambda m: b" " + self.special[m[0]] + b" ", text)
        return text.lower()

    def keys(self, text: bytes) -> list[bytes]:
        if not self.byte_level:
            return self.lowered(text).split()
        if any(s in text for s in self.special):
            return [k for part in self.special_at.split(text) for k in ([self.special[part]] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: bytes) -> list[bytes]:
        """Keys of a text without special tokens, byte level."""
        if not text:
            return []
        if not text.isascii() and any(x in text for x in _ODD_BYTES) and _ODD_SPACE.search(text.decode()):
            return [self.FIRST + text]
        if text[0] not in b" \n" and text[-1] not in b" \n" and not any(x in text for x in _WIDE_GAPS):
            keys = text.replace(b"\n", b" \n").split(b" ")
            keys[0] = self.FIRST + keys[0]
            return keys
        return [self._key(c) for c in _BYTE_CHUNK.findall(text)]

    def _key(self, chunk: bytes) -> bytes:
        plain = chunk[1:2] > b" "
        if plain and chunk[0] == 32:
            return chunk[1:]
        return chunk if plain and chunk[0] == 10 else self.FIRST + chunk

    def _text(self, key: bytes) -> bytes:
        if not self.byte_level or key[0] == 10:
            return key
        return key[1:] if key[:1] == self.FIRST else b" " + key

    def _alone(self, keys: list[bytes]) -> None:
        import numpy as np

        texts = [self._text(k).decode() for k in keys]
        for k, e in zip(keys, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            self.known[k] = np.array(e.ids, dtype="<u4").tobytes()

    def _joined(self, groups: list[list[bytes]], tokenizer) -> None:
        import numpy as np

        if self.byte_level:
            texts = [b"".join(map(self._text, g)) for g in groups]
        else:
            texts = [b" ".join(g) for g in groups]
        found = tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        for keys, text, e in zip(groups, texts, found, strict=True):
            ids = np.array(e.ids, dtype="<u4")
            at = np.cumsum(self.width[ids])
            ends = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)))
            if self.byte_level:
                ends += np.cumsum([k[0] != 10 for k in keys])
            elif not text.isascii():
                ends = np.cumsum([len(k) if k.isascii() else len(k.decode().lower().encode()) for k in keys])
            cut = np.searchsorted(at, ends)
            if len(at) and at[-1] == ends[-1] and (at[np.minimum(cut, len(at) - 1)] == ends).all():
                raw, stops = ids.tobytes(), ((cut + 1) * 4).tolist()
                self.known.update(zip(keys, [raw[a:b] for a, b in zip([0, *stops], stops)]))
            else:
                self._alone(keys)

    def _learn(self, missing: set[bytes]) -> list[bytes]:
        """Makes the ids of all these keys known; returns those to forget after use."""
        if len(self.known) > self.keep:
            self.known = dict(self.fixed)
            self.marks = {}
        long, ended, short = [], [], set()
        for k in missing:
            if len(k) > self.keep_bytes or k[:1] == self.FIRST:
                long.append(k)
                continue
            stem = k.rstrip(_SYMBOLS)
            # a letter and the symbols after it never share a piece: "word..." is "word" and "..."
            if 0 < len(k) - len(stem) <= _MOST_SYMBOLS and stem and stem[-1] in _LETTERS:
                ended.append((k, stem))
                short.add(stem)
            else:
                short.add(k)
        ascii, other = [], []
        for k in short:
            if k not in self.known:
                (ascii if k.isascii() else other).append(k)
        for new in (ascii, other):
            groups = [new[a : a + 128] for a in range(0, len(new), 128)]
            for a in range(0, len(groups), 16):
                some = groups[a : a + 16]
                text = b"" if new is ascii else b"".join(map(b"".join, some)).decode()
                latin = new is ascii or (_LATIN.fullmatch(text) and text == text.lower())
                self._joined(some, self.bare if latin else self.tokenizer)
        for k, stem in ended:
            self.known[k] = self.known[stem] + self.mark(k[len(stem) :])
        for a in range(0, len(long), 256):
            self._alone(long[a : a + 256])
        if self.stops:  # stems that came along end in letters
            for k in filter(ends_sentence, missing):
                self.known[k] += self.STOP
        return long

    def mark(self, symbols: bytes) -> bytes:
        if symbols not in self.marks:
            import numpy as np

            self.marks[symbols] = np.array(self.tokenizer.encode(symbols.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self.marks[symbols]

    def encode(self, lists: list[list[bytes]]) -> list[list[bytes]]:
        """Per list of keys: the ids of each key as little-endian unsigned 32-bit integers."""
        out = [list(map(self.known.get, x)) for x in lists]
        holes = [(x, e, list(compress(range(len(e)), map(is_, e, repeat(None))))) for x, e in zip(lists, out) if None in e]
        spare = self._learn({x[i] for x, _, at in holes for i in at})
        get = self.known.get
        for x, e, at in holes:
            for i in at:
                e[i] = get(x[i])
        for k in spare:
            del self.known[k]
        return out

    def encode_texts(self, texts: list[bytes | None]) -> list[bytes]:
        """Per text (UTF-8): all its ids as little-endian unsigned 32-bit integers."""
        return list(map(b"".join, self.encode([self.keys(t or b"") for t in texts])))


_encoders: dict[tuple[str, bool, bool, bool], Encoder] = {}


def encoder(path: str, byte_level: bool, special_as_text: bool = False, stops: bool = False) -> Encoder:
    """One encoder at a time in a Python worker."""
    key = path, byte_level, special_as_text, stops
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(path, byte_level, special_as_text=special_as_text, stops=stops)
    return _encoders[key]


def forget_encoders() -> None:
    """Free what a Python worker that is used again remembers from an earlier stage."""
    _encoders.clear()


def slices(batch, rows: int = 256):
    """Cut an Arrow batch so that a few texts are held as Python objects at a time.

    Lists of words are no garbage cycles: a Python worker that looks for these seldom spends a quarter less time.
    """
    gc.set_threshold(500_000, 50, 50)
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
