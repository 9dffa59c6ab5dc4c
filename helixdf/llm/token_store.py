"""Token ids of documents in small compressed frames with a shared zstandard dictionary.

A shard file holds, for documents in ascending order of their id:

    magic ``TOKZ0001`` | sha256 of the dictionary (32 bytes) | frames, one per
    document (zstandard with the shared dictionary over little-endian unsigned
    32-bit ids) | index: per document offset, frame length, number of ids and
    document id (4 unsigned/signed 64-bit numbers) | number of documents, 64 bits

The dictionary file lies beside the shards and is named by its hash; a reader
checks it, and can fetch one document by reading the index and one frame.

Documents are range-partitioned by id and encoded and written in one pass; the
tokens never pass a shuffle. Each task writes a file of its own name and returns
it, and only files named by the stored manifest belong to the result, so retried or
doubled tasks leave no wrong data. Files are written with pyarrow's file systems to
the shared folder.

Texts are encoded with the tokenizers library. Where a text has single spaces and
line breaks only (and none at its ends), its tokens never span them, so words are
encoded once and looked up after that (by 128-bit hashes, with numpy); any other text, and
any that holds an added token such as ``<|endoftext|>``, is encoded whole.

Defined cases: null text is empty and gives the end id alone; repeated ids keep all
their rows; an empty table gives no shards.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix64, powers, shared_path

MAGIC = b"TOKZ0001"
HEAD = len(MAGIC) + 32
END_ID = 2
SAMPLE_DOCS = 400
#: Characters of a sample document that the dictionary is trained on.
WINDOW = 30_000
DICT_BYTES = 64 << 10
LEVEL = 3
#: Words that a worker remembers, and bytes of texts that it looks up together.
CACHE = 500_000
BATCH = 1 << 19


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes
    for themselves, the others in order from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(printable))}


_LETTERS = _byte_letters()
#: Characters that end words and never join with letters into one token.
_ENDINGS = ".,!?;:%&$#*|"
_ODD_BYTES = b"\0\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_ODD = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CODES = [mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_BASES = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25))


class Known:
    """Words (by 128 bits of two hashes) and their ids, one after another in one array."""

    def __init__(self):
        self.h1 = self.h2 = np.zeros(0, dtype=np.uint64)
        self.at, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def find(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words (ascending ``h1``) and whether they are known."""
        if not len(self.h1):
            return np.zeros(len(h1), dtype=np.int64), np.zeros(len(h1), dtype=bool)
        k = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        return k, (self.h1[k] == h1) & (self.h2[k] == h2)

    def add(self, h1: np.ndarray, h2: np.ndarray, ids: list[list[int]]) -> None:
        size = np.array([len(x) for x in ids], dtype=np.int64)
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate((self.ids, np.fromiter((i for x in ids for i in x), dtype="<u4", count=int(size.sum()))))
        h1 = np.concatenate((self.h1, h1))
        o = np.argsort(h1, kind="stable")
        self.h1, self.h2 = h1[o], np.concatenate((self.h2, h2))[o]
        self.at, self.size = np.concatenate((self.at, at))[o], np.concatenate((self.size, size))[o]


class Encoder:
    """Token ids as little-endian bytes, with the words of plain texts remembered: a plain
    text's white space is single spaces and line breaks between words, which tokens never
    span, so its ids are those of its words, each behind what stands before it."""

    _made: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        pre = self.tok.pre_tokenizer
        self.byte_level = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and pre.use_regex
        self.known, self.endings = Known(), {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def whole(self, text: str) -> bytes:
        return np.array(self.ids(text), dtype="<u4").tobytes()

    def word(self, before: str, word: str) -> list[int]:
        """Ids of a word and the space or line break before it: letters are one pre-token
        with the space, and so are the marks that end them."""
        if before == "\n":
            return self.ending("\n") + self.word("", word)
        body = word.rstrip(_ENDINGS)
        if not body.isalpha():
            return self.ids(before + word)
        out = [t.id for t in self.tok.model.tokenize((before + body).encode().decode("latin-1").translate(_LETTERS))]
        return out + self.ending(word[len(body):]) if len(body) < len(word) else out

    def ending(self, text: str) -> list[int]:
        got = self.endings.get(text)
        if got is None:
            got = self.ids(text)
            if len(text) < 4:
                self.endings[text] = got
        return got

    def plain(self, text: str, data: bytes) -> bool:
        return (self.byte_level and text[0] not in " \n" and text[-1] not in " \n" and "  " not in text and "\n\n" not in text
                and " \n" not in text and "\n " not in text and len(data.translate(None, _ODD_BYTES)) == len(data)
                and not any(a in text for a in self.added) and (len(data) == len(text) or not _ODD.search(text)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out, at, some, size = [b""] * len(texts), [], [], 0
        for k, t in enumerate(texts):
            if not t:
                continue
            data = t.encode("utf-8", "surrogatepass")
            if not self.plain(t, data):
                out[k] = self.whole(t)
                continue
            at.append(k)
            some.append(data)
            size += len(data)
            if size > BATCH:
                for i, e in zip(at, self._plain(some)):
                    out[i] = e
                at, some, size = [], [], 0
        if some:
            for i, e in zip(at, self._plain(some)):
                out[i] = e
        return out

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        data = b"\0" + b"\0".join(texts) + b"\0"
        b = np.frombuffer(data, dtype=np.uint8)
        cut = np.flatnonzero((b == 32) | (b == 10) | (b == 0))
        low, high, before = cut[:-1] + 1, cut[1:], b[cut[:-1]]
        h1, h2 = (self._hashes(b, low, high, before, k) for k in (0, 1))
        u1, first, own = np.unique(h1, return_index=True, return_inverse=True)
        u2 = h2[first]
        if (u2[own] != h2).any():  # two words with one 64-bit hash
            return [self.whole(t.decode("utf-8", "surrogatepass")) for t in texts]
        if len(self.known.h1) > CACHE:
            self.known = Known()
        _, hit = self.known.find(u1, u2)
        if not hit.all():
            miss = np.flatnonzero(~hit)
            k = first[miss]
            lead = {0: "", 32: " ", 10: "\n"}
            self.known.add(u1[miss], u2[miss], [self.word(lead[v], data[i:j].decode("utf-8", "surrogatepass")) for v, i, j in zip(before[k].tolist(), low[k].tolist(), high[k].tolist())])
        place, hit = self.known.find(u1, u2)
        if not hit.all():  # a word known by an equal 64-bit hash
            return [self.whole(t.decode("utf-8", "surrogatepass")) for t in texts]
        place = place[own]
        size = self.known.size[place]
        end = np.cumsum(size)
        flat = self.known.ids[np.repeat(self.known.at[place] - (end - size), size) + np.arange(int(end[-1]))].tobytes()
        begin = np.append((4 * (end - size))[before == 0], 4 * int(end[-1])).tolist()
        return [flat[i:j] for i, j in zip(begin[:-1], begin[1:])]

    @staticmethod
    def _hashes(b: np.ndarray, low: np.ndarray, high: np.ndarray, before: np.ndarray, k: int) -> np.ndarray:
        # sum of byte code * base^(index from the word's start), from prefix sums of the whole batch
        power, inverse = powers(len(b) + 1, _BASES[k]), powers(len(b) + 1, np.uint64(pow(int(_BASES[k]), -1, 1 << 64)))
        acc = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_CODES[k][b] * power[:len(b)], out=acc[1:])
        return mix64((acc[high] - acc[low]) * inverse[low] + (before.astype(np.uint64) << np.uint64(32)) + (high - low).astype(np.uint64))


def _chunks(lists: list, n: int) -> Iterator[list]:
    for i in range(0, len(lists), n):
        yield lists[i:i + n]


def train_dictionary(docs: DataFrame, tokenizer: str, doc_id: str, text: str, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """Shared dictionary from a bounded sample: the ``sample_docs`` documents of smallest
    hash, of each a window of ``WINDOW`` characters that begins at a hashed place of the whole
    text, as training material."""
    place = F.xxhash64(F.lit(5), F.col(doc_id))
    chosen = docs.select(place.alias("h")).orderBy("h").limit(sample_docs).distinct()
    room = F.greatest(F.length(text) - WINDOW, F.lit(0)) + 1
    window = F.substring(F.col(text), F.pmod(F.xxhash64(F.lit(6), F.col(doc_id)), room).cast("int") + 1, F.lit(WINDOW))
    rows = (docs.select(place.alias("h"), window.alias("t")).join(F.broadcast(chosen), "h")
            .dropDuplicates(["h", "t"]).orderBy("h", "t").limit(sample_docs).collect())
    enc = Encoder(tokenizer)
    samples = [e for e in enc.encode([r["t"] for r in rows]) if e]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:  # too little material
        return b"".join(samples)[:DICT_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _write(folder: str, tokenizer: str, dictionary: bytes, end_id: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what earlier tasks left in this worker
        enc, tail = Encoder.of(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        zc = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True)
        out = None
        store, at = _file_system(folder)
        name, index, pos, total, first = f"{uuid.uuid4().hex}.tokz", [], HEAD, 0, None
        for batch in batches:
            for ids, texts in zip(_chunks(batch.column(0).to_pylist(), 256), _chunks(batch.column(1).to_pylist(), 256)):
                if out is None:
                    store.create_dir(at, recursive=True)
                    out = store.open_output_stream(f"{at}/{name}")
                    out.write(MAGIC + hashlib.sha256(dictionary).digest())
                    first = ids[0]
                for doc, data in zip(ids, enc.encode(texts)):
                    frame = zc.compress(data + tail)
                    out.write(frame)
                    index.append((pos, len(frame), len(data) // 4 + 1, doc if doc is not None else -(1 << 63)))
                    pos += len(frame)
                    total += len(data) // 4 + 1
        if out is not None:
            out.write(np.array(index, dtype="<i8").tobytes() + struct.pack("<q", len(index)))
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "first_id": pa.array([first], pa.int64()), "docs": [len(index)], "tokens": [total]},
                                             pa.schema([("file", pa.string()), ("first_id", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())]))
    return each


def write_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
                 folder: str | None = None) -> tuple[str, DataFrame]:
    """Write ``docs`` and return the folder and its manifest: shard, file, docs, tokens and
    start (ids of all shards before), one row per shard in order."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    dictionary = train_dictionary(docs, tokenizer, doc_id, text)
    store, at = _file_system(_uri(folder))
    store.create_dir(at, recursive=True)
    with store.open_output_stream(f"{at}/{hashlib.sha256(dictionary).hexdigest()}.dict") as f:
        f.write(dictionary)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(F.col("doc"), F.xxhash64("text")).sortWithinPartitions("doc", F.xxhash64("text"))
    # a row per partition: numbered by the partition, then prefix sums over that small table
    made = rows.mapInArrow(_write(_uri(folder), tokenizer, dictionary, end_id), "file string, first_id long, docs long, tokens long")
    made = made.withColumn("part", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = made.select(F.col("part").alias("shard"), "file", "docs", "tokens", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    return folder, manifest


def read_index(f, size: int) -> np.ndarray:
    f.seek(size - 8)
    n = struct.unpack("<q", f.read(8))[0]
    f.seek(size - 8 - 32 * n)
    return np.frombuffer(f.read(32 * n), dtype="<i8").reshape(n, 4)


def _reader(folder: str, digest: bytes, known: dict) -> zstandard.ZstdDecompressor:
    if digest not in known:
        store, at = _file_system(folder)
        with store.open_input_stream(f"{at}/{digest.hex()}.dict") as f:
            data = f.read()
        if hashlib.sha256(data).digest() != digest:
            raise ValueError("the dictionary does not match its hash")
        known[digest] = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
    return known[digest]


def _open(folder: str, file: str):
    store, at = _file_system(folder)
    f = store.open_input_file(f"{at}/{file}")
    head = f.read(HEAD)
    if head[:len(MAGIC)] != MAGIC:
        raise ValueError(f"{file} is not a token shard")
    return f, head[len(MAGIC):]


def read_document(folder: str, file: str, row: int) -> np.ndarray:
    """Ids of one document of a shard: reads the index and one frame."""
    folder = _uri(folder)
    f, digest = _open(folder, file)
    with f:
        at, length, _, _ = (int(x) for x in read_index(f, f.size())[row])
        f.seek(at)
        return np.frombuffer(_reader(folder, digest, {}).decompress(f.read(length)), dtype="<u4")


def _read(folder: str, with_ids: bool):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for shard, file, start in zip(*(c.to_pylist() for c in batch.columns)):
                f, digest = _open(folder, file)
                with f:
                    index, reader = read_index(f, f.size()), _reader(folder, digest, known)
                    f.seek(HEAD)
                    for some in range(0, len(index), 512):
                        part = index[some:some + 512]
                        data = [reader.decompress(f.read(int(n))) for n in part[:, 1]]
                        n_tokens = np.array([len(d) // 4 for d in data], dtype=np.int64)
                        starts = start + np.cumsum(n_tokens) - n_tokens
                        start += int(n_tokens.sum())
                        docs = pa.array([None if d == -(1 << 63) else int(d) for d in part[:, 3]], pa.int64())
                        cols = [pa.array([shard] * len(part), pa.int32()), docs, pa.array(starts), pa.array(n_tokens),
                                pa.array([zlib.crc32(d) for d in data], pa.int64())]
                        names = ["shard", "doc_id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            cols.append(pa.array([np.frombuffer(d, dtype="<u4").astype(np.int64) for d in data], pa.list_(pa.int64())))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(cols, names)
    return each


def read_tokens(folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of the shards in a manifest: shard, doc_id, start, n_tokens,
    ids_crc32 and, if asked, ids."""
    kind = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    files = manifest.select("shard", "file", "start").repartition(F.col("file"))
    return files.mapInArrow(_read(_uri(folder), with_ids), kind)
