"""Token-id files with one shared zstandard dictionary.

Layout, little-endian. A data set is a folder of ``*.tok`` files and one dictionary ``<sha256>.zdict``, trained on
the serialized id arrays of a bounded sample of short documents. A file holds documents of one range of doc_id in
ascending order, and ends at ``FILE_DOCS`` documents or ``FILE_BYTES``, so its index stays small:

* header, 64 bytes: magic ``LSPTOK01``, u32 version, u32 bytes an id, 32 bytes dictionary sha256, 16 zero bytes;
* one zstandard frame for each document, compressed by itself with the dictionary: its ids as u32;
* index: for each document i64 doc_id (``NO_ID`` for null), u64 offset and u32 bytes of its frame, u64 ids of the
  documents before it in the file, u32 number of ids;
* footer, 32 bytes: u64 offset of the index, u64 documents, u64 ids, u32 crc32 of the index, magic ``TOK1``.

So one document is one read of the index and one of a frame. The manifest that ``write`` returns has a row for each
file with ``base``, the ids of all files before it. Files are written under names of their own and count only once
they are in the manifest, so a task that is lost or runs twice leaves nothing that is read.

Edge cases: a null or empty text has the end id alone. Documents of equal doc_id stand in the order of the xxhash64
of their text, then of the text. Null ids come first. An empty table has no files. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, table
from .pieces import PieceStore, slices

MAGIC, TAIL, VERSION = b"LSPTOK01", b"TOK1", 1
NO_ID = -(2**63)
ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("size", "<u4"), ("start", "<u8"), ("n", "<u4")])
END_ID = 1
#: Words of plain letters; distinct words that a Python worker remembers.
PLAIN, WORDS = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+").fullmatch, 800_000
#: A file ends when it has so many documents or bytes.
FILE_DOCS, FILE_BYTES = 1 << 18, 1 << 28
#: Bytes of frames that are read together.
AHEAD = 8_000_000
#: Documents of the dictionary's sample, and the most ids that one of them may have.
SAMPLE_DOCS, SAMPLE_IDS, DICT_BYTES, LEVEL = 1000, 4096, 65536, 3


class WordTokenizer:
    """A tokenizer of the tokenizers library that lower-cases, and whose pre-tokens never span white space: words can be
    encoded one by one. To have fewer distinct words, two changes are made that the tokenizer makes or doesn't notice:
    A-Z become lower case where the text has no character over U+02FF (such texts are in normal form C either way), and
    a word ends before a full stop or comma after a letter, which always starts a pre-token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.store = PieceStore(self._encode, WORDS)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of plain letters are one pre-token each and are encoded in lines of many, others one by one."""
        lens, ids = np.empty(len(pieces), np.int64), [None, None]
        plain = np.fromiter(map(bool, map(PLAIN, pieces)), bool, len(pieces))
        places = [np.flatnonzero(plain), np.flatnonzero(~plain)]
        words = [pieces[i] for i in places[0]]
        lines = [" ".join(words[k : k + 100]) for k in range(0, len(words), 100)]
        ids[0] = np.array([i for x in self._batches(lines) for i in x], np.int32)
        last = np.flatnonzero(self.ends_word[ids[0]])
        lens[plain] = np.diff(last, prepend=-1)
        each = list(self._batches([pieces[i] for i in places[1]]))
        lens[~plain] = np.fromiter(map(len, each), np.int64, len(each))
        ids[1] = np.array([i for x in each for i in x], np.int32)
        flat, starts = np.empty(int(lens.sum()), np.int32), np.cumsum(lens) - lens
        for at, own in zip(places, ids, strict=True):
            n = lens[at]
            flat[np.arange(len(own)) + np.repeat(starts[at] - (np.cumsum(n) - n), n)] = own
        return flat, lens

    def _batches(self, texts: list[str]) -> Iterator[list[int]]:
        for k in range(0, len(texts), 5000):
            for x in self.tokenizer.encode_batch_fast(texts[k : k + 5000], add_special_tokens=False):
                yield x.ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the number of ids of each."""
        texts = pc.fill_null(texts, "")
        lower = pc.replace_substring_regex(pc.ascii_lower(texts), pattern=r"([a-z])([.,])", replacement=r"\1 \2")
        cut = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(texts, pattern=r"[^\x{0}-\x{2FF}]"), texts, lower))
        return self.store.lay_out(cut.flatten(), np.diff(cut.offsets.to_numpy()))


@lru_cache(maxsize=2)
def load(path: str) -> WordTokenizer:
    """The tokenizer, once in each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokenizer(path)


def _serialized(texts: pa.Array, tokenizer: str, end_id: int) -> Iterator[bytes]:
    word = load(tokenizer)
    end = np.array([end_id], "<u4")
    for a, b in slices(texts, 4_000_000):
        flat, n = word.encode(texts.slice(a, b - a))
        at = 0
        for k in n.tolist():
            yield np.concatenate([flat[at : at + k].astype("<u4"), end]).tobytes()
            at += k


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int = END_ID, sample: int = SAMPLE_DOCS, most_ids: int = SAMPLE_IDS) -> bytes:
    """Dictionary from the ``sample`` documents of smallest hash; of these only those of ``most_ids`` ids at most, as
    the dictionary serves short documents. Nothing else is fitted on the sample."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [r for r in _serialized(batch.column(0), tokenizer, end_id) if len(r) <= 4 * most_ids]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["ids"])

    some = docs.select("text").where(F.length("text") <= 16 * most_ids).orderBy(F.xxhash64("text")).limit(sample)
    samples = [bytes(r.ids) for r in some.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples: their bytes are the dictionary
        return b"".join(samples)[-DICT_BYTES:] or bytes(8)


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + path.removeprefix("file:")


def write(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> list[dict]:
    """Writes ``docs`` (doc_id, text) to ``folder``; the manifest: name, docs, ids and base of each file, in order."""
    folder = _uri(folder)
    raw = train_dictionary(docs, tokenizer, end_id)
    key = hashlib.sha256(raw).hexdigest()
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{key}.zdict") as f:
        f.write(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        part, fs, out = TaskContext.get().partitionId(), None, None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw))
        number, name, index, offset, start = 0, "", [], 64, 0

        def closed() -> pa.RecordBatch:
            table = np.array(index, ENTRY).tobytes()
            out.write(table)
            out.write(struct.pack("<QQQI4s", offset, len(index), start, zlib.crc32(table), TAIL))
            out.close()
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "name": [name], "docs": pa.array([len(index)], pa.int64()), "ids": pa.array([start], pa.int64())})

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), _serialized(batch.column(1), tokenizer, end_id), strict=True):
                if out is not None and (len(index) >= FILE_DOCS or offset >= FILE_BYTES):
                    yield closed()
                    out, number = None, number + 1
                if out is None:
                    fs, top = _open(folder)
                    name = f"{part:06d}-{number:04d}-{uuid.uuid4().hex}.tok"
                    out, index, offset, start = fs.open_output_stream(f"{top}/{name}"), [], 64, 0
                    out.write(struct.pack("<8sII32s16x", MAGIC, VERSION, 4, bytes.fromhex(key)))
                frame = press.compress(data)
                out.write(frame)
                index.append((NO_ID if doc_id is None else doc_id, offset, len(frame), start, len(data) // 4))
                offset, start = offset + len(frame), start + len(data) // 4
        if out is not None:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    # Rows of one id, or without any, are dealt by text; equal rows by where they stand.
    ordered = rows.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "text", "row").select("doc_id", "text")
    files = sorted(ordered.mapInArrow(run, "part int, number int, name string, docs bigint, ids bigint").collect())
    base, manifest = 0, []
    for f in files:
        manifest.append({"name": f.name, "docs": f.docs, "ids": f.ids, "base": base})
        base += f.ids
    return manifest


class TokenFile:
    """Random access to the documents of one file."""

    def __init__(self, folder: str, name: str):
        import zstandard

        self.fs, root = _open(_uri(folder))
        self.file = self.fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        magic, version, width, key = struct.unpack("<8sII32s16x", self.file.read_at(64, 0))
        at, n, self.n_ids, crc, tail = struct.unpack("<QQQI4s", self.file.read_at(32, size - 32))
        if magic != MAGIC or tail != TAIL or version != VERSION or width != 4:
            raise ValueError(f"{name} is no token file of version {VERSION}")
        raw = self.file.read_at(n * ENTRY.itemsize, at)
        if zlib.crc32(raw) != crc:
            raise ValueError(f"the index of {name} is damaged")
        self.index = np.frombuffer(raw, ENTRY)
        with self.fs.open_input_file(f"{root}/{key.hex()}.zdict") as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != key:
            raise ValueError(f"the dictionary of {name} is another one")
        self.inflate = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def stream(self) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Index entries and ids (u32 little-endian bytes) of all documents in order. Frames lie side by side, so they are
        read many at once; no more than about AHEAD bytes of frames and of ids, or one document, are held."""
        ends = (self.index["offset"] + self.index["size"]).astype(np.int64)
        first = 0
        while first < len(self):
            at = int(self.index["offset"][first])
            last = max(first + 1, int(np.searchsorted(ends, at + AHEAD, "right")))
            frames = self.file.read_at(int(ends[last - 1]) - at, at)
            rows: list[bytes] = []
            size, begin = 0, first
            for k in range(first, last):
                e = self.index[k]
                low = int(e["offset"]) - at
                rows.append(self.inflate.decompress(frames[low : low + int(e["size"])], max_output_size=4 * int(e["n"])))
                size += len(rows[-1])
                if size >= AHEAD or k == last - 1:
                    yield self.index[begin : k + 1], rows
                    rows, size, begin = [], 0, k + 1
            first = last

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document."""
        e = self.index[k]
        return np.frombuffer(self.inflate.decompress(self.file.read_at(int(e["size"]), int(e["offset"])), max_output_size=4 * int(e["n"])), "<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """Ids of the first document with this doc_id."""
        k = int(np.searchsorted(self.index["doc_id"], doc_id))
        return self.ids(k) if k < len(self.index) and self.index["doc_id"][k] == doc_id else None


def read(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (u32 little-endian bytes) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for e, rows in TokenFile(folder, name).stream():
                    ids = pa.array(e["doc_id"], pa.int64(), mask=e["doc_id"] == NO_ID)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(e["start"].astype(np.int64) + base), pa.array(e["n"].astype(np.int64)), pa.array(rows, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    if not manifest:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame([(f["name"], f["base"]) for f in manifest], "name string, base bigint").repartition(len(manifest))
    return files.mapInArrow(run, schema)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = write(spark, table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, folder, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
