"""Token ids as binary files with a shared zstandard dictionary.

A run writes one dictionary file and shard files, each holding a range of doc_ids in ascending order:

    magic "IDZ1" | dictionary's SHA-256, 32 bytes | one zstandard frame per document
    index: int64 doc_id + 1 byte "id is null", uint64 offset, uint64 size, uint32 n_tokens, as columns
    uint64 offset of the index | uint64 number of documents | magic "IDZ1"

A frame is the document's ids as little-endian unsigned 32-bit integers, compressed alone with the dictionary, so a short
document is read by one look into the index and one frame. The dictionary is trained on the serialised ids of
``SAMPLE`` documents, those with the smallest hash of their ids, or is empty where those are too few to train on.

Shards are cut by quantiles of the doc_id. Attempts of a task write under names of their own; a manifest, committed by
Spark, names the files that count, so a lost executor or a second attempt leaves at most an unnamed file behind.

Defined results: a null or empty text has the end id alone; a null doc_id stands before all others; repeated ids are
written each, in any order among themselves; an empty table gives no shard and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoload.llm.bpe import shipped
from chronoload.llm.common import Cache, keyed_texts, table, uncollected
from chronoload.session import new_path, stage

MAGIC = b"IDZ1"
END = 2
SAMPLE = 512
DICTIONARY_BYTES = 64 << 10
DOCS_PER_SHARD = 1 << 14
LEVEL = 3
_MEMO = 600_000
#: Stands between words encoded in one call; a word that holds it is encoded alone.
_BETWEEN = "\x01"
#: Letters that normalisation only lower-cases, and signs that the pre-tokeniser cuts off.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: The byte-level alphabet writes the bytes 80 to A0 and AD, in order, from U+0122 on.
_BYTE_LEVEL = {b: 0x122 + k for k, b in enumerate((*range(0x80, 0xA1), 0xAD))}
#: str.split() cuts at these, the tokenizer does not: texts with one of them go to the library as they are.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by URI or absolute path."""
    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def _folded(text: str) -> str:
    """Lower case where Python and the normaliser agree on it: Latin-1 without a special token, whose case counts."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text if "<|" in text else text.lower()


class Encoder:
    """A tokenizers file whose pre-tokeniser never joins what white space parts: words are looked up one by one."""

    def __init__(self, path: str, end: int = END) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = struct.pack("<I", end)
        self.recent: dict[str, bytes] = {}  # words and their ids, in two generations of _MEMO
        self.older: dict[str, bytes] = {}
        self.signs = Cache(self._word, 10_000)
        (self.between,) = np.frombuffer(self._word(_BETWEEN), "<u4").tolist()

    def _word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, fresh: list[str]) -> None:
        """Encodes new words: plain ones by the library's merges, the others in one call of its whole chain."""
        found, merges, signs, rest = self.recent, self.tokenizer.model.tokenize, self.signs, []
        for w in fresh:
            plain = _PLAIN(w)
            if plain is None:
                if _BETWEEN in w:
                    found[w] = self._word(w)
                else:
                    rest.append(w)
                continue
            word, tail = plain.groups()
            word = word.lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(_BYTE_LEVEL)
            ids = array("I", [t.id for t in merges(word)]).tobytes()
            found[w] = ids + signs[tail] if tail else ids
        if rest:
            ids = np.array(self.tokenizer.encode(f" {_BETWEEN} ".join(rest), add_special_tokens=False).ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.between), len(ids))
            raw, begin = ids.tobytes(), 0
            for w, end in zip(rest, (4 * ends).tolist(), strict=True):
                found[w] = raw[begin:end]
                begin = end + 4

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of some texts, each with the end id, little-endian. A distinct word is looked up once."""
        odd = {k for k, t in enumerate(texts) if t and _SEPARATORS.search(t)}
        words = [_folded(t).split() if t and k not in odd else [] for k, t in enumerate(texts)]
        distinct = set().union(*words)
        if len(self.recent) + len(distinct) > _MEMO:
            self.older, self.recent = self.recent, {}
        recent, older, fresh = self.recent, self.older, []
        for w in distinct.difference(recent):
            ids = older.get(w)
            if ids is None:
                fresh.append(w)
            else:
                recent[w] = ids
        self._learn(fresh)
        look, end = recent.__getitem__, self.end
        return [
            (self._word(texts[k]) if k in odd else b"".join(map(look, own))) + end for k, own in enumerate(words)
        ]


@lru_cache(maxsize=2)
def _encoder(path: str, end: int) -> Encoder:
    return Encoder(path, end)


def _dictionary(docs: DataFrame, tokenizer_path: str, end: int) -> bytes:
    chosen = docs.where("text != ''").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    ids = [r.doc_id for r in chosen.collect() if r.doc_id is not None]
    encoder = Encoder(tokenizer_path, end)
    rows = docs.where(F.col("doc_id").isin(ids)).toLocalIterator() if ids else []
    parts = [encoder.encode_all([r.text])[0] for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return b""


def _zdict(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def encode_frames(docs: DataFrame, tokenizer_path: str, dictionary: bytes, end: int = END) -> DataFrame:
    """``doc_id, n_tokens, frame``: each document's ids, compressed alone."""
    spark = docs.sparkSession
    name = shipped(spark, tokenizer_path)
    sent = spark.sparkContext.broadcast(dictionary)

    def encode(batches):
        encoder = _encoder(SparkFiles.get(name), end)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(sent.value))
        for batch in batches:
            for a in range(0, len(batch), 1024):
                part = batch.slice(a, 1024)
                with uncollected():
                    raw = encoder.encode_all(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(r) // 4 for r in raw], pa.int64()),
                    pa.array([press.compress(r) for r in raw], pa.binary())], names=["doc_id", "n_tokens", "frame"])

    return keyed_texts(docs).mapInArrow(encode, "doc_id long, n_tokens long, frame binary")


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end: int = END) -> DataFrame:
    """Writes the files under ``folder`` (a URI that all executors reach); the manifest, a row per shard, in order."""
    spark = docs.sparkSession
    docs = keyed_texts(docs)
    dictionary = _dictionary(docs, tokenizer_path, end)
    mark = hashlib.sha256(dictionary).digest()
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{mark.hex()}.dictionary") as out:
        out.write(dictionary)
    frames = stage(encode_frames(docs, tokenizer_path, dictionary, end), "token-frames")
    total = frames.count()
    shards = max(1, -(-total // DOCS_PER_SHARD))

    def write(batches):
        name = f"{uuid.uuid4().hex}.ids"
        own, place = open_store(folder)
        columns: list[list] = [[], [], [], [], []]
        at, tokens, out = 0, 0, None
        for batch in batches:
            if out is None and len(batch):
                out = own.open_output_stream(f"{place}/{name}")
                at = out.write(MAGIC + mark)
            for i, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for c, v in zip(columns, (i or 0, i is None, at, len(frame), n), strict=True):
                    c.append(v)
                at += out.write(frame)
                tokens += n
        if out is None:
            return
        for c, kind in zip(columns, ("<i8", "u1", "<u8", "<u8", "<u4"), strict=True):
            out.write(np.array(c, kind).tobytes())
        out.write(struct.pack("<QQ", at, len(columns[0])) + MAGIC)
        out.close()
        nulls = sum(columns[1])
        first = columns[0][nulls] if nulls < len(columns[0]) else None
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([nulls > 0]), pa.array([first], pa.int64()), pa.array([len(columns[0])], pa.int64()),
             pa.array([tokens], pa.int64())], names=["file", "nulls", "first_id", "n_docs", "n_tokens"])

    ordered = frames.repartitionByRange(shards, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first())
    written = ordered.mapInArrow(write, "file string, nulls boolean, first_id long, n_docs long, n_tokens long")
    manifest = stage(written, "token-manifest")
    order = Window.orderBy(F.desc("nulls"), F.col("first_id").asc_nulls_first(), "file").rowsBetween(
        Window.unboundedPreceding, -1)
    return manifest.select("file", "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("start"))


class Shard:
    """One shard file opened for reading, whole or by document."""

    def __init__(self, folder: str, name: str) -> None:
        store, path = open_store(folder)
        self.file = store.open_input_file(f"{path}/{name}")
        size = self.file.size()
        tail = self.file.read_at(20, size - 20)
        index, n = struct.unpack("<QQ", tail[:16])
        head = self.file.read_at(36, 0)
        if tail[16:] != MAGIC or head[:4] != MAGIC:
            raise ValueError(f"{name} is no token file")
        mark = head[4:36]
        with store.open_input_stream(f"{path}/{mark.hex()}.dictionary") as source:
            dictionary = source.read()
        if hashlib.sha256(dictionary).digest() != mark:
            raise ValueError(f"{name} was written with another dictionary")
        raw = self.file.read_at(size - 20 - index, index)
        at = 0
        columns = []
        for kind in ("<i8", "u1", "<u8", "<u8", "<u4"):
            columns.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.doc_id, self.null, self.offset, self.size, self.n_tokens = columns
        self.unpress = zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))

    def frame(self, k: int) -> bytes:
        data = self.file.read_at(int(self.size[k]), int(self.offset[k]))
        return self.unpress.decompress(data, max_output_size=4 * int(self.n_tokens[k]))

    def document(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every row with this doc_id, by the index alone."""
        first = int(self.null.sum())
        a, b = np.searchsorted(self.doc_id[first:], [doc_id, doc_id + 1]) + first
        return [np.frombuffer(self.frame(k), "<u4") for k in range(a, b)]


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and ``ids`` of every document in the files that the manifest names."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def read(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(folder, name)
                begins = start + np.cumsum(shard.n_tokens.astype(np.int64)) - shard.n_tokens
                for a in range(0, len(begins), 1024):
                    b = min(a + 1024, len(begins))
                    raw = [shard.frame(k) for k in range(a, b)]
                    arrays = [pa.array(shard.doc_id[a:b], pa.int64(), mask=shard.null[a:b] > 0), pa.array(begins[a:b], pa.int64()),
                              pa.array(shard.n_tokens[a:b].astype(np.int64)), pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays + [pa.array(raw, pa.binary())] * with_ids, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    files = max(1, manifest.count())
    return manifest.select("file", "start").repartition(files).mapInArrow(read, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    folder = new_path(spark, "token-files")
    manifest = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_token_files(stage(manifest, "token-starts"), folder, with_ids=False)
