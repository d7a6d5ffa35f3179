"""Reversible line dedup: sharded cuckoo filters backed by an exact reference-count table.

A line's key is its 128-bit BLAKE2b digest after stripping and lower-casing, as two longs. ``LineIndex`` holds, as
tables in the shared folder,

* ``refs`` (h1, h2, n, largest): how many documents hold a key, and the largest doc_id among them; exact;
* ``posts`` (h1, h2, doc_id): who holds it, so that deletions can be undone line by line;
* ``filters`` (shard, table): a cuckoo filter of each shard's keys.

``insert`` asks the filters first: a key that a filter does not know is new for certain and is appended without a look
at ``refs``; only the others are joined with it, and those that ``refs`` does not hold are new as well. Every new key leaves
a mark of its own in its filter, also where the filter knew that mark from another key, so that a deletion never takes away
what a key that stays needs. ``delete`` lowers the counts, takes keys that reach 0 out of table and filter, and finds the
next largest holder of the others. Counts are summed before they are shuffled, so a line that a third of all documents hold
is one row a task. A filter that gets too full is built anew, larger, from its shard's keys; there are more shards once
they hold twice the keys meant for them. A whole table is loaded in ``LOADS`` insertions, dealt by doc_id.

Defined results: a null or empty text is one empty line; keys of fewer than ``min_chars`` code points are never dropped;
a line repeated inside a document counts once; each row is a document, and rows that share the largest doc_id all keep
the line; a row with a null doc_id counts as a document and loses nothing; an empty table gives an empty result; other
columns are carried by ``drop_lines`` and ignored by the rest.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm.common import LOWER, keyed_texts, table, texts_of, unused
from chronoload.session import prepare, stage

MIN_CHARS = 20
MIN_DOCS = 3
LOADS = 3
KEYS_PER_SHARD = 1 << 17
_WHITE = b" \t\n\x0b\x0c\r"
_SLOTS = 4
_KICKS = 500


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    key = line.strip(_WHITE)
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.blake2b(key.translate(LOWER), digest_size=16).digest()


class CuckooFilter:
    """Four 16-bit marks a bucket, two buckets a key; 0 is an empty slot. Works on arrays of 64-bit key hashes."""

    def __init__(self, slots: np.ndarray) -> None:
        self.slots = slots
        self.mask = np.uint64(len(slots) - 1)

    @classmethod
    def of(cls, keys: np.ndarray, room: int = 0) -> CuckooFilter:
        """A filter of all ``keys`` with buckets for ``room`` keys at least."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(len(keys), room, 1) / (_SLOTS * 0.8)))))
        while True:
            made = cls(np.zeros((buckets, _SLOTS), np.uint16))
            if made.insert(keys):
                return made
            buckets *= 2

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, _SLOTS).copy())

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = keys.astype(np.uint64)
        mark = (keys >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = keys & self.mask
        return mark, first.astype(np.int64), self._other(first, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        spread = mark.astype(np.uint64) * np.uint64(0x5BD1E995)
        return ((bucket.astype(np.uint64) ^ spread) & self.mask).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        wanted = mark[:, None]
        return (self.slots[one] == wanted).any(1) | (self.slots[two] == wanted).any(1)

    def _fill(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts marks into free slots of their buckets; which found none."""
        order = np.argsort(bucket, kind="stable")
        sorted_ = bucket[order]
        head = np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(order) else np.empty(0, bool)
        start = np.flatnonzero(head)
        rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        free = self.slots[sorted_] == 0
        fits = rank < free.sum(1)
        slot = np.argmax(np.cumsum(free, 1) == (rank + 1)[:, None], 1)
        self.slots[sorted_[fits], slot[fits]] = mark[order[fits]]
        left = np.zeros(len(mark), bool)
        left[order[~fits]] = True
        return left

    def insert(self, keys: np.ndarray) -> bool:
        """Adds keys that are not in it. False: no room; the filter is then to be built anew."""
        mark, one, two = self._places(keys)
        left = self._fill(mark, one)
        mark, two = mark[left], two[left]
        left = self._fill(mark, two)
        for m, b in zip(mark[left].tolist(), two[left].tolist(), strict=True):
            for kick in range(_KICKS):
                row = self.slots[b]
                empty = np.flatnonzero(row == 0)
                if len(empty):
                    row[empty[0]] = m
                    break
                m, row[kick % _SLOTS] = int(row[kick % _SLOTS]), m
                b = int(self._other(np.array([b]), np.array([m], np.uint16))[0])
            else:
                return False
        return True

    def remove(self, keys: np.ndarray) -> None:
        """Takes out keys that are in it."""
        mark, one, two = self._places(keys)
        for m, a, b in zip(mark.tolist(), one.tolist(), two.tolist(), strict=True):
            for bucket in (a, b):
                at = np.flatnonzero(self.slots[bucket] == m)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, doc_id``: the distinct keys of each document."""
    prepare(docs.sparkSession)

    def make(batches):
        for batch in batches:
            ids = batch.column(0)
            digests, owner = [], []
            for i, text in enumerate(texts_of(batch)):
                if text:
                    own = {k for k in (line_key(line, min_chars) for line in text.split(b"\n")) if k}
                    digests += own
                    owner += [i] * len(own)
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), ids.take(pa.array(owner, pa.int64()))],
                names=["h1", "h2", "doc_id"])

    return keyed_texts(docs).mapInArrow(make, "h1 long, h2 long, doc_id long")


def _counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("largest"))


def _with_shard(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.col("h2"), F.lit(shards)).cast("int"))


def _hash64(keys: pa.Table) -> np.ndarray:
    return keys["h1"].to_numpy().astype(np.int64).view(np.uint64)


def _probe(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """The keys of a shard, and whether its filter knows them."""
    known = np.zeros(len(keys), bool)
    if len(filters) and len(keys):
        known = CuckooFilter.load(filters["table"][0].as_py()).contains(_hash64(keys))
    return keys.select(["h1", "h2", "n", "largest"]).append_column("known", pa.array(known))


def _filter_row(shard: pa.Scalar, data: bytes) -> pa.Table:
    return pa.table({"shard": pa.array([shard.as_py()], pa.int32()), "table": pa.array([data], pa.binary())})


def _marked(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """A shard's filter with the marks of new keys; empty if it has no room and is to be built anew."""
    if not len(filters):
        return _filter_row(keys["shard"][0], CuckooFilter.of(_hash64(keys)).dump())
    own = CuckooFilter.load(filters["table"][0].as_py())
    return _filter_row(filters["shard"][0], own.dump() if own.insert(_hash64(keys)) else b"")


def _unmarked(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """A shard's filter without the marks of dead keys."""
    if not len(filters):
        return filters.select(["shard", "table"])
    own = CuckooFilter.load(filters["table"][0].as_py())
    own.remove(_hash64(keys))
    return _filter_row(filters["shard"][0], own.dump())


def _built(keys: pa.Table) -> pa.Table:
    return _filter_row(keys["shard"][0], CuckooFilter.of(_hash64(keys)).dump())


_FILTER = "shard int, table binary"


@dataclass(frozen=True)
class LineIndex:
    """State after some insertions and deletions; each step makes a new one and leaves the old one as it is."""

    spark: SparkSession
    shards: int
    refs: DataFrame | None = None
    posts: DataFrame | None = None
    filters: DataFrame | None = None

    @staticmethod
    def empty(spark: SparkSession, expected_keys: int = KEYS_PER_SHARD) -> LineIndex:
        prepare(spark)
        return LineIndex(spark, max(1, -(-expected_keys // KEYS_PER_SHARD)))

    def _filters_of(self, keys: DataFrame) -> DataFrame:
        return _with_shard(keys, self.shards).select("shard", "h1").groupBy("shard").applyInArrow(_built, _FILTER)

    def _with_filters(self, keys: DataFrame, change, schema: str) -> DataFrame:
        sharded = _with_shard(keys, self.shards)
        return sharded.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(change, schema)

    def _roomier(self) -> LineIndex:
        """With more shards, once they hold twice the keys meant for them."""
        keys = self.refs.count()
        if keys <= 2 * self.shards * KEYS_PER_SHARD:
            return self
        wider = replace(self, shards=-(-keys // KEYS_PER_SHARD))
        return replace(wider, filters=stage(wider._filters_of(self.refs), "line-filters"))

    def insert(self, posts: DataFrame) -> LineIndex:
        """``posts`` as of ``line_keys``, of documents that are not in the index."""
        batch = _counts(posts)
        if self.refs is None:
            refs = stage(batch, "line-refs")
            return replace(self, refs=refs, posts=posts, filters=stage(self._filters_of(refs), "line-filters"))._roomier()
        probed = self._with_filters(batch, _probe, "h1 long, h2 long, n long, largest long, known boolean")
        probed = stage(probed, "line-probe")
        known = probed.where("known").select("h1", "h2", F.col("n").alias("n2"), F.col("largest").alias("largest2"))
        met = self.refs.join(known, ["h1", "h2"], "full_outer").select(
            "h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
            F.greatest("largest", "largest2").alias("largest"), F.col("n").isNull().alias("fresh"))
        unknown = probed.where("not known").select("h1", "h2", "n", "largest", F.lit(True).alias("fresh"))
        merged = stage(met.unionByName(unknown), "line-refs")
        refs = merged.drop("fresh")
        marked = stage(self._with_filters(merged.where("fresh").select("h1", "h2"), _marked, _FILTER), "line-marks")
        full = marked.where(F.length("table") == 0).select("shard")
        again = self._filters_of(_with_shard(refs, self.shards).join(full, "shard", "left_semi").drop("shard"))
        filters = stage(marked.where(F.length("table") > 0).unionByName(again), "line-filters")
        return replace(self, refs=refs, posts=self.posts.unionByName(posts), filters=filters)._roomier()

    def delete(self, posts: DataFrame) -> LineIndex:
        """``posts`` as of ``line_keys``, of documents that are in the index."""
        gone = posts.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("doc_id").alias("gd")).distinct()
        same = (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & F.col("doc_id").eqNullSafe(F.col("gd"))
        left = stage(self.posts.join(gone, same, "left_anti"), "line-posts")
        touched = posts.select("h1", "h2").distinct()
        again = _counts(left.join(touched, ["h1", "h2"], "left_semi"))
        rest = self.refs.join(touched, ["h1", "h2"], "left_anti")
        refs = stage(rest.unionByName(again), "line-refs")
        dead = touched.join(refs, ["h1", "h2"], "left_anti")
        filters = stage(self._with_filters(dead, _unmarked, _FILTER), "line-filters")
        return replace(self, refs=refs, posts=left, filters=filters)

    def losses(self, posts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """``doc_id, lost``: the keys each document of ``posts`` loses, as binary digests."""
        often = self.refs.where(F.col("n") >= min_docs).select("h1", "h2", "largest")
        hit = posts.join(often, ["h1", "h2"]).where("doc_id < largest")
        return hit.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))


def _kept(text: bytes | None, lost: set, min_chars: int) -> tuple[list[bytes], int]:
    lines = (text or b"").split(b"\n")
    kept = [line for line in lines if line_key(line, min_chars) not in lost] if lost else lines
    return kept, len(lines)


def _lost_sets(column: pa.Array):
    """For each row the digests it loses, as a set."""
    offsets = column.offsets.to_pylist()
    pairs = column.values
    h = np.stack([pairs.field(0).to_numpy(zero_copy_only=False), pairs.field(1).to_numpy(zero_copy_only=False)], 1)
    raw = np.ascontiguousarray(h.astype("<i8")).tobytes()
    for i in range(len(column)):
        yield {raw[16 * k : 16 * k + 16] for k in range(offsets[i], offsets[i + 1])}


def _judged(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """``docs`` and, as last column, what each loses, by an index into which all of them were inserted."""
    spark = prepare(docs.sparkSession)
    posts = stage(line_keys(docs, min_chars), "line-posts")
    index = LineIndex.empty(spark, posts.count())
    for load in range(LOADS):
        index = index.insert(posts.where(F.pmod(F.xxhash64("doc_id"), F.lit(LOADS)) == load))
    loser, lost = unused(docs, "loser"), unused(docs, "lost")
    losses = index.losses(posts, min_docs).select(F.col("doc_id").alias(loser), F.col("lost").alias(lost))
    return docs.join(losses, docs["doc_id"] == losses[loser], "left").drop(loser).withColumn(
        lost, F.coalesce(lost, F.array().cast("array<struct<h1:bigint,h2:bigint>>")))


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept_sha256``."""
    def report(batches):
        for batch in batches:
            n, dropped, digest = [], [], []
            for text, lost in zip(texts_of(batch), _lost_sets(batch.column(2)), strict=True):
                kept, lines = _kept(text, lost, min_chars)
                n.append(lines)
                dropped.append(lines - len(kept))
                digest.append(hashlib.sha256(b"\n".join(kept) if lost else text or b"").hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return _judged(keyed_texts(docs), min_docs, min_chars).mapInArrow(
        report, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with all its columns; ``text`` has lost the repeated lines, ``n_chars``, if there, follows it."""
    def rewrite(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            old = batch.column(at)
            texts = []
            for text, lost in zip(texts_of(batch), _lost_sets(batch.column(batch.num_columns - 1)), strict=True):
                texts.append(b"\n".join(_kept(text, lost, min_chars)[0]) if lost else text)
            arrays = list(batch.columns[:-1])
            arrays[at] = pa.array(texts, pa.binary()).cast(old.type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    out = _judged(docs, min_docs, min_chars).mapInArrow(rewrite, docs.schema)
    kind = dict(docs.dtypes).get("n_chars")
    return out.withColumn("n_chars", F.char_length("text").cast(kind)) if kind else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


SQL = r"""WITH l AS MATERIALIZED (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(w) AS line, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents))),
c AS MATERIALIZED (SELECT k, max(doc_id) AS largest FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.doc_id, i, line, coalesce(l.doc_id < largest, FALSE) AS gone FROM l LEFT JOIN c ON l.k = c.k)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id"""
