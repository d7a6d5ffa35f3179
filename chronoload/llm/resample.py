"""Importance resampling towards a target corpus: hashed word runs, a gain per bucket, a draw without replacement.

A block of texts (``BLOCK`` bytes, or one longer text) gives its distinct words. Each is an entry of an Aho-Corasick
automaton, between two spaces, with its CRC-32 and its length as payload; one scan of the block emits the payload of each
word. The CRC of a run of words is composed from the payloads of its parts (the CRC of a joined string follows from the two
CRCs and the length of the second), so no run is ever built as a string. Words of more than ``LONG`` bytes enter the
automaton under a short alias in capitals, which cannot occur in a lower-cased text, so its size is bounded by the block.

The corpus is scanned once: bucket numbers are written as one array a document (two bytes a feature), and read twice, for
the counts and for the scores. A task adds its counts up in one array, so at most ``buckets`` rows a task are shuffled and
2 * ``buckets`` numbers reach the driver; the gains go back as one array of that size. Ranks come from a range-partitioned
sort of narrow rows; no task sees all of them.

Defined results: null and empty texts have no words, weight 0 and are never drawn (``min_words`` of 1 or more); a null id
counts as the empty string in the draw and comes before other ids among ties; repeated rows are rows of their own, with the
same score and neighbouring ranks; an empty target or corpus leaves the added counts of one; an empty table gives an empty
result. Other columns are ignored, or carried if named in ``carry``.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator, Sequence
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm.common import WORDS, table, texts_of
from chronoload.llm.numbering import numbered
from chronoload.session import prepare, stage

RUN = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
BLOCK = 4 << 20
LONG = 64
RESULT = ("doc_id", "n_features", "weight", "score", "rank")


def _appended(length: int) -> np.ndarray:
    """What ``length`` zero bytes do to a CRC-32, as four tables of 256: the register's bytes act independently."""

    def times(a: list[int], b: list[int]) -> list[int]:
        return [_through(a, column) for column in b]

    out = [1 << k for k in range(32)]
    step = [0xEDB88320, *[1 << k for k in range(31)]]  # one zero bit; the number is CRC-32's reversed polynomial
    for _ in range(3):
        step = times(step, step)
    while length:
        if length & 1:
            out = times(step, out)
        step, length = times(step, step), length >> 1
    return np.array([[_through(out, byte << 8 * part) for byte in range(256)] for part in range(4)], np.uint32)


def _through(columns: list[int], value: int) -> int:
    out = 0
    for k, column in enumerate(columns):
        if value >> k & 1:
            out ^= column
    return out


class Payloads:
    """CRC-32 and length of each word of a block, and of the word behind a space."""

    def __init__(self, words: Sequence[bytes]) -> None:
        self.crc = np.array([0, *map(zlib.crc32, words)], np.uint32)  # entry 0 is the border between texts
        self.size = np.array([0, *map(len, words)], np.int64)
        self.spaced = None
        self._tables: dict[int, np.ndarray] = {}
        self._words = words

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """CRCs of strings with CRC ``left``, a space and the words of entries ``right``."""
        if self.spaced is None:
            start = zlib.crc32(b" ")
            self.spaced = np.array([0, *[zlib.crc32(w, start) for w in self._words]], np.uint32)
        size = self.size[right] + 1
        out = np.empty(len(left), np.uint32)
        for length in np.unique(size).tolist():
            own = np.flatnonzero(size == length)
            if length not in self._tables:
                self._tables[length] = _appended(length)
            moved, tables = left[own], self._tables[length]
            shifted = tables[0][moved & 255] ^ tables[1][moved >> 8 & 255] ^ tables[2][moved >> 16 & 255] ^ tables[3][moved >> 24]
            out[own] = shifted ^ self.spaced[right[own]]
        return out


def _emitted(texts: Sequence[bytes]) -> tuple[Payloads, np.ndarray]:
    """The block's payload table and the entry of each word in order; 0 closes each text."""
    split = [t.translate(WORDS).split() for t in texts]
    distinct = list(set().union(*split))
    alias = {w: b"A%d" % k for k, w in enumerate(distinct) if len(w) > LONG}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    automaton.add_word(" \n ", 0)
    for k, word in enumerate(distinct, 1):
        automaton.add_word(f" {alias.get(word, word).decode('latin-1')} ", k)
    automaton.make_automaton()
    if alias:
        split = [[alias.get(w, w) for w in words] for words in split]
    scanned = " " + "".join((b" ".join(words) + b" \n " if words else b"\n ").decode("latin-1") for words in split)
    return Payloads(distinct), np.fromiter(map(itemgetter(1), automaton.iter(scanned)), np.int64)


def bucket_arrays(texts: Sequence[bytes], run: int = RUN, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and buckets of all runs of 1 to ``run`` words, for each text of a block."""
    payloads, entry = _emitted(texts)
    ends = np.flatnonzero(entry == 0)
    starts = np.concatenate([[0], ends[:-1] + 1])
    crc = payloads.crc[entry]
    levels = [(crc % buckets, np.ones(len(entry), bool))]
    whole = entry > 0
    for k in range(2, run + 1):
        at = np.flatnonzero(whole[: len(entry) - k + 1] & (entry[k - 1 :] > 0))
        crc = crc.copy()
        crc[at] = payloads.joined(crc[at], entry[at + k - 1])
        whole = np.zeros(len(entry), bool)
        whole[at] = True
        levels.append((crc % buckets, whole))
    for a, b in zip(starts.tolist(), ends.tolist()):
        yield b - a, np.concatenate([values[a:b][there[a:b]] for values, there in levels])


def _blocks(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def hashed(docs: DataFrame, run: int = RUN, buckets: int = BUCKETS, carry: Sequence[str] = ()) -> DataFrame:
    """``text`` scanned: ``carry`` columns, ``n_words, n_features`` and ``buckets`` (binary, two or four bytes a feature)."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def scan(batches):
        for batch in batches:
            words, features, arrays = [], [], []
            for block in _blocks(t or b"" for t in texts_of(batch, "_text")):
                for n, values in bucket_arrays(block, run, buckets):
                    words.append(n)
                    features.append(len(values))
                    arrays.append(values.astype(kind).tobytes())
            kept = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(arrays, pa.binary())],
                names=[*carry, "n_words", "n_features", "buckets"])

    base = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").cast("string").alias("_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema if f.name in carry)
    return base.mapInArrow(scan, f"{schema}n_words long, n_features long, buckets binary")


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of the whole table by bucket."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for array in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(array, kind), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    return scanned.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln of the ratio of the bucket's smoothed shares), target over corpus, for each bucket."""
    n = {side: np.zeros(buckets, np.int64) for side in (0, 1)}
    both = bucket_counts(corpus, buckets).withColumn("side", F.lit(0)).unionByName(
        bucket_counts(target, buckets).withColumn("side", F.lit(1)))
    for r in both.collect():  # at most two rows a bucket
        n[r.side][r.bucket] = r.n
    all_s, all_t = (float(n[side].sum() + buckets) for side in (0, 1))
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(n[0].tolist(), n[1].tolist())
    ], np.int64)


def _noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(scanned: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """``scanned`` (with ``doc_id``) without its arrays, with ``weight`` and ``score``."""
    kind = np.dtype("<u2") if len(gains) <= 1 << 16 else np.dtype("<u4")
    kept = [c for c in scanned.columns if c != "buckets"]

    def score(batches):
        for batch in batches:
            weight = []
            for array in batch.column(batch.schema.get_field_index("buckets")).to_pylist():
                own = gains[np.frombuffer(array, kind)]
                weight.append(int(own.sum()) // len(own) if len(own) else 0)
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            total = [w + _noise(i, seed) for w, i in zip(weight, ids)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(weight, pa.int64()), pa.array(total, pa.int64())], names=[*kept, "weight", "score"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in scanned.schema if f.name in kept)
    return scanned.mapInArrow(score, f"{schema}weight long, score long")


def importance_resample(
    docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, percent: int = PERCENT,
    min_words: int = MIN_WORDS, seed: int = SEED, carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank`` and ``carry``; ``rank`` is null where not drawn."""
    clash = {c.lower() for c in carry} & {*RESULT, "n_words", "buckets"}
    if clash:
        raise ValueError(f"carried columns {sorted(clash)} would hide the result's")
    prepare(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(f"`{c}`") for c in carry if c != "text"])
    corpus = stage(hashed(own, run, buckets, ["doc_id", *carry]), "resample-corpus")
    gains = bucket_gains(corpus, hashed(target, run, buckets), buckets)
    may = F.col("n_words") >= min_words
    rows = scored(corpus, gains, seed).withColumn("_may", may).withColumn("_salt", F.monotonically_increasing_id())
    order = [F.desc("_may"), F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("_salt")]
    rows = numbered(rows, order, "_place", "resample-order")
    draws = corpus.where(may).count() * percent // 100
    rank = F.when(F.col("_may") & (F.col("_place") < draws), F.col("_place") + 1)
    return rows.select("doc_id", "n_features", "weight", "score", rank.alias("rank"), *carry)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: CRC-32 byte by byte over the distinct words; the table of 256 follows from the polynomial.
SQL = f"""WITH crc_table AS (SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(generate_series(0, 255)) AS b)),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
q AS MATERIALIZED (SELECT unnest({_WORDS}) AS w FROM benchmark WHERE text IS NOT NULL),
dw AS MATERIALIZED (SELECT r, unnest(w) AS w FROM d),
names AS MATERIALIZED (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM q)),
b AS MATERIALIZED (SELECT w, xor(list_reduce(list_concat([4294967295],
    list_transform(generate_series(1, CAST(length(hex(w)) / 2 AS BIGINT)), lambda i: CAST(('0x' || substr(hex(w), 2 * i - 1, 2)) AS BIGINT))),
    lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 10000 AS k FROM names, crc_table),
s AS (SELECT k, count(*) AS n FROM dw JOIN b USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM q JOIN b USING (w) GROUP BY k),
total AS (SELECT (SELECT count(*) FROM dw) AS s, (SELECT count(*) FROM q) AS t),
gain AS MATERIALIZED (SELECT k, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (total.s + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (total.t + 10000)::DOUBLE))) AS g
  FROM (SELECT DISTINCT k FROM b) JOIN total ON true LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
weights AS (SELECT r, floor(sum(g) / count(*)) AS weight FROM dw JOIN b USING (w) JOIN gain USING (k) GROUP BY r),
scores AS (SELECT r, doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN weights USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS p,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS n FROM scores)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_features >= 20 AND p <= n * 10 // 100 THEN p END AS rank
FROM ranked"""
