"""Exact top-k search by inner product: columnar branch and bound over blocks of dimensions.

Vectors are whole numbers, floor(scale * x). A task lays a batch of candidates out dimension by dimension and adds up a
block of dimensions at a time for a tile of queries. After each block the part still missing is at most the product of
the remaining masses (norms) of query and candidate; candidates whose bound stays below every query's k-th best score
so far are dropped and the arrays compacted. Ties stay in, so the result is exact. Each partition keeps k rows a
query; only these are shuffled. The stated queries are broadcast in blocks of ``QUERY_BLOCK``.

Defined results: null vectors, vectors with a null, NaN or infinite component and rows with a null vec_id take no part;
vectors of different lengths have no inner product and never meet; rows that share the query's vec_id are its own; an id
asked several times is asked once, with the least of its vectors; equal candidates rank by vec_id; a query without any
candidate returns no row; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoload.llm.common import table
from chronoload.session import prepare

SCALE = 256
K = 5
QUERY_BLOCK = 4096
DIMENSIONS = 16
_TILE = 64
_ROWS = 4096


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: the vectors that take part, as arrays of longs."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * float(scale))).alias("v"))


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and rows of each vector length in the batch."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lists = batch.column(1)
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    for d in np.unique(size):
        own = np.flatnonzero(size == d)
        yield ids[own], flat[offsets[own][:, None] + np.arange(d)[None, :]].reshape(len(own), int(d))


class _Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = [np.empty(0, np.int64)] * n
        self.id = [np.empty(0, np.int64)] * n
        self.least = np.full(n, -np.inf)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[q], score]), np.concatenate([self.id[q], ids])
        top = np.lexsort((ids, -score))[: self.k]
        self.score[q], self.id[q] = score[top], ids[top]
        if len(top) == self.k:
            self.least[q] = score[top[-1]]


def _scan(best: _Best, at: np.ndarray, query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
    """One tile of queries (rows ``at`` of the block) against one layout of candidates."""
    d = q.shape[1]
    largest = max(1.0, float(np.abs(q).max(initial=0))) * max(1.0, float(np.abs(x).max(initial=0))) * max(d, 1)
    kind = np.float64 if largest < 2**52 else np.int64  # both exact; the first has fast products
    order = np.argsort(-np.abs(q).sum(0, dtype=np.float64), kind="stable")
    q, columns = q[:, order].astype(kind), np.ascontiguousarray(x.T[order]).astype(kind)
    q_mass = np.sqrt(np.cumsum((q.astype(np.float64) ** 2)[:, ::-1], 1)[:, ::-1])
    x_mass = np.sqrt(np.cumsum((columns.astype(np.float64) ** 2)[::-1], 0)[::-1])
    alive = np.arange(len(ids))
    part = np.zeros((len(q), len(ids)), kind)
    least = best.least[at][:, None]
    for a in range(0, d, DIMENSIONS):
        b = min(a + DIMENSIONS, d)
        part += q[:, a:b] @ columns[a:b]
        if b < d:
            missing = q_mass[:, b][:, None] * x_mass[b][None, alive] * (1 + 1e-9) + 1
            keep = ((part + missing) >= least).any(0)
            if keep.mean() < 0.75:
                alive, part, columns = alive[keep], part[:, keep], columns[:, keep]
    for row, k in enumerate(at.tolist()):
        good = (part[row] >= best.least[k]) & (ids[alive] != query_ids[k])
        score = part[row][good].astype(np.int64)
        own = ids[alive][good]
        if len(score) > best.k:
            cut = np.partition(score, len(score) - best.k)[len(score) - best.k]
            own, score = own[score >= cut], score[score >= cut]
        if len(score):
            best.add(k, score, own)


def _search(sent, k: int):
    def run(batches):
        query_ids, groups = sent.value
        best = _Best(len(query_ids), k)
        for batch in batches:
            for ids, rows in _matrix(batch):
                at_all, q_all = groups.get(rows.shape[1], (np.empty(0, np.int64), None))
                for c in range(0, len(ids), _ROWS):
                    for a in range(0, len(at_all), _TILE):
                        _scan(best, at_all[a : a + _TILE], query_ids, q_all[a : a + _TILE], ids[c : c + _ROWS], rows[c : c + _ROWS])
        size = [len(s) for s in best.score]
        if sum(size):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(query_ids, size)), pa.array(np.concatenate(best.id)), pa.array(np.concatenate(best.score))
            ], names=["query_id", "vec_id", "score"])

    return run


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple]:
    """Query ids and, by vector length, their rows; the driver holds one block at a time."""
    ids, rows = [], []
    for r in queries.toLocalIterator():
        ids.append(r.vec_id)
        rows.append(np.array(r.v, np.int64))
        if len(ids) == size:
            yield _packed(ids, rows)
            ids, rows = [], []
    if ids:
        yield _packed(ids, rows)


def _packed(ids: list, rows: list) -> tuple:
    size = np.array([len(r) for r in rows])
    groups = {int(d): (np.flatnonzero(size == d), np.stack([r for r in rows if len(r) == d])) for d in np.unique(size)}
    return np.array(ids, np.int64), groups


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``; both sides as of ``whole_vectors``."""
    spark = prepare(candidates.sparkSession)
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    out = None
    for block in _blocks(asked, query_block):
        sent = spark.sparkContext.broadcast(block)
        part = candidates.mapInArrow(_search(sent, k), "query_id long, vec_id long, score long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


SQL = """WITH v AS MATERIALIZED (SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id != c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5"""
