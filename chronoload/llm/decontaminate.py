"""Benchmark decontamination with suffix arrays over shards of the training text.

Every batch of documents a task reads is cut into shards of whole documents. A shard's words become numbers by the
benchmark's vocabulary (other words: 0), a suffix array orders all places from which the benchmark could still be
matched, and every benchmark suffix is looked up in it word by word by binary search. That yields the longest match
of each suffix and its places. No shuffle: the documents never move, the benchmark is sent to the tasks in blocks of
``block_bytes`` of text (a longer item is a block of its own), and a task holds one block at a time.

Defined results: a null or empty text, and one without words, has no words and is never hit; items without words
match nothing; repeated documents are judged each; an empty benchmark hits nothing; empty tables give empty results;
other columns of the input are carried by ``remove_contaminated`` and ignored by the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm.common import WORDS, keyed_texts, table, texts_of
from chronoload.session import prepare

WINDOW = 10
BLOCK_BYTES = 32 << 20
SHARD_WORDS = 1_000_000


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS).split() if text else []


class Block:
    """Some benchmark items: vocabulary, words as numbers (0 closes an item) and the window starting at each word."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        codes, item, need = [], [], []
        for k, (_, own) in enumerate(items):
            n = len(own)
            length = min(window, n)
            for i, w in enumerate(own):
                codes.append(self.vocabulary.setdefault(w, len(self.vocabulary) + 1))
                item.append(k)
                need.append(length if i + length <= n else 0)
            codes.append(0)
            item.append(k)
            need.append(0)
        self.codes = np.array([*codes, 0], np.int32)
        self.item = np.array([*item, -1], np.int64)
        self.need = np.array([*need, 0], np.int64)
        positive = self.need[self.need > 0]
        self.shortest = int(positive.min()) if len(positive) else 0
        self.longest = max((len(own) for _, own in items), default=0)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``codes`` ordered by their next ``depth`` numbers or more, by doubling of ranks; 0 ends a suffix."""
    n = len(codes)
    rank, reach = codes.astype(np.int64), 1
    while reach < depth:
        after = np.zeros(n, np.int64)
        after[: max(n - reach, 0)] = rank[reach:]
        pair = np.where(rank > 0, rank * (rank.max() + after.max() + 2) + after, 0)
        _, new = np.unique(pair, return_inverse=True)
        rank = new.astype(np.int64) + (0 if pair.min() == 0 else 1)
        reach *= 2
    return np.argsort(rank, kind="stable")


def _bound(codes, order, lo, hi, step, value, right: bool) -> np.ndarray:
    """Binary search in each interval of the suffix array for the number that stands ``step`` words on."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        at = order[np.minimum(mid, len(order) - 1)] + step
        found = codes[np.minimum(at, len(codes) - 1)]
        go = open_ & ((found <= value) if right else (found < value))
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~go, mid, hi)


class Found:
    """What a look-up of all suffixes of a block gave: longest match lengths, and the intervals of whole windows."""

    def __init__(self, block: Block, codes: np.ndarray, order: np.ndarray) -> None:
        n = len(block.codes)
        self.length = np.zeros(n, np.int64)
        self.lo, self.hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.window_lo, self.window_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live = np.flatnonzero(block.codes > 0)
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(order), np.int64)
        step = 0
        while len(live):
            value = block.codes[live + step]
            new_lo = _bound(codes, order, lo, hi, step, value, False)
            new_hi = _bound(codes, order, new_lo, hi, step, value, True)
            keep = (new_lo < new_hi) & (value > 0)
            live, lo, hi, step = live[keep], new_lo[keep], new_hi[keep], step + 1
            self.length[live], self.lo[live], self.hi[live] = step, lo, hi
            full = block.need[live] == step
            self.window_lo[live[full]], self.window_hi[live[full]] = lo[full], hi[full]


class Shard:
    """Whole documents in a row, reduced to the runs of benchmark words that are long enough to hold a window."""

    def __init__(self, block: Block, own: list[list[bytes]], least: int) -> None:
        self.sizes = np.array([len(w) for w in own], np.int64)
        get = block.vocabulary.get
        total = int(self.sizes.sum()) + len(own)
        codes = np.zeros(total, np.int32)
        begins = np.concatenate([[0], np.cumsum(self.sizes + 1)])[:-1].astype(np.int64)
        for at, w in zip(begins.tolist(), own, strict=True):
            codes[at : at + len(w)] = np.fromiter(map(get, w, repeat(0)), np.int32, len(w))
        self.begins, self.total = begins, total
        known = np.concatenate([[0], (codes > 0).astype(np.int8), [0]])
        turns = np.flatnonzero(np.diff(known))
        starts, ends = turns[::2], turns[1::2]
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        runs = ends - starts + 1  # each with one 0 behind it
        base = np.concatenate([[0], np.cumsum(runs)])
        self.place = np.arange(base[-1]) - np.repeat(base[:-1], runs) + np.repeat(starts, runs)
        self.codes = codes[np.minimum(self.place, total - 1)] if total else codes
        self.codes[base[1:] - 1] = 0
        self.order = np.empty(0, np.int64)
        if len(self.codes):
            self.order = suffix_array(self.codes, block.longest + 1)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, side="right") - 1


def _ragged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, hi), and the range each belongs to."""
    size = hi - lo
    owner = np.repeat(np.arange(len(lo)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size), owner


def search(block: Block, own: list[list[bytes]], least: int | None = None) -> tuple[Shard, Found] | None:
    """Suffix array of the documents and the block's suffixes looked up in it; None where nothing can match."""
    shard = Shard(block, own, least or block.shortest)
    return (shard, Found(block, shard.codes, shard.order)) if len(shard.order) else None


def window_hits(blocks: Iterator[Block], own: list[list[bytes]]) -> tuple[np.ndarray, list[set[str]]]:
    """For each document: words inside an occurring window, and the names of items with one."""
    items: list[set[str]] = [set() for _ in own]
    edges = shard = None
    for block in blocks:
        if not block.shortest or (result := search(block, own)) is None:
            continue
        shard, found = result
        whole = np.flatnonzero(found.window_lo < found.window_hi)
        key = np.stack([found.window_lo[whole], found.window_hi[whole], block.need[whole]], 1)
        spans, which = np.unique(key, axis=0, return_inverse=True)
        which = which.reshape(-1)
        at, span = _ragged(spans[:, 0], spans[:, 1])
        places = shard.place[shard.order[at]]
        if edges is None:
            edges = np.zeros(shard.total + 1, np.int64)
        np.add.at(edges, places, 1)
        np.add.at(edges, places + spans[span, 2], -1)
        pairs = np.unique(np.stack([span, shard.document(places)], 1), axis=0)
        names = [{block.names[k] for k in set(block.item[whole[which == s]].tolist())} for s in range(len(spans))]
        for s, d in pairs.tolist():
            items[d] |= names[s]
    if edges is None:
        return np.zeros(len(own), np.int64), items
    hit = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
    return hit[shard.begins + shard.sizes] - hit[shard.begins], items


def blocks_of(benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """The benchmark as broadcast blocks. Items are dealt to blocks by hash; the driver holds one block at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-int(total) // block_bytes) or 1
    out = []
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        rows = [(r.item, words(r.text.encode())) for r in part.toLocalIterator() if r.text]
        out.append(spark.sparkContext.broadcast(Block([r for r in rows if r[1]], window)))
    return out


def _each(sent: list) -> Iterator[Block]:
    for b in sent:
        yield b.value
        if len(sent) > 1 and hasattr(b, "_path"):
            b.__dict__.pop("_value", None)  # read again when its turn comes


def _shards(own: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, w in enumerate(own):
        if size and size + len(w) > SHARD_WORDS:
            yield begin, i
            begin, size = i, 0
        size += len(w) + 1
    if begin < len(own):
        yield begin, len(own)


def _batch_hits(sent: list, texts: list[bytes | None]) -> tuple[list[int], list[int], list[set[str]]]:
    """Words, hit words and items of each text; texts are split into words a shard at a time."""
    n_words, n_hit, items = [], [], []
    begin = size = 0
    for i in range(len(texts) + 1):
        if i == len(texts) or size and size + len(texts[i] or b"") > 6 * SHARD_WORDS:
            own = [words(t) for t in texts[begin:i]]
            for a, b in _shards(own):
                h, s = window_hits(_each(sent), own[a:b])
                n_hit += h.tolist()
                items += s
            n_words += [len(w) for w in own]
            begin, size = i, 0
        if i < len(texts):
            size += len(texts[i] or b"") + 1
    return n_words, n_hit, items


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    prepare(docs.sparkSession)
    sent = blocks_of(benchmark, window, block_bytes)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
        ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
    ])

    def judge(batches):
        for batch in batches:
            n_words, n_hit, items = _batch_hits(sent, texts_of(batch))
            digest = [hashlib.sha256(",".join(sorted(s)).encode()).hexdigest() for s in items]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array([len(s) for s in items], pa.int64()), pa.array(digest, pa.string()),
                pa.array([h > 0 for h in n_hit], pa.bool_()),
            ], schema=schema)

    return keyed_texts(docs).mapInArrow(
        judge, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a benchmark window."""
    prepare(docs.sparkSession)
    sent = blocks_of(benchmark, window, block_bytes)

    def keep(batches):
        for batch in batches:
            _, n_hit, _ = _batch_hits(sent, texts_of(batch))
            yield batch.filter(pa.array([h == 0 for h in n_hit], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, min_words: int = WINDOW) -> DataFrame:
    """The longest verbatim match of each item and every place of it: ``item, item_start, n_words, doc_id, doc_start``.

    Word numbers start at 0. Matches of fewer than ``min_words`` words are not reported; of equally long matches of
    an item the first in the item counts.
    """
    prepare(docs.sparkSession)
    sent = blocks_of(benchmark, min_words, BLOCK_BYTES)

    def look(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            own = [words(t) for t in texts_of(batch)]
            for a, b in _shards(own):
                for block in _each(sent):
                    if (result := search(block, own[a:b], min_words)) is None:
                        continue
                    shard, found = result
                    good = np.flatnonzero(found.length >= min_words)
                    order = good[np.lexsort((good, -found.length[good], block.item[good]))]
                    first = order[np.unique(block.item[order], return_index=True)[1]]
                    at, which = _ragged(found.lo[first], found.hi[first])
                    places = shard.place[shard.order[at]]
                    doc = shard.document(places)
                    head = np.searchsorted(block.item, block.item[first])
                    yield pa.RecordBatch.from_pydict({
                        "item": [block.names[block.item[first[w]]] for w in which],
                        "item_start": (first - head)[which],
                        "n_words": found.length[first][which],
                        "doc_id": pa.array([ids[a + d] for d in doc], pa.int64()),
                        "doc_start": places - shard.begins[doc],
                    })

    got = keyed_texts(docs).mapInArrow(look, "item string, item_start long, n_words long, doc_id long, doc_start long")
    best = got.groupBy("item").agg(F.min(F.struct(-F.col("n_words"), "item_start")).alias("b"))
    best = best.select("item", (-F.col("b.col1")).alias("n_words"), "b.item_start")
    return got.join(best, ["item", "item_start", "n_words"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_DUCK_WORDS = (
    r"regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_DUCK_WORDS.format(c="text")}, []) AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, {_DUCK_WORDS.format(c="text")} AS w FROM benchmark WHERE text IS NOT NULL),
win AS MATERIALIZED (SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
place AS MATERIALIZED (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT r, i, win.n, item_id FROM place JOIN win ON place.k = win.k AND place.n = win.n),
cnt AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS j FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS t FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cnt USING (r) LEFT JOIN its USING (r)"""
