"""SimHash near-duplicates by exact tiled comparison.

A document's fingerprint is the bitwise majority of its shingles' XXH64 values. Distinct fingerprints are laid out in
tiles by the population counts of their ``SEGMENTS`` 16-bit segments. Two fingerprints whose population counts differ
by more than the radius in sum over the segments differ in more bits than the radius, so that pair of tiles is never
built; the other pairs of tiles are compared exactly, with numpy's exclusive-or and bit counts. A tile of more than
``TILE`` fingerprints is split by hash, what visits it is sent to every part, and each part visits the later ones: no
task holds more than a part and a block of visitors. Each tile gives a spanning forest of its links, and components are joined by stars.

Defined results: null, empty and word-less texts have fingerprint zero and link like any other; texts of one or two
words are one shingle; repeated rows share a fingerprint and a component; a null doc_id is never the least of a
component unless all its ids are null; an empty table gives an empty result; other columns are carried by
``drop_near_duplicates`` and ignored by the rest.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm.common import SPACED, keyed_texts, table, texts_of, unused
from chronoload.llm.components import components
from chronoload.session import prepare, stage

SHINGLE = 3
RADIUS = 2
SEED = 42
SEGMENTS = 4
TILE = 8192
_BLOCK = 256


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """64-bit majority fingerprint as a signed number."""
    words = text.translate(SPACED).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= size:
        values = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = list(accumulate(map((1).__add__, map(len, words))))
        hashed = xxhash.xxh64_intdigest
        values = [hashed(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[size - 1 :], strict=False)]
    ones = np.zeros(64, np.int64)
    array = np.array(values, "<u8")
    for a in range(0, len(array), 65_536):
        part = array[a : a + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(array), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: one row per document."""
    prepare(docs.sparkSession)

    def make(batches):
        for batch in batches:
            fps = [fingerprint(t, size) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return keyed_texts(docs).mapInArrow(make, "doc_id long, fp long")


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of segment counts that sum to at most ``radius``, one of each pair of opposites, zero left out."""
    out: list[tuple[int, ...]] = [()]
    for _ in range(SEGMENTS):
        out = [(*o, d) for o in out for d in range(-radius, radius + 1) if sum(map(abs, o)) + abs(d) <= radius]
    return [o for o in out if o > (0,) * SEGMENTS]


def _cells(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(SEGMENTS)]


def _code(parts: list[Column]) -> Column:
    code = F.lit(0)
    for p in parts:
        code = code * 17 + p
    return code.cast("int")


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    r = parent[x]
    while True:
        up = parent[r]
        if (up == r).all():
            return r
        r = up


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of all pairs; every root is the least of its members."""
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def _near(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)


def _compare(radius: int):
    """Streams rows sorted by (tile, visits, fp): the tile's own fingerprints first, then its visitors."""

    def forest(homes: np.ndarray, parent: np.ndarray):
        top = _roots(parent, np.arange(len(homes)))
        own = np.flatnonzero(top != np.arange(len(homes)))
        return homes[own], homes[top[own]]

    def run(batches):
        tile, parts, homes, parent = None, [], None, None

        def close_homes():
            nonlocal homes, parent
            homes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            parent = np.arange(len(homes))
            for a in range(0, len(homes), _BLOCK):
                i, j = _near(homes[a : a + _BLOCK], homes[a:], radius)
                _hook(parent, i[i < j] + a, j[i < j] + a)

        def out(a, b):
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

        def finish():
            if tile is not None:
                if homes is None:
                    close_homes()
                yield from out(*forest(homes, parent))

        for batch in batches:
            tiles = batch.column(0).to_numpy(zero_copy_only=False)
            visits = batch.column(1).to_numpy(zero_copy_only=False)
            fps = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            cut = np.flatnonzero((tiles[1:] != tiles[:-1]) | (visits[1:] != visits[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(tiles)], strict=True):
                if a == b:
                    continue
                if tiles[a] != tile:
                    yield from finish()
                    tile, parts, homes, parent = tiles[a], [], None, None
                if not visits[a]:
                    parts.append(fps[a:b])
                    continue
                if homes is None:
                    close_homes()
                if not len(homes):
                    continue
                for c in range(a, b, _BLOCK):
                    guests = fps[c : min(c + _BLOCK, b)]
                    g, h = _near(guests, homes, radius)
                    if len(g):
                        first = np.unique(g, return_index=True)[1]
                        anchor = np.zeros(len(guests), np.int64)
                        anchor[g[first]] = h[first]
                        _hook(parent, h, anchor[g])
                        yield from out(guests[g[first]], homes[h[first]])
        yield from finish()

    return run


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the distinct ``fp`` of ``prints``, at least one path for every pair within ``radius``."""
    cells = _cells(F.col("fp"))
    own = prints.select("fp", _code(cells).alias("cell"), *[c.alias(f"s{i}") for i, c in enumerate(cells)])
    parts = stage(own.groupBy("cell").count().where(F.col("count") > tile).select(
        F.col("cell").alias("c"), F.ceil(F.col("count") / tile).cast("int").alias("k")), "simhash-large-tiles")
    moves = F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(o)]) for o in _offsets(radius)])
    inside = F.lit(True)
    for i in range(SEGMENTS):
        inside = inside & (F.col(f"s{i}") + F.col(f"o.d{i}")).between(0, 16)
    there = own.withColumn("o", F.explode(moves)).where(inside)
    guests = there.select("fp", _code([F.col(f"s{i}") + F.col(f"o.d{i}") for i in range(SEGMENTS)]).alias("cell"))
    k = F.coalesce("k", F.lit(1))
    homes = own.select("fp", "cell").join(parts, F.col("cell") == F.col("c"), "left").select(
        "cell", k.alias("k"), F.pmod(F.xxhash64("fp"), k).cast("int").alias("p"), "fp")
    guests = guests.join(parts, F.col("cell") == F.col("c"), "left").select(
        "cell", F.explode(F.sequence(F.lit(0), k - 1)).alias("p"), "fp")
    # The moves leave the own cell out: the parts of a split cell meet each other here, each two of them once.
    fellows = homes.where(F.col("p") < F.col("k") - 1).select(
        "cell", F.explode(F.sequence(F.col("p") + 1, F.col("k") - 1)).alias("p"), "fp")

    def placed(rows: DataFrame, visits: bool) -> DataFrame:
        return rows.select((F.col("cell").cast("long") * (1 << 32) + F.col("p")).alias("tile"),
                           F.lit(visits).alias("visits"), "fp")

    rows = placed(homes, False).unionByName(placed(guests.unionByName(fellows), True))
    rows = rows.repartition("tile").sortWithinPartitions("tile", "visits", "fp")
    return rows.mapInArrow(_compare(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (least doc_id that is linked)."""
    prints = stage(fingerprints(docs, size), "simhash-prints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(near_links(distinct, radius, tile), "simhash-links")
    grouped = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = grouped.join(least, "root").select(F.col("fp").alias("f"), "component_id")
    return prints.join(by_print, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with all its columns, keeping of each component the rows with its least doc_id (or with a null id)."""
    name = unused(docs, "lost_id")
    lost = near_duplicates(docs, size, radius).where("doc_id > component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(lost, docs["doc_id"] == lost[name], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
