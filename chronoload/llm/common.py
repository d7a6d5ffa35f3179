"""Helpers that several operators share: tables, byte tables for words, and bounded caches."""

from __future__ import annotations

import gc
from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.session import prepare

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
LOWER = bytes.maketrans(_UPPER, _LOWER)
#: Lower-cases A-Z; ``bytes.split()`` then cuts at exactly the bytes 09-0D and 20.
SPACED = LOWER
#: Lower-cases A-Z and turns every ASCII byte that is no digit or letter into a space; bytes from 80 on stay.
WORDS = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever else the table carries."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The column's values as UTF-8 bytes, without a detour through ``str``."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id has remainder 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(0)).cast("int")


class Cache(dict):
    """A memo of two generations: what was not asked for during a generation is forgotten. Holds 2 * ``limit`` at most."""

    def __init__(self, make: Callable, limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


@contextmanager
def uncollected():
    """No cycle collector meanwhile: large memos have no cycles, and walking them again and again costs a third."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()
