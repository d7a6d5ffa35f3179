"""Consecutive numbers over a whole sorted table, without one task that sees it all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoload.session import stage

_SHIFT = 33  # monotonically_increasing_id: partition number above, row of the partition below


def numbered(rows: DataFrame, order: Sequence[Column], column: str, name: str) -> DataFrame:
    """``rows`` with ``column``: 0, 1, 2, … in ``order``.

    Range partitions are sorted side by side and written; the numbers of a partition begin after the rows of those before it.
    Only one count a partition (at most ``spark.sql.shuffle.partitions`` rows) is added up in one place and broadcast.
    ``order`` should tell rows apart: rows that are equal in it share a partition.
    """
    at, part = f"{column}_at_", f"{column}_part_"
    out = stage(rows.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), name)
    out = out.withColumn(part, F.shiftright(at, _SHIFT))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = out.groupBy(part).agg(F.count("*").alias("_n"))
    starts = sizes.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col(at).bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return out.join(F.broadcast(starts), part).select(*rows.columns, place.alias(column))
