"""Joins on key columns that may hold nulls, and joins with a one-row table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that treats null keys as equal; the right side's key columns are dropped.

    There is no broadcast hint: Catalyst and AQE broadcast the right side when its size allows it,
    and otherwise sort-merge with skew splitting. With no keys, ``right`` must have exactly one row
    and its columns are attached through a scalar subquery.
    """
    if not keys:
        return with_single_row(left, right)
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def with_single_row(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a global aggregate) to every row of ``left``."""
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("_one"))
    return left.withColumn("_one", packed.scalar()).select(
        *[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_one.`{c}`").alias(c) for c in one_row.columns]
    )


def by(keys: Sequence[str], *more: str | Column) -> list[str | Column]:
    return [*keys, *more]
