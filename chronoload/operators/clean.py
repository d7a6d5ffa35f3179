"""Row cleaning: duplicates, nulls, positive values, type filter, logs, train split, imputation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoload.functions.timefns import ts_lit

# Typical power in kW of a plug type, for sessions without a metered energy.
PLUG_POWER_KW = {"J1772": 6.0, "NEMA 5-20R": 1.5}


def train_rows(df: DataFrame, split_date: str, ts_col: str | None = None) -> DataFrame:
    """Rows that ended (or, without an end, started) before the split."""
    column = ts_col or ("endtime" if "endtime" in df.columns else "starttime")
    return df.where(F.col(column) < ts_lit(split_date))


def test_rows(df: DataFrame, split_date: str, ts_col: str) -> DataFrame:
    return df.where(F.col(ts_col) >= ts_lit(split_date))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates over all columns go; copies meet in the map-side aggregation first."""
    return df.dropDuplicates()


def drop_untimed(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[c for c in ("starttime", "endtime") if c in df.columns])


def positive_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A null or non-positive value in any of the columns drops the row."""
    return reduce(lambda d, c: d.where(F.col(c) > 0), columns, df)


def add_logs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``log_<c>`` = log(1 + c); rows where c is null are dropped."""
    if not columns:
        return df
    return df.dropna(subset=list(columns)).withColumns({f"log_{c}": F.log1p(c) for c in columns})


def clean_events(
    df: DataFrame,
    keep_cols: Sequence[str] = (),
    positive_cols: Sequence[str] = (),
    log_cols: Sequence[str] = (),
    types: Sequence[str] = (),
) -> DataFrame:
    """The fixed cleaning order. Duplicates are judged on all columns, before the projection."""
    out = distinct_rows(df).dropna(how="all")
    if keep_cols:
        out = out.select(*keep_cols)
    out = positive_only(drop_untimed(out), positive_cols)
    if types:
        out = out.where(F.col("type").isin(list(types)))
    return add_logs(out, log_cols)


def clean_and_split(df: DataFrame, split_date: str, **rules) -> tuple[DataFrame, DataFrame]:
    """``clean_events`` and its train part, both on one lazy plan."""
    cleaned = clean_events(df, **rules)
    return cleaned, train_rows(cleaned, split_date)


def impute_energy(df: DataFrame, power_kw: dict[str, float] | None = None) -> DataFrame:
    """Missing energy becomes plug power times hours; rows of plugs without a known power go."""
    power_kw = PLUG_POWER_KW if power_kw is None else power_kw
    guess = reduce(
        lambda acc, kv: F.when(F.col("plug_type") == kv[0], F.lit(kv[1]) * F.col("duration_hours")).otherwise(acc),
        power_kw.items(),
        F.lit(None).cast("double"),
    )
    return df.withColumn("energy", F.coalesce(F.col("energy"), guess)).dropna(subset=["energy"])


def null_outside(c: str | Column, low: float, high: float) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.between(low, high), c)


def sum_matching(df: DataFrame, out: str, first: str, second: str = "") -> DataFrame:
    """Row-wise sum of the columns whose name holds both substrings; 0 when there are none."""
    hits = [c for c in df.columns if first in c and second in c]
    total = reduce(lambda acc, c: acc + F.col(f"`{c}`"), hits, F.lit(0.0))
    return df.withColumn(out, total)


def ints_to_double(df: DataFrame) -> DataFrame:
    whole = {"tinyint", "smallint", "int", "bigint"}
    return df.select(
        *[F.col(f"`{n}`").cast("double").alias(n) if t in whole else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def location_filter(
    df: DataFrame, states: Sequence[str] = (), counties: Sequence[str] = (), cities: Sequence[str] = (),
    columns: tuple[str, str, str] = ("State", "County", "City"),
) -> DataFrame:
    """Optional membership filters, all of which must hold; an empty list filters nothing."""
    for column, wanted in zip(columns, (states, counties, cities), strict=True):
        if wanted:
            df = df.where(F.col(column).isin(list(wanted)))
    return df
