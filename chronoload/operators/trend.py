"""Linear trend of a series, its parameter store, and detrending both ways."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.functions.timefns import steps_since, ts_lit
from chronoload.operators.keys import join_on


def ols_trend(
    df: DataFrame, value: str, start: str, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    step_seconds: int = 3600,
) -> DataFrame:
    """``(series…, slope, intercept)`` of value on the row position 0..n-1 counted from ``start``."""
    t = steps_since(ts_col, start, step_seconds).cast("double")
    y = F.col(value).cast("double")
    return df.groupBy(*series_cols).agg(
        F.regr_slope(y, t).alias("slope"), F.regr_intercept(y, t).alias("intercept")
    )


def _shift(df, trend, value, start, series_cols, ts_col, step_seconds, sign):
    t = steps_since(ts_col, start, step_seconds).cast("double")
    line = F.col("slope") * t + F.col("intercept")
    marked = trend.select(*series_cols, "slope", "intercept", F.lit(True).alias("_has_trend"))
    joined = join_on(df, marked, series_cols, "left")
    moved = F.when(F.col("_has_trend"), F.col(value) + F.lit(float(sign)) * line).otherwise(
        F.raise_error(F.lit("a series has no row in the trend table")))
    return joined.withColumn(value, moved).select(*[F.col(f"`{c}`") for c in df.columns])


def remove_trend(df, trend, value, start, series_cols=(), ts_col="timestamp", step_seconds=3600) -> DataFrame:
    return _shift(df, trend, value, start, series_cols, ts_col, step_seconds, -1)


def add_trend(df, trend, value, start, series_cols=(), ts_col="timestamp", step_seconds=3600) -> DataFrame:
    return _shift(df, trend, value, start, series_cols, ts_col, step_seconds, 1)


def trend_records(trend: DataFrame, start: str, split_date: str, end: str) -> DataFrame:
    """Trend rows with the key of the span they were fitted on."""
    span = F.concat_ws("|", *[ts_lit(x).cast("string") for x in (start, split_date, end)])
    return trend.withColumn("date_key", span)


def new_records(stored: DataFrame, candidate: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Candidate rows whose key is not stored yet: what an upsert has to append."""
    renamed = stored.select(*[F.col(k).alias(f"_stored_{k}") for k in key_cols])
    match = None
    for k in key_cols:
        same = F.col(k).eqNullSafe(F.col(f"_stored_{k}"))
        match = same if match is None else match & same
    return candidate.join(renamed, match, "left_anti")
