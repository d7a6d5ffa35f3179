"""Seasonal history: expanding means for imputation and robust outlier flags per (hour, weekday).

The windows here are partitioned by series and season slot. A slot receives one row per year
(hour, day of year) or per week (hour, weekday), so the calendar bounds each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoload.functions.arrays import robust_sigma, sorted_mad, sorted_median
from chronoload.functions.timefns import steps_since
from chronoload.operators.blocks import BLOCK_ROWS, EPOCH, block_scan
from chronoload.operators.keys import join_on

SLOT = ("hour", "weekday")


def expanding_mean(
    df: DataFrame, value: str, series_cols: Sequence[str] = (), ts_col: str = "timestamp", out: str | None = None
) -> DataFrame:
    """Mean of all values so far, this row included, at the same hour and day of year."""
    out = out or f"avg_{value}"
    w = (
        Window.partitionBy(*series_cols, F.hour(ts_col), F.dayofyear(ts_col))
        .orderBy(ts_col)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return df.withColumn(out, F.avg(value).over(w))


def forward_fill(
    df: DataFrame, value: str, series_cols: Sequence[str] = (), ts_col: str = "timestamp", out: str | None = None,
    step_seconds: int = 3600, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Last non-null value up to the row, along the whole series."""
    pos = steps_since(ts_col, EPOCH, step_seconds)
    return block_scan(df, F.col(value), out or value, "last", series_cols, pos, ts_col, block_rows)


def impute_from_history(
    df: DataFrame, value: str, series_cols: Sequence[str] = (), ts_col: str = "timestamp", step_seconds: int = 3600,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Flag missing values, then fill them with the forward-filled seasonal expanding mean."""
    flagged = df.withColumn(f"{value}_imputed", F.col(value).isNull().cast("int"))
    tracked = expanding_mean(flagged, value, series_cols, ts_col, "_seen")
    filled = forward_fill(tracked, "_seen", series_cols, ts_col, "_seen", step_seconds, block_rows)
    return filled.withColumn(value, F.coalesce(F.col(value), F.col("_seen"))).drop("_seen")


def with_slot(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return df.withColumns({"hour": F.hour(ts_col), "weekday": F.weekday(ts_col)})


def _flag(value: str, median: Column, sigma: Column, k: float) -> Column:
    beyond = F.abs(F.col(value) - median) > F.lit(float(k)) * sigma
    return F.coalesce((beyond & (sigma > 0)).cast("int"), F.lit(0))


def expanding_mad_flags(
    df: DataFrame, value: str, start: str, k: float = 3.5, min_samples: int = 0, series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", out: str = "outlier", step_seconds: int = 3600,
) -> DataFrame:
    """Adds hour, weekday and a 0/1 flag judged on strictly earlier values of the same slot.

    Median and sigma (1.4826 * MAD, none when the MAD is 0) come from all earlier values, flagged
    ones included. The first ``min_samples`` rows of a series, counted from ``start``, are not judged.
    """
    w = Window.partitionBy(*series_cols, *SLOT).orderBy(ts_col).rowsBetween(Window.unboundedPreceding, -1)
    judged = steps_since(ts_col, start, step_seconds) >= min_samples
    return (
        with_slot(df, ts_col)
        .withColumn("_past", F.collect_list(value).over(w))
        .withColumn("_past", F.sort_array("_past"))
        .withColumn("_med", sorted_median(F.col("_past")))
        .withColumn("_sigma", robust_sigma(sorted_mad(F.col("_past"), F.col("_med"))))
        .withColumn(out, F.when(judged, _flag(value, F.col("_med"), F.col("_sigma"), k)).otherwise(F.lit(0)))
        .drop("_past", "_med", "_sigma")
    )


def seasonal_params(
    df: DataFrame, value: str, series_cols: Sequence[str] = (), ts_col: str = "timestamp"
) -> DataFrame:
    """Median and sigma per slot over all rows: 168 rows per series."""
    keys = [*series_cols, *SLOT]
    return (
        with_slot(df, ts_col)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(value)).alias("_all"))
        .withColumn("median", sorted_median(F.col("_all")))
        .withColumn("sigma", robust_sigma(sorted_mad(F.col("_all"), F.col("median"))))
        .select(*keys, "median", "sigma")
    )


def frozen_mad_flags(
    df: DataFrame, params: DataFrame, value: str, k: float = 3.5, series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", out: str = "outlier",
) -> DataFrame:
    """Flags judged on given parameters; a slot without parameters is never an outlier."""
    keys = [*series_cols, *SLOT]
    joined = join_on(with_slot(df, ts_col), params.select(*keys, "median", "sigma"), keys, "left")
    return joined.withColumn(out, _flag(value, F.col("median"), F.col("sigma"), k)).drop("median", "sigma")


def load_outliers(
    df: DataFrame, value: str, start: str, split_date: str, k: float = 3.5, min_samples: int = 720,
    series_cols: Sequence[str] = (), ts_col: str = "timestamp", out: str = "outlier", step_seconds: int = 3600,
) -> DataFrame:
    """Train rows are judged on their own past, test rows on the parameters of all train rows."""
    split = F.lit(split_date).cast("timestamp")
    train, test = df.where(F.col(ts_col) < split), df.where(F.col(ts_col) >= split)
    past = expanding_mad_flags(train, value, start, k, min_samples, series_cols, ts_col, out, step_seconds)
    frozen = frozen_mad_flags(
        test, seasonal_params(train, value, series_cols, ts_col), value, k, series_cols, ts_col, out
    )
    return past.unionByName(frozen)
