"""Outlier bounds of raw events as small tables, and the operators that apply them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.operators.keys import join_on
from chronoload.operators.quantiles import exact_quantiles, quantile_name
from chronoload.session import stage


def long_values(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """``(groups…, column, _x)``: one row per value of the columns ``cols``."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x")) for c in cols]
    return df.select(*group_cols, F.explode(F.array(*pairs)).alias("_p")).select(*group_cols, "_p.*")


def mad_bounds(
    df: DataFrame, cols: Sequence[str], threshold: float = 3.0, group_cols: Sequence[str] = ()
) -> DataFrame:
    """``(groups…, column, median, skewed, min_val, max_val)`` from median absolute deviations.

    Up to two distinct values (null counts as one): no bounds. Population skewness below 1 in size:
    median +- threshold * MAD. Otherwise, or with any null in the column: separate deviations of the
    values at or above and below the median. A null bound means no bound.
    """
    return mad_bounds_of(long_values(df, cols, group_cols), threshold, group_cols)


def mad_bounds_of(long: DataFrame, threshold: float = 3.0, group_cols: Sequence[str] = ()) -> DataFrame:
    """``mad_bounds`` of values in long form, which may come from several tables: all bounds share the passes."""
    keys = [*group_cols, "column"]
    base = exact_quantiles(
        long, "_x", [0.5], keys,
        extras=[
            (F.count("*") > F.count("_x")).alias("_has_null"),
            F.min("_x").alias("_min"),
            F.max("_x").alias("_max"),
            F.skewness("_x").alias("_skew"),
        ],
    ).withColumnRenamed(quantile_name(0.5), "median")
    base = base.withColumn("skewed", F.col("_has_null") | ~F.coalesce(F.abs("_skew") < 1, F.lit(False)))
    base = stage(base, "centres")  # one row per group and column
    side = F.when(~F.col("skewed"), F.lit("both")).when(F.col("_x") >= F.col("median"), F.lit("upper")).otherwise("lower")
    deviations = join_on(long.where(F.col("_x").isNotNull()), base, keys).select(
        *keys,
        side.alias("_side"),
        F.abs(F.col("_x") - F.col("median")).alias("_dev"),
        ((F.col("_x") > F.col("_min")) & (F.col("_x") < F.col("_max"))).alias("_between"),
    )
    mad = F.col(quantile_name(0.5))
    spreads = (
        exact_quantiles(
            deviations, "_dev", [0.5], [*keys, "_side"], extras=[F.max(F.col("_between").cast("int")).alias("_inner")]
        )
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("_side").isin("both", "upper"), mad)).alias("_up"),
            F.max(F.when(F.col("_side").isin("both", "lower"), mad)).alias("_down"),
            F.max("_inner").alias("_inner"),
        )
    )
    table = join_on(base, spreads, keys, "left")
    distinct = (
        F.when(F.col("_min").isNull(), 0).when(F.col("_min") == F.col("_max"), 1)
        .when(F.col("_inner") == 1, 3).otherwise(2) + F.col("_has_null").cast("int")
    )
    bounded = distinct > 2
    return table.select(
        *keys,
        F.when(bounded, F.col("median")).alias("median"),
        (bounded & F.col("skewed")).alias("skewed"),
        F.when(bounded, F.col("median") - threshold * F.col("_down")).alias("min_val"),
        F.when(bounded, F.col("median") + threshold * F.col("_up")).alias("max_val"),
    )


def bounds_from_log(bounds: DataFrame, prefix: str = "log_") -> DataFrame:
    """Bounds of ``log_<c>`` turned into bounds of ``c``."""
    return bounds.withColumns(
        {
            "column": F.regexp_replace("column", f"^{prefix}", ""),
            "median": F.expm1("median"),
            "min_val": F.expm1("min_val"),
            "max_val": F.expm1("max_val"),
        }
    )


def iqr_bounds(df: DataFrame, cols: Sequence[str], factor: float = 2.0, group_cols: Sequence[str] = ()) -> DataFrame:
    keys = [*group_cols, "column"]
    q = exact_quantiles(long_values(df, cols, group_cols), "_x", [0.25, 0.75], keys)
    spread = F.col("q75") - F.col("q25")
    return q.select(
        *keys, (F.col("q25") - factor * spread).alias("min_val"), (F.col("q75") + factor * spread).alias("max_val")
    )


def _wide(bounds: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    picks = []
    for c in cols:
        mine = F.col("column") == c
        picks += [
            F.max(F.when(mine, F.col("min_val"))).alias(f"_min_{c}"),
            F.max(F.when(mine, F.col("max_val"))).alias(f"_max_{c}"),
        ]
    return bounds.groupBy(*group_cols).agg(*picks)


def cap_to_bounds(
    df: DataFrame, bounds: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()
) -> DataFrame:
    """Values beyond a bound become the bound; a null or missing bound caps nothing."""
    joined = join_on(df, _wide(bounds, cols, group_cols), group_cols, "left")
    capped = {
        c: F.when(F.col(c) > F.col(f"_max_{c}"), F.col(f"_max_{c}"))
        .when(F.col(c) < F.col(f"_min_{c}"), F.col(f"_min_{c}"))
        .otherwise(F.col(c))
        for c in cols
    }
    return joined.select(*[capped[c].alias(c) if c in capped else F.col(c) for c in df.columns])


def outlier_share(
    df: DataFrame, bounds: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()
) -> DataFrame:
    """Percentage of rows outside the bounds, per column: ``(groups…, column, outlier_pct)``."""
    keys = [*group_cols, "column"]
    rows = join_on(long_values(df, cols, group_cols), bounds.select(*keys, "min_val", "max_val"), keys, "left")
    outside = F.coalesce(
        F.coalesce(F.col("_x") < F.col("min_val"), F.lit(False)) | F.coalesce(F.col("_x") > F.col("max_val"), F.lit(False)),
        F.lit(False),
    )
    return rows.groupBy(*keys).agg((F.avg(outside.cast("double")) * 100).alias("outlier_pct"))


def quantile_trim_bounds(train: DataFrame, value: str, q: float, group_cols: Sequence[str]) -> DataFrame:
    table = exact_quantiles(train, value, [q, 1 - q], group_cols)
    low, high = table.columns[-2:]
    return table.select(*group_cols, F.col(low).alias("low"), F.col(high).alias("high"))


def quantile_trim(df: DataFrame, bounds: DataFrame, value: str, group_cols: Sequence[str]) -> DataFrame:
    """Keep ``low < value < high`` strictly; groups without bounds and null values are kept."""
    joined = join_on(df, bounds, group_cols, "left")
    extreme = (F.col(value) <= F.col("low")) | (F.col(value) >= F.col("high"))
    return joined.where(~F.coalesce(extreme, F.lit(False))).select(*df.columns)
