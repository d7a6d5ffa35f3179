"""Profiling tables of a raw source."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoload.operators.keys import join_on
from chronoload.operators.quantiles import exact_quantiles

# Seconds per period unit.
PERIOD_SECONDS = {"min": 60, "h": 3600, "D": 86_400}
DUPLICATE_CHUNK = 10_000


def completeness(
    df: DataFrame, time_col: str, period: str, n: int, group_cols: Sequence[str] = (), inclusive: bool = False
) -> DataFrame:
    """Non-empty n-period bins over the bins the group spans, per group.

    Bins start at midnight of the group's first day. The span is last bin minus first bin, so the
    ratio can exceed 1; ``inclusive`` counts both ends. A span of 0 gives null.
    """
    unit = PERIOD_SECONDS[period]
    width = unit * n
    keys = list(group_cols)
    # one row per group and unit period; both uses below read the same shuffle
    unit_no = F.floor(F.unix_seconds(time_col) / unit).cast("long")
    units = (
        df.where(F.col(time_col).isNotNull()).groupBy(*keys, unit_no.alias("_u")).agg(F.min(time_col).alias("_first"))
    )
    firsts = units.groupBy(*keys).agg(F.unix_seconds(F.date_trunc("DAY", F.min("_first"))).alias("_day"), F.min("_u").alias("_u0"))
    binned = join_on(units, firsts.select(*keys, "_day"), keys).withColumn(
        "_bin", F.floor((F.unix_seconds("_first") - F.col("_day")) / width)
    )
    used = binned.groupBy(*keys).agg(
        F.countDistinct("_bin").alias("used_bins"),
        (F.max("_bin") - F.min("_bin") + F.lit(1 if inclusive else 0)).cast("long").alias("span_bins"),
    )
    return used.withColumn("completeness", F.try_divide(F.col("used_bins").cast("double"), F.col("span_bins").cast("double")))


def period_totals(
    df: DataFrame, period: str | Column, value: str, how: str = "total", weekday_split: bool = False,
    weekdays: Sequence[int] = range(7), ts_col: str = "timestamp",
) -> DataFrame:
    """Sum or mean of ``value`` per period, optionally per weekday of a subset of weekdays."""
    agg = {"total": F.sum, "mean": F.avg}[how.lower()](value).alias("value")
    column = (F.col(period) if isinstance(period, str) else period).alias("period")
    if not weekday_split:
        return df.groupBy(column).agg(agg)
    day = F.weekday(ts_col)
    return df.where(day.isin(list(weekdays))).groupBy(column, day.alias("weekday")).agg(agg)


def describe(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max per column (and group)."""
    keys = [*group_cols, "column"]
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x")) for c in cols]
    long = df.select(*group_cols, F.explode(F.array(*pairs)).alias("_p")).select(*group_cols, "_p.*")
    basic = long.groupBy(*keys).agg(
        F.count("_x").alias("count"), F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("std"),
        F.min("_x").alias("min"), F.max("_x").alias("max"),
    )
    quartiles = exact_quantiles(long, "_x", [0.25, 0.5, 0.75], keys).drop("n")
    return join_on(basic, quartiles, keys, "left")


def column_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values and nulls per column.

    Columns are unpivoted to (column, value) so that one column's distinct set is spread over tasks.
    """
    cols = list(cols or df.columns)
    if approx:
        aggs = [F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)]
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
        row = df.agg(*aggs)
        cells = [F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("distinct_values"), F.col(f"n{i}").alias("nulls"))
                 for i, c in enumerate(cols)]
        return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    values = (
        df.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("c"))
    )
    return values.groupBy("column").agg(
        F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("c"))), F.lit(0)).alias("nulls"),
    )


def repeated_rows(df: DataFrame) -> DataFrame:
    """The second and further copies of each row.

    Copies are counted, and the listing of a large group is cut into chunks before it is written
    out, so one group may hold any share of the rows.
    """
    cols = [f"`{c}`" for c in df.columns]
    extra = df.groupBy(*cols).agg((F.count("*") - 1).alias("_extra")).where("_extra > 0")
    chunk = F.lit(DUPLICATE_CHUNK)
    chunks = extra.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_extra") - 1) / chunk).cast("int"))))
    sized = chunks.withColumn("_size", F.least(chunk, F.col("_extra") - F.col("_chunk") * chunk).cast("int"))
    spread = sized.repartition(*cols, "_chunk")
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_size")))).select(*cols)


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("count"))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Counts of two columns against each other, 0 where a pair does not occur."""
    wide = df.where(F.col(rows).isNotNull()).groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1)))
    return wide.fillna(0)


def scalar_summary(df: DataFrame, value: str) -> DataFrame:
    return df.agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("sum"),
        F.count_if(F.col(value) < 0).alias("negatives"), F.count("*").alias("rows"),
    )


def active_hours(df: DataFrame, ts: Column, days: Column | None = None, span_col: str | None = None) -> DataFrame:
    """Per hour of day: the number of distinct hours with activity, and that number per day of the span."""
    span_col = span_col or "ts"
    hours = df.groupBy(ts.alias("_hour")).agg(F.min(span_col).alias("_lo"), F.max(span_col).alias("_hi"))
    span = hours.agg(
        F.floor((F.unix_seconds(F.max("_hi")) - F.unix_seconds(F.min("_lo"))) / 3600).alias("_hours")
    )
    counted = hours.groupBy(F.hour("_hour").alias("hour")).agg(F.count("*").alias("count"))
    return join_on(counted, span, ()).select(
        "hour", "count", F.round(F.col("count") / (F.col("_hours") / 24), 3).alias("normalised_count")
    )


def zero_share(df: DataFrame, value: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols).agg((F.avg((F.col(value) == 0).cast("double")) * 100).alias("zero_pct"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts of equal-width bins over [low, high]; the last bin is closed, values outside are left out."""
    width = (high - low) / bins
    x = F.col(value)
    number = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    return (
        df.where(x.between(low, high)).groupBy(number.alias("bin")).agg(F.count("*").alias("count"))
        .withColumn("bin_start", F.lit(float(low)) + F.col("bin") * F.lit(width))
    )


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
