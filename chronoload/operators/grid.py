"""Complete, regular series: resampling, pivoting, alignment to the grid and its validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoload.functions.timefns import floor_interval, ts_lit
from chronoload.operators.keys import join_on


def resample(
    df: DataFrame,
    ts_col: str,
    aggs: Sequence[Column],
    series_cols: Sequence[str] = (),
    step_seconds: int = 3600,
    origin: str | None = None,
    out_ts: str = "timestamp",
) -> DataFrame:
    """Aggregate each bin of the start time. Sums and means shrink map-side, so a hot series or hour
    reaches the shuffle as one row per task."""
    binned = floor_interval(ts_col, step_seconds, origin)
    return df.groupBy(*series_cols, binned.alias(out_ts)).agg(*aggs)


def _grid_times(start: str, end: str, step_seconds: int) -> Column:
    """All grid times in [start, end) as an array."""
    last = F.timestamp_micros(F.unix_micros(ts_lit(end)) - 1)
    return F.sequence(ts_lit(start), last, F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(step_seconds)))


def align(
    agg: DataFrame,
    start: str,
    end: str,
    series_cols: Sequence[str] = (),
    zero_cols: Sequence[str] = (),
    step_seconds: int = 3600,
    ts_col: str = "timestamp",
    series: DataFrame | None = None,
) -> DataFrame:
    """One row per series and grid time in [start, end); off-grid rows fall away. A null key is a series like any other.

    Missing values become 0 in ``zero_cols`` and stay null elsewhere. ``series`` may name the series;
    by default they are those in ``agg``.
    """
    values = [c for c in agg.columns if c not in (*series_cols, ts_col)]
    if series_cols:
        if series is None:
            # counting every value column keeps both uses of ``agg`` alike, so Spark scans once and reuses its shuffle
            used = [F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate([*values, ts_col])]
            series = agg.groupBy(*series_cols).agg(*used).where(" and ".join(f"_n{i} >= 0" for i in range(len(used))))
        grid = series.select(*series_cols, F.explode(_grid_times(start, end, step_seconds)).alias(ts_col))
    else:
        spark = agg.sparkSession
        grid = spark.range(1).select(F.explode(_grid_times(start, end, step_seconds)).alias(ts_col))
    joined = join_on(grid, agg, [*series_cols, ts_col], "left")
    filled = [
        F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(agg.schema[c].dataType)).alias(c) if c in zero_cols else F.col(f"`{c}`")
        for c in values
    ]
    return joined.select(*series_cols, ts_col, *filled)


def pivot_sums(
    df: DataFrame,
    key_cols: Sequence[str],
    pivot_cols: Sequence[str],
    pivot_values: Sequence[Sequence[str]],
    sums: Sequence[str],
    name,
    rest: Sequence[str] | None = None,
) -> DataFrame:
    """Sum of each ``sums`` column per combination in ``pivot_values``, 0 where there is none.

    The combinations come from configuration, which saves the distinct job and fixes the schema. ``name(column, values)``
    gives the output names. Combinations that are not listed, with a null or not, are left out, unless ``rest`` names them:
    then ``name(column, rest)`` holds their sum, from the same pass, and every amount is in one of the columns.
    """
    label = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in pivot_cols])
    labels = ["\u0001".join(map(str, v)) for v in pivot_values]
    if rest is not None:
        label = F.when(label.isin(labels), label).otherwise("\u0002")
        labels, pivot_values = [*labels, "\u0002"], [*pivot_values, tuple(rest)]
    aggs = [F.sum(c).alias(c) for c in sums]
    wide = df.withColumn("_label", label).groupBy(*key_cols).pivot("_label", labels).agg(*aggs)
    outputs = []
    for s in sums:
        for value, text in zip(pivot_values, labels, strict=True):
            source = text if len(sums) == 1 else f"{text}_{s}"
            outputs.append(F.coalesce(F.col(f"`{source}`"), F.lit(0.0)).alias(name(s, value)))
    return wide.select(*key_cols, *outputs)


def check_series(df: DataFrame, series_cols: Sequence[str] = (), ts_col: str = "timestamp") -> DataFrame:
    """Per series: rows, distinct times, first and last time."""
    return df.groupBy(*series_cols).agg(
        F.count("*").alias("rows"),
        F.countDistinct(ts_col).alias("distinct_times"),
        F.min(ts_col).alias("first_time"),
        F.max(ts_col).alias("last_time"),
    )


def require_complete(df: DataFrame, periods: int, name: str, series_cols: Sequence[str] = (), ts_col: str = "timestamp"):
    """Raise unless every series has exactly ``periods`` rows at distinct times; returns the span.

    One aggregated row reaches the driver.
    """
    kind = dict(df.dtypes)[ts_col]
    if not kind.startswith("timestamp"):
        raise TypeError(f"{name}: {ts_col} must be a timestamp, not {kind}")
    row = (
        check_series(df, series_cols, ts_col)
        .agg(
            F.min("rows").alias("low"), F.max("rows").alias("high"),
            F.min("distinct_times").alias("times"),
            F.min("first_time").alias("first_min"), F.max("first_time").alias("first_max"),
            F.min("last_time").alias("last_min"), F.max("last_time").alias("last_max"),
        )
        .first()
    )
    if row.low != periods or row.high != periods:
        raise ValueError(f"{name}: expected {periods} rows per series, found {row.low} to {row.high}")
    if row.times != periods:
        raise ValueError(f"{name}: expected {periods} distinct times per series, found {row.times}")
    if row.first_min != row.first_max or row.last_min != row.last_max:
        raise ValueError(f"{name}: series do not share one span")
    return row.first_min, row.last_max


def combine(frames: dict[str, DataFrame], periods: int, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
            validate: bool = True) -> DataFrame:
    """Inner join of aligned sources on series and time, in the given order, validated before and after."""
    if validate:
        spans = {name: require_complete(df, periods, name, series_cols, ts_col) for name, df in frames.items()}
        if len(set(spans.values())) != 1:
            raise ValueError(f"sources are misaligned: {spans}")
    parts = list(frames.values())
    out = parts[0]
    for part in parts[1:]:
        out = join_on(out, part, [*series_cols, ts_col])
    if validate:
        require_complete(out, periods, "combined", series_cols, ts_col)
    return out
