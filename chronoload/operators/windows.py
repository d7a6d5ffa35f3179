"""Lag, rolling and differencing columns; frames reach back by time, so a missing hour is a missing value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoload.functions.timefns import steps_since
from chronoload.operators.blocks import BLOCK, EPOCH, with_halo, without_halo

Steps = Mapping[str, Sequence[int]]


def _by_time(series_cols: Sequence[str], ts_col: str, step_seconds: int):
    """Rows of a block along their place in time: frames over it count steps, whether or not rows are there."""
    return Window.partitionBy(*series_cols, BLOCK).orderBy(steps_since(ts_col, EPOCH, step_seconds))


def _known(df: DataFrame, name: str) -> Column:
    """The column with NaN as null."""
    c = F.col(f"`{name}`")
    return F.when(~F.isnan(c), c) if dict(df.dtypes)[name] in ("double", "float") else c


def history_features(
    df: DataFrame,
    lags: Steps | None = None,
    sums: Steps | None = None,
    means: Steps | None = None,
    series_cols: Sequence[str] = (),
    ts_col: str = "timestamp",
    step_seconds: int = 3600,
    block_rows: int | None = None,
) -> DataFrame:
    """``<c>_lag_<k>``, ``<c>_rw_<w>_sum`` and ``<c>_rw_<w>_mean`` for all columns in one pass.

    A lag is the value k steps earlier, null where that time has no row. Rolling windows hold the w steps
    before the current one and are null unless all w are there and neither null nor NaN. Each window sums its
    own values, so a spike or a NaN ends with the windows that hold it; one shuffle and one sort serve all
    columns. Lags of absent columns are skipped.
    """
    lags = {c: list(k) for c, k in (lags or {}).items() if c in df.columns}
    rolled: dict[str, list[tuple[int, str]]] = {}
    for kind, wanted in (("sum", sums or {}), ("mean", means or {})):
        for c, widths in wanted.items():
            if c not in df.columns:
                raise ValueError(f"rolling windows need column {c}")
            rolled.setdefault(c, []).extend((w, kind) for w in widths)
    reach = max([k for ks in lags.values() for k in ks] + [w for ws in rolled.values() for w, _ in ws], default=0)
    rows = with_halo(df, series_cols, ts_col, reach, 0, step_seconds, block_rows)
    w = _by_time(series_cols, ts_col, step_seconds)

    def rolling(c: str, width: int, kind: str) -> Column:
        value, frame = _known(df, c).cast("double"), w.rangeBetween(-width, -1)
        total = F.sum(value).over(frame)
        result = total if kind == "sum" else total / F.lit(width)
        return F.when(F.count(value).over(frame) == width, result).alias(f"{c}_rw_{width}_{kind}")

    out = rows.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.first(F.col(f"`{c}`")).over(w.rangeBetween(-k, -k)).alias(f"{c}_lag_{k}") for c, ks in lags.items() for k in ks],
        *[rolling(c, width, "sum") for c, ws in rolled.items() for width, kind in ws if kind == "sum"],
        *[rolling(c, width, "mean") for c, ws in rolled.items() for width, kind in ws if kind == "mean"],
        BLOCK,
        "_halo",
    )
    return without_halo(out)


def lag_features(df: DataFrame, lags: Steps, **where) -> DataFrame:
    return history_features(df, lags=lags, **where)


def rolling_features(df: DataFrame, windows: Steps, how: str, **where) -> DataFrame:
    if how not in ("sum", "mean"):
        raise ValueError(f"rolling features are sums or means, not {how}")
    return history_features(df, **{"sums" if how == "sum" else "means": windows}, **where)


def trailing_stats(
    df: DataFrame, value: str, widths: Sequence[int], series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    step_seconds: int = 3600, block_rows: int | None = None,
) -> DataFrame:
    """Mean and sample variance of the last w steps, the current one included; null unless all w are there."""
    rows = with_halo(df, series_cols, ts_col, max(widths) - 1, 0, step_seconds, block_rows)
    w = _by_time(series_cols, ts_col, step_seconds)
    known = _known(df, value)
    stats = []
    for width in widths:
        frame = w.rangeBetween(-(width - 1), 0)
        full = F.count(known).over(frame) == width
        stats += [
            F.when(full, F.avg(known).over(frame)).alias(f"{value}_mean_{width}"),
            F.when(full, F.var_samp(known).over(frame)).alias(f"{value}_var_{width}"),
        ]
    return without_halo(rows.select("*", *stats))


def seasonal_difference(
    df: DataFrame, value: str, period: int, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    out: str | None = None, step_seconds: int = 3600, block_rows: int | None = None,
) -> DataFrame:
    """``value`` minus the value ``period`` steps earlier; rows without one are dropped."""
    out = out or f"{value}_diff_{period}"
    rows = with_halo(df, series_cols, ts_col, period, 0, step_seconds, block_rows)
    earlier = F.first(value).over(_by_time(series_cols, ts_col, step_seconds).rangeBetween(-period, -period))
    return without_halo(rows.withColumn(out, F.col(value) - earlier)).dropna(subset=[out])
