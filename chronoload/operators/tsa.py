"""Series statistics: autocorrelation, unit-root and stationarity tests, seasonal decomposition.

Everything that touches the rows is a window per block and one aggregation per series. What remains
per series (a few hundred autocorrelations, a small moment matrix) is solved in one short Python call.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoload.functions.arrays import MAD_TO_SIGMA
from chronoload.functions.timefns import steps_since, ts_lit
from chronoload.operators.blocks import BLOCK, BLOCK_ROWS, EPOCH, block_scan, block_window, with_halo, without_halo
from chronoload.operators.keys import join_on
from chronoload.operators.quantiles import exact_quantiles, quantile_name
from chronoload.operators.trend import ols_trend, remove_trend
from chronoload.session import stage

# ------------------------------------------------------------------ autocorrelation


def _centred(df: DataFrame, value: str, series_cols: Sequence[str]) -> DataFrame:
    means = df.groupBy(*series_cols).agg(F.avg(value).alias("_mean"))
    return join_on(df, means, series_cols).withColumn("_y", F.col(value) - F.col("_mean"))


def _lag_products(
    rows: DataFrame, y: str, max_lag: int, series_cols: Sequence[str], ts_col: str, step_seconds: int,
    block_rows: int | None,
) -> DataFrame:
    """Sum of y(t) * y(t - k) for k = 0..max_lag, per series: ``(series…, lag, product)``.

    A block and the halo before it (at most two block lengths of rows) come to a task as one array of values; each lag is one
    product of two slices of it, so a block sends on ``max_lag + 1`` sums whatever its length. Nulls add nothing.
    """
    keys = list(series_cols)
    values = rows.select(*keys, ts_col, F.col(y).cast("double").alias("_y"))
    halo = with_halo(values, keys, ts_col, max_lag, 0, step_seconds, block_rows).select(*keys, BLOCK, ts_col, "_y", "_halo")
    fields = {f.name: f for f in halo.schema}
    schema = T.StructType([*[fields[k] for k in keys], T.StructField("lag", T.LongType()), T.StructField("product", T.DoubleType())])

    def products(block: pa.Table) -> pa.Table:
        block = block.sort_by(ts_col)
        column = block["_y"].combine_chunks()
        there = column.is_valid().to_numpy(zero_copy_only=False)
        v = np.where(there, column.to_numpy(zero_copy_only=False), 0.0)
        own = int(np.count_nonzero(block["_halo"].to_numpy()))  # the halo is earlier than the block's own rows
        lags, sums = [], []
        for lag in range(min(max_lag, len(v) - 1) + 1):
            first = max(own, lag)
            if first < len(v):
                met = (there[first:] & there[first - lag : len(v) - lag]).any()
                lags.append(lag)
                sums.append(float(v[first:] @ v[first - lag : len(v) - lag]) if met else None)
        own_keys = [block[k].slice(0, 1).combine_chunks().take(pa.array([0] * len(lags), pa.int64())) for k in keys]
        return pa.Table.from_arrays([*own_keys, pa.array(lags, pa.int64()), pa.array(sums, pa.float64())], names=schema.names)

    blocks = halo.groupBy(*keys, BLOCK).applyInArrow(products, schema)
    return blocks.groupBy(*keys, "lag").agg(F.sum("product").alias("product"))


def acf(
    df: DataFrame, value: str, max_lag: int, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    step_seconds: int = 3600, block_rows: int | None = None,
) -> DataFrame:
    """Autocorrelations for lags 0..max_lag with the overall mean and the full sum of squares below."""
    sums = _lag_products(_centred(df, value, series_cols), "_y", max_lag, series_cols, ts_col, step_seconds, block_rows)
    whole = sums.where("lag = 0").select(*series_cols, F.col("product").alias("_var"))
    return join_on(sums, whole, series_cols).select(
        *series_cols, F.col("lag").cast("int").alias("lag"), F.try_divide("product", "_var").alias("acf")
    )


def _partial(rho: np.ndarray) -> np.ndarray:
    """Durbin-Levinson recursion: partial autocorrelations from autocorrelations 0..L."""
    last = len(rho) - 1
    out = np.ones(last + 1)
    phi = np.zeros(0)
    error = 1.0
    for k in range(1, last + 1):
        gap = rho[k] - phi @ rho[k - 1 : 0 : -1] if k > 1 else rho[1]
        out[k] = gap / error
        phi = np.append(phi - out[k] * phi[::-1], out[k])
        error *= 1.0 - out[k] ** 2
    return out


def pacf(
    df: DataFrame, value: str, max_lag: int, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    step_seconds: int = 3600, block_rows: int | None = None,
) -> DataFrame:
    """Partial autocorrelations (Yule-Walker on the biased autocorrelations) for lags 0..max_lag.

    A group handed to Python is the max_lag + 1 autocorrelations of one series.
    """
    correlations = acf(df, value, max_lag, series_cols, ts_col, step_seconds, block_rows)
    schema = T.StructType([f for f in correlations.schema if f.name != "acf"] + [T.StructField("pacf", T.DoubleType())])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        return pdf.drop(columns="acf").assign(pacf=_partial(pdf["acf"].to_numpy()))

    return correlations.groupBy(*series_cols).applyInPandas(solve, schema)


# ------------------------------------------------------------------ unit root test

# Published response surfaces (MacKinnon 1994, 2010, one variable) for the test with a
# constant (c), a constant and trend (ct), and a quadratic trend (ctt).
CRITICAL_VALUES = {
    "c": {
        "1%": [-3.43035, -6.5393, -16.786, -79.433],
        "5%": [-2.86154, -2.8903, -4.234, -40.040],
        "10%": [-2.56677, -1.5384, -2.809, 0.0],
    },
    "ct": {
        "1%": [-3.95877, -9.0531, -28.428, -134.155],
        "5%": [-3.41049, -4.3904, -9.036, -45.374],
        "10%": [-3.12705, -2.5856, -3.925, -22.380],
    },
    "ctt": {
        "1%": [-4.37113, -11.5882, -35.819, -334.047],
        "5%": [-3.83239, -5.9057, -12.490, -118.284],
        "10%": [-3.55326, -3.6596, -5.293, -63.559],
    },
}
# smallest and largest statistic covered, switch point, then the two polynomials of the p-value
P_VALUE_SURFACE = {
    "c": (-18.83, 2.74, -1.61, [2.1659, 1.4412, 0.038269], [1.7339, 0.93202, -0.12745, -0.010368]),
    "ct": (-16.18, 0.70, -2.89, [3.2512, 1.6047, 0.049588], [2.5261, 0.61654, -0.37956, -0.060285]),
    "ctt": (-17.17, 0.54, -3.21, [4.0003, 1.6580, 0.048288], [3.0778, 0.49529, -0.41477, -0.059359]),
}


def unit_root_p_value(statistic: float, regression: str) -> float:
    low, high, switch, small, large = P_VALUE_SURFACE[regression]
    if statistic > high:
        return 1.0
    if statistic < low:
        return 0.0
    coefs = small if statistic <= switch else large
    z = sum(c * statistic**i for i, c in enumerate(coefs))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def adf(
    df: DataFrame, value: str, lags: int, regression: str = "c", series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", start: str | None = None, step_seconds: int = 3600, block_rows: int | None = None,
) -> DataFrame:
    """Augmented Dickey-Fuller test with a given number of lagged differences.

    The regression of the first difference on the lagged level, ``lags`` lagged differences, a constant
    and, for ``ct`` / ``ctt``, a linear / quadratic trend. Its moment matrix is summed in Spark; one row
    per series is solved in Python. There is no search for the lag order.
    """
    if regression not in CRITICAL_VALUES:
        raise ValueError(f"regression must be one of {sorted(CRITICAL_VALUES)}, not {regression}")
    rows = with_halo(df.select(*series_cols, ts_col, value), series_cols, ts_col, lags + 1, 0, step_seconds, block_rows)
    w = block_window(series_cols, ts_col)
    step = lambda k: F.lag(value, k).over(w) - F.lag(value, k + 1).over(w)
    trend = {"c": 0, "ct": 1, "ctt": 2}[regression]
    # a trend counted in thousands of steps keeps the matrix well scaled; the statistic does not change
    t = steps_since(ts_col, start or EPOCH, step_seconds).cast("double") / 1000.0
    design = without_halo(
        rows.select(
            *series_cols, "_block", "_halo",
            F.lag(value, 1).over(w).alias("x0"),
            *[step(k).alias(f"x{k}") for k in range(1, lags + 1)],
            F.lit(1.0).alias(f"x{lags + 1}"),
            *[F.pow(t, F.lit(p)).alias(f"x{lags + 1 + p}") for p in range(1, trend + 1)],
            (F.col(value) - F.lag(value, 1).over(w)).alias("y"),
        )
    ).dropna()
    width = lags + 2 + trend
    names = [f"x{i}" for i in range(width)] + ["y"]
    cells = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    moments = design.groupBy(*series_cols).agg(
        F.count("*").alias("n"), *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"m_{i}_{j}") for i, j in cells]
    )
    packed = moments.select(*series_cols, "n", F.array(*[f"m_{i}_{j}" for i, j in cells]).alias("m"))
    keys = list(series_cols)
    schema = T.StructType(
        [f for f in packed.schema if f.name in keys]
        + [T.StructField("n", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("statistic", "p_value", "crit_1", "crit_5", "crit_10")]
        + [T.StructField("stationary", T.BooleanType())]
    )

    def solve(batches):
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                full = np.zeros((width + 1, width + 1))
                for (i, j), s in zip(cells, row["m"], strict=True):
                    full[i, j] = full[j, i] = s
                gram, xy, yy = full[:width, :width], full[:width, width], full[width, width]
                scale = np.sqrt(np.diag(gram))
                inverse = np.linalg.inv(gram / np.outer(scale, scale)) / np.outer(scale, scale)
                beta = inverse @ xy
                n = int(row["n"])
                sigma2 = (yy - beta @ xy) / (n - width)
                stat = float(beta[0] / math.sqrt(sigma2 * inverse[0, 0]))
                crit = {lv: sum(c / n**i for i, c in enumerate(cs)) for lv, cs in CRITICAL_VALUES[regression].items()}
                p = unit_root_p_value(stat, regression)
                out.append([*(row[k] for k in keys), n, stat, p, crit["1%"], crit["5%"], crit["10%"],
                            bool(p <= 0.05 and stat < crit["5%"])])
            yield pd.DataFrame(out, columns=schema.names)

    return packed.mapInPandas(solve, schema)


# ------------------------------------------------------------------ stationarity test

# Published critical values of the KPSS test and their significance levels.
KPSS_CRITICAL = {"c": [0.347, 0.463, 0.574, 0.739], "ct": [0.119, 0.146, 0.176, 0.216]}
KPSS_LEVELS = [0.10, 0.05, 0.025, 0.01]


def _kpss_p_value(stat, regression: str):
    crit = KPSS_CRITICAL[regression]
    p = F.lit(KPSS_LEVELS[-1])
    for i in reversed(range(len(crit) - 1)):
        part = (stat - crit[i]) / (crit[i + 1] - crit[i])
        p = F.when(stat < crit[i + 1], F.lit(KPSS_LEVELS[i]) + part * (KPSS_LEVELS[i + 1] - KPSS_LEVELS[i])).otherwise(p)
    return F.when(stat <= crit[0], F.lit(KPSS_LEVELS[0])).otherwise(p)


def kpss(
    df: DataFrame, value: str, lags: int, regression: str = "c", series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", start: str = EPOCH, step_seconds: int = 3600, block_rows: int | None = None,
) -> DataFrame:
    """KPSS statistic about a level (c) or a trend (ct) with Bartlett weights over ``lags`` lags.

    ``(series…, n, statistic, p_value)``; p-values are interpolated between, and held at, the published
    levels.
    """
    keys = list(series_cols)
    if regression == "c":
        resid = _centred(df, value, keys).select(*keys, ts_col, F.col("_y").alias("_e"))
    elif regression == "ct":
        line = ols_trend(df, value, start, keys, ts_col, step_seconds)
        resid = remove_trend(df, line, value, start, keys, ts_col, step_seconds).select(*keys, ts_col, F.col(value).alias("_e"))
    else:
        raise ValueError(f"regression must be c or ct, not {regression}")
    size = max(block_rows or BLOCK_ROWS, 1)
    sums = block_scan(resid, F.col("_e"), "_s", "sum", keys, steps_since(ts_col, EPOCH, step_seconds), ts_col, size)
    squares = sums.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col("_s") * F.col("_s")).alias("_eta"))
    weight = F.when(F.col("lag") == 0, 1.0).otherwise(2.0 * (1.0 - F.col("lag") / F.lit(lags + 1.0)))
    long_run = (
        _lag_products(resid, "_e", lags, keys, ts_col, step_seconds, block_rows)
        .groupBy(*keys)
        .agg(F.sum(weight * F.col("product")).alias("_s2"))
    )
    n = F.col("n").cast("double")
    stat = F.try_divide(F.col("_eta") / (n * n), F.col("_s2") / n)
    return join_on(squares, long_run, keys).withColumn("statistic", stat).select(
        *keys, "n", "statistic", _kpss_p_value(F.col("statistic"), regression).alias("p_value")
    )


def automatic_kpss_lags(
    df: DataFrame, value: str, n: int, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    step_seconds: int = 3600, block_rows: int | None = None,
) -> DataFrame:
    """Data-dependent lag order per series of length n (Hobijn, Franses and Ooms 1998): ``(series…, lags)``."""
    top = int(n ** (2.0 / 9.0))
    sums = _lag_products(_centred(df, value, series_cols), "_y", top, series_cols, ts_col, step_seconds, block_rows)
    part = F.when(F.col("lag") == 0, F.col("product") / n).otherwise(2.0 * F.col("product") / n)
    total = sums.groupBy(*series_cols).agg(
        F.sum(part).alias("_s0"), F.sum(F.when(F.col("lag") > 0, F.col("lag") * part).otherwise(0.0)).alias("_s1")
    )
    ratio = F.try_divide("_s1", "_s0")
    lags = F.floor(F.lit(1.1447) * F.pow(ratio * ratio, F.lit(1.0 / 3.0)) * F.lit(float(n) ** (1.0 / 3.0)))
    return total.select(*series_cols, F.least(lags, F.lit(n - 1)).cast("int").alias("lags"))


# ------------------------------------------------------------------ decomposition


def decompose(
    df: DataFrame, value: str, period: int, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    start: str = EPOCH, step_seconds: int = 3600, block_rows: int | None = None, prefix: str = "",
) -> DataFrame:
    """Additive decomposition: adds ``trend``, ``seasonal`` and ``resid``.

    The trend is a centred moving average over one period (half weights at the ends when the period is
    even), null for half a period at both ends of a series. The seasonal part is the mean of the
    detrended values per phase, shifted to average 0 over a period.
    """
    keys = list(series_cols)
    half = period // 2
    rows = with_halo(df, keys, ts_col, half, half, step_seconds, block_rows)
    w = block_window(keys, ts_col)
    frame = w.rowsBetween(-half, half)
    total = F.sum(value).over(frame)
    if period % 2 == 0:
        total = total - (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2.0
    full = F.count(value).over(frame) == 2 * half + 1
    trended = without_halo(rows.withColumn("_trend", F.when(full, total / F.lit(float(period)))))
    phase = F.pmod(steps_since(ts_col, start, step_seconds), F.lit(period))
    phased = trended.withColumn("_phase", phase)
    means = phased.groupBy(*keys, "_phase").agg(F.avg(F.col(value) - F.col("_trend")).alias("_season"))
    # `period` rows per series
    level = F.avg("_season").over(Window.partitionBy(*keys))
    seasons = means.select(*keys, "_phase", (F.col("_season") - level).alias("_season"))
    joined = join_on(phased, seasons, [*keys, "_phase"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_trend").alias(f"{prefix}trend"),
        F.col("_season").alias(f"{prefix}seasonal"),
        (F.col(value) - F.col("_trend") - F.col("_season")).alias(f"{prefix}resid"),
    )


def robust_params(df: DataFrame, value: str, series_cols: Sequence[str] = ()) -> DataFrame:
    """``(series…, median, sigma)`` with sigma = 1.4826 * MAD; both medians are selected, never gathered."""
    keys = list(series_cols)
    half = quantile_name(0.5)
    df = stage(df.select(*keys, value), "values")  # read once a round; what comes before is not run again
    centre = stage(exact_quantiles(df, value, [0.5], keys).select(*keys, F.col(half).alias("median")), "medians")
    apart = join_on(df, centre, keys).withColumn("_apart", F.abs(F.col(value) - F.col("median")))
    spread = join_on(centre, exact_quantiles(apart, "_apart", [0.5], keys).withColumnRenamed(half, "_mad"), keys, "left")
    return spread.select(*keys, "median", (F.lit(MAD_TO_SIGMA) * F.col("_mad")).alias("sigma"))


def robust_flags(
    df: DataFrame, value: str, k: float = 3.5, series_cols: Sequence[str] = (), params: DataFrame | None = None,
    out: str = "outlier",
) -> DataFrame:
    """0/1 flag of values more than k sigma from the median; given parameters are used as they are."""
    keys = list(series_cols)
    params = robust_params(df, value, keys) if params is None else params
    joined = join_on(df, params.select(*keys, "median", "sigma"), keys, "left")
    beyond = F.abs(F.col(value) - F.col("median")) > F.lit(float(k)) * F.col("sigma")
    return joined.withColumn(out, F.coalesce(beyond.cast("int"), F.lit(0))).select(*[F.col(f"`{c}`") for c in df.columns], out)


def multi_seasonal_outliers(
    df: DataFrame, value: str, periods: Sequence[int] = (24, 168), k: float = 3.5, series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", start: str = EPOCH, step_seconds: int = 3600, params: DataFrame | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Flag residuals after taking out several seasons, the shortest first.

    Seasons come from moving averages, one after the other, not from a robust LOESS fit; so residuals,
    and flags near the limit, differ from that method's.
    """
    work = df.withColumn("_x", F.col(value))
    ordered = sorted(periods)
    for i, period in enumerate(ordered):
        parts = decompose(work, "_x", period, series_cols, ts_col, start, step_seconds, block_rows, prefix="_")
        if i < len(ordered) - 1:
            work = parts.withColumn("_x", F.col("_x") - F.col("_seasonal")).drop("_trend", "_seasonal", "_resid")
        else:
            work = parts.withColumn("resid", F.col("_resid")).drop("_trend", "_seasonal", "_resid", "_x")
    return robust_flags(work, "resid", k, series_cols, params)


def in_span(df: DataFrame, start: str, end: str, ts_col: str = "timestamp") -> DataFrame:
    return df.where((F.col(ts_col) >= ts_lit(start)) & (F.col(ts_col) < ts_lit(end)))
