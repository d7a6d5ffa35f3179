"""Forecasts: seasonal naive, one-step walk-forward, recursive multi-step, columns of an additive regression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoload.functions.textfns import quoted
from chronoload.functions.timefns import steps_since, ts_lit
from chronoload.operators.keys import join_on
from chronoload.operators.scores import forecast_errors
from chronoload.operators.trend import add_trend, remove_trend
from chronoload.operators.windows import lag_features
from chronoload.session import stage
from chronoload.training.fit import feature_names

# ------------------------------------------------------------------ seasonal naive


def seasonal_naive(
    df: DataFrame, value: str, split_date: str, period: int = 168, series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", step_seconds: int = 3600,
) -> DataFrame:
    """Value one period earlier as the prediction, with the split each row belongs to."""
    lagged = lag_features(df, {value: [period]}, series_cols=series_cols, ts_col=ts_col, step_seconds=step_seconds)
    part = F.when(F.col(ts_col) < ts_lit(split_date), "train").otherwise("test")
    return lagged.withColumnRenamed(f"{value}_lag_{period}", "prediction").withColumn("split", part)


def naive_errors(df: DataFrame, value: str, split_date: str, period: int = 168, series_cols=(), **where) -> DataFrame:
    scored = seasonal_naive(df, value, split_date, period, series_cols, **where)
    return forecast_errors(scored, value, "prediction", [*series_cols, "split"])


# ------------------------------------------------------------------ walk-forward


def walk_forward_score(
    scored: DataFrame, actual: str, predicted: str, start: str, end: str, group_cols: Sequence[str] = (),
    ts_col: str = "timestamp",
) -> DataFrame:
    """Mean error of one-step predictions made in [start, end), each with all earlier actuals known.

    Lag features of the actual series already hold what is known at each origin, so all origins are
    scored together. The error of a single step is the same by RMSE and by MAE.
    """
    steps = scored.where((F.col(ts_col) >= ts_lit(start)) & (F.col(ts_col) < ts_lit(end)))
    return steps.groupBy(*group_cols).agg(
        F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("score"), F.count("*").alias("steps")
    )


# ------------------------------------------------------------------ recursive forecast


def _latest(history: Column, k: int) -> Column:
    return F.try_element_at(history, F.lit(-k))


def _window(history: Column, width: int, how: str) -> Column:
    part = F.slice(history, F.lit(-width), F.lit(width))
    total = F.aggregate(part, F.lit(0.0), lambda acc, x: acc + x)
    return total if how == "sum" else total / F.lit(float(width))


def _from_history(name: str, source: str, history: Column) -> Column:
    """Value of a history feature, read off its name."""
    rest = name[len(source) + 1 :].split("_")
    if rest[0] == "lag":
        return _latest(history, int(rest[1]))
    if rest[0] == "rw":
        return _window(history, int(rest[1]), rest[2])
    raise ValueError(f"cannot rebuild feature {name}")


def _reach(name: str, source: str) -> int:
    """How many steps back a history feature looks, read off its name."""
    rest = name[len(source) + 1 :].split("_")
    return int(rest[1])


SEGMENT = 8


def recursive_forecast(
    model: PipelineModel, history: DataFrame, exogenous: DataFrame, target: str, forecast_start: str, horizon: int,
    max_lag: int | None = None, flag: str | None = None, series_cols: Sequence[str] = (), ts_col: str = "timestamp",
    step_seconds: int = 3600, trend: DataFrame | None = None, series_start: str | None = None, segment: int = SEGMENT,
) -> DataFrame:
    """``(series…, timestamp, forecast, actual)`` over ``horizon`` steps, each step fed by the ones before.

    ``history`` holds the raw target (and ``flag``, such as an outlier flag) up to the start; rows after it only serve as
    ``actual``. ``exogenous`` holds every feature that is not built from the target, at the forecast times; a missing value
    is refused. With ``trend`` the target is detrended first and the trend added back at the end; positions count from
    ``series_start``. Flags of forecast steps are 0.

    A series' state is one row with the last values its features look back on: how many follows from their names (``max_lag``
    may only confirm it). The horizon is walked in segments: the exogenous rows of the next ``segment`` steps join the state,
    the steps are projections without a shuffle, and state and forecasts are written, so neither the state nor the plan
    grows with the horizon.
    """
    keys = list(series_cols)
    features, regressor = feature_names(model), model.stages[-1]
    sources = [s for s in (flag, target) if s]
    from_target = {f: next(s for s in sources if f.startswith(f"{s}_")) for f in features
                   if any(f.startswith(f"{s}_lag_") or f.startswith(f"{s}_rw_") for s in sources)}
    given = [f for f in features if f not in from_target]
    reach = max([1, *[_reach(f, s) for f, s in from_target.items()]])
    if max_lag is not None and max_lag < reach:
        raise ValueError(f"the model looks back {reach} steps, max_lag allows {max_lag}")
    begin = ts_lit(forecast_start)
    first = F.timestamp_seconds(F.unix_seconds(begin) - reach * step_seconds)
    end = F.timestamp_seconds(F.unix_seconds(begin) + horizon * step_seconds)

    past = history
    if trend is not None:
        if series_start is None:
            raise ValueError("a trend needs series_start")
        past = remove_trend(history, trend, target, series_start, keys, ts_col, step_seconds)
    recent = past.where((F.col(ts_col) >= first) & (F.col(ts_col) < begin))
    packed = F.sort_array(F.collect_list(F.struct(ts_col, *[F.col(s).cast("double").alias(s) for s in sources])))
    state = recent.groupBy(*keys).agg(packed.alias("_rows"), F.countDistinct(ts_col).alias("_n")).select(
        *keys, "_n", *[F.col(f"_rows.{s}").alias(f"_h_{s}") for s in sources]
    )
    at = F.floor((F.unix_seconds(ts_col) - F.unix_seconds(begin)) / step_seconds)
    future = exogenous.where((F.col(ts_col) >= begin) & (F.col(ts_col) < end)).select(
        *keys, at.alias("_at"), F.floor(at / segment).cast("int").alias("_segment"), *[quoted(g).cast("double").alias(g) for g in given])
    future = stage(future, "exogenous")
    absent = F.lit(False)
    for g in given:
        absent = absent | quoted(g).isNull() | F.isnan(quoted(g))
    steps = future.groupBy(*keys).agg(F.countDistinct("_at").alias("_m"), F.count_if(absent).alias("_absent"))
    state = stage(join_on(state, steps, keys, "left"), "states")
    lacking = state.where((F.col("_n") != reach) | F.col("_m").isNull() | (F.col("_m") != horizon))
    short = lacking.select(F.count("*").alias("c"), F.min("_n").alias("n"), F.min("_m").alias("m")).first()
    if short.c or state.isEmpty():
        raise ValueError(
            f"{short.c} series lack required times: {short.n} of {reach} before the start, {short.m} of {horizon} after"
        )
    holes = state.where("_absent > 0").count()
    if holes:
        raise ValueError(f"{holes} series lack values of {', '.join(given)} at forecast times")
    past_values = [f"_h_{s}" for s in sources]
    state = state.select(*keys, *past_values)
    # the columns of a step are the same for every step: its number is how many forecasts the segment has. The vector is
    # in the order the model was fitted
    now = F.element_at("_ahead", F.size("_fc") + 1)
    vector = F.array(
        *[_from_history(f, from_target[f], F.col(f"_h_{from_target[f]}")) if f in from_target else now.getField(f) for f in features]
    )
    inputs = [*keys, *past_values, "_ahead", "_fc", array_to_vector(vector).alias("features")]
    moved = [
        F.concat(F.slice(f"_h_{s}", F.lit(2), F.lit(reach - 1)), F.array(F.col("prediction") if s == target else F.lit(0.0))).alias(f"_h_{s}")
        for s in sources
    ]
    outputs = [*keys, *moved, "_ahead", F.concat("_fc", F.array("prediction")).alias("_fc")]
    out = None
    for part in range(-(-horizon // segment)):
        ahead = F.sort_array(F.collect_list(F.struct("_at", *[quoted(g) for g in given]))).alias("_ahead")
        own = future.where(F.col("_segment") == part).groupBy(*keys).agg(ahead)
        state = join_on(state.select(*keys, *past_values), own, keys).withColumn("_fc", F.array().cast("array<double>"))
        for _ in range(min(segment, horizon - part * segment)):
            state = regressor.transform(state.select(*inputs)).select(*outputs)
        state = stage(state.drop("_ahead"), "states")
        told = state.select(*keys, F.posexplode("_fc").alias("_i", "forecast")).withColumn("_i", F.col("_i") + part * segment)
        out = told if out is None else out.unionByName(told)
    out = out.select(*keys, F.timestamp_seconds(F.unix_seconds(begin) + F.col("_i") * step_seconds).alias(ts_col), "forecast")
    if trend is not None:
        out = add_trend(out, trend, "forecast", series_start, keys, ts_col, step_seconds)
    actual = history.where((F.col(ts_col) >= begin) & (F.col(ts_col) < end)).select(*keys, ts_col, F.col(target).alias("actual"))
    return join_on(out, actual, [*keys, ts_col], "left")


# ------------------------------------------------------------------ additive regression

HOURS_PER_YEAR = 8766.0  # 365.25 days


def additive_features(
    df: DataFrame, start: str, end: str, changepoints: int = 10, changepoint_range: float = 0.8,
    fourier: Mapping[float, int] | None = None, ts_col: str = "timestamp", step_seconds: int = 3600,
) -> tuple[DataFrame, list[str]]:
    """Trend with hinges at evenly spaced changepoints, and Fourier pairs per period (in hours).

    ``start`` and ``end`` bound the training span; changepoints lie in its first ``changepoint_range``.
    """
    fourier = dict(fourier or {24.0: 4, 168.0: 3, HOURS_PER_YEAR: 5})
    hours = steps_since(ts_col, start, step_seconds).cast("double") * F.lit(step_seconds / 3600.0)
    span = (F.unix_seconds(ts_lit(end)) - F.unix_seconds(ts_lit(start))) / F.lit(3600.0)
    t = hours / span
    columns: dict[str, Column] = {"trend": t}
    for j in range(1, changepoints + 1):
        at = changepoint_range * j / (changepoints + 1)
        columns[f"hinge_{j}"] = F.greatest(t - F.lit(at), F.lit(0.0))
    for i, (period, order) in enumerate(sorted(fourier.items())):
        for k in range(1, order + 1):
            angle = F.lit(2.0 * k) * F.pi() * hours / F.lit(float(period))
            columns[f"season_{i}_sin_{k}"] = F.sin(angle)
            columns[f"season_{i}_cos_{k}"] = F.cos(angle)
    return df.withColumns(columns), list(columns)
