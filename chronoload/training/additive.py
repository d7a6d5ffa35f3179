"""Trend + seasons + holidays as one ridge regression, fitted and searched from sufficient statistics.

One pass over the rows adds up ``[1 x y]' [1 x y]`` per time segment between the fold cuts. Fold i trains on the sum of segments
0 … i and tests on segment i + 1, so every fold, trial and penalty is solved from these small matrices on the driver; the squared
error of a test segment follows from its own matrix. Absolute errors need residuals: one more pass scores all trials and folds
together. A task holds one matrix per segment and batch, and what is shuffled or collected depends on the number of columns
(``MAX_COLUMNS`` a pass) and segments only, never on the rows. Trials whose columns together exceed it take further passes.
"""

from __future__ import annotations

import random
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoload.functions.holidays import add_holiday_flags, holidays
from chronoload.functions.textfns import quoted
from chronoload.functions.timefns import ts_lit
from chronoload.training.folds import cuts
from chronoload.training.search import draw

WEEK, YEAR = 168.0, 8766.0  # hours; a year has 365.25 days
MAX_COLUMNS = 512


@dataclass(frozen=True)
class AdditiveSpec:
    """What a model consists of. ``orders`` maps a period in hours to its number of sine and cosine pairs.

    Scales are prior standard deviations of coefficients in units of the target's largest value: small ones shrink.
    ``multiplicative``: seasons and holidays also appear multiplied by time, so that they grow with a linear trend.
    """

    changepoints: int = 25
    changepoint_range: float = 0.8
    orders: Mapping[float, int] = field(default_factory=lambda: {24.0: 4, WEEK: 3, YEAR: 10})
    multiplicative: bool = False
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    holiday_scale: float = 10.0
    interval: float = 0.8


def spec_of(params: Mapping[str, object]) -> AdditiveSpec:
    """Configured parameters as a spec; names without a meaning here are named in a warning."""
    orders = {24.0: 4, WEEK: int(params.get("weekly_seasonality", 3)), YEAR: int(params.get("yearly_seasonality", 10))}
    if params.get("growth", "linear") != "linear":
        raise ValueError(f"growth must be linear, not {params['growth']}")
    mode = params.get("seasonality_mode", "additive")
    if mode not in ("additive", "multiplicative"):
        raise ValueError(f"seasonality_mode must be additive or multiplicative, not {mode}")
    # Configured names and the fields they set.
    names = {
        "n_changepoints": ("changepoints", int),
        "changepoint_range": ("changepoint_range", float),
        "changepoint_prior_scale": ("changepoint_scale", float),
        "seasonality_prior_scale": ("season_scale", float),
        "holidays_prior_scale": ("holiday_scale", float),
        "interval_width": ("interval", float),
    }
    known = {"growth", "seasonality_mode", "weekly_seasonality", "yearly_seasonality", *names}
    if set(params) - known:
        warnings.warn(f"additive model: no counterpart for {', '.join(sorted(set(params) - known))}", stacklevel=2)
    own = {names[k][0]: names[k][1](x) for k, x in params.items() if k in names}
    return AdditiveSpec(orders={p: n for p, n in orders.items() if n > 0}, multiplicative=mode == "multiplicative", **own)


def design(spec: AdditiveSpec, start: str, end: str, holiday_names: Sequence[str] = (), ts_col: str = "timestamp") -> dict[str, tuple[Column, float | None]]:
    """Name -> (column, prior scale); the trend is free. ``start`` and ``end`` bound the training span.

    Equal names are equal columns whatever the spec, so trials share them.
    """
    begin = F.unix_seconds(ts_lit(start))
    hours = (F.unix_seconds(ts_col) - begin) / F.lit(3600.0)
    t = hours * F.lit(3600.0) / F.greatest(F.unix_seconds(ts_lit(end)) - begin, F.lit(1))
    out: dict[str, tuple[Column, float | None]] = {"trend": (t, None)}
    for j in range(1, spec.changepoints + 1):
        at = spec.changepoint_range * j / (spec.changepoints + 1)
        out[f"hinge_{at:.12f}"] = (F.greatest(t - F.lit(at), F.lit(0.0)), spec.changepoint_scale)
    waves: dict[str, tuple[Column, float]] = {}
    for period, order in sorted(spec.orders.items()):
        for k in range(1, order + 1):
            angle = F.lit(2.0 * k) * F.pi() * hours / F.lit(float(period))
            waves[f"sin_{period:g}_{k}"] = (F.sin(angle), spec.season_scale)
            waves[f"cos_{period:g}_{k}"] = (F.cos(angle), spec.season_scale)
    waves |= {f"holiday {name}": (quoted(name).cast("double"), spec.holiday_scale) for name in holiday_names}
    out |= waves
    if spec.multiplicative:
        out |= {f"{name} x trend": (column * t, scale) for name, (column, scale) in waves.items()}
    return out


# ------------------------------------------------------------------ sufficient statistics


def _segment(cut_times: Sequence, ts_col: str) -> Column:
    """0 before the first cut, 1 up to the second, …; null from the last on."""
    out = F.lit(None).cast("int")
    for k in reversed(range(len(cut_times))):
        out = F.when(F.col(ts_col) < F.lit(cut_times[k]), F.lit(k)).otherwise(out)
    return out


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)


def gram_table(rows: DataFrame, width: int) -> DataFrame:
    """``segment, at, value``: the cells of ``[1 x y]' [1 x y]`` of each segment. ``rows``: segment, x…, y, all present.

    A task adds its batches up; segments are few, so the shuffle carries tasks * segments matrices at most.
    """

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.concatenate([np.ones((len(own), 1)), _matrix(batch.select(batch.schema.names[1:]))], 1)
            for k in np.unique(own).tolist():
                part = values[own == k]
                total[k] = total.get(k, 0.0) + part.T @ part
        for k, matrix in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(matrix.size, k, np.int32)), pa.array(np.arange(matrix.size, dtype=np.int32)), pa.array(matrix.ravel())],
                names=["segment", "at", "value"])

    return rows.mapInArrow(add, "segment int, at int, value double").groupBy("segment", "at").agg(F.sum("value").alias("value"))


def grams(df: DataFrame, columns: Mapping[str, Column], target: str, cut_times: Sequence, ts_col: str = "timestamp") -> np.ndarray:
    """One matrix per segment, ``(segments, p + 2, p + 2)``; rows with a null or NaN value take no part."""
    rows = _rows(df, columns, target, cut_times, ts_col)
    width = len(columns) + 2
    out = np.zeros((len(cut_times), width * width))
    cells = gram_table(rows, width).toPandas()  # segments * width^2 numbers, whatever the data
    out[cells.segment.to_numpy(int), cells["at"].to_numpy(int)] = cells.value.to_numpy(float)
    return out.reshape(len(cut_times), width, width)


def _rows(df: DataFrame, columns: Mapping[str, Column], target: str, cut_times: Sequence, ts_col: str) -> DataFrame:
    values = [c.cast("double").alias(f"x{k}") for k, c in enumerate(columns.values())]
    rows = df.select(_segment(cut_times, ts_col).alias("segment"), *values, quoted(target).cast("double").alias("y"))
    present = F.col("segment").isNotNull()
    for c in rows.columns[1:]:
        present = present & F.col(c).isNotNull() & ~F.isnan(c)
    return rows.where(present)


def ridge(gram: np.ndarray, columns: Sequence[int], penalty: np.ndarray) -> np.ndarray:
    """Intercept and coefficients of the chosen columns that minimise squared error + sum of penalty * coefficient^2.

    The intercept is free. Columns and target are centred and columns brought to one scale first, so neither a large level nor
    a large penalty costs digits.
    """
    n = gram[0, 0]
    if n == 0:
        raise ValueError("no training rows with all values")
    keep = np.array(columns, int) + 1
    mean, target = gram[0, keep] / n, gram[0, -1] / n
    a = gram[np.ix_(keep, keep)] - n * np.outer(mean, mean)
    b = gram[keep, -1] - n * mean * target
    a = a + np.diag(penalty)
    unit = np.sqrt(np.maximum(np.diag(a), 0.0))
    unit[unit == 0] = 1.0  # a column without variation: its coefficient stays 0
    beta = np.linalg.lstsq(a / np.outer(unit, unit), b / unit, rcond=None)[0] / unit
    return np.concatenate([[target - mean @ beta], beta])


def squared_error(gram: np.ndarray, columns: Sequence[int], beta: np.ndarray) -> float:
    """Sum of squared errors of a fit over the rows behind a matrix."""
    z = np.zeros(len(gram))
    z[[0, *(np.array(columns, int) + 1)]] = -beta
    z[-1] = 1.0
    return max(0.0, float(z @ gram @ z))


def _penalties(gram: np.ndarray, columns: Sequence[int], scales: Sequence[float | None]) -> np.ndarray:
    """Prior scales as penalties: error variance over prior variance, with the error of the least-squares fit.

    Scales are in units of the target's root mean square.
    """
    n = gram[0, 0]
    free = ridge(gram, columns, np.zeros(len(columns)))
    noise = squared_error(gram, columns, free) / max(n, 1.0)
    unit = gram[-1, -1] / max(n, 1.0)
    if unit == 0:
        return np.zeros(len(columns))
    return np.array([0.0 if s is None else max(noise, 1e-12 * unit) / (unit * s * s) for s in scales])


def absolute_errors(
    df: DataFrame, columns: Mapping[str, Column], target: str, cut_times: Sequence, betas: np.ndarray, ts_col: str = "timestamp",
) -> np.ndarray:
    """Mean absolute error ``(folds, trials)`` of coefficients ``(folds, 1 + p, trials)`` on the segment after each fold."""
    folds, _, trials = betas.shape

    def score(batches):
        total, n = np.zeros((folds, trials)), np.zeros(folds)
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.concatenate([np.ones((len(own), 1)), _matrix(batch.select(batch.schema.names[1:]))], 1)
            for k in range(folds):
                part = values[own == k + 1]
                total[k] += np.abs(part[:, :-1] @ betas[k] - part[:, -1:]).sum(0)
                n[k] += len(part)
        at = np.repeat(np.arange(folds, dtype=np.int32), trials)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(np.tile(np.arange(trials, dtype=np.int32), folds)), pa.array(total.ravel()), pa.array(np.repeat(n, trials))],
            names=["fold", "trial", "total", "n"])

    rows = _rows(df, columns, target, cut_times, ts_col).mapInArrow(score, "fold int, trial int, total double, n double")
    sums = rows.groupBy("fold", "trial").agg((F.sum("total") / F.sum("n")).alias("mae")).toPandas()  # folds * trials rows
    out = np.zeros((folds, trials))
    out[sums.fold.to_numpy(int), sums.trial.to_numpy(int)] = sums.mae.to_numpy(float)
    return out


# ------------------------------------------------------------------ cross-validation and search


def cross_validated(
    df: DataFrame, columns: Mapping[str, Column], target: str, trials: Sequence[tuple[Sequence[str], Mapping[str, float | None] | float]],
    fold_cuts: Sequence[tuple], ts_col: str = "timestamp",
) -> list[dict]:
    """Mean ``rmse`` and ``mae`` over the folds of each trial, from two passes over ``df`` for all of them.

    A trial is its column names and either prior scales by name or one ridge weight (error per row + weight * coefficient^2).
    """
    names = list(columns)
    place = {c: k for k, c in enumerate(names)}
    cut_times = [fold_cuts[0][0], *[end for _, end in fold_cuts]]
    segments = grams(df, columns, target, cut_times, ts_col)
    betas = np.zeros((len(fold_cuts), len(names) + 1, len(trials)))
    rmse = np.zeros((len(fold_cuts), len(trials)))
    for i in range(len(fold_cuts)):
        train, test = segments[: i + 1].sum(0), segments[i + 1]
        if test[0, 0] == 0:
            raise ValueError(f"fold {i} has no test rows with all values")
        for j, (own, weights) in enumerate(trials):
            at = [place[c] for c in own]
            if isinstance(weights, Mapping):
                penalty = _penalties(train, at, [weights[c] for c in own])
            else:
                penalty = np.full(len(at), float(weights) * train[0, 0])
            beta = ridge(train, at, penalty)
            betas[i, [0, *(np.array(at, int) + 1)], j] = beta
            rmse[i, j] = np.sqrt(squared_error(test, at, beta) / test[0, 0])
    mae = absolute_errors(df, columns, target, cut_times, betas, ts_col)
    return [{"rmse": float(rmse[:, j].mean()), "mae": float(mae[:, j].mean())} for j in range(len(trials))]


def _span(df: DataFrame, ts_col: str) -> tuple[str, str]:
    row = df.agg(F.min(ts_col).cast("string").alias("a"), F.max(ts_col).cast("string").alias("b")).first()
    if row.a is None:
        raise ValueError("no rows")
    return row.a, row.b


def with_holidays(df: DataFrame, ts_col: str = "timestamp", span: tuple[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with a 0/1 column for each holiday that the span holds, and their names (13 at most)."""
    start, end = span or _span(df, ts_col)
    table = holidays(df.sparkSession, start, end)
    names = sorted(r.holiday for r in table.select("holiday").distinct().collect())
    return add_holiday_flags(df, table, names, ts_col), names


def additive_search(
    df: DataFrame, target: str, space: Mapping[str, Sequence], trials: int, n_splits: int = 4, seed: int = 42,
    ts_col: str = "timestamp", step_seconds: int = 3600, max_columns: int = MAX_COLUMNS,
) -> list[dict]:
    """Trials ``{trial, params, rmse, mae}`` of the additive model over drawn parameters, in order."""
    rng = random.Random(seed)
    drawn = [draw(space, rng) for _ in range(trials)]
    start, end = _span(df, ts_col)
    frame, names = with_holidays(df, ts_col, (start, end))
    fold_cuts = cuts(df, n_splits, ts_col, step_seconds)
    designs = [design(spec_of(params), start, end, names, ts_col) for params in drawn]
    passes: list[list[int]] = []
    for k, own in enumerate(designs):  # trials that fit into one matrix share its passes
        if passes and len({c for j in passes[-1] for c in designs[j]} | set(own)) <= max_columns:
            passes[-1].append(k)
        else:
            passes.append([k])
    out = []
    for together in passes:
        columns = {c: column for k in together for c, (column, _) in designs[k].items()}
        asked = [(list(designs[k]), {c: scale for c, (_, scale) in designs[k].items()}) for k in together]
        scores = cross_validated(frame, columns, target, asked, fold_cuts, ts_col)
        out += [{"trial": k, "params": drawn[k], **score} for k, score in zip(together, scores)]
    return out


def ridge_search(
    df: DataFrame, features: Sequence[str], target: str, weights: Sequence[float], n_splits: int = 4,
    ts_col: str = "timestamp", step_seconds: int = 3600,
) -> list[dict]:
    """Trials ``{trial, params, rmse, mae}`` of a linear model over ridge weights: one matrix serves all of them."""
    columns = {c: quoted(c) for c in features}
    scores = cross_validated(df, columns, target, [(list(features), w) for w in weights], cuts(df, n_splits, ts_col, step_seconds), ts_col)
    return [{"trial": k, "params": {"reg_lambda": w}, **score} for k, (w, score) in enumerate(zip(weights, scores))]


# ------------------------------------------------------------------ final fit


@dataclass(frozen=True)
class AdditiveModel:
    """A fitted model: plain numbers, so it can be stored as a row."""

    spec: AdditiveSpec
    start: str
    end: str
    coefficients: Mapping[str, float]
    sigma: float

    def predict(self, df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
        """``df`` with ``prediction, lower, upper``; one expression in the JVM, no Python worker."""
        names = [c.removeprefix("holiday ") for c in self.coefficients if c.startswith("holiday ") and not c.endswith(" x trend")]
        frame = df
        flags = [f"_holiday_{k}" for k in range(len(names))]
        if names:
            start, end = _span(df, ts_col)
            table = holidays(df.sparkSession, min(self.start, start), max(self.end, end))
            renamed = table.replace(dict(zip(names, flags)), subset=["holiday"])
            frame = add_holiday_flags(df, renamed, flags, ts_col)
        total = F.lit(self.coefficients["intercept"])
        columns = design(self.spec, self.start, self.end, flags, ts_col)
        plain = {f"holiday {f}": f"holiday {n}" for f, n in zip(flags, names)}
        for c, (column, _) in columns.items():
            head, times, tail = c.partition(" x trend")
            total = total + F.lit(self.coefficients[plain.get(head, head) + times + tail]) * column
        reach = F.lit(NormalDist().inv_cdf(0.5 + self.spec.interval / 2) * self.sigma)
        kept = [quoted(c) for c in df.columns]
        return frame.select(*kept, total.alias("prediction"), (total - reach).alias("lower"), (total + reach).alias("upper"))


def fit_additive(df: DataFrame, target: str, spec: AdditiveSpec = AdditiveSpec(), ts_col: str = "timestamp") -> AdditiveModel:
    """Fit on all given rows, from one pass."""
    start, end = _span(df, ts_col)
    frame, names = with_holidays(df, ts_col, (start, end))
    own = design(spec, start, end, names, ts_col)
    beyond = frame.agg((F.max(ts_col) + F.expr("INTERVAL 1 DAY")).alias("t")).first().t
    gram = grams(frame, {c: column for c, (column, _) in own.items()}, target, [beyond], ts_col)[0]
    at = list(range(len(own)))
    beta = ridge(gram, at, _penalties(gram, at, [scale for _, scale in own.values()]))
    sigma = float(np.sqrt(squared_error(gram, at, beta) / gram[0, 0]))
    return AdditiveModel(spec, start, end, dict(zip(["intercept", *own], beta.tolist())), sigma)
