"""Holt-Winters with additive trend and season, by composing blocks of time.

For fixed smoothing parameters a step maps the state (level, slope, one season value per phase) affinely, and its error is
affine in the state too. So a block of whole periods is ``x -> M x + v`` with squared error ``x'Qx - 2 q'x + r``, where M and Q
depend on the block's length alone and v, q and r on its values. Blocks are worked out side by side, whatever series they
belong to, for all parameter triples at once; neighbours are then composed ``FAN`` at a time until one row a series is left.
A task sees one block (``BLOCK_PERIODS`` periods) or ``FAN`` composed ones, never a series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.functions.timefns import ts_lit
from chronoload.operators.keys import join_on
from chronoload.session import stage

DEFAULT_SMOOTHING = {"alpha": (0.05, 0.2, 0.5), "beta": (0.0, 0.01, 0.1), "gamma": (0.05, 0.2, 0.5)}
BLOCK_PERIODS = 28
FAN = 16


class Recursion:
    """The recursion for a grid of parameter triples; a state is ``(level, slope, season of phase 0, 1, …)``."""

    def __init__(self, grid: np.ndarray, period: int, block: int) -> None:
        self.grid, self.period, self.block, self.size = grid, period, block, period + 2
        self._maps: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def run(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Move states ``x`` (n, triples, size) in place over values ``y`` (steps, n); errors (steps, n, triples)."""
        alpha, beta, gamma = self.grid.T
        errors = np.empty((len(y), *x.shape[:2]))
        for t, value in enumerate(y):
            at, now = 2 + t % self.period, value[:, None]
            level, slope, season = x[:, :, 0].copy(), x[:, :, 1], x[:, :, at]
            errors[t] = now - (level + slope + season)
            moved = alpha * (now - season) + (1 - alpha) * (level + slope)
            x[:, :, 1] = beta * (moved - level) + (1 - beta) * slope
            x[:, :, at] = gamma * (now - moved) + (1 - gamma) * season
            x[:, :, 0] = moved
        return errors

    def responses(self, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """M (triples, size, size) and, for each step, what a starting state takes from the error (steps, triples, size)."""
        x = np.repeat(np.eye(self.size)[:, None, :], len(self.grid), axis=1)
        errors = self.run(x, np.zeros((steps, self.size)))
        return x.transpose(1, 2, 0), -errors.transpose(0, 2, 1)

    def maps(self, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """M and Q of ``steps`` steps from phase 0."""
        if steps not in self._maps:
            if steps <= self.block:
                m, h = self.responses(steps)
                self._maps[steps] = m, np.einsum("tgi,tgj->gij", h, h)
            else:  # by halves of whole blocks, so a long segment costs a logarithm of products
                whole = -(-steps // self.block)
                head = max(1, whole // 2) * self.block
                (m, q), (m_tail, q_tail) = self.maps(head), self.maps(steps - head)
                self._maps[steps] = m_tail @ m, q + m.transpose(0, 2, 1) @ q_tail @ m
        return self._maps[steps]

    def segment(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """v (n, triples, size), q (the same) and r (n, triples) of blocks ``y`` (n, steps)."""
        x = np.zeros((len(y), len(self.grid), self.size))
        errors = self.run(x, y.T)
        return x, np.einsum("tng,tgi->ngi", errors, self.responses(y.shape[1])[1]), (errors**2).sum(0)

    def composed(self, parts: Sequence[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Neighbouring segments ``(steps, v, q, r)`` in order of time as one."""
        n, v, q, r = parts[0]
        for steps, v_next, q_next, r_next in parts[1:]:
            m, square = self.maps(steps)
            back = q_next - np.einsum("gij,gj->gi", square, v)
            r = r + r_next - np.einsum("gi,gi->g", q_next + back, v)
            q = q + np.einsum("gji,gj->gi", self.maps(n)[0], back)
            v = np.einsum("gij,gj->gi", m, v) + v_next
            n += steps
        return n, v, q, r

    def start(self, y: np.ndarray) -> np.ndarray:
        """Level and season of the first period, slope from the first to the second."""
        first, second = y[: self.period].mean(), y[self.period : 2 * self.period].mean()
        return np.concatenate([[first, (second - first) / self.period], y[: self.period] - first])


_PARTS = "steps long, start array<double>, v array<double>, q array<double>, r array<double>"


def _row(batch: pa.RecordBatch, keys: Sequence[str], k: int, **columns) -> pa.RecordBatch:
    kept = [batch.column(batch.schema.get_field_index(c)).slice(k, 1) for c in keys]
    kinds = {"at": pa.int64(), "steps": pa.int64()}
    own = [pa.array([x.ravel() if isinstance(x, np.ndarray) else x], kinds.get(c, pa.list_(pa.float64()))) for c, x in columns.items()]
    return pa.RecordBatch.from_arrays([*kept, *own], names=[*keys, *columns])


def _schema(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name in keys)


def _segments(blocks: DataFrame, keys: Sequence[str], grid: np.ndarray, period: int, block: int) -> DataFrame:
    """One row per series and block: its v, q and r, and in block 0 the starting state."""

    def work(batches):
        own = Recursion(grid, period, block)
        for batch in batches:
            at, values = (batch.column(batch.schema.get_field_index(c)) for c in ("at", "values"))
            for k in range(len(batch)):
                y = values[k].values.to_numpy(zero_copy_only=False)
                v, q, r = own.segment(y[None, :])
                start = own.start(y) if at[k].as_py() == 0 else None
                yield _row(batch, keys, k, at=at[k].as_py(), steps=len(y), start=start, v=v, q=q, r=r)

    return blocks.mapInArrow(work, f"{_schema(blocks, keys)}at long, {_PARTS}")


def _merged(segments: DataFrame, keys: Sequence[str], grid: np.ndarray, period: int, block: int) -> DataFrame:
    """``FAN`` neighbouring segments as one."""
    part = F.struct("at", "steps", "start", "v", "q", "r")
    groups = segments.groupBy(*keys, F.floor(F.col("at") / FAN).alias("_at")).agg(F.sort_array(F.collect_list(part)).alias("_parts"))

    def work(batches):
        own = Recursion(grid, period, block)
        shape = (len(grid), period + 2)
        for batch in batches:
            at, parts = (batch.column(batch.schema.get_field_index(c)) for c in ("_at", "_parts"))
            for k in range(len(batch)):
                rows = parts[k].as_py()
                arrays = [(p["steps"], np.reshape(p["v"], shape), np.reshape(p["q"], shape), np.array(p["r"])) for p in rows]
                steps, v, q, r = own.composed(arrays)
                yield _row(batch, keys, k, at=at[k].as_py(), steps=steps, start=rows[0]["start"], v=v, q=q, r=r)

    return groups.mapInArrow(work, f"{_schema(segments, keys)}at long, {_PARTS}")


def _fitted(segments: DataFrame, keys: Sequence[str], grid: np.ndarray, period: int, block: int) -> DataFrame:
    """One row per series and triple: its squared error and its state after the last value."""

    def work(batches):
        own = Recursion(grid, period, block)
        shape = (len(grid), period + 2)
        for batch in batches:
            get = {c: batch.column(batch.schema.get_field_index(c)) for c in ("steps", "start", "v", "q", "r")}
            for k in range(len(batch)):
                steps = get["steps"][k].as_py()
                x = np.array(get["start"][k].as_py())
                v, q = (np.reshape(get[c][k].as_py(), shape) for c in "vq")
                m, square = own.maps(steps)
                state = m @ x + v
                sse = np.maximum(square @ x @ x - 2 * q @ x + np.array(get["r"][k].as_py()), 0.0)
                names = [*keys, "triple", "alpha", "beta", "gamma", "sse", "state", "steps"]
                kept = [pa.repeat(batch.column(batch.schema.get_field_index(c))[k], len(grid)) for c in keys]
                yield pa.RecordBatch.from_arrays([
                    *kept, pa.array(np.arange(len(grid), dtype=np.int32)), *[pa.array(c) for c in grid.T.copy()], pa.array(sse),
                    pa.array(list(state), pa.list_(pa.float64())), pa.array(np.full(len(grid), steps)),
                ], names=names)

    return segments.mapInArrow(
        work, f"{_schema(segments, keys)}triple int, alpha double, beta double, gamma double, sse double, state array<double>, steps long")


def holt_winters(
    df: DataFrame, value: str, split_date: str, horizon: int, period: int = 24, series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", step_seconds: int = 3600, smoothing: Mapping[str, Sequence[float]] | None = None,
    block_periods: int = BLOCK_PERIODS,
) -> DataFrame:
    """Additive trend and season, fitted on the rows before the split, forecast ``horizon`` steps.

    The smoothing parameters are those of least squared one-step error on a given grid; of equal ones the first. A series
    with a missing time or value, a repeated time or less than two periods before the split is refused.
    """
    if block_periods < 2:
        raise ValueError("a block needs two periods, from which the first state is taken")
    smoothing = dict(smoothing or DEFAULT_SMOOTHING)
    grid = np.array(list(product(smoothing["alpha"], smoothing["beta"], smoothing["gamma"])), dtype=float)
    keys, block = list(series_cols), period * block_periods
    y = F.col(value).cast("double")
    train = df.where(F.col(ts_col) < ts_lit(split_date)).select(*keys, F.unix_seconds(ts_col).alias("_t"), F.when(~F.isnan(y), y).alias("_y"))
    spans = train.groupBy(*keys).agg(
        F.min("_t").alias("_first"), F.count("*").alias("_n"), F.count("_y").alias("_valued"),
        (F.floor((F.max("_t") - F.min("_t")) / step_seconds) + 1).alias("_times"))
    if not keys:
        spans = spans.where("_n > 0")
    spans = stage(spans, "spans")
    short, gaps, longest = spans.agg(
        F.count_if(F.col("_n") < 2 * period), F.count_if((F.col("_valued") < F.col("_n")) | (F.col("_n") != F.col("_times"))), F.max("_n")).first()
    if short:
        raise ValueError(f"a series needs two periods ({2 * period} rows) before the split; {short} have fewer")
    if gaps:
        raise ValueError(f"{gaps} series have a missing or repeated time or a missing value before the split")
    place = F.floor((F.col("_t") - F.col("_first")) / step_seconds)
    rows = join_on(train, spans.select(*keys, "_first"), keys) if longest else train.withColumn("_first", F.col("_t"))
    rows = rows.withColumn("_place", place).withColumn("at", F.floor(F.col("_place") / block))
    blocks = rows.groupBy(*keys, "at").agg(F.sort_array(F.collect_list(F.struct("_place", "_y"))).alias("_v"))
    segments = _segments(blocks.select(*keys, "at", F.col("_v._y").alias("values")), keys, grid, period, block)
    left = -(-(longest or 1) // block)
    while left > 1:
        segments, left = stage(_merged(segments, keys, grid, period, block), "segments"), -(-left // FAN)
    fitted = _fitted(segments, keys, grid, period, block)
    best = F.min_by(F.struct("alpha", "beta", "gamma", "sse", "state", "steps"), F.struct("sse", "triple")).alias("_b")
    chosen = fitted.groupBy(*keys).agg(best)
    if not keys:
        chosen = chosen.where("_b IS NOT NULL")
    ahead = chosen.select(*keys, "_b.*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h"))
    phase = F.pmod(F.col("steps") + F.col("_h") - 1, F.lit(period)).cast("int")
    prediction = F.get("state", F.lit(0)) + F.col("_h") * F.get("state", F.lit(1)) + F.get("state", phase + 2)
    when = F.timestamp_seconds(F.unix_seconds(ts_lit(split_date)) + (F.col("_h") - 1) * step_seconds)
    return ahead.select(*keys, prediction.alias("prediction"), "alpha", "beta", "gamma", "sse", when.alias(ts_col))
