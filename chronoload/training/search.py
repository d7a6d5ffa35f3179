"""Hyper-parameter search by seeded random draws."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from chronoload.training.fit import assembled
from chronoload.training.folds import cross_validate, cuts
from chronoload.training.registry import build_model


def draw(space: Mapping[str, Sequence], rng: random.Random) -> dict:
    """One value per parameter.

    Two ends of booleans or text: one of the listed values. Two whole numbers: a whole number between
    them, ends included. A float at either end: a float between them.
    """
    chosen = {}
    for name in sorted(space):
        values = sorted(space[name])
        low, high = values[0], values[-1]
        if isinstance(low, (bool, str)):
            chosen[name] = rng.choice(values)
        elif isinstance(low, float) or isinstance(high, float):
            chosen[name] = rng.uniform(low, high)
        else:
            chosen[name] = rng.randint(low, high)
    return chosen


def random_search(
    df: DataFrame, features: Sequence[str], target: str, model_name: str, space: Mapping[str, Sequence],
    trials: int, n_splits: int = 4, metric: str = "rmse", seed: int = 42, ts_col: str = "timestamp",
    step_seconds: int = 3600, parallel: int = 4,
) -> list[dict]:
    """Trials ``{trial, params, rmse, mae}`` in order. All draws are made up front from one seed, so the
    result does not depend on which trial finishes first; all trials share one cached frame."""
    if metric not in ("rmse", "mae"):
        raise ValueError(f"metric must be rmse or mae, not {metric}")
    if model_name == "Prophet":  # trend, seasons and holidays follow from the time column alone
        from chronoload.training.additive import additive_search

        return additive_search(df, target, space, trials, n_splits, seed, ts_col, step_seconds)
    rng = random.Random(seed)
    drawn = [draw(space, rng) for _ in range(trials)]
    rows = assembled(df, features, target, [ts_col]).persist()
    try:
        fold_cuts = cuts(df, n_splits, ts_col, step_seconds)

        def run(item):
            number, params = item
            folds = cross_validate(rows, build_model(model_name, params, seed), fold_cuts, ts_col)
            mean = {m: sum(f[m] for f in folds) / len(folds) for m in ("rmse", "mae")}
            return {"trial": number, "params": params, **mean}

        with ThreadPoolExecutor(max_workers=parallel) as pool:
            return list(pool.map(run, enumerate(drawn)))
    finally:
        rows.unpersist()


def best_trial(results: Sequence[dict], metric: str = "rmse") -> dict:
    return min(results, key=lambda t: (t[metric], t["trial"]))
