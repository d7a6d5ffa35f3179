"""Time-ordered cross-validation."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.operators.scores import forecast_errors
from chronoload.training.fit import assembled


def fold_table(df: DataFrame, n_splits: int, ts_col: str = "timestamp", step_seconds: int = 3600) -> DataFrame:
    """``(fold, train_start, train_end, test_end)``; a fold tests [train_end, test_end).

    With n grid times, each test block has n // (n_splits + 1) of them; the last ``n_splits`` blocks are
    tested in turn, each trained on everything before it. Cuts are times, so all series share them.
    """
    if n_splits < 2:
        raise ValueError("need at least 2 splits")
    step = F.lit(step_seconds)
    span = df.agg(F.unix_seconds(F.min(ts_col)).alias("_lo"), F.unix_seconds(F.max(ts_col)).alias("_hi"))
    sized = span.withColumn("_n", F.floor((F.col("_hi") - F.col("_lo")) / step) + 1).withColumn(
        "_size", F.floor(F.col("_n") / (n_splits + 1))
    )
    folds = sized.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"))
    cut = F.col("_lo") + (F.col("_n") - (n_splits - F.col("fold")) * F.col("_size")) * step
    return folds.select(
        "fold",
        F.timestamp_seconds("_lo").alias("train_start"),
        F.timestamp_seconds(cut).alias("train_end"),
        F.timestamp_seconds(cut + F.col("_size") * step).alias("test_end"),
        F.col("_size").cast("long").alias("test_size"),
    )


def cuts(df: DataFrame, n_splits: int, ts_col: str = "timestamp", step_seconds: int = 3600) -> list[tuple]:
    """The ``n_splits`` rows of the fold table, for the driver."""
    rows = fold_table(df, n_splits, ts_col, step_seconds).orderBy("fold").collect()
    if any(r.test_size < 1 for r in rows):
        raise ValueError(f"too few grid times for {n_splits} splits")
    return [(r.train_end, r.test_end) for r in rows]


def split_fold(rows: DataFrame, cut: tuple, ts_col: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    t = F.col(ts_col)
    return rows.where(t < F.lit(cut[0])), rows.where((t >= F.lit(cut[0])) & (t < F.lit(cut[1])))


def cross_validate(rows: DataFrame, estimator, fold_cuts: Sequence[tuple], ts_col: str = "timestamp") -> list[dict]:
    """RMSE and MAE per fold of an estimator on an assembled (and cached) frame; folds run side by side."""

    def run(cut):
        train, test = split_fold(rows, cut, ts_col)
        scored = estimator.copy().fit(train).transform(test)
        row = forecast_errors(scored, "label", "prediction").first()
        return {"rmse": row.rmse, "mae": row.mae}

    with ThreadPoolExecutor(max_workers=max(1, len(fold_cuts))) as pool:
        return list(pool.map(run, fold_cuts))


def cv_scores(
    df: DataFrame, features: Sequence[str], target: str, estimator, n_splits: int, ts_col: str = "timestamp",
    step_seconds: int = 3600,
) -> dict:
    """Mean RMSE and MAE over the folds."""
    rows = assembled(df, features, target, [ts_col]).persist()
    try:
        per_fold = cross_validate(rows, estimator, cuts(df, n_splits, ts_col, step_seconds), ts_col)
    finally:
        rows.unpersist()
    return {m: sum(f[m] for f in per_fold) / len(per_fold) for m in ("rmse", "mae")}
