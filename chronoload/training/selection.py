"""Feature selection by scores, forest importance and recursive elimination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.operators.scores import f_scores, mutual_information, top_features
from chronoload.training.fit import FEATURES, assembled
from chronoload.training.folds import cuts, split_fold

METHODS = ("f", "mi", "imp", "rfe", "rfecv")


def _forest(seed: int | None, trees: int, depth: int) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="_picked", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed or 0)


def _sliced(rows: DataFrame, picked: Sequence[int]) -> DataFrame:
    return VectorSlicer(inputCol=FEATURES, outputCol="_picked", indices=list(picked)).transform(rows)


def _importances(rows: DataFrame, picked: Sequence[int], forest: RandomForestRegressor) -> tuple[dict[int, float], object]:
    model = forest.fit(_sliced(rows, picked))
    scores = model.featureImportances.toArray()
    return {i: float(s) for i, s in zip(picked, scores, strict=True)}, model


def _drop_worst(scores: dict[int, float], count: int) -> list[int]:
    """Indices left after removing the ``count`` least important; equal scores drop the later column."""
    worst = sorted(scores, key=lambda i: (scores[i], -i))[:count]
    return [i for i in scores if i not in worst]


def importance_ranking(
    df: DataFrame, features: Sequence[str], target: str, seed: int | None = 42, trees: int = 100, depth: int = 8
) -> DataFrame:
    """``(feature, score)`` from the impurity decrease of a random forest."""
    rows = assembled(df, features, target).persist()
    try:
        scores, _ = _importances(rows, range(len(features)), _forest(seed, trees, depth))
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame([(features[i], s) for i, s in scores.items()], "feature string, score double")


def eliminate(rows: DataFrame, width: int, k: int, forest: RandomForestRegressor, step: int = 1) -> list[int]:
    """Recursive elimination on an assembled, cached frame: indices of the k features kept."""
    left = list(range(width))
    while len(left) > k:
        scores, _ = _importances(rows, left, forest)
        left = _drop_worst(scores, min(step, len(left) - k))
    return left


def _path_scores(train: DataFrame, test: DataFrame, width: int, k: int, step: int, forest) -> dict[int, float]:
    """R squared on ``test`` at every size the elimination passes."""
    left, scores = list(range(width)), {}
    while True:
        importance, model = _importances(train, left, forest)
        scored = model.transform(_sliced(test, left))
        gap = F.col("label") - F.col("prediction")
        row = scored.agg(F.sum(gap * gap).alias("sse"), F.var_pop("label").alias("v"), F.count("*").alias("n")).first()
        scores[len(left)] = 1.0 - row.sse / (row.v * row.n) if row.v else float("nan")
        if len(left) <= k:
            return scores
        left = _drop_worst(importance, min(step, len(left) - k))


def select_features(
    df: DataFrame, features: Sequence[str], target: str, method: str, k: int, seed: int | None = 42,
    trees: int = 100, depth: int = 8, step: int = 3, splits: int = 3, ts_col: str = "timestamp",
    step_seconds: int = 3600, bins: int = 10,
) -> list[str]:
    """Names of the selected features, in source order except for ``imp``, which lists the best first.

    ``f`` F statistic, ``mi`` mutual information, ``imp`` forest importance, ``rfe`` recursive elimination
    to k, ``rfecv`` elimination in steps of ``step`` with the size of best mean R squared over time-ordered
    folds, which keeps k features or more.
    """
    features = list(features)
    if method not in METHODS:
        raise ValueError(f"unknown feature selection method: {method}")
    if not 0 < k <= len(features):
        raise ValueError(f"k must be between 1 and the number of features ({len(features)}), got {k}")
    if method in ("f", "mi"):
        scores = f_scores(df, features, target) if method == "f" else mutual_information(df, features, target, bins)
        chosen = {r.feature for r in top_features(scores, k).collect()}
        return [f for f in features if f in chosen]
    if method == "imp":
        return [r.feature for r in top_features(importance_ranking(df, features, target, seed, trees, depth), k).collect()]
    forest = _forest(seed, trees, depth)
    rows = assembled(df, features, target, [ts_col] if method == "rfecv" else []).persist()
    try:
        if method == "rfe":
            return [features[i] for i in eliminate(rows, len(features), k, forest)]
        totals: dict[int, list[float]] = {}
        for cut in cuts(rows, splits, ts_col, step_seconds):
            train, test = split_fold(rows, cut, ts_col)
            for size, score in _path_scores(train, test, len(features), k, step, forest).items():
                totals.setdefault(size, []).append(score)
        best = max(sorted(totals), key=lambda size: sum(totals[size]) / len(totals[size]))
        return [features[i] for i in eliminate(rows, len(features), best, forest, step)]
    finally:
        rows.unpersist()
