"""Forecast job: load the best model and write a recursive forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.plans.train import load_best
from chronoload.sources.stages import write_stage
from chronoload.training.fit import safe_names, with_safe_names
from chronoload.training.forecast import recursive_forecast


def forecast_best(
    history: DataFrame, exogenous: DataFrame | None, target: str, forecast_start: str, horizon: int, runs_path: str,
    models_path: str, experiment: str, out: str | None = None, metric: str = "rmse", trend_path: str | None = None,
    trend_key: str | None = None, **details,
) -> DataFrame:
    """Recursive forecast by the best run's model.

    ``exogenous`` is the feature frame as it was trained on, with its own column names; without one, ``history`` is that
    frame and holds the target too. ``trend_path`` names a trend store, ``trend_key`` the ``date_key`` of the row to use.
    """
    spark = history.sparkSession
    model, _ = load_best(spark, runs_path, models_path, experiment, metric)
    frame = with_safe_names(history if exogenous is None else exogenous)
    if trend_path is not None:
        stored = spark.read.parquet(trend_path)
        details["trend"] = stored if trend_key is None else stored.where(F.col("date_key") == trend_key)
    result = recursive_forecast(model, with_safe_names(history), frame, safe_names(history.columns)[target], forecast_start, horizon, **details)
    if out is not None:
        write_stage(result, out)
        return spark.read.schema(result.schema).parquet(out)
    return result
