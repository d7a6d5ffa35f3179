"""Training job: tune, log runs, fit the best model on all train rows, and evaluate it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from chronoload.operators.clean import ints_to_double, test_rows, train_rows
from chronoload.operators.scores import correlations, residuals
from chronoload.training.additive import AdditiveModel, additive_search, fit_additive, spec_of
from chronoload.training.fit import fit_final, predict, safe_names, with_safe_names
from chronoload.training.importance import permutation_importance
from chronoload.training.runs import append_runs, best_run, claim_run_number, run_record, store_tables
from chronoload.training.search import best_trial, random_search


@dataclass
class Trained:
    run_id: str
    model: PipelineModel
    trials: list[dict]
    correlations: DataFrame
    importances: DataFrame
    residuals: DataFrame


def train_model(
    frame: DataFrame, features: Sequence[str], target: str, split_date: str, model_name: str,
    space: Mapping[str, Sequence], runs_path: str, models_path: str, experiment: str, version: str = "",
    trials: int = 10, n_splits: int = 4, metric: str = "rmse", seed: int = 42, ts_col: str = "timestamp",
    key_cols: Sequence[str] = ("timestamp",), repeats: int = 5,
) -> Trained:
    """Random search with time-ordered folds; one parent run with the best trial, one child per trial.

    Correlations, importances and residuals are stored under the run and read back.
    """
    if model_name == "Prophet":
        raise ValueError("train_additive fits the regression on trend, seasons and holidays")
    spark = frame.sparkSession
    names = safe_names(frame.columns)
    features = [names[f] for f in features]
    rows = with_safe_names(ints_to_double(frame))
    train, test = train_rows(rows, split_date, ts_col), test_rows(rows, split_date, ts_col)
    results = random_search(train, features, target, model_name, space, trials, n_splits, metric, seed, ts_col)
    best = best_trial(results, metric)
    number = claim_run_number(spark, runs_path, model_name, experiment)
    parent = run_record(
        experiment, model_name, "parent", run_number=number, params=best["params"],
        metrics={f"best_{metric}": float(best[metric])}, tags={"feature_set_version": version},
    )
    children = [
        run_record(experiment, model_name, "child", parent_id=parent["run_id"], trial=t["trial"], params=t["params"],
                   metrics={"rmse": float(t["rmse"]), "mae": float(t["mae"])})
        for t in results
    ]
    model = fit_final(train, features, target, model_name, best["params"], seed)
    model.write().overwrite().save(f"{models_path}/{parent['run_id']}")
    tables = store_tables(models_path, parent["run_id"], {
        "correlations": correlations(train, features, target),
        "importances": permutation_importance(model.stages[-1], train, features, target, key_cols, repeats, seed),
        "residuals": residuals(predict(model, test), target, "prediction", [ts_col]),
    })
    append_runs(spark, runs_path, [parent, *children])  # last: a run that is listed is whole
    return Trained(parent["run_id"], model, results, **tables)


@dataclass
class TrainedAdditive:
    run_id: str
    model: AdditiveModel
    trials: list[dict]
    residuals: DataFrame


def train_additive(
    frame: DataFrame, target: str, split_date: str, space: Mapping[str, Sequence], runs_path: str, models_path: str, experiment: str,
    trials: int = 10, n_splits: int = 4, metric: str = "rmse", seed: int = 42, ts_col: str = "timestamp",
) -> TrainedAdditive:
    """As ``train_model`` for the regression on trend, seasons and holidays, which needs the time and the target only.

    The coefficients are stored as a table of (name, value) under the run.
    """
    spark = frame.sparkSession
    train, test = train_rows(frame, split_date, ts_col), test_rows(frame, split_date, ts_col)
    results = additive_search(train, target, space, trials, n_splits, seed, ts_col)
    best = best_trial(results, metric)
    number = claim_run_number(spark, runs_path, "Prophet", experiment)
    parent = run_record(
        experiment, "Prophet", "parent", run_number=number, params=best["params"], metrics={f"best_{metric}": float(best[metric])})
    children = [
        run_record(experiment, "Prophet", "child", parent_id=parent["run_id"], trial=t["trial"], params=t["params"],
                   metrics={"rmse": t["rmse"], "mae": t["mae"]})
        for t in results
    ]
    model = fit_additive(train, target, spec_of(best["params"]), ts_col)
    cells = [*model.coefficients.items(), ("sigma", model.sigma)]
    spark.createDataFrame(cells, "name string, value double").write.parquet(f"{models_path}/{parent['run_id']}")
    errors = residuals(model.predict(test, ts_col), target, "prediction", [ts_col])
    tables = store_tables(models_path, parent["run_id"], {"residuals": errors})
    append_runs(spark, runs_path, [parent, *children])
    return TrainedAdditive(parent["run_id"], model, results, tables["residuals"])


def load_best(spark, runs_path: str, models_path: str, experiment: str, metric: str = "rmse") -> tuple[PipelineModel, object]:
    """Model of the best finished run; a tuning run's model is stored under its parent."""
    row = best_run(spark, runs_path, experiment, metric)
    return PipelineModel.load(f"{models_path}/{row.artifact_run_id}"), row
