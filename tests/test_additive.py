"""The regression on trend, seasons and holidays, and its search, against dense least squares."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoload.plans import train as TN
from chronoload.training import additive as A
from chronoload.training.folds import cuts
from chronoload.training.runs import read_runs
from chronoload.training.search import best_trial, random_search


@pytest.fixture(scope="module")
def load(spark):
    rng = np.random.default_rng(4)
    n = 24 * 70
    t = np.arange(n)
    times = pd.date_range("2023-11-10", periods=n, freq="h")
    y = 50 + 0.02 * t + (1 + t / n) * 6 * np.sin(2 * np.pi * t / 24) + 3 * np.cos(2 * np.pi * t / 168) + rng.normal(0, 1, n)
    y[np.isin(times.strftime("%m-%d"), ["11-23", "12-25"])] -= 15
    pdf = pd.DataFrame({"timestamp": times, "load": y})
    pdf.loc[[5, 900], "load"] = np.nan
    return spark.createDataFrame(pdf).repartition(5).cache()


SPEC = A.AdditiveSpec(changepoints=4, orders={24.0: 2, 168.0: 1}, multiplicative=True, season_scale=2.0, holiday_scale=0.5)


def dense(frame, own):
    pdf = frame.select("timestamp", *[c.cast("double").alias(f"x{k}") for k, (c, _) in enumerate(own.values())], "load").toPandas()
    pdf = pdf.sort_values("timestamp").dropna()
    return pdf.timestamp, pdf[[f"x{k}" for k in range(len(own))]].to_numpy(float), pdf.load.to_numpy(float)


def plain_ridge(x, y, scales):
    z = np.column_stack([np.ones(len(x)), x])
    free = np.linalg.lstsq(z, y, rcond=None)[0]
    noise, unit = np.mean((y - z @ free) ** 2), np.mean(y**2)
    penalty = np.array([0.0] + [0.0 if s is None else noise / (unit * s * s) for s in scales])
    return np.linalg.lstsq(np.vstack([z, np.diag(np.sqrt(penalty))]), np.concatenate([y, np.zeros(len(penalty))]), rcond=None)[0]


def test_fit_equals_dense_ridge(spark, load):
    start, end = A._span(load, "timestamp")
    frame, names = A.with_holidays(load)
    assert len(names) >= 3
    own = A.design(SPEC, start, end, names)
    _, x, y = dense(frame, own)
    want = plain_ridge(x, y, [s for _, s in own.values()])
    model = A.fit_additive(load, "load", SPEC)
    fitted = np.column_stack([np.ones(len(x)), x]) @ want
    got = np.column_stack([np.ones(len(x)), x]) @ np.array(list(model.coefficients.values()))
    np.testing.assert_allclose(got, fitted, rtol=1e-7)
    assert model.sigma == pytest.approx(np.sqrt(np.mean((y - fitted) ** 2)), rel=1e-6) and model.sigma < 1.3
    scored = model.predict(load.withColumn("lower_", F.lit(1))).orderBy("timestamp").toPandas()
    assert len(scored) == load.count() and list(scored.columns) == ["timestamp", "load", "lower_", "prediction", "lower", "upper"]
    np.testing.assert_allclose(scored.prediction[scored.load.notna()], fitted, rtol=1e-7)
    np.testing.assert_allclose(scored.upper - scored.prediction, 1.2815515655446004 * model.sigma)
    later = spark.createDataFrame([(datetime(2024, 7, 4, 12),)], "timestamp timestamp")  # a holiday that was not learned
    assert model.predict(later).count() == 1


def test_search_equals_refitting_each_fold(load):
    start, end = A._span(load, "timestamp")
    frame, names = A.with_holidays(load)
    space = {"n_changepoints": [1, 6], "weekly_seasonality": [0, 2], "yearly_seasonality": [0], "seasonality_mode": ["additive", "multiplicative"],
             "changepoint_prior_scale": [0.01, 0.5], "holidays_prior_scale": [1, 5], "growth": ["linear"]}
    found = random_search(load, [], "load", "Prophet", space, 4, 3)
    narrow = A.additive_search(load, "load", space, 4, 3, max_columns=30)  # several passes
    assert len({str(t["params"]) for t in found}) == 4 and len({round(t["rmse"], 6) for t in found}) == 4
    for trial, again in zip(found, narrow):
        own = A.design(A.spec_of(trial["params"]), start, end, names)
        times, x, y = dense(frame, own)
        rmse, mae = [], []
        for low, high in cuts(load, 3):
            train, test = (times < low).to_numpy(), ((times >= low) & (times < high)).to_numpy()
            beta = plain_ridge(x[train], y[train], [s for _, s in own.values()])
            error = y[test] - beta[0] - x[test] @ beta[1:]
            rmse.append(np.sqrt(np.mean(error**2)))
            mae.append(np.mean(np.abs(error)))
        assert (trial["rmse"], trial["mae"]) == pytest.approx((np.mean(rmse), np.mean(mae)), rel=1e-4)
        assert (again["rmse"], again["mae"]) == pytest.approx((trial["rmse"], trial["mae"]), rel=1e-6)


def test_matrices_do_not_grow_with_rows(load):
    frame = load.withColumn("x", F.hour("timestamp")).dropna()
    rows = A._rows(frame, {"x": F.col("x")}, "load", [datetime(2023, 12, 1), datetime(2024, 1, 1)], "timestamp")
    assert A.gram_table(rows, 3).count() == 2 * 9
    assert A.gram_table(rows.unionByName(rows), 3).count() == 2 * 9


def test_parameters_of_the_additive_model():
    spec = A.spec_of({"n_changepoints": 7, "weekly_seasonality": 0, "seasonality_mode": "multiplicative", "interval_width": 0.9})
    assert spec.changepoints == 7 and spec.multiplicative and 168.0 not in spec.orders and spec.interval == 0.9
    with pytest.raises(ValueError, match="growth"):
        A.spec_of({"growth": "logistic"})
    with pytest.raises(ValueError, match="seasonality_mode"):
        A.spec_of({"seasonality_mode": "both"})
    with pytest.warns(UserWarning, match="mcmc_samples"):
        A.spec_of({"mcmc_samples": 3})


def test_training_job(spark, load, tmp_path):
    space = {"n_changepoints": [1, 3], "weekly_seasonality": [1, 3], "yearly_seasonality": [0]}
    done = TN.train_additive(load, "load", "2024-01-10", space, f"{tmp_path}/runs", f"{tmp_path}/models", "demo", 3, 3)
    runs = read_runs(spark, f"{tmp_path}/runs")
    assert runs.count() == 4 and runs.where("run_id = '" + done.run_id + "'").count() == 1
    stored = {r.name: r.value for r in spark.read.parquet(f"{tmp_path}/models/{done.run_id}").collect()}
    assert stored["trend"] == done.model.coefficients["trend"] and best_trial(done.trials)["rmse"] < 6
    assert done.residuals.count() == load.where("timestamp >= '2024-01-10'").count()
    with pytest.raises(ValueError, match="train_additive"):
        TN.train_model(load, [], "load", "2024-01-10", "Prophet", space, "r", "m", "demo")
