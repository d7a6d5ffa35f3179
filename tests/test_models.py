from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from chronoload.operators import windows
from chronoload.plans import features as FE
from chronoload.plans import select as SE
from chronoload.plans import train as TN
from chronoload.plans.forecast import forecast_best
from chronoload.session import new_path
from chronoload.training import fit, folds, forecast, importance, runs, search, selection, smoothing
from chronoload.training.registry import build_model, translate

LAGS = ["y_lag_1", "y_lag_24", "y_rw_3_mean", "y_rw_24_sum"]


@pytest.fixture(scope="module")
def learn(spark):
    rng = np.random.default_rng(0)
    n = 400
    pdf = pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=n, freq="h"), "k": range(n)})
    for c in "abcd":
        pdf[c] = rng.normal(size=n)
    pdf["y"] = 5 * pdf.a + 2 * pdf.b + 0.1 * rng.normal(size=n)
    return spark.createDataFrame(pdf).cache()


# ------------------------------------------------------------------ registry


def test_registry_translates_and_drops(spark):
    accepted, dropped = translate("XGBoost", {"n_estimators": 7, "max_depth": 99, "learning_rate": 0.2, "reg_alpha": 1, "rate_drop": 0.1})
    assert accepted == {"maxIter": 7, "maxDepth": 30, "stepSize": 0.2} and dropped == ["reg_alpha", "rate_drop"]
    model = build_model("Random Forest", {"n_estimators": 3, "min_samples_leaf": 4, "max_features": "sqrt"}, seed=9)
    assert (model.getNumTrees(), model.getMinInstancesPerNode(), model.getSeed()) == (3, 4, 9)
    with pytest.raises(ValueError, match="unknown model"):
        build_model("Oracle")


def test_safe_names():
    assert fit.safe_names(["New Year's Day", "New Year s Day", "a"]) == {"New Year's Day": "New_Year_s_Day", "New Year s Day": "New_Year_s_Day_", "a": "a"}


# ------------------------------------------------------------------ folds


@pytest.mark.parametrize("n, k", [(20, 4), (23, 4), (400, 3)])
def test_folds_are_expanding_and_never_look_ahead(spark, n, k):
    df = spark.createDataFrame(pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=n, freq="h")}))
    rows = folds.fold_table(df, k).orderBy("fold").collect()
    hour = lambda t: int((t - datetime(2024, 1, 1)).total_seconds() // 3600)
    size = n // (k + 1)
    assert [(hour(r.train_end), hour(r.test_end)) for r in rows] == [(n - (k - i) * size, n - (k - i - 1) * size) for i in range(k)]
    for cut in folds.cuts(df, k):
        train, test = folds.split_fold(df, cut)
        assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]
        assert test.count() == size


def test_too_few_rows_for_the_folds(spark):
    df = spark.createDataFrame(pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=3, freq="h")}))
    with pytest.raises(ValueError, match="too few"):
        folds.cuts(df, 4)
    with pytest.raises(ValueError):
        folds.fold_table(df, 1)


def test_cv_of_a_perfect_model(spark, learn):
    exact = learn.withColumn("y", 2 * F.col("a") + 1)
    scores = folds.cv_scores(exact, ["a", "b"], "y", build_model("Linear"), 3)
    assert scores["rmse"] < 1e-6 and scores["mae"] < 1e-6


# ------------------------------------------------------------------ selection


@pytest.mark.parametrize("method", ["f", "imp", "rfe", "rfecv"])
def test_selection_finds_the_signal(spark, learn, method):
    more = dict(trees=8, depth=5, step=1, splits=2)
    got = selection.select_features(learn, list("cadb"), "y", method, 2, 42, **more)
    if method == "rfecv":
        assert {"a", "b"} <= set(got) and len(got) >= 2
    else:
        assert set(got) == {"a", "b"}
    assert got == selection.select_features(learn, list("cadb"), "y", method, 2, 42, **more)


def test_mutual_information_selection(spark, learn):
    assert selection.select_features(learn, list("cad"), "y", "mi", 1, bins=4) == ["a"]


def test_selection_arguments(learn):
    with pytest.raises(ValueError, match="k must be"):
        selection.select_features(learn, ["a"], "y", "f", 2)
    with pytest.raises(ValueError, match="unknown"):
        selection.select_features(learn, ["a"], "y", "magic", 1)


def test_candidate_and_final_sets():
    names = ["hour_sin", "hour_cos", "month_sin", "month_cos", "energy_lag_1", "temp_rw_3_mean", "w_rain_dur_rw_1_sum", "t_cong_dur_rw_1_sum", "Boxing Day"]
    assert SE.candidate_features(names, SE.SelectionRules()) == [n for n in names if n[:2] not in ("te", "w_", "t_")]
    assert SE.candidate_features(names, SE.SelectionRules(weather=True, traffic=True)) == names
    assert SE.complete_set(names, ["hour_cos", "energy_lag_1"], ["Boxing Day"]) == ["hour_sin", "hour_cos", "energy_lag_1", "Boxing Day"]


# ------------------------------------------------------------------ search, runs


def test_draw_follows_the_range_grammar():
    space = {"i": [2, 5], "f": [0.1, 0.9], "mixed": [0, 1.5], "b": [True, False], "s": ["x", "y", "z"], "one": ["k"], "n": [-1]}
    rng = random.Random(1)
    drawn = [search.draw(space, rng) for _ in range(200)]
    assert {d["i"] for d in drawn} == {2, 3, 4, 5} and {d["s"] for d in drawn} == {"x", "y", "z"} and {d["b"] for d in drawn} == {True, False}
    assert all(0.1 <= d["f"] <= 0.9 and 0 <= d["mixed"] <= 1.5 and d["one"] == "k" and d["n"] == -1 for d in drawn)
    assert any(isinstance(d["mixed"], float) and d["mixed"] % 1 for d in drawn)


def test_search_is_deterministic_and_finds_the_better_depth(spark, learn):
    args = (learn, list("abcd"), "y", "Random Forest", {"n_estimators": [4, 6], "max_depth": [1, 6]}, 3)
    one = search.random_search(*args, n_splits=2, parallel=3)
    two = search.random_search(*args, n_splits=2, parallel=1)
    assert one == two and [t["trial"] for t in one] == [0, 1, 2]
    assert search.best_trial(one)["rmse"] == min(t["rmse"] for t in one)
    with pytest.raises(ValueError):
        search.random_search(*args, metric="r2")


def test_run_table(spark):
    path = new_path(spark, "runs")
    assert runs.next_run_number(runs.read_runs(spark, path), "m") == 1
    with pytest.raises(ValueError, match="no finished run"):
        runs.best_run(spark, path, "e")
    parent = runs.run_record("e", "m", "parent", run_number=11, metrics={"best_rmse": 2.0})
    child = runs.run_record("e", "m", "child", parent_id=parent["run_id"], trial=0, metrics={"rmse": 2.0}, params={"d": 3})
    worse = runs.run_record("e", "m", "child", parent_id=parent["run_id"], trial=1, metrics={"rmse": 3.0})
    failed = runs.run_record("e", "m", "child", trial=2, status="FAILED", metrics={"rmse": 0.1})
    alone = runs.run_record("e2", "m", "child", trial=2, metrics={"rmse": 9.0})
    runs.append_runs(spark, path, [parent, child, worse])
    runs.append_runs(spark, path, [failed, alone])
    table = runs.read_runs(spark, path)
    assert runs.next_run_number(table, "m", "e") == 12 and runs.next_run_number(table, "other") == 1
    best = runs.best_run(spark, path, "e")
    assert (best.run_id, best.artifact_run_id, best.params) == (child["run_id"], parent["run_id"], {"d": "3"})
    assert runs.best_run(spark, path, "e", ascending=False).run_id == worse["run_id"]
    lone = runs.best_run(spark, path, "e2")
    assert lone.artifact_run_id == lone.run_id == alone["run_id"]
    assert {(r.experiment, r.metric) for r in runs.experiment_metrics(table).collect()} == {("e", "best_rmse"), ("e", "rmse"), ("e2", "rmse")}
    with pytest.raises(ValueError):
        runs.run_record("e", "m", "child", colour="red")


def test_champion_trace(spark):
    values = [5.0, 6.0, 4.0, 4.0, 1.0, 2.0]
    df = spark.createDataFrame(list(enumerate(values)), "trial int, value double")
    got = runs.champion_trace(df, "value", block_rows=2).orderBy("trial").collect()
    assert [r.best for r in got] == [5.0, 5.0, 4.0, 4.0, 1.0, 1.0]
    assert [r.improved for r in got] == [True, False, True, False, True, False]
    assert [r.improvement_pct for r in got] == [None, None, 25.0, None, 300.0, None]


# ------------------------------------------------------------------ evaluation, forecasts


def test_permutation_importance_ranks_the_signal(spark, learn, monkeypatch):
    monkeypatch.setattr(importance, "ROWS_PER_BUCKET", 150)
    model = fit.fit_final(learn, list("abcd"), "y", "Linear")
    args = (model.stages[-1], learn, list("abcd"), "y", ["k"])
    got = {r.feature: r.importance for r in importance.permutation_importance(*args, repeats=3).collect()}
    assert got == {r.feature: r.importance for r in importance.permutation_importance(*args, repeats=3).collect()}
    assert got["a"] > got["b"] > 10 * abs(got["c"])
    # a shuffled standard normal adds about |w| * sqrt(2) to the error
    assert got["a"] == pytest.approx(5 * np.sqrt(2), rel=0.15)


def plain_holt_winters(y, period, alpha, beta, gamma, horizon):
    level, slope = y[:period].mean(), (y[period : 2 * period].mean() - y[:period].mean()) / period
    season = list(y[:period] - level)
    for t, x in enumerate(y):
        s = season[t % period]
        before = level
        level = alpha * (x - s) + (1 - alpha) * (level + slope)
        slope = beta * (level - before) + (1 - beta) * slope
        season[t % period] = gamma * (x - level) + (1 - gamma) * s
    return [level + h * slope + season[(len(y) + h - 1) % period] for h in range(1, horizon + 1)]


def test_holt_winters(spark, hourly):
    df, pdf = hourly
    split = "2024-01-20"
    got = smoothing.holt_winters(df, "y", split, 30, 24, ["s"], smoothing={"alpha": [0.2, 0.9], "beta": [0.01], "gamma": [0.3]})
    got = got.orderBy("s", "timestamp").toPandas()
    for s, p in pdf[pdf.timestamp < split].groupby("s"):
        mine = got[got.s == s]
        a, b, g = mine[["alpha", "beta", "gamma"]].iloc[0]
        np.testing.assert_allclose(mine.prediction, plain_holt_winters(p.y.to_numpy(), 24, a, b, g, 30))
        assert mine.timestamp.iloc[0] == pd.Timestamp(split)
    errors = got.merge(pdf, on=["s", "timestamp"])
    assert np.abs(errors.prediction - errors.y).mean() < errors.y.std()


def test_holt_winters_composes_blocks(spark):
    rng = np.random.default_rng(6)
    frames = []
    for name, n in (("long", 24 * 50 + 7), ("short", 48), (None, 24 * 9)):
        t = np.arange(n)
        y = 1e3 + 0.1 * t + 9 * np.sin(2 * np.pi * t / 6) + rng.normal(0, 1, n)
        frames.append(pd.DataFrame({"s": name, "timestamp": pd.date_range("2024-03-01", periods=n, freq="h") - pd.Timedelta(hours=n), "y": y}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf, "s string, timestamp timestamp, y double").repartition(6)
    choice = {"alpha": [0.1, 0.4, 0.4], "beta": [0.0, 0.2], "gamma": [0.3, 1.0]}
    want = {}
    for name, p in zip(("long", "short", None), frames):
        tried = []
        for a, b, g in [(a, b, g) for a in choice["alpha"] for b in choice["beta"] for g in choice["gamma"]]:
            y, period = p.y.to_numpy(), 6
            level, slope = y[:6].mean(), (y[6:12].mean() - y[:6].mean()) / 6
            season, sse = list(y[:6] - level), 0.0
            for t, x in enumerate(y):
                s, before = season[t % 6], level
                sse += (x - level - slope - s) ** 2
                level = a * (x - s) + (1 - a) * (level + slope)
                slope = b * (level - before) + (1 - b) * slope
                season[t % 6] = g * (x - level) + (1 - g) * s
            tried.append((sse, a, b, g))
        sse, a, b, g = min(tried)
        want[name] = (a, b, g, sse, plain_holt_winters(p.y.to_numpy(), 6, a, b, g, 9))
    for periods in (2, 3, 28):  # up to a hundred blocks: two rounds of composing
        got = smoothing.holt_winters(df, "y", "2024-03-01", 9, 6, ["s"], smoothing=choice, block_periods=periods)
        plan = got._jdf.queryExecution().toString()
        assert "FlatMapGroups" not in plan and "BatchEvalPython" not in plan
        rows = got.orderBy("timestamp").toPandas()
        for name, (a, b, g, sse, ahead) in want.items():
            own = rows[rows.s.isna()] if name is None else rows[rows.s == name]
            assert tuple(own[["alpha", "beta", "gamma"]].iloc[0]) == (a, b, g)
            np.testing.assert_allclose(own.sse, sse, rtol=1e-6)
            np.testing.assert_allclose(own.prediction, ahead, rtol=1e-8)
    one = df.where("s = 'long'").drop("s")
    assert smoothing.holt_winters(one, "y", "2024-03-01", 3, 6, smoothing=choice).count() == 3
    assert smoothing.holt_winters(df.limit(0), "y", "2024-03-01", 3, 6, ["s"]).count() == 0
    with pytest.raises(ValueError, match="missing"):
        smoothing.holt_winters(df.withColumn("y", F.when(F.hour("timestamp") != 3, F.col("y"))), "y", "2024-03-01", 3, 6, ["s"])
    with pytest.raises(ValueError, match="missing"):
        smoothing.holt_winters(df.where("hour(timestamp) != 3"), "y", "2024-03-01", 3, 6, ["s"])
    with pytest.raises(ValueError, match="two periods"):
        smoothing.holt_winters(df, "y", "2024-03-01", 3, 30, ["s"])


def test_seasonal_naive_and_walk_forward(spark, hourly):
    df, pdf = hourly
    got = {(r.s, r.split): r for r in forecast.naive_errors(df, "y", "2024-01-20", 168, ["s"]).collect()}
    for s, p in pdf.groupby("s"):
        gap = (p.y - p.y.shift(168)).to_numpy()
        test = (p.timestamp >= "2024-01-20").to_numpy()
        assert got[(s, "test")].mae == pytest.approx(np.abs(gap[test]).mean())
        assert got[(s, "train")].rmse == pytest.approx(np.sqrt(np.nanmean(gap[~test] ** 2)))
    scored = forecast.seasonal_naive(df, "y", "2024-01-20", 1, ["s"])
    row = forecast.walk_forward_score(scored, "y", "prediction", "2024-01-20", "2024-01-21", ["s"]).where("s = 'a'").first()
    day = pdf[(pdf.s == "a")].set_index("timestamp").y
    assert row.steps == 24 and row.score == pytest.approx(day.diff().loc["2024-01-20"].abs().mean())


def lag_frame(df):
    return windows.history_features(df, {"y": [1, 24]}, {"y": [24]}, {"y": [3]}, ["s"]).withColumn("hour", F.hour("timestamp").cast("double"))


@pytest.mark.parametrize("with_trend", [False, True])
def test_recursive_forecast_equals_a_plain_loop(spark, hourly, with_trend):
    df, pdf = hourly
    start, horizon = "2024-01-20", 7
    names = [*LAGS, "hour"]
    frame = lag_frame(df)
    model = fit.fit_final(frame.where(F.col("timestamp") < start).dropna(), names, "y", "Linear")
    weights, bias = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    trend = spark.createDataFrame([("a", 0.02, 3.0), ("b", 0.01, 1.0)], "s string, slope double, intercept double") if with_trend else None
    got = forecast.recursive_forecast(
        model, df, frame.select("s", "timestamp", "hour"), "y", start, horizon, max_lag=24, series_cols=["s"],
        trend=trend, series_start="2024-01-01", segment=3,
    ).orderBy("s", "timestamp").toPandas()
    lines = {"a": (0.02, 3.0), "b": (0.01, 1.0)}
    for s, p in pdf.groupby("s"):
        first = int((p.timestamp < start).sum())
        slope, level = lines[s] if with_trend else (0.0, 0.0)
        y = list(p.y.to_numpy()[:first] - (slope * np.arange(first) + level))
        want = []
        for i in range(horizon):
            x = [y[-1], y[-24], np.mean(y[-3:]), np.sum(y[-24:]), (first + i) % 24]
            y.append(float(weights @ x + bias))
            want.append(y[-1] + slope * (first + i) + level)
        mine = got[got.s == s]
        np.testing.assert_allclose(mine.forecast, want, rtol=1e-9)
        np.testing.assert_allclose(mine.actual, p.y.to_numpy()[first : first + horizon])


def test_recursive_forecast_needs_its_history_and_future(spark, hourly):
    df, _ = hourly
    frame = lag_frame(df)
    model = fit.fit_final(frame.where("s = 'a'").dropna(), [*LAGS, "hour"], "y", "Linear")
    exogenous = frame.select("s", "timestamp", "hour")
    with pytest.raises(ValueError, match="lack required times"):
        forecast.recursive_forecast(model, df.where("timestamp != '2024-01-19 05:00:00'"), exogenous, "y", "2024-01-20", 3, 24, series_cols=["s"])
    with pytest.raises(ValueError, match="lack required times"):
        forecast.recursive_forecast(model, df, exogenous, "y", "2024-01-25 20:00:00", 30, 24, series_cols=["s"])
    with pytest.raises(ValueError, match="looks back 24 steps"):
        forecast.recursive_forecast(model, df, exogenous, "y", "2024-01-20", 3, 23, series_cols=["s"])
    holes = exogenous.withColumn("hour", F.when(F.col("hour") != 2, F.col("hour")))
    with pytest.raises(ValueError, match="lack values of hour"):
        forecast.recursive_forecast(model, df, holes, "y", "2024-01-20", 3, series_cols=["s"])
    assert forecast.recursive_forecast(model, df, holes, "y", "2024-01-20", 2, series_cols=["s"], segment=5).count() == 4


def test_recursive_forecast_with_an_outlier_flag(spark, hourly):
    df, _ = hourly
    flagged = df.withColumn("y_outlier", (F.col("y") > 25).cast("int"))
    frame = windows.history_features(flagged, {"y": [1], "y_outlier": [1, 3]}, series_cols=["s"]).withColumn("hour", F.hour("timestamp"))
    names = ["y_lag_1", "y_outlier_lag_1", "y_outlier_lag_3", "hour"]
    model = fit.fit_final(frame.dropna(), names, "y", "Linear")
    got = forecast.recursive_forecast(model, flagged, frame.select("s", "timestamp", "hour"), "y", "2024-01-20", 5, 24, flag="y_outlier", series_cols=["s"])
    assert got.count() == 10 and got.where("forecast is null").count() == 0


def test_additive_features(spark, hourly):
    df, _ = hourly
    out, names = forecast.additive_features(df, "2024-01-01", "2024-01-26", 4, 0.8, {24.0: 2, 168.0: 1})
    assert len(names) == 1 + 4 + 2 * 3
    row = out.where("s = 'a' and timestamp = '2024-01-13 12:00:00'").first()
    assert row.trend == pytest.approx(0.5) and row.hinge_1 == pytest.approx(0.5 - 0.16) and row.hinge_4 == 0.0
    assert row.season_0_sin_1 == pytest.approx(0.0, abs=1e-9) and row.season_0_cos_1 == pytest.approx(-1.0)


def test_features_train_and_forecast_end_to_end(spark, hourly):
    df, _ = hourly
    load = df.where("s = 'a'").drop("s").withColumnRenamed("y", "energy")
    rules = FE.FeatureRules(lags={"energy": (1, 24)}, sums={"energy": (24,)}, means={"energy": (3,)}, detrend=False)
    frame, names = FE.make_features(load, "2024-01-01", "2024-01-26", "2024-01-20", rules)
    assert frame.count() == 600 - 24 and len(names) == 6 + 2 + 1 + 1 + 6
    assert frame.dropna().count() == frame.count()
    small, chosen = SE.select_feature_set(frame, names, "2024-01-20", SE.SelectionRules(method_1="f", k_1=5, method_2="rfe", k_2=3, trees=5, depth=4))
    assert set(SE.HOLIDAYS) <= set(chosen) and small.columns == ["timestamp", *chosen, "energy"]
    runs_path, models = new_path(spark, "runs"), new_path(spark, "models")
    trained = TN.train_model(small, chosen, "energy", "2024-01-20", "Random Forest", {"n_estimators": [3, 5], "max_depth": [2, 4]}, runs_path, models, "exp", trials=2, n_splits=2, repeats=1)
    assert trained.residuals.count() == 600 - 19 * 24 and trained.importances.count() == len(chosen)
    again = PipelineModel.load(f"{models}/{trained.run_id}")
    assert fit.feature_names(again) == [fit.safe_names(small.columns)[c] for c in chosen]
    table = runs.read_runs(spark, runs_path)
    assert table.where("level = 'child'").count() == 2 and table.where("level = 'parent'").first().run_number == 1
    out = forecast_best(load, small, "energy", "2024-01-20", 4, runs_path, models, "exp", out=new_path(spark, "fc"))
    assert out.count() == 4 and out.where("forecast is null or actual is null").count() == 0


def test_predictions_keep_every_row(spark):
    rows = [(float(i), float(i % 3), 2.0 * i + i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = fit.fit_final(df, ["a", "b"], "y", "Linear")
    holes = df.unionByName(spark.createDataFrame([(None, 1.0, 5.0), (float("nan"), 1.0, 6.0)], df.schema))
    out = fit.predict(model, holes)
    assert out.columns == ["a", "b", "y", "prediction"]
    got = out.collect()
    assert len(got) == 32 and sorted(r.y for r in got if r.prediction is None) == [5.0, 6.0]
    assert all(abs(r.prediction - r.y) < 1e-6 for r in got if r.prediction is not None)


def test_dropped_parameters_and_depth_are_reported():
    with pytest.warns(UserWarning, match="no counterpart for gamma_x"):
        build_model("XGBoost", {"gamma_x": 1})
    with pytest.warns(UserWarning, match="36"):
        assert build_model("Random Forest", {"max_depth": 36}).getMaxDepth() == 30
