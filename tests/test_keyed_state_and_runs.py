from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoload.operators import blocks, tsa
from chronoload.session import new_path
from chronoload.streaming.load import _OrderedSlotHistory, _SlotHistory
from chronoload.streaming.ordered import LEAF, OrderedCounts
from chronoload.training import fit, importance, runs
from chronoload.training.registry import build_model, settle, translate


# ------------------------------------------------------------------ ordered state


def plain_spread(values):
    median = np.median(values)
    return median, np.median(np.abs(np.array(values) - median))


@pytest.mark.parametrize("kind", ["normal", "ties", "wide"])
def test_running_median_and_deviation_equal_numpy(kind):
    rng = np.random.default_rng(5)
    draws = {
        "normal": rng.normal(50, 4, 700),
        "ties": rng.integers(-3, 4, 700) / 2,
        "wide": np.concatenate([rng.normal(0, 1, 300) * 10.0 ** rng.integers(-200, 200, 300), [0.0, -0.0, np.inf, 1e308, -1e308]]),
    }[kind].tolist()
    stored = {}
    for start in range(0, len(draws), 7):  # a batch: what is not kept in the state is gone
        seen = OrderedCounts(stored.get)
        for i in range(start, min(start + 7, len(draws))):
            if i:
                median, deviation = plain_spread(draws[:i])
                assert seen.median() == median and len(seen) == i
                if np.isfinite(median) and np.isfinite(draws[:i]).all():
                    assert seen.deviation(median) == deviation
            seen.add(draws[i])
        stored.update(seen.changed())


def test_a_row_reads_few_nodes_of_a_long_history():
    stored = {}
    seen = OrderedCounts(stored.get)
    for x in np.random.default_rng(1).normal(0, 1, 50_000).tolist():
        seen.add(x)
    stored.update(seen.changed())
    reads = []
    again = OrderedCounts(lambda name: reads.append(name) or stored.get(name))
    again.deviation(again.median())
    again.add(0.1234)
    assert len(stored) > 1000 and len(reads) < 120 and len(again.changed()) < 20
    assert all(len(node[0]) <= LEAF for node in stored.values())


class _Values(list):
    def get(self):
        return iter(self)

    def exists(self):
        return bool(self)

    def appendList(self, rows):  # noqa: N802
        self.extend(rows)


class _Nodes(dict):
    def containsKey(self, key):  # noqa: N802
        return key in self

    def getValue(self, key):  # noqa: N802
        return self[key]

    def updateValue(self, key, node):  # noqa: N802
        self[key] = node


def test_list_and_nodes_give_one_answer():
    rng = np.random.default_rng(9)
    y = np.where(rng.random(300) < 0.1, np.nan, rng.normal(10, 1, 300) + 20 * (rng.random(300) < 0.05))
    frame = pd.DataFrame({"t": range(300), "y": y, "grid_pos": range(300)})
    found = {}
    for kind, state in ((_OrderedSlotHistory, _Nodes()), (_SlotHistory, _Values())):
        history = kind("t", "y", 3.5, 20, ["t", "y"], "outlier")
        history.past = state
        found[kind] = [f for a in range(0, 300, 40)
                       for f in next(history.handleInputRows(None, iter([frame[a : a + 40]]), None))["outlier"].tolist()]
    assert found[_OrderedSlotHistory] == found[_SlotHistory] and sum(found[_SlotHistory]) > 5


# ------------------------------------------------------------------ least value so far


def test_sparse_trials_share_ranges(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [("hot", int(10**9 * i), float(x)) for i, x in enumerate(rng.normal(100, 20, 900))]
    rows += [(None, int(i), float(x)) for i, x in enumerate(rng.normal(100, 20, 40))] + [("one", 5, 3.0)]
    df = spark.createDataFrame(rows, "study string, trial long, value double")
    written = []
    stage = blocks.stage
    monkeypatch.setattr(blocks, "stage", lambda d, name: written.append(stage(d, name)) or written[-1])
    got = runs.champion_trace(df, "value", "trial", ["study"], block_rows=100).toPandas()
    ranges = written[0].groupBy("_range").agg(F.count("*").alias("n"), F.count_distinct(F.coalesce("study", F.lit("-"))).alias("s")).toPandas()
    assert 8 <= len(ranges) <= 10 and ranges.n.max() < 400 and ranges.s.sum() <= len(ranges) + 2
    for study, own in pd.DataFrame(rows, columns=["study", "trial", "value"]).groupby("study", dropna=False):
        mine = got[got.study.isna() if pd.isna(study) else got.study == study].sort_values("trial")
        np.testing.assert_array_equal(mine.best, np.minimum.accumulate(own.value))
        assert mine.improved.tolist() == [True, *(np.diff(np.minimum.accumulate(own.value)) < 0)]


def test_trace_of_no_trials(spark):
    assert runs.champion_trace(spark.createDataFrame([], "trial int, value double"), "value").count() == 0


# ------------------------------------------------------------------ one cyclic order


def test_importance_does_not_depend_on_the_ranges(spark, monkeypatch):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(0, 1, (400, 2)), columns=["a", "b"]).assign(k=range(400))
    pdf["y"] = 3 * pdf.a - pdf.b
    df = spark.createDataFrame(pdf)
    model = fit.fit_final(df, ["a", "b"], "y", "Linear").stages[-1]
    found = []
    for rows in (10_000, 90, 1):
        monkeypatch.setattr(importance, "ROWS_PER_BUCKET", rows)
        out = importance.permutation_importance(model, df, ["a", "b"], "y", ["k"], repeats=2).orderBy("feature").collect()
        found.append([(r.importance, r.std) for r in out])
    np.testing.assert_allclose(found[0], found[1], rtol=1e-9)
    np.testing.assert_allclose(found[0], found[2], rtol=1e-9)  # hundreds of ranges, most of one row or none
    assert found[0][0][0] == pytest.approx(3 * np.sqrt(2), rel=0.2)


# ------------------------------------------------------------------ autocovariances


@pytest.mark.parametrize("size", [None, 30])
def test_lag_products_with_missing_values(spark, size):
    rng = np.random.default_rng(8)
    y = rng.normal(0, 1, 200)
    y[[0, 7, 50, 199]] = np.nan
    times = pd.date_range("2024-01-01", periods=200, freq="h")
    rows = [(s, t.to_pydatetime(), None if np.isnan(x) else float(x)) for s in ("a", None) for t, x in zip(times, y)]
    df = spark.createDataFrame(rows, "s string, timestamp timestamp, y double")
    got = tsa._lag_products(df, "y", 25, ["s"], "timestamp", 3600, size).toPandas()
    assert len(got) == 52
    for own in (got[got.s == "a"], got[got.s.isna()]):
        own = own.sort_values("lag")
        np.testing.assert_allclose(own["product"], [np.nansum(y[k:] * y[: 200 - k]) for k in range(26)], atol=1e-9)


def test_lag_products_send_sums_only(spark, hourly):
    plan = tsa.acf(hourly[0], "y", 48, ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate posexplode" not in plan and "collect_list" not in plan


# ------------------------------------------------------------------ run store


def test_writers_get_numbers_of_their_own(spark):
    path = new_path(spark, "runs")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: runs.claim_run_number(spark, path, "m", "e"), range(12)))
    assert sorted(got) == list(range(1, 13))
    assert runs.claim_run_number(spark, path, "m", "other") == 1 and runs.claim_run_number(spark, path, "n", "e") == 1
    runs.append_runs(spark, path, [runs.run_record("e", "m", "parent", run_number=40)])
    assert runs.claim_run_number(spark, path, "m", "e") == 41
    assert runs.read_runs(spark, path).count() == 1


def test_tables_are_stored_with_their_run(spark):
    models = new_path(spark, "models")
    table = spark.createDataFrame([("a", 0.5)], "feature string, correlation double")
    assert runs.store_tables(models, "r1", {"correlations": table})["correlations"].collect() == table.collect()
    assert runs.read_table(spark, models, "r1", "correlations").collect() == table.collect()


# ------------------------------------------------------------------ parameter rules

DART = {"sample_type": 1, "normalize_type": 1, "rate_drop": 0.1, "skip_drop": 0.1}
TREE = {"colsample_bytree": 0.5, "max_depth": 4, "max_leaves": 8, "min_child_weight": 1, "min_split_loss": 0.1, "subsample": 0.5, "tree_method": "hist"}


@pytest.mark.parametrize("model,given,kept", [
    ("XGBoost", {"booster": "dart", **DART, **TREE}, {"booster": "dart", **DART, **TREE}),
    ("XGBoost", {"booster": "gbtree", **DART, **TREE}, {"booster": "gbtree", **TREE}),
    ("XGBoost", {**DART, **TREE}, TREE),
    ("XGBoost", {"booster": "gblinear", "reg_lambda": 2.0, **DART, **TREE}, {"booster": "gblinear", "reg_lambda": 2.0}),
    ("LightGBM", {"boosting_type": "gbdt", "drop_rate": 0.1, "skip_drop": 0.1, "uniform_drop": True, "xgboost_dart_mode": True, "subsample": 0.7},
     {"boosting_type": "gbdt", "subsample": 0.7}),
    ("LightGBM", {"boosting_type": "dart", "drop_rate": 0.1}, {"boosting_type": "dart", "drop_rate": 0.1}),
    ("CatBoost", {"bootstrap_type": "Bayesian", "subsample": 0.8, "bagging_temperature": 0.3, "mvs_reg": 1.0},
     {"bootstrap_type": "Bayesian", "bagging_temperature": 0.3}),
    ("CatBoost", {"bootstrap_type": "MVS", "subsample": 0.8, "bagging_temperature": 0.3, "mvs_reg": 1.0},
     {"bootstrap_type": "MVS", "subsample": 0.8, "mvs_reg": 1.0}),
    ("CatBoost", {"grow_policy": "Lossguide", "max_leaves": 20, "min_data_in_leaf": 5}, {"grow_policy": "Lossguide", "max_leaves": 20, "min_data_in_leaf": 5}),
    ("CatBoost", {"grow_policy": "SymmetricTree", "max_leaves": 20, "min_data_in_leaf": 5}, {"grow_policy": "SymmetricTree"}),
    ("CatBoost", {"boosting_type": "Ordered", "grow_policy": "Lossguide", "max_leaves": 20, "min_data_in_leaf": 5, "fold_len_multiplier": 2},
     {"boosting_type": "Ordered", "fold_len_multiplier": 2}),
    ("CatBoost", {"boosting_type": "Plain", "fold_permutation_block": 4, "fold_len_multiplier": 2}, {"boosting_type": "Plain"}),
    ("CatBoost", {"boosting_type": "Ordered", "leaf_estimation_method": "Exact", "leaf_estimation_iterations": 3}, {"boosting_type": "Ordered"}),
    ("CatBoost", {"score_function": "NewtonL2", "leaf_estimation_method": "Gradient", "leaf_estimation_iterations": 3},
     {"score_function": "NewtonL2", "leaf_estimation_method": "Newton", "leaf_estimation_iterations": 3}),
    ("CatBoost", {"score_function": "NewtonCosine", "leaf_estimation_method": "Exact", "leaf_estimation_iterations": 3},
     {"score_function": "NewtonCosine", "leaf_estimation_method": "Newton"}),
    ("Random Forest", {"max_depth": 4, "subsample": 0.5}, {"max_depth": 4, "subsample": 0.5}),
])
def test_parameters_that_others_rule_out(model, given, kept):
    before = dict(given)
    assert settle(model, given) == kept and given == before


def test_boosted_linear_models_are_linear(spark):
    assert type(build_model("XGBoost", {"reg_lambda": 0.5, "max_depth": 3})).__name__ == "GBTRegressor"
    with pytest.warns(UserWarning, match="booster"):
        model = build_model("XGBoost", {"booster": "gblinear", "reg_lambda": 0.5, "max_depth": 3})
    assert type(model).__name__ == "LinearRegression" and model.getRegParam() == 0.5
    assert translate("CatBoost", {"bootstrap_type": "Bayesian", "subsample": 0.5, "depth": 4}) == ({"maxDepth": 4}, ["bootstrap_type", "subsample"])
