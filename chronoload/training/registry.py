"""Model names and parameters, translated to MLlib regressors."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

# Model names users configure. The three boosted-tree families share MLlib's
# gradient-boosted trees; the additive seasonal model is a regression on trend, Fourier and holiday columns.
MODELS = {
    "Random Forest": RandomForestRegressor,
    "XGBoost": GBTRegressor,
    "LightGBM": GBTRegressor,
    "CatBoost": GBTRegressor,
    "Prophet": LinearRegression,
    "Linear": LinearRegression,
}

MAX_DEPTH = 30  # MLlib's limit


def _depth(x) -> int:
    if int(x) > MAX_DEPTH:
        warnings.warn(f"tree depth {x} is beyond MLlib's limit and becomes {MAX_DEPTH}", stacklevel=2)
    return min(int(x), MAX_DEPTH)


# configured parameter -> (MLlib parameter, conversion)
_TREE = {
    "max_depth": ("maxDepth", _depth),
    "depth": ("maxDepth", _depth),
    "min_samples_leaf": ("minInstancesPerNode", int),
    "min_child_samples": ("minInstancesPerNode", int),
    "min_data_in_leaf": ("minInstancesPerNode", int),
    "min_split_loss": ("minInfoGain", float),
    "min_split_gain": ("minInfoGain", float),
    "border_count": ("maxBins", int),
    "subsample": ("subsamplingRate", float),
    "max_features": ("featureSubsetStrategy", str),
    "colsample_bytree": ("featureSubsetStrategy", lambda x: str(float(x))),
}
TRANSLATION = {
    RandomForestRegressor: {**_TREE, "n_estimators": ("numTrees", int)},
    GBTRegressor: {
        **_TREE,
        "n_estimators": ("maxIter", int),
        "iterations": ("maxIter", int),
        "learning_rate": ("stepSize", float),
    },
    LinearRegression: {"reg_lambda": ("regParam", float), "l1_ratio": ("elasticNetParam", float)},
}


@dataclass(frozen=True)
class Rule:
    """Holds when every configured parameter in ``when`` is one of its values, and none in ``unless`` is."""

    when: Mapping[str, tuple] = field(default_factory=dict)
    unless: Mapping[str, tuple] = field(default_factory=dict)
    remove: tuple[str, ...] = ()
    put: Mapping[str, object] = field(default_factory=dict)

    def holds(self, params: Mapping) -> bool:
        return all(params.get(p) in values for p, values in self.when.items()) and not any(
            params.get(p) in values for p, values in self.unless.items()
        )


# Which parameters mean nothing beside others, per model family.
RULES = {
    "XGBoost": [
        Rule(unless={"booster": ("dart",)}, remove=("sample_type", "normalize_type", "rate_drop", "skip_drop")),
        Rule(
            when={"booster": ("gblinear",)},
            remove=("colsample_bytree", "max_depth", "max_leaves", "min_child_weight", "min_split_loss", "subsample", "tree_method"),
        ),
    ],
    "LightGBM": [
        Rule(unless={"boosting_type": ("dart",)}, remove=("drop_rate", "skip_drop", "xgboost_dart_mode", "uniform_drop")),
    ],
    "CatBoost": [
        Rule(unless={"bootstrap_type": ("Bayesian",)}, remove=("bagging_temperature",)),
        Rule(unless={"bootstrap_type": ("Bernoulli", "MVS")}, remove=("subsample",)),
        Rule(unless={"bootstrap_type": ("MVS",)}, remove=("mvs_reg",)),
        Rule(unless={"grow_policy": ("Lossguide",)}, remove=("max_leaves",)),
        Rule(when={"grow_policy": ("SymmetricTree",)}, remove=("min_data_in_leaf",)),
        Rule(
            when={"boosting_type": ("Ordered",)}, unless={"grow_policy": ("SymmetricTree",)},
            remove=("grow_policy", "max_leaves", "min_data_in_leaf"),
        ),
        Rule(unless={"boosting_type": ("Ordered",)}, remove=("fold_len_multiplier", "fold_permutation_block")),
        Rule(when={"boosting_type": ("Ordered",), "leaf_estimation_method": ("Exact",)}, remove=("leaf_estimation_method",)),
        Rule(when={"score_function": ("NewtonCosine", "NewtonL2")}, put={"leaf_estimation_method": "Newton"}),
        Rule(when={"leaf_estimation_method": ("Exact",)}, remove=("leaf_estimation_iterations",)),
    ],
}


def settle(model_name: str, params: Mapping) -> dict:
    """``params`` without those that the others rule out, and with those that the others ask for.

    Every rule is judged on the parameters as they were configured; removals come first, then values that are put.
    """
    holding = [rule for rule in RULES.get(model_name, ()) if rule.holds(params)]
    gone = {name for rule in holding for name in rule.remove}
    kept = {name: value for name, value in params.items() if name not in gone}
    for rule in holding:
        kept.update(rule.put)
    return kept


def regressor_of(model_name: str, params: Mapping):
    """The MLlib class: boosting of linear models is a linear model."""
    if model_name not in MODELS:
        raise ValueError(f"unknown model: {model_name}; known are {sorted(MODELS)}")
    linear = model_name == "XGBoost" and params.get("booster") == "gblinear"
    return LinearRegression if linear else MODELS[model_name]


def translate(model_name: str, params: dict) -> tuple[dict, list[str]]:
    """MLlib parameters, and the configured names without effect: ruled out by the others, or without a counterpart.

    Parameters already named as MLlib names them pass through.
    """
    regressor = regressor_of(model_name, params)
    table = TRANSLATION[regressor]
    accepted, used = {}, set()
    for name, value in settle(model_name, params).items():
        if name in table:
            target, convert = table[name]
            accepted[target] = convert(value)
        elif name[0].islower() and regressor().hasParam(name):
            accepted[name] = value
        else:
            continue
        used.add(name)
    return accepted, [name for name in params if name not in used]


def build_model(
    model_name: str, params: dict | None = None, seed: int | None = None, features_col: str = "features",
    label_col: str = "label",
):
    """An unfitted regressor; parameters that hold and have no counterpart are named in a warning."""
    accepted, dropped = translate(model_name, params or {})
    missing = settle(model_name, params or {}).keys() & set(dropped)
    if missing:
        warnings.warn(f"{model_name}: no counterpart for {', '.join(sorted(missing))}", stacklevel=2)
    model = regressor_of(model_name, params or {})(featuresCol=features_col, labelCol=label_col, predictionCol="prediction", **accepted)
    if seed is not None and model.hasParam("seed"):
        model = model.setSeed(seed)
    return model
