"""Assembled frames, final fits and what a fitted model needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.functions.textfns import quoted
from chronoload.training.registry import build_model

FEATURES, LABEL = "features", "label"


def safe_names(columns: Sequence[str]) -> dict[str, str]:
    """ML column names without characters that need quoting: ``{source: safe}``."""
    out: dict[str, str] = {}
    for c in columns:
        base = "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in c)
        while base in out.values():
            base += "_"
        out[c] = base
    return out


def with_safe_names(df: DataFrame) -> DataFrame:
    names = safe_names(df.columns)
    return df.select(*[quoted(c).alias(names[c]) for c in df.columns])


def assembler(features: Sequence[str], invalid: str = "skip") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid=invalid)


def assembled(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep…, features, label)``; rows with a null feature or target are dropped."""
    rows = df.where(F.col(target).isNotNull())
    return assembler(features).transform(rows).select(*keep, FEATURES, F.col(target).cast("double").alias(LABEL))


def fit_final(
    df: DataFrame, features: Sequence[str], target: str, model_name: str, params: dict | None = None,
    seed: int | None = 42,
) -> PipelineModel:
    """Fit on all given rows; the model carries its feature list."""
    rows = df.where(F.col(target).isNotNull()).withColumn(LABEL, F.col(target).cast("double"))
    return Pipeline(stages=[assembler(features), build_model(model_name, params, seed)]).fit(rows)


def feature_names(model: PipelineModel) -> list[str]:
    """Input columns of a fitted (or loaded) pipeline, in vector order."""
    for part in model.stages:
        if isinstance(part, VectorAssembler):
            return part.getInputCols()
    raise ValueError("the model has no feature assembler")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction``, which is null where a feature is null or NaN: every row comes back."""
    whole = F.lit(True)
    for c in feature_names(model):
        value = quoted(c).cast("double")
        whole = whole & value.isNotNull() & ~F.isnan(value)
    rows = df
    for part in model.stages:
        rows = (part.copy({part.handleInvalid: "keep"}) if isinstance(part, VectorAssembler) else part).transform(rows)
    return rows.withColumn("prediction", F.when(whole, F.col("prediction"))).drop(FEATURES)
