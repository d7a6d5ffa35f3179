"""Scores: correlations, F statistics, mutual information, forecast errors, residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoload.functions.textfns import quoted
from chronoload.operators.quantiles import exact_quantiles, quantile_name
from chronoload.session import stage


def _per_feature(row: DataFrame, features: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One-row aggregate with columns ``<prefix><i>`` to one row per feature."""
    cells = [
        F.struct(F.lit(f).alias("feature"), *[F.col(f"{prefix}{i}").alias(name) for name, prefix in fields.items()])
        for i, f in enumerate(features)
    ]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows with both values; null when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every feature with the target, in one pass."""
    y = quoted(target).cast("double")
    aggs = [_correlation(quoted(f).cast("double"), y).alias(f"r{i}") for i, f in enumerate(features)]
    return _per_feature(df.agg(*aggs), features, {"correlation": "r"})


def f_scores(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Univariate regression F statistic: r^2 / (1 - r^2) * (n - 2)."""
    y = quoted(target).cast("double")
    aggs = []
    for i, f in enumerate(features):
        x = quoted(f).cast("double")
        aggs += [_correlation(x, y).alias(f"r{i}"), F.count_if(x.isNotNull() & y.isNotNull()).alias(f"n{i}")]
    table = _per_feature(df.agg(*aggs), features, {"_r": "r", "_n": "n"})
    r2 = F.col("_r") * F.col("_r")
    score = F.when(r2 >= 1.0, F.lit(float("inf"))).otherwise(r2 / (1 - r2) * (F.col("_n") - 2))
    return table.select("feature", F.when(F.col("_r").isNotNull(), score).alias("score"))


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each feature and the target over their quantile bins.

    The estimate counts joint bins; it is not a nearest-neighbour estimate, so values differ from that
    one's while the ranking serves the same purpose.
    """
    names = [*features, target]
    probs = [i / bins for i in range(1, bins)]
    pairs = lambda cols: F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).cast("double").alias("x")) for c in cols])
    )
    long = df.select(pairs(names).alias("p")).select("p.*")
    cuts = stage(exact_quantiles(long, "x", probs, ["feature"]).drop("n"), "cuts")
    cols = [quantile_name(p) for p in probs]
    number = lambda v, side: sum((F.col(v) > F.col(f"{side}{c}")).cast("int") for c in cols)
    mine = cuts.select(F.col("feature"), *[F.col(c).alias(f"f_{c}") for c in cols])
    targets = cuts.where(F.col("feature") == target).select(*[F.col(c).alias(f"t_{c}") for c in cols])
    rows = df.select(quoted(target).cast("double").alias("y"), pairs(features).alias("p")).select("y", "p.*").dropna()
    targeted = rows.withColumn("_t", targets.select(F.struct("*")).scalar()).select("*", "_t.*").drop("_t")
    joint = (
        targeted.withColumn("by", number("y", "t_"))
        .join(mine, "feature")
        .groupBy("feature", "by", number("x", "f_").alias("bx"))
        .agg(F.count("*").alias("c"))
    )
    # at most bins * bins rows per feature from here on
    share = lambda *keys: F.sum("c").over(Window.partitionBy("feature", *keys)).cast("double")
    term = F.col("c") / share() * F.log(F.col("c") * share() / (share("bx") * share("by")))
    return joint.withColumn("_t", term).groupBy("feature").agg(F.sum("_t").alias("score"))


def ranked(scores: DataFrame) -> DataFrame:
    """Best first; equal scores go by name."""
    return scores.orderBy(F.col("score").desc_nulls_last(), F.col("feature"))


def top_features(scores: DataFrame, k: int) -> DataFrame:
    return ranked(scores).limit(k)


def forecast_errors(
    df: DataFrame, actual: str, predicted: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """RMSE, MAE and the mean actual value per group."""
    gap = F.col(actual) - F.col(predicted)
    scored = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return scored.groupBy(*group_cols).agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"), F.avg(actual).alias("mean_load"),
        F.count("*").alias("n"),
    )


def residuals(df: DataFrame, actual: str, predicted: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(
        *keep, F.col(actual).alias("actual"), F.col(predicted).alias("prediction"),
        (F.col(actual) - F.col(predicted)).alias("residual"),
    )
