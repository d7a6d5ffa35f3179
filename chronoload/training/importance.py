"""Permutation importance of a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoload.functions.textfns import quoted

ROWS_PER_BUCKET = 10_000


def permutation_importance(
    model, df: DataFrame, features: Sequence[str], target: str, key_cols: Sequence[str], repeats: int = 5,
    seed: int = 42, rows: int | None = None,
) -> DataFrame:
    """Mean RMSE increase per feature when its values are shuffled: ``(feature, importance, std)``.

    ``model`` is a fitted regressor on a ``features`` vector. A repeat has one cyclic order of all rows, by
    ``md5(seed|repeat|key)`` with the keys as text (null: empty), and every row takes the values of the row before it. The
    order is cut into ranges of the digest, which are even by construction; the first row of a range takes the last
    row of the range before, so the result does not depend on how many there are. ``key_cols`` should name a row; rows
    that share a key stand in the order of their values. All (repeat, feature) pairs are scored in one frame.
    """
    rows = df.count() if rows is None else rows
    ranges = min(1 << 16, max(1, rows // ROWS_PER_BUCKET))
    base = df.select(
        *[quoted(k) for k in key_cols],
        F.col(target).cast("double").alias("_y"),
        F.array(*[quoted(f).cast("double") for f in features]).alias("_x"),
    ).where(F.col("_y").isNotNull() & ~F.exists("_x", lambda x: x.isNull()))
    copies = base.withColumn("_repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    keys = [F.coalesce(quoted(k).cast("string"), F.lit("")) for k in key_cols]
    keyed = copies.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_repeat").cast("string"), *keys)))
    place = F.conv(F.substring("_h", 1, 4), 16, 10).cast("int")
    keyed = keyed.withColumn("_range", F.floor(place * ranges / F.lit(1 << 16)).cast("int"))
    part = Window.partitionBy("_repeat", "_range").orderBy("_h", "_y", "_x")
    # one row a range: its last values, handed to the next range that has rows, and from the last range to the first
    ends = keyed.groupBy("_repeat", "_range").agg(F.max_by("_x", F.struct("_h", "_y", "_x")).alias("_end"))
    along = Window.partitionBy("_repeat").orderBy("_range")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = ends.select("_repeat", "_range", F.coalesce(F.lag("_end").over(along), F.last("_end").over(whole)).alias("_edge"))
    shuffled = keyed.withColumn("_before", F.lag("_x").over(part)).join(edges, ["_repeat", "_range"])
    shuffled = shuffled.withColumn("_other", F.coalesce("_before", "_edge"))
    variants = shuffled.select(
        "_repeat", "_range", "_y", "_x", "_other", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))).alias("_f")
    )
    # feature -1 is the unshuffled baseline
    vector = F.transform("_x", lambda x, i: F.when(i == F.col("_f"), F.get(F.col("_other"), i)).otherwise(x))
    scored = model.transform(variants.select("_repeat", "_range", "_f", "_y", array_to_vector(vector).alias("features")))
    gap = F.col("_y") - F.col("prediction")
    # a range adds up in its own order and ranges in theirs, so two runs agree to the last bit
    parts = scored.groupBy("_repeat", "_range", "_f").agg(F.sum(gap * gap).alias("_s"), F.count("*").alias("_c"))
    errors = parts.groupBy("_repeat", "_f").agg(
        F.sqrt(_ordered_sum("_range", "_s") / F.sum("_c")).alias("_rmse"))
    # repeats * (features + 1) rows from here on
    baseline = errors.where("_f = -1").select("_repeat", F.col("_rmse").alias("_base"))
    rises = errors.where("_f >= 0").join(baseline, "_repeat").withColumn("_rise", F.col("_rmse") - F.col("_base"))
    names = F.array(*[F.lit(f) for f in features])
    means = rises.groupBy("_f").agg((_ordered_sum("_repeat", "_rise") / F.count("*")).alias("importance"))
    far = rises.join(means, "_f").withColumn("_far", (F.col("_rise") - F.col("importance")) ** 2)
    return far.groupBy("_f").agg(
        F.first("importance").alias("importance"), F.sqrt(_ordered_sum("_repeat", "_far") / F.count("*")).alias("std")
    ).select(F.get(names, F.col("_f")).alias("feature"), "importance", "std")


def _ordered_sum(order: str, value: str) -> Column:
    listed = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.aggregate(listed, F.lit(0.0), lambda total, x: total + x[value])
