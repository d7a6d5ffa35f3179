from __future__ import annotations

import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoload.operators import bounds as B
from chronoload.operators import clean as C
from chronoload.operators import quantiles
from chronoload.operators.quantiles import exact_quantiles


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_clean_events_order_of_steps(spark):
    t = [datetime(2024, 1, 1, h) for h in range(6)]
    data = [
        (1, t[0], t[1], "a", 2.0),
        (1, t[0], t[1], "a", 2.0),  # exact copy
        (2, t[0], t[1], "a", 2.0),  # copy only after the projection: stays
        (3, None, t[1], "a", 2.0),
        (4, t[0], None, "a", 2.0),
        (5, t[2], t[3], "b", 2.0),
        (6, t[2], t[3], "a", 0.0),
        (7, t[2], t[3], "a", None),
        (8, t[2], t[5], "a", 5.0),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, "id int, starttime timestamp, endtime timestamp, type string, x double")
    cleaned, train = C.clean_and_split(
        df, "2024-01-01 05:00:00", keep_cols=["starttime", "endtime", "type", "x"], positive_cols=["x"], log_cols=["x"], types=["a"]
    )
    got = rows(cleaned.select("starttime", "endtime", "x", F.round("log_x", 9)), "starttime", "x")
    assert got == [(t[0], t[1], 2.0, round(np.log(3.0), 9))] * 2 + [(t[2], t[5], 5.0, round(np.log(6.0), 9))]
    assert train.count() == 2  # the last one ends exactly at the split
    assert C.train_rows(cleaned.drop("endtime"), "2024-01-01 05:00:00").count() == 3


def test_impute_energy(spark):
    df = spark.createDataFrame(
        [("J1772", None, 2.0), ("NEMA 5-20R", None, 2.0), ("other", None, 2.0), ("other", 7.0, 2.0)],
        "plug_type string, energy double, duration_hours double",
    )
    assert sorted(r.energy for r in C.impute_energy(df).collect()) == [3.0, 7.0, 12.0]


def test_sum_matching_and_ints(spark):
    df = spark.createDataFrame([(1, 2.0, 3, "x")], "w_rain_a int, w_rain_b double, other int, t string")
    out = C.sum_matching(C.sum_matching(df, "total", "rain"), "none", "storm")
    assert (out.first().total, out.first().none) == (3.0, 0.0)
    assert [t for _, t in C.ints_to_double(df).dtypes] == ["double", "double", "double", "string"]


# ------------------------------------------------------------------ quantiles


@pytest.mark.parametrize("accuracy", [50, 500, 20_000])
def test_exact_quantiles_of_hot_and_small_groups(spark, accuracy):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(
        {
            "g": ["hot"] * 20_000 + ["same"] * 5_000 + ["tiny"] * 3 + [None] * 40,
            "v": np.concatenate([rng.gamma(1.5, 10, 20_000).round(1), np.full(5_000, 4.5), [1.0, 2.0, 10.0], rng.normal(size=40)]),
        }
    )
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [0.001, 0.25, 0.5, 0.75, 0.999]
    got = {r.g: tuple(r)[1:] for r in exact_quantiles(df, "v", probs, ["g"], accuracy).collect()}
    for name, part in pdf.groupby("g", dropna=False):
        name = None if pd.isna(name) else name
        assert got[name][0] == len(part)
        np.testing.assert_allclose(got[name][1:], np.quantile(part.v, probs), rtol=1e-12)


def test_exact_quantiles_without_groups_and_with_nulls(spark):
    df = spark.createDataFrame([(None,), (3.0,), (1.0,), (2.0,)], "v double")
    assert rows(exact_quantiles(df, "v", [0.5, 0.75])) == [(3, 2.0, 2.5)]
    assert rows(exact_quantiles(df.where("v > 5"), "v", [0.5])) == []
    big = spark.range(100_000).select((F.col("id") * 7919 % 100_000).cast("double").alias("v"))
    assert rows(exact_quantiles(big, "v", [0.0, 0.5, 1.0], accuracy=100)) == [(100_000, 0.0, 49_999.5, 99_999.0)]


def test_exact_quantiles_bound_what_a_window_sees(spark):
    # one group of a million distinct values: the bins of the grid, then the parts of the open brackets
    v = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_000 + 0.25).alias("_v"))
    bins = quantiles.grid_counts(v, [], 256)
    assert bins.count() <= 22 * 16 and bins.agg(F.sum("_c")).first()[0] == 1_000_000
    widest = bins.orderBy(F.desc("_c")).first()
    bracket = spark.createDataFrame([([(widest._lo, widest._hi, 5, widest._c)],)], "_open array<struct<lo:double,hi:double,below:long,inside:long>>")
    parts = quantiles.bracket_counts(v, bracket, [], 256)
    assert widest._c > 30_000 and parts.count() <= 257 and parts.agg(F.sum("_c")).first()[0] == widest._c
    got = exact_quantiles(v, "_v", [0.1, 0.5, 0.999], accuracy=256).first()
    np.testing.assert_allclose(tuple(got)[1:], np.quantile(np.arange(1_000_000) + 0.25, [0.1, 0.5, 0.999]), rtol=1e-15)


def test_exact_quantiles_of_extreme_values(spark):
    inf = float("inf")
    values = [-inf, -1e308, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0 + 2**-50, 2.0, 1e308, inf, inf]
    df = spark.createDataFrame([(v,) for v in values] * 3, "v double")
    for accuracy in (2, 16, 4096):
        got = quantiles._order_statistics(df.selectExpr("v AS _v"), [], [k / 47 for k in range(48)], accuracy)
        assert [r._value for r in sorted(got.collect(), key=lambda r: r._rank)] == sorted(values * 3)
    with_nan = df.unionByName(spark.createDataFrame([(float("nan"),)], "v double"))
    assert math.isnan(exact_quantiles(with_nan, "v", [1.0]).first()[1]) and exact_quantiles(with_nan, "v", [0.5]).first()[1] == 1.0


def test_exact_quantiles_of_close_values_in_null_and_hot_groups(spark):
    rng = np.random.default_rng(11)
    close = 1e6 + rng.integers(0, 400, 3000) * 2.0**-30  # one bin of the grid, many repeats
    rows_ = [("hot", float(x)) for x in close] + [(None, float(x)) for x in range(7)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows_, "g string, v double").repartition(5)
    probs = [0.01, 0.25, 0.5, 0.99]
    got = {r.g: tuple(r)[1:] for r in exact_quantiles(df, "v", probs, ["g"], accuracy=16, extras=[F.count("*").alias("rows")]).collect()}
    np.testing.assert_allclose(got["hot"], (3000, 3000, *np.quantile(close, probs)), rtol=1e-15)
    np.testing.assert_allclose(got[None], (7, 7, *np.quantile(range(7), probs)))
    assert got["one"] == (1, 1, 4.0, 4.0, 4.0, 4.0) and got["none"] == (1, None, None, None, None, None)


# ------------------------------------------------------------------ median-deviation bounds


def plain_bounds(x, threshold):
    """The rule in plain numpy: (median, skewed, min, max)."""
    x = np.array(x, dtype=float)
    if len(set(x[~np.isnan(x)])) + int(np.isnan(x).any()) <= 2:
        return None, False, None, None
    v = x[~np.isnan(x)]
    med = np.median(v)
    m2 = ((x - x.mean()) ** 2).mean()
    skew = ((x - x.mean()) ** 3).mean() / m2**1.5
    if abs(skew) < 1:
        mad = np.median(np.abs(v - med))
        return med, False, med - threshold * mad, med + threshold * mad
    low, up = v[v < med], v[v >= med]
    down = med - threshold * np.median(np.abs(low - med)) if len(low) else None
    return med, True, down, med + threshold * np.median(np.abs(up - med))


CASES = {
    "two_values": [1, 1, 2, 2, 2],
    "one_value": [4, 4, 4],
    "symmetric": [1, 2, 3, 4, 5, 6, 7],
    "right_skewed": [1, 1.5, 2, 2, 3, 3, 4, 50, 90],
    "nothing_below": [1, 1, 1, 1, 1, 1, 2, 60],
    "with_null": [1, 2, 3, 4, 5, np.nan],
    "null_and_one": [2, 2, np.nan],
    "null_and_two": [2, 3, 3, np.nan],
    "all_null": [np.nan, np.nan],
}


def test_mad_bounds_follow_the_rule(spark):
    data = [(name, None if np.isnan(x) else float(x)) for name, xs in CASES.items() for x in xs]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: (r.median, r.skewed, r.min_val, r.max_val) for r in B.mad_bounds(df, ["v"], 3.5, ["g"]).collect()}
    for name, xs in CASES.items():
        want = plain_bounds(xs, 3.5)
        for a, b in zip(got[name], want, strict=True):
            assert a == pytest.approx(b) if b is not None and not isinstance(b, bool) else a == b, (name, got[name], want)


def test_mad_bounds_of_several_columns_without_groups(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=500), "b": rng.exponential(size=500)})
    got = {r["column"]: r for r in B.mad_bounds(spark.createDataFrame(pdf), ["a", "b"], 4).collect()}
    for c in ("a", "b"):
        med, skewed, low, high = plain_bounds(pdf[c], 4)
        assert got[c].skewed == skewed
        assert (got[c].median, got[c].min_val, got[c].max_val) == pytest.approx((med, low, high))


def test_cap_and_share(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)] + [(None,)], "v double")
    limits = spark.createDataFrame([("v", 2.0, 7.0)], "column string, min_val double, max_val double")
    capped = sorted((r.v for r in B.cap_to_bounds(df, limits, ["v"]).collect()), key=lambda x: (x is None, x))
    assert capped == [2.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 7.0, 7.0, None]
    assert B.outlier_share(df, limits, ["v"]).first().outlier_pct == pytest.approx(100 * 4 / 11)
    open_ended = spark.createDataFrame([("v", None, 7.0)], "column string, min_val double, max_val double")
    assert min(r.v for r in B.cap_to_bounds(df.dropna(), open_ended, ["v"]).collect()) == 0.0


def test_quantile_trim_is_strict_and_keeps_unseen_groups(spark):
    train = spark.createDataFrame([("a", float(x)) for x in range(1, 6)], "p string, kw double")
    limits = B.quantile_trim_bounds(train, "kw", 0.25, ["p"])
    assert rows(limits) == [("a", 2.0, 4.0)]
    df = spark.createDataFrame([("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", None), ("new", 99.0)], "p string, kw double")
    assert sorted((r.p, str(r.kw)) for r in B.quantile_trim(df, limits, "kw", ["p"]).collect()) == [
        ("a", "3.0"), ("a", "None"), ("new", "99.0"),
    ]


def test_log_bounds(spark):
    table = spark.createDataFrame([("log_v", 1.0, False, 0.0, 2.0)], "column string, median double, skewed boolean, min_val double, max_val double")
    row = B.bounds_from_log(table).first()
    assert (row["column"], row.min_val, row.max_val) == ("v", 0.0, pytest.approx(np.expm1(2.0)))
