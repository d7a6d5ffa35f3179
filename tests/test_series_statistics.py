from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoload.operators import scores as SC
from chronoload.operators import tsa


def per_series(pdf):
    return {s: p.y.to_numpy() for s, p in pdf.groupby("s")}


def plain_acf(y, lags):
    d = y - y.mean()
    return np.array([d[k:] @ d[: len(d) - k] for k in range(lags + 1)]) / (d @ d)


@pytest.mark.parametrize("block", [None, 60])
def test_acf(spark, hourly, block):
    df, pdf = hourly
    got = tsa.acf(df, "y", 48, ["s"], block_rows=block).orderBy("s", "lag").toPandas()
    for s, y in per_series(pdf).items():
        np.testing.assert_allclose(got[got.s == s].acf, plain_acf(y, 48), atol=1e-9)


def test_pacf_solves_yule_walker(spark, hourly):
    df, pdf = hourly
    got = tsa.pacf(df, "y", 12, ["s"]).orderBy("s", "lag").toPandas()
    for s, y in per_series(pdf).items():
        rho = plain_acf(y, 12)
        want = [1.0]
        for k in range(1, 13):
            matrix = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
            want.append(np.linalg.solve(matrix, rho[1 : k + 1])[-1])
        np.testing.assert_allclose(got[got.s == s].pacf, want, atol=1e-8)


def test_pacf_without_series(spark, hourly):
    df, pdf = hourly
    got = tsa.pacf(df.where("s = 'a'").drop("s"), "y", 3).orderBy("lag").toPandas()
    assert got.pacf[1] == pytest.approx(plain_acf(per_series(pdf)["a"], 1)[1])


@pytest.mark.parametrize("regression, trend", [("c", 0), ("ct", 1), ("ctt", 2)])
def test_adf_equals_ordinary_least_squares(spark, hourly, regression, trend):
    df, pdf = hourly
    lags = 5
    got = {r.s: r for r in tsa.adf(df, "y", lags, regression, ["s"], start="2024-01-01", block_rows=100).collect()}
    for s, y in per_series(pdf).items():
        d = np.diff(y)
        rows = range(lags, len(d))
        x = np.array([[y[i], *[d[i - k] for k in range(1, lags + 1)], 1.0, *[(i + 1.0) ** p for p in range(1, trend + 1)]] for i in rows])
        target = d[lags:]
        beta, *_ = np.linalg.lstsq(x, target, rcond=None)
        resid = target - x @ beta
        cov = resid @ resid / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)
        assert got[s].n == len(x)
        assert got[s].statistic == pytest.approx(beta[0] / np.sqrt(cov[0, 0]), rel=1e-5)
        assert got[s].stationary == (got[s].p_value <= 0.05 and got[s].statistic < got[s].crit_5)


def test_unit_root_p_values_agree_with_the_critical_values():
    for regression, crit in tsa.CRITICAL_VALUES.items():
        for level, p in (("1%", 0.01), ("5%", 0.05), ("10%", 0.10)):
            assert tsa.unit_root_p_value(crit[level][0], regression) == pytest.approx(p, rel=0.06)
    assert tsa.unit_root_p_value(-50, "c") == 0.0 and tsa.unit_root_p_value(5, "ct") == 1.0
    with pytest.raises(ValueError):
        tsa.adf(None, "y", 1, "n")


@pytest.mark.parametrize("regression", ["c", "ct"])
def test_kpss(spark, hourly, regression):
    df, pdf = hourly
    lags = 9
    got = {r.s: r for r in tsa.kpss(df, "y", lags, regression, ["s"], start="2024-01-01", block_rows=100).collect()}
    for s, y in per_series(pdf).items():
        t = np.arange(len(y))
        e = y - y.mean() if regression == "c" else y - np.polyval(np.polyfit(t, y, 1), t)
        n = len(e)
        s2 = e @ e / n + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[: n - k]) / n for k in range(1, lags + 1))
        stat = (np.cumsum(e) ** 2).sum() / n**2 / s2
        assert got[s].statistic == pytest.approx(stat, rel=1e-9)
        table = tsa.KPSS_CRITICAL[regression]
        assert got[s].p_value == pytest.approx(np.interp(stat, table, tsa.KPSS_LEVELS))


def test_automatic_lags(spark, hourly):
    df, pdf = hourly
    got = {r.s: r.lags for r in tsa.automatic_kpss_lags(df, "y", 600, ["s"]).collect()}
    for s, y in per_series(pdf).items():
        e, n = y - y.mean(), len(y)
        s0, s1 = e @ e / n, 0.0
        for k in range(1, int(n ** (2 / 9)) + 1):
            g = e[k:] @ e[: n - k] / (n / 2)
            s0, s1 = s0 + g, s1 + k * g
        assert got[s] == int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3))


def plain_decompose(y, period):
    half = period // 2
    w = np.ones(period + 1) / period if period % 2 == 0 else np.ones(period) / period
    if period % 2 == 0:
        w[[0, -1]] /= 2
    trend = np.full(len(y), np.nan)
    trend[half : len(y) - half] = np.convolve(y, w, "valid")
    means = np.array([np.nanmean((y - trend)[i::period]) for i in range(period)])
    seasonal = np.resize(means - means.mean(), len(y))
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("period", [24, 7])
def test_decomposition(spark, hourly, period):
    df, pdf = hourly
    got = tsa.decompose(df, "y", period, ["s"], start="2024-01-01", block_rows=50).orderBy("s", "timestamp").toPandas()
    for s, y in per_series(pdf).items():
        mine = got[got.s == s]
        for name, want in zip(("trend", "seasonal", "resid"), plain_decompose(y, period)):
            np.testing.assert_allclose(mine[name].astype(float), want, atol=1e-9)


def test_multi_seasonal_outliers_find_spikes_and_take_parameters(spark, hourly):
    _, pdf = hourly
    pdf = pdf[pdf.s == "a"].copy()
    pdf.loc[pdf.index[300], "y"] += 60
    df = spark.createDataFrame(pdf)
    flagged = tsa.multi_seasonal_outliers(df, "y", (24, 168), 5.0, ["s"], start="2024-01-01").where("outlier = 1")
    # the weekly mean takes part of a spike over to the same hour of the other weeks
    spike = pdf.timestamp.iloc[300]
    found = {r.timestamp: abs(r.resid) for r in flagged.collect()}
    assert max(found, key=found.get) == spike.to_pydatetime()
    assert {(t.hour, t.weekday()) for t in found} == {(spike.hour, spike.weekday())}
    loose = spark.createDataFrame([("a", 0.0, 1e9)], "s string, median double, sigma double")
    assert tsa.multi_seasonal_outliers(df, "y", (24, 168), 5.0, ["s"], start="2024-01-01", params=loose).where("outlier = 1").count() == 0


# ------------------------------------------------------------------ scores


def frame(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 3))
    pdf = pd.DataFrame(x, columns=["strong", "weak", "it's none"])
    pdf["flat"] = 1.0
    pdf["y"] = 3 * pdf.strong + 0.9 * pdf.weak + rng.normal(size=800)
    return spark.createDataFrame(pdf), pdf


def test_correlations_and_f_scores(spark):
    df, pdf = frame(spark)
    names = ["strong", "weak", "it's none", "flat"]
    got = {r.feature: r.correlation for r in SC.correlations(df, names, "y").collect()}
    f = {r.feature: r.score for r in SC.f_scores(df, names, "y").collect()}
    for n in names[:3]:
        r = np.corrcoef(pdf[n], pdf.y)[0, 1]
        assert got[n] == pytest.approx(r) and f[n] == pytest.approx(r * r / (1 - r * r) * 798)
    assert got["flat"] is None and f["flat"] is None
    assert [r.feature for r in SC.top_features(SC.f_scores(df, names, "y"), 2).collect()] == ["strong", "weak"]


def test_mutual_information_by_hand(spark):
    df, pdf = frame(spark)
    got = {r.feature: r.score for r in SC.mutual_information(df, ["strong", "it's none"], "y", 5).collect()}
    q = np.arange(1, 5) / 5
    by = np.searchsorted(np.quantile(pdf.y, q), pdf.y)
    for n in ("strong", "it's none"):
        bx = np.searchsorted(np.quantile(pdf[n], q), pdf[n])
        joint = np.histogram2d(bx, by, bins=[range(6), range(6)])[0] / len(pdf)
        outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
        want = (joint[joint > 0] * np.log(joint[joint > 0] / outer[joint > 0])).sum()
        assert got[n] == pytest.approx(want)


def test_forecast_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, None)], "y double, p double")
    row = SC.forecast_errors(df, "y", "p").first()
    assert (row.rmse, row.mae, row.mean_load, row.n) == (pytest.approx(np.sqrt(0.5)), 0.5, 2.0, 2)
    assert [r.residual for r in SC.residuals(df.dropna(), "y", "p").collect()] == [-1.0, 0.0]
    assert SC.ranked(df.select(F.lit("b").alias("feature"), F.col("y").alias("score"))).first().score == 5.0
