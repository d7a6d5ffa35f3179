from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoload.operators import grid as G
from chronoload.operators import seasonal as S
from chronoload.operators import trend as TR
from chronoload.operators import windows as W
from chronoload.operators.blocks import block_scan
from chronoload.operators.events import split_by_hour
from chronoload.plans import enrich as E
from chronoload.session import new_path


def split(spark, start, minutes):
    df = spark.createDataFrame([(datetime.fromisoformat(start), float(minutes), 2.5)], "starttime timestamp, duration double, distance double")
    return [(r.timestamp, r.duration, r.distance) for r in split_by_hour(df).orderBy("timestamp").collect()]


def test_split_by_hour_edges(spark):
    day = datetime(2024, 1, 1)
    assert split(spark, "2024-01-01 10:30:00", 30) == [(day.replace(hour=10), 30.0, 2.5)]
    assert split(spark, "2024-01-01 10:30:00", 31) == [(day.replace(hour=10), 30.0, 2.5), (day.replace(hour=11), 1.0, 2.5)]
    assert split(spark, "2024-01-01 10:30:00", 0) == []
    assert split(spark, "2024-01-01 10:30:00", -5) == []
    assert split(spark, "2024-01-01 10:00:00", 0.5) == [(day.replace(hour=10), 0.5, 2.5)]
    long = split(spark, "2024-01-01 23:50:00", 1500)
    assert [x[1] for x in long] == [10.0] + [60.0] * 24 + [50.0]
    assert long[0][0] == day.replace(hour=23) and long[-1][0] == datetime(2024, 1, 3, 0)


def test_split_by_hour_conserves_minutes(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": range(300), "starttime": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 10**6, 300), unit="s"), "duration": rng.exponential(200, 300)})
    got = split_by_hour(spark.createDataFrame(pdf)).groupBy("id").agg(F.sum("duration").alias("d"), F.max("duration").alias("m")).toPandas().set_index("id")
    np.testing.assert_allclose(got.d.sort_index(), pdf.duration, atol=1e-6)
    assert got.m.max() <= 60


def test_align_fills_and_drops_off_grid_rows(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", t, 1.0, 5.0), ("a", t + timedelta(hours=2), 2.0, None), ("b", t + timedelta(hours=50), 9.0, 9.0), (None, t, 1.0, 1.0)],
        "s string, timestamp timestamp, load double, temp double",
    )
    out = G.align(df, "2024-01-01", "2024-01-01 03:00:00", ["s"], ["load"]).orderBy("s", "timestamp").collect()
    assert [(r.s, r.timestamp.hour, r.load, r.temp) for r in out] == [
        (None, 0, 1.0, 1.0), (None, 1, 0.0, None), (None, 2, 0.0, None),
        ("a", 0, 1.0, 5.0), ("a", 1, 0.0, None), ("a", 2, 2.0, None), ("b", 0, 0.0, None), ("b", 1, 0.0, None), ("b", 2, 0.0, None),
    ]
    hours = G.align(df.select("s", "timestamp", "load"), "2024-01-01", "2024-01-01 03:00:00", ["s"])
    both = G.combine({"x": hours, "y": hours.withColumnRenamed("load", "other")}, 3, ["s"])
    assert both.columns == ["s", "timestamp", "load", "other"] and both.where("s IS NULL").count() == 3
    alone = G.align(df.where("s = 'a'").drop("s"), "2024-01-01", "2024-01-02", (), ["load"])
    assert alone.count() == 24


def test_pivot_sums(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, "Rain", "Light", 2.0), (t, "Rain", "Light", 3.0), (t, "Fog", "Heavy", 1.0), (t, "Hail", "Light", 7.0)], "t timestamp, type string, sev string, d double")
    out = G.pivot_sums(df, ["t"], ["type", "sev"], [("Rain", "Light"), ("Fog", "Heavy"), ("Fog", "Light")], ["d"], lambda c, p: f"w_{p[0]}_{p[1]}_dur".lower())
    assert out.columns == ["t", "w_rain_light_dur", "w_fog_heavy_dur", "w_fog_light_dur"]
    assert tuple(out.first())[1:] == (5.0, 1.0, 0.0)


def test_pivot_loses_no_amount(spark):
    t = datetime(2024, 1, 1)
    rows = [(t, "Rain", "Light", 2.0), (t, "Hail", "Light", 7.0), (t, "Rain", None, 1.0), (t, None, "Light", 4.0), (t, None, None, 0.5)]
    df = spark.createDataFrame(rows, "t timestamp, type string, sev string, d double").withColumn("e", F.col("d") * 10)
    name = lambda c, p: f"{c}_{'_'.join(p)}"
    out = G.pivot_sums(df, ["t"], ["type", "sev"], [("Rain", "Light")], ["d", "e"], name, rest=("rest",)).first()
    assert out.asDict() == {"t": t, "d_Rain_Light": 2.0, "d_rest": 12.5, "e_Rain_Light": 20.0, "e_rest": 125.0}
    period = E.Period("2024-01-01", "2024-01-02", "2024-01-02")
    log = spark.createDataFrame(
        [(t + timedelta(hours=k), t + timedelta(hours=k, minutes=20 + k), "Rain", s) for k, s in enumerate(["Light", "Light", "New", None])],
        "starttime timestamp, endtime timestamp, type string, severity string")
    rules = dict(types=["Rain"], severities=["Light"], rollups={"w_rain_dur": "rain"})
    out = E.incidents_to_hours(log, period, E.weather_rules(**rules, other="other"))
    sums = out.agg(*[F.sum(c).alias(c) for c in ("w_rain_light_dur", "w_rain_other_dur", "w_rain_dur")]).first()
    assert out.count() == 24 and sums.w_rain_other_dur > 0 and sums.w_rain_dur == sums.w_rain_light_dur + sums.w_rain_other_dur
    with pytest.raises(Exception, match="severity not listed"):
        E.incidents_to_hours(log, period, E.weather_rules(**rules)).collect()


def test_alignment_scans_its_source_once(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(1000).selectExpr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id % 24) AS ts", "id % 3 AS s", "id AS x").write.parquet(path)
    sums = G.resample(spark.read.parquet(path), "ts", [F.sum("x").alias("x")], ["s"])
    out = G.align(sums, "2024-01-01", "2024-01-02", ["s"], ["x"])
    assert out.count() == 72
    plan = out._jdf.queryExecution().executedPlan().toString()
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final or final.count("Scan parquet") == 1, plan


def test_validation(spark, hourly):
    df, _ = hourly
    assert G.require_complete(df, 600, "y", ["s"])[0] == datetime(2024, 1, 1)
    with pytest.raises(ValueError, match="expected 601"):
        G.require_complete(df, 601, "y", ["s"])
    doubled = df.where("s = 'a'").withColumn("timestamp", F.date_trunc("DAY", "timestamp"))
    with pytest.raises(ValueError, match="distinct"):
        G.require_complete(doubled, 600, "y", ["s"])
    with pytest.raises(TypeError):
        G.require_complete(df.withColumn("timestamp", F.col("timestamp").cast("string")), 600, "y", ["s"])
    later = df.where("s = 'a'").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 HOUR"))
    with pytest.raises(ValueError, match="misaligned"):
        G.combine({"a": df.where("s = 'a'"), "b": later}, 600, ["s"])


def plain_history(pdf, lags, sums, means):
    out = pdf.sort_values("timestamp").copy()
    for k in lags:
        out[f"y_lag_{k}"] = out.y.shift(k)
    for w in sums:
        out[f"y_rw_{w}_sum"] = out.y.shift(1).rolling(w).sum()
    for w in means:
        out[f"y_rw_{w}_mean"] = out.y.shift(1).rolling(w).mean()
    return out


@pytest.mark.parametrize("block", [None, 30, 200])
def test_history_features_equal_pandas_for_any_block_size(spark, hourly, block):
    _, pdf = hourly
    pdf = pdf.copy()
    pdf.loc[[50, 51, 300, 900], "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    got = W.history_features(df, {"y": [1, 24], "no": [1]}, {"y": [3, 24]}, {"y": [1, 12]}, ["s"], block_rows=block)
    got = got.orderBy("s", "timestamp").toPandas()
    want = pd.concat([plain_history(p, [1, 24], [3, 24], [1, 12]) for _, p in pdf.groupby("s")]).sort_values(["s", "timestamp"])
    assert len(got) == len(pdf)
    for c in want.columns[3:]:
        np.testing.assert_allclose(got[c].astype(float), want[c], atol=1e-9, err_msg=c)


def test_history_does_not_show_block_borders_gaps_or_spikes(spark):
    times = pd.date_range("2024-01-01", periods=400, freq="h")
    y = np.tile([0.1, 0.2, 0.3, 0.4], 100)
    y[20], y[200] = np.nan, 1e17
    pdf = pd.DataFrame({"timestamp": times, "y": y})
    gone = [23, 47, 48, 49, 100, 101, 203]
    df = spark.createDataFrame(pdf.drop(index=gone))
    whole = pdf.copy()
    whole.loc[gone, "y"] = np.nan
    want = plain_history(whole, [1, 24], [], []).drop(index=gone)
    for w in (3, 24):  # summed window by window
        want[f"y_rw_{w}_sum"] = [whole.y[i - w : i].to_numpy().sum() if i >= w else np.nan for i in want.index]
    for block in (24, 51, 1344):
        got = W.history_features(df, {"y": [1, 24]}, {"y": [3, 24]}, block_rows=block).orderBy("timestamp").toPandas()
        for c in want.columns[2:]:
            np.testing.assert_allclose(got[c].astype(float), want[c], rtol=1e-12, err_msg=f"{c} {block}")
        stats = W.trailing_stats(df, "y", [3], block_rows=block).orderBy("timestamp").toPandas()
        assert list(stats.y_mean_3.notna()) == [whole.y[max(0, i - 2) : i + 1].count() == 3 for i in want.index]
        diff = W.seasonal_difference(df.where("NOT isnan(y)"), "y", 24, block_rows=block)
        assert diff.count() == int(whole.y.diff(24).notna().sum())


def test_rolling_needs_its_column(spark, hourly):
    with pytest.raises(ValueError):
        W.rolling_features(hourly[0], {"no": [3]}, "sum", series_cols=["s"])
    with pytest.raises(ValueError):
        W.rolling_features(hourly[0], {"y": [3]}, "max", series_cols=["s"])


def test_trailing_stats_and_difference(spark, hourly):
    df, pdf = hourly
    got = W.trailing_stats(df, "y", [24], ["s"], block_rows=50).orderBy("s", "timestamp").toPandas()
    want = pdf.groupby("s").y.rolling(24)
    np.testing.assert_allclose(got.y_mean_24.astype(float), want.mean().to_numpy(), atol=1e-9)
    np.testing.assert_allclose(got.y_var_24.astype(float), want.var().to_numpy(), atol=1e-9)
    diff = W.seasonal_difference(df, "y", 24, ["s"], block_rows=40).orderBy("s", "timestamp").toPandas()
    np.testing.assert_allclose(diff.y_diff_24, pdf.groupby("s").y.diff(24).dropna().to_numpy(), atol=1e-9)


@pytest.mark.parametrize("kind", ["last", "sum", "min", "max"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_block_scan_equals_one_plain_window(spark, kind, inclusive):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"s": np.repeat(["a", "b"], 100), "i": list(range(100)) * 2, "v": rng.normal(size=200).round(3)})
    pdf.loc[rng.choice(200, 120, replace=False), "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    w = Window.partitionBy("s").orderBy("i").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    plain = {"last": F.last("v", True), "sum": F.sum("v"), "min": F.min("v"), "max": F.max("v")}[kind].over(w)
    want = df.withColumn("x", plain).orderBy("s", "i").toPandas()
    got = block_scan(df, F.col("v"), "x", kind, ["s"], F.col("i"), "i", 7, inclusive).orderBy("s", "i").toPandas()
    np.testing.assert_allclose(got.x.astype(float), want.x.astype(float), atol=1e-9)


def test_impute_from_history(spark):
    times = [datetime(2020 + y, 1, 1) + timedelta(hours=h) for y in range(2) for h in range(3)]
    temps = [None, 4.0, None, 6.0, None, None]
    df = spark.createDataFrame(list(zip(times, temps)), "timestamp timestamp, temp double")
    got = S.impute_from_history(df, "temp", block_rows=2).orderBy("timestamp").collect()
    # hour 0 of the first day has no history; hour 2 takes the value carried from hour 1; in the second
    # year hour 1 has its own history and hour 2 again takes what was carried
    assert [r.temp for r in got] == [None, 4.0, 4.0, 6.0, 4.0, 4.0]
    assert [r.temp_imputed for r in got] == [1, 0, 1, 0, 1, 1]


def plain_flags(values, times, k, min_samples, params=None):
    seen, flags = {}, []
    for i, (x, t) in enumerate(zip(values, times)):
        key = (t.hour, t.weekday())
        if params is None:
            past = seen.setdefault(key, [])
            med = np.median(past) if past else np.nan
            mad = np.median(np.abs(np.array(past) - med)) if past else 0
            past.append(x)
        else:
            med, mad = params.get(key, (np.nan, 0))
        flags.append(int((i >= min_samples or params is not None) and mad > 0 and abs(x - med) > k * 1.4826 * mad))
    return flags


def test_expanding_and_frozen_flags(spark):
    rng = np.random.default_rng(8)
    times = pd.date_range("2024-01-01", periods=24 * 7 * 12, freq="h")
    y = rng.normal(50, 3, len(times))
    y[rng.choice(len(y), 60, replace=False)] += 40
    y[times.hour == 3] = 0.0  # no spread: never flagged
    y[np.flatnonzero(times.hour == 3)[-1]] = 99.0
    df = spark.createDataFrame(pd.DataFrame({"timestamp": times, "y": y}))
    got = S.expanding_mad_flags(df, "y", "2024-01-01", 3.5, 720).orderBy("timestamp").toPandas()
    assert list(got.outlier) == plain_flags(y, times, 3.5, 720)
    assert list(got.weekday) == [t.weekday() for t in times] and got.outlier.sum() > 10

    cut = "2024-03-01"
    train = times < pd.Timestamp(cut)
    params = {}
    for key, part in pd.Series(y[train]).groupby([times[train].hour, times[train].weekday]):
        med = np.median(part)
        params[key] = (med, np.median(np.abs(part - med)))
    out = S.load_outliers(df, "y", "2024-01-01", cut, 3.5, 720).orderBy("timestamp").toPandas()
    want = plain_flags(y[train], times[train], 3.5, 720) + plain_flags(y[~train], times[~train], 3.5, 0, params)
    assert list(out.outlier) == want


def test_first_judged_row_is_at_min_samples(spark):
    times = pd.date_range("2024-01-01", periods=24 * 7 * 5, freq="h")
    y = np.where(np.arange(len(times)) % 2 == 0, 1.0, 2.0) + np.arange(len(times)) // 168 * 0.1
    y[24 * 7 * 3], y[24 * 7 * 3 + 1] = 500.0, 500.0
    df = spark.createDataFrame(pd.DataFrame({"timestamp": times, "y": y}))
    flagged = S.expanding_mad_flags(df, "y", "2024-01-01", 3.5, 24 * 7 * 3 + 1).where("outlier = 1").orderBy("timestamp").first()
    assert flagged.timestamp == times[24 * 7 * 3 + 1].to_pydatetime()


def test_slots_without_parameters_are_not_outliers(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5), 1e9)], "timestamp timestamp, y double")
    params = spark.createDataFrame([(6, 0, 1.0, 1.0)], "hour int, weekday int, median double, sigma double")
    assert S.frozen_mad_flags(df, params, "y").first().outlier == 0


def test_trend_round_trip_and_store(spark, hourly):
    from chronoload.sources.stages import upsert_trend

    df, pdf = hourly
    trend = TR.ols_trend(df, "y", "2024-01-01", ["s"])
    got = {r.s: (r.slope, r.intercept) for r in trend.collect()}
    for s, p in pdf.groupby("s"):
        assert got[s] == pytest.approx(tuple(np.polyfit(np.arange(600), p.y, 1)))
    flat = TR.remove_trend(df, trend, "y", "2024-01-01", ["s"])
    assert abs(flat.agg(F.avg("y")).first()[0]) < 1e-9
    back = TR.add_trend(flat, trend, "y", "2024-01-01", ["s"]).join(df.withColumnRenamed("y", "y0"), ["s", "timestamp"])
    assert back.agg(F.max(F.abs(F.col("y") - F.col("y0")))).first()[0] < 1e-9

    path = new_path(spark, "trend")
    records = TR.trend_records(trend, "2024-01-01", "2024-01-20", "2024-01-26")
    assert upsert_trend(records, path, ("s", "date_key")).count() == 2
    changed = records.withColumn("slope", F.lit(0.0)).unionByName(records.withColumn("date_key", F.lit("other")))
    store = upsert_trend(changed, path, ("s", "date_key"))
    assert store.count() == 4 and store.where("slope = 0").count() == 0
