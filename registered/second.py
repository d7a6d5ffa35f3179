"""Window operators, calendar features, series statistics, scores and run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoload.functions import holidays as H
from chronoload.operators import clean as C
from chronoload.operators import grid as G
from chronoload.operators import scores as SC
from chronoload.operators import seasonal as S
from chronoload.operators import trend as TR
from chronoload.operators import tsa, windows
from chronoload.plans.features import cyclic_features
from chronoload.streaming import load as STR
from chronoload.session import new_path, prepare, stage
from chronoload.sources.stages import write_stage
from chronoload.training import folds, forecast, runs
from registered import views as v
from registered.first import TREND_SQL
from registered.views import END, SPLIT, START, q, with_views

QUERIES, SQL = {}, {}


def register(name, sql=None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


KEY = ["event_type"]
_W = "(PARTITION BY event_type ORDER BY timestamp)"
_POS = f"date_diff('hour', TIMESTAMP '{START}', timestamp)"

# ---------------------------------------------------------------- E: windows


def rolling_sql(col, width, how, part=f"PARTITION BY event_type ORDER BY timestamp", places=6):
    frame = f"({part} ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
    fn = "sum" if how == "sum" else "avg"
    return q(f"CASE WHEN count({col}) OVER {frame} = {width} THEN {fn}({col}) OVER {frame} END", f"{col}_rw_{width}_{how}", places)


LAGS = (1, 3, 6, 24, 168)
WIDTHS = (3, 6, 12, 24, 168)


@register("e1_lag_features", with_views("load_hourly", f"""SELECT event_type, timestamp, {q('load')}, {', '.join(q(f'lag(load, {k}) OVER {_W}', f'load_lag_{k}') for k in LAGS)} FROM load_hourly"""))
def e1(spark, sf):
    return v.r(windows.lag_features(v.load_hourly(spark, sf), {"load": LAGS, "absent": [1]}, series_cols=KEY))


@register("e2_rolling_sums", with_views("load_hourly", f"""SELECT event_type, timestamp, {q('load')}, {', '.join(rolling_sql('load', w, 'sum') for w in WIDTHS)} FROM load_hourly"""))
def e2(spark, sf):
    return v.r(windows.rolling_features(v.load_hourly(spark, sf), {"load": WIDTHS}, "sum", series_cols=KEY))


_GAPS = "(SELECT event_type, timestamp, CASE WHEN load > 0 THEN load END AS gap FROM load_hourly)"


@register("e3_rolling_means_with_gaps", with_views("load_hourly", f"""SELECT event_type, timestamp, {q('gap')}, {', '.join(rolling_sql('gap', w, 'mean') for w in WIDTHS)} FROM {_GAPS}"""))
def e3(spark, sf):
    df = v.load_hourly(spark, sf).select("event_type", "timestamp", F.when(F.col("load") > 0, F.col("load")).alias("gap"))
    return v.r(windows.rolling_features(df, {"gap": WIDTHS}, "mean", series_cols=KEY))


@register("e4_expanding_seasonal_mean", with_views("load_daily", f"""SELECT timestamp, {q('x', places=2)}, {q('avg(x) OVER (PARTITION BY hour(timestamp), dayofyear(timestamp) ORDER BY timestamp)', 'avg_x', 2)}
  FROM (SELECT timestamp, CASE WHEN month(timestamp) % 5 != 0 OR year(timestamp) > 1997 THEN load END AS x FROM load_daily)"""))
def e4(spark, sf):
    df = v.load_daily(spark, sf).select("timestamp", F.when((F.month("timestamp") % 5 != 0) | (F.year("timestamp") > 1997), F.col("load")).alias("x"))
    return v.r(S.expanding_mean(df, "x"), 2)


_TEMP_GRID = """means AS (SELECT s.station, h.timestamp, t.temp FROM (SELECT DISTINCT station FROM temps) s CROSS JOIN hours h
  LEFT JOIN (SELECT station, starttime, avg(temp) AS temp FROM temps GROUP BY 1, 2) t ON t.station IS NOT DISTINCT FROM s.station AND t.starttime = h.timestamp)"""


def _temp_grid(spark, sf):
    means = G.resample(v.temps(spark, sf), "starttime", [F.avg("temp").alias("temp")], ["station"])
    return G.align(means, START, END, ["station"])


@register("e5_forward_fill", with_views("temps hours", f"""{_TEMP_GRID} SELECT station, timestamp, {q('temp')}, {q('last_value(temp IGNORE NULLS) OVER (PARTITION BY station ORDER BY timestamp ROWS UNBOUNDED PRECEDING)', 'filled')} FROM means"""))
def e5(spark, sf):
    return v.r(S.forward_fill(_temp_grid(spark, sf), "temp", ["station"], out="filled"))


SLOTS_SQL = "CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) - 1 AS INTEGER) AS weekday"


def past_flags_sql(src, value, k, min_samples, key="event_type, "):
    return f"""SELECT * EXCLUDE (med, md), CAST(CASE WHEN {_POS} >= {min_samples} AND md > 0 AND abs({value} - med) > {k} * (1.4826 * md) THEN 1 ELSE 0 END AS INTEGER) AS outlier
  FROM (SELECT *, median({value}) OVER w AS med, mad({value}) OVER w AS md FROM (SELECT *, {SLOTS_SQL} FROM {src})
  WINDOW w AS (PARTITION BY {key}hour, weekday ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def frozen_flags_sql(train, test, value, k, key=("event_type",)):
    on = " AND ".join(f"t.{c} = p.{c}" for c in (*key, "hour", "weekday"))
    cols = ", ".join((*key, "hour", "weekday"))
    return f"""SELECT t.*, CAST(coalesce(CASE WHEN md > 0 AND abs(t.{value} - med) > {k} * (1.4826 * md) THEN 1 ELSE 0 END, 0) AS INTEGER) AS outlier
  FROM (SELECT *, {SLOTS_SQL} FROM {test}) t LEFT JOIN (SELECT {cols}, median({value}) AS med, mad({value}) AS md FROM (SELECT *, {SLOTS_SQL} FROM {train}) GROUP BY {cols}) p ON {on}"""


@register("e6_expanding_mad_flags", with_views("load_hourly", f"SELECT event_type, timestamp, hour, weekday, {q('load')}, outlier FROM ({past_flags_sql('load_hourly', 'load', 3.5, 240)})"))
def e6(spark, sf):
    return v.r(S.expanding_mad_flags(v.load_hourly(spark, sf), "load", START, 3.5, 240, KEY))


def _split(spark, sf):
    load = v.load_hourly(spark, sf)
    return C.train_rows(load, SPLIT, "timestamp"), C.test_rows(load, SPLIT, "timestamp")


_TRAIN = f"(SELECT * FROM load_hourly WHERE timestamp < TIMESTAMP '{SPLIT}')"
_TEST = f"(SELECT * FROM load_hourly WHERE timestamp >= TIMESTAMP '{SPLIT}')"
E7_SQL = with_views("load_hourly", f"SELECT event_type, timestamp, hour, weekday, {q('load')}, outlier FROM ({frozen_flags_sql(_TRAIN, _TEST, 'load', 3.0)})")


@register("e7_c5_frozen_mad_flags", E7_SQL)
def e7(spark, sf):
    train, test = _split(spark, sf)
    return v.r(S.frozen_mad_flags(test, S.seasonal_params(train, "load", KEY), "load", 3.0, KEY))


def _trailing(w):
    f = f"(PARTITION BY event_type ORDER BY timestamp ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return ", ".join([q(f"CASE WHEN count(load) OVER {f} = {w} THEN avg(load) OVER {f} END", f"load_mean_{w}"),
                      q(f"CASE WHEN count(load) OVER {f} = {w} THEN var_samp(load) OVER {f} END", f"load_var_{w}", 4)])


@register("e8_trailing_mean_and_variance", with_views("load_hourly", f"SELECT event_type, timestamp, {q('load')}, {_trailing(24)}, {_trailing(168)} FROM load_hourly"))
def e8(spark, sf):
    out = v.r(windows.trailing_stats(v.load_hourly(spark, sf), "load", [24, 168], KEY), 6, ["load", "load_mean_24", "load_mean_168"])
    return v.r(out, 4, ["load_var_24", "load_var_168"])


@register("e9_seasonal_difference", with_views("load_hourly", f"SELECT * FROM (SELECT event_type, timestamp, {q('load')}, {q(f'load - lag(load, 24) OVER {_W}', 'load_diff_24')} FROM load_hourly) WHERE load_diff_24 IS NOT NULL"))
def e9(spark, sf):
    return v.r(windows.seasonal_difference(v.load_hourly(spark, sf), "load", 24, KEY))


@register("e10_detrended_load", with_views("load_hourly", f"t AS ({TREND_SQL}) SELECT l.event_type, timestamp, {_POS} AS position, {q(f'load - (slope * {_POS} + intercept)', 'load')} FROM load_hourly l JOIN t USING (event_type)"))
def e10(spark, sf):
    load = v.load_hourly(spark, sf)
    trend = TR.ols_trend(C.train_rows(load, SPLIT, "timestamp"), "load", START, KEY)
    from chronoload.functions.timefns import steps_since

    return v.r(TR.remove_trend(load, trend, "load", START, KEY).withColumn("position", steps_since("timestamp", START)))


@register("e11_trend_added_back", with_views("load_hourly", f"t AS ({TREND_SQL}) SELECT l.event_type, timestamp, {q(f'load + (slope * {_POS} + intercept)', 'load')} FROM load_hourly l JOIN t USING (event_type) WHERE timestamp >= TIMESTAMP '{SPLIT}'"))
def e11(spark, sf):
    train, test = _split(spark, sf)
    return v.r(TR.add_trend(test, TR.ols_trend(train, "load", START, KEY), "load", START, KEY))


# ---------------------------------------------------------------- H: calendar


@register("h5_cyclic_encodings", with_views("load_hourly", "SELECT event_type, timestamp, " + ", ".join(
    q(f"{fn}(2 * pi() * {part} / {period}.0)", f"{name}_{fn}", 8)
    for name, part, period in (("month", "month(timestamp)", 12), ("weekday", "(isodow(timestamp) - 1)", 7), ("hour", "hour(timestamp)", 24)) for fn in ("sin", "cos")) + " FROM load_hourly"))
def h5(spark, sf):
    return v.r(cyclic_features(v.load_hourly(spark, sf).drop("load")), 8)


def _holiday_sql():
    near = "CASE isodow({d}) WHEN 6 THEN {d} - 1 WHEN 7 THEN {d} + 1 ELSE {d} END"
    parts = []
    for name, m, d, since in H.FIXED_DATE:
        day = f"make_date(y, {m}, {d})"
        parts.append(f"SELECT $${name}$$ AS holiday, {near.format(d=day)} AS ds, TRUE AS federal, y FROM years WHERE y >= {since or 0}")
    for name, m, wd, nth, since in H.NTH_WEEKDAY:
        first = f"make_date(y, {m}, 1)"
        if nth > 0:
            day = f"{first} + CAST(({wd} + 7 - (isodow({first}) - 1)) % 7 + {7 * (nth - 1)} AS INTEGER)"
        else:
            last = f"last_day({first})"
            day = f"{last} - CAST((isodow({last}) - 1 - {wd} + 7) % 7 AS INTEGER)"
        parts.append(f"SELECT $${name}$$, {day}, TRUE, y FROM years WHERE y >= {since or 0}")
    for name, m, d in H.EXTRA:
        parts.append(f"SELECT $${name}$$, make_date(y, {m}, {d}), FALSE, y FROM years")
    return f"""span AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
  years AS (SELECT unnest(generate_series(year(lo) - 1, year(hi) + 1)) AS y FROM span),
  listed AS ({' UNION ALL '.join(parts)}),
  hol AS (SELECT CAST(ds AS TIMESTAMP) AS ds, holiday FROM listed, span WHERE CASE WHEN federal THEN ds >= lo AND ds <= hi ELSE y BETWEEN year(lo) AND year(hi) END)"""


def _order_holidays(spark, sf):
    span = v.table(spark, sf, "orders").agg(F.min("o_orderdate").alias("min_ts"), F.max("o_orderdate").alias("max_ts"))
    return H.holidays_for(span)


@register("h6_holiday_calendar", f"WITH {_holiday_sql()} SELECT ds, holiday FROM hol")
def h6(spark, sf):
    return v.r(_order_holidays(spark, sf).withColumn("ds", F.col("ds").cast("timestamp")))


_NAMES = ["Independence Day", "Thanksgiving Day", "Christmas Eve", "Christmas Day", "Boxing Day", "New Year's Day"]


@register("h7_c2_c3_holiday_flags", with_views("load_daily", f"""{_holiday_sql()}, flags AS (SELECT ds, {', '.join(f'max(CAST(holiday = $${n}$$ AS INTEGER)) AS "{n}"' for n in _NAMES)} FROM hol GROUP BY 1)
  SELECT d.timestamp, {q('load', places=2)}, {', '.join(f'coalesce("{n}", 0) AS "{n}"' for n in _NAMES)} FROM load_daily d LEFT JOIN flags ON ds = d.timestamp"""))
def h7(spark, sf):
    return v.r(H.add_holiday_flags(v.load_daily(spark, sf), _order_holidays(spark, sf), _NAMES), 2)


# ---------------------------------------------------------------- J: series statistics


@register("j1_autocorrelation", with_views("load_hourly", f"""m AS MATERIALIZED (SELECT event_type, {_POS} AS p, load - avg(load) OVER (PARTITION BY event_type) AS y FROM load_hourly),
  s AS (SELECT a.event_type, k.k AS lag, sum(a.y * b.y) AS c FROM m a, (SELECT unnest(generate_series(0, 192)) AS k) k, m b WHERE b.event_type = a.event_type AND b.p = a.p - k.k GROUP BY 1, 2)
  SELECT event_type, CAST(lag AS INTEGER) AS lag, {q('c / first(c) OVER (PARTITION BY event_type ORDER BY lag)', 'acf')} FROM s"""))
def j1(spark, sf):
    return v.r(tsa.acf(v.load_hourly(spark, sf), "load", 192, KEY))


_J1 = f"""m AS MATERIALIZED (SELECT event_type, {_POS} AS p, load - avg(load) OVER (PARTITION BY event_type) AS y FROM load_hourly),
  s AS MATERIALIZED (SELECT a.event_type, k.k AS lag, sum(a.y * b.y) AS c FROM m a, (SELECT unnest(generate_series(0, 192)) AS k) k, m b WHERE b.event_type = a.event_type AND b.p = a.p - k.k GROUP BY 1, 2)"""
# the recursion on lists: rho[i + 1] is the autocorrelation at lag i
_J2 = f"""{_J1}, rho AS MATERIALIZED (SELECT event_type, list(c / v ORDER BY lag) AS rho FROM s JOIN (SELECT event_type, c AS v FROM s WHERE lag = 0) USING (event_type) GROUP BY 1),
  dl AS (SELECT event_type, 1 AS k, [rho[2]] AS phi, 1 - rho[2] * rho[2] AS err, rho[2] AS a FROM rho
  UNION ALL SELECT event_type, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - na * phi[k + 1 - j]), na), err * (1 - na * na), na
  FROM (SELECT dl.*, (rho[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rho[k + 2 - j]))) / err AS na FROM dl JOIN rho USING (event_type) WHERE k < 192))
  SELECT event_type, CAST(k AS INTEGER) AS lag, {q('a', 'pacf')} FROM dl UNION ALL SELECT event_type, 0, 1.0 FROM rho"""


@register("j2_partial_autocorrelation", with_views("load_hourly", _J2).replace("WITH ", "WITH RECURSIVE ", 1))
def j2(spark, sf):
    return v.r(tsa.pacf(v.load_hourly(spark, sf), "load", 192, KEY))


@register("j3_unit_root_test")
def j3(spark, sf):
    load = stage(v.load_hourly(spark, sf), "load")
    parts = [tsa.adf(load, "load", 12, reg, KEY, start=START).withColumn("regression", F.lit(reg)) for reg in ("c", "ct", "ctt")]
    return v.r(parts[0].unionByName(parts[1]).unionByName(parts[2]))


_SXX = "regr_sxx(y, x)"
_SSE = "(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x))"


@register("j3_unit_root_without_lags", with_views("load_hourly", f"""d AS (SELECT event_type, load - lag(load) OVER {_W} AS y, lag(load) OVER {_W} AS x FROM load_hourly)
  SELECT event_type, count(*) AS n, {q(f'regr_slope(y, x) / sqrt({_SSE} / (count(*) - 2) / {_SXX})', 'statistic')},
  {q('-2.86154 - 2.8903 / count(*) - 4.234 / power(count(*), 2) - 40.040 / power(count(*), 3)', 'crit_5')} FROM d WHERE x IS NOT NULL GROUP BY 1"""))
def j3s(spark, sf):
    return v.r(tsa.adf(v.load_hourly(spark, sf), "load", 0, "c", KEY, start=START).select("event_type", "n", "statistic", "crit_5"))


def _kpss_sql(resid, reg, lags, crit):
    cross = f"""SELECT a.event_type, sum(CASE WHEN k.k = 0 THEN 1 ELSE 2 * (1 - k.k / {lags + 1}.0) END * a.e * b.e) AS s2 FROM e a, (SELECT unnest(generate_series(0, {lags})) AS k) k, e b
    WHERE b.event_type = a.event_type AND b.p = a.p - k.k GROUP BY 1"""
    lv = [0.10, 0.05, 0.025, 0.01]
    pv = " ".join(f"WHEN st < {crit[i + 1]} THEN {lv[i]} + (st - {crit[i]}) / {crit[i + 1] - crit[i]} * {lv[i + 1] - lv[i]}" for i in range(3))
    return f"""e AS MATERIALIZED ({resid}), eta AS (SELECT event_type, count(*) AS n, sum(s * s) AS eta FROM (SELECT event_type, sum(e) OVER (PARTITION BY event_type ORDER BY p) AS s FROM e) GROUP BY 1),
  lr AS ({cross}), st AS (SELECT event_type, n, (eta / (n * n)) / (s2 / n) AS st FROM eta JOIN lr USING (event_type))
  SELECT event_type, n, {q('st', 'statistic')}, {q(f'CASE WHEN st <= {crit[0]} THEN 0.10 {pv} ELSE 0.01 END', 'p_value')} FROM st"""


@register("j4_kpss_level", with_views("load_hourly", _kpss_sql(f"SELECT event_type, {_POS} AS p, load - avg(load) OVER (PARTITION BY event_type) AS e FROM load_hourly", "c", 20, tsa.KPSS_CRITICAL["c"])))
def j4(spark, sf):
    return v.r(tsa.kpss(v.load_hourly(spark, sf), "load", 20, "c", KEY, start=START))


@register("j4_kpss_trend", with_views("load_hourly", _kpss_sql(
    f"SELECT event_type, {_POS} AS p, load - (regr_slope(load, {_POS}) OVER (PARTITION BY event_type) * {_POS} + regr_intercept(load, {_POS}) OVER (PARTITION BY event_type)) AS e FROM load_hourly",
    "ct", 20, tsa.KPSS_CRITICAL["ct"])))
def j4t(spark, sf):
    return v.r(tsa.kpss(v.load_hourly(spark, sf), "load", 20, "ct", KEY, start=START))


def _decompose_sql(src, value, period, name):
    h = period // 2
    w = "(PARTITION BY event_type ORDER BY timestamp"
    f = f"{w} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    return f"""{name}_t AS MATERIALIZED (SELECT *, CASE WHEN count({value}) OVER {f} = {2 * h + 1} THEN (sum({value}) OVER {f} - (lag({value}, {h}) OVER {w}) + lead({value}, {h}) OVER {w})) / 2) / {period} END AS trend,
    {_POS} % {period} AS phase FROM {src}),
  {name}_s AS (SELECT event_type, phase, s - avg(s) OVER (PARTITION BY event_type) AS seasonal FROM (SELECT event_type, phase, avg({value} - trend) AS s FROM {name}_t GROUP BY 1, 2)),
  {name} AS MATERIALIZED (SELECT t.*, seasonal, {value} - trend - seasonal AS resid FROM {name}_t t JOIN {name}_s USING (event_type, phase))"""


@register("j5_seasonal_decomposition", with_views("load_hourly", f"{_decompose_sql('load_hourly', 'load', 24, 'd')} SELECT event_type, timestamp, {q('load')}, {q('trend')}, {q('seasonal')}, {q('resid')} FROM d"))
def j5(spark, sf):
    return v.r(tsa.decompose(v.load_hourly(spark, sf), "load", 24, KEY, start=START))


_J6 = f"""{_decompose_sql('load_hourly', 'load', 24, 'd')}, x AS (SELECT event_type, timestamp, load, load - seasonal AS x FROM d),
  {_decompose_sql('x', 'x', 168, 'd2')}, rp AS (SELECT event_type, median(resid) AS med, 1.4826 * mad(resid) AS sigma FROM d2 GROUP BY 1)"""


@register("j6_multi_seasonal_outliers", with_views("load_hourly", f"{_J6} SELECT event_type, timestamp, {q('load')}, {q('resid')}, CAST(coalesce(abs(resid - med) > 2.5 * sigma, FALSE) AS INTEGER) AS outlier FROM d2 JOIN rp USING (event_type)"))
def j6(spark, sf):
    load = stage(v.load_hourly(spark, sf), "load")
    return v.r(tsa.multi_seasonal_outliers(load, "load", (24, 168), 2.5, KEY, start=START))


@register("j7_robust_z_flags", with_views("load_hourly", f"""p AS (SELECT event_type, median(load) AS med, 1.4826 * mad(load) AS sigma FROM load_hourly GROUP BY 1)
  SELECT event_type, timestamp, {q('load')}, CAST(abs(load - med) > 3.0 * sigma AS INTEGER) AS outlier FROM load_hourly JOIN p USING (event_type)"""))
def j7(spark, sf):
    return v.r(tsa.robust_flags(v.load_hourly(spark, sf), "load", 3.0, KEY))


# ---------------------------------------------------------------- D23, D24, K, F: scores

FEATURES = ["load_lag_1", "load_lag_24", "load_lag_168", "load_rw_24_sum", "load_rw_3_mean", "hour"]
FRAME_SQL = f"""frame AS MATERIALIZED (SELECT event_type, timestamp, load, CAST(hour(timestamp) AS DOUBLE) AS hour, lag(load, 1) OVER {_W} AS load_lag_1, lag(load, 24) OVER {_W} AS load_lag_24, lag(load, 168) OVER {_W} AS load_lag_168,
  CASE WHEN count(load) OVER a = 24 THEN sum(load) OVER a END AS load_rw_24_sum, CASE WHEN count(load) OVER b = 3 THEN avg(load) OVER b END AS load_rw_3_mean FROM load_hourly
  WINDOW a AS (PARTITION BY event_type ORDER BY timestamp ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), b AS (PARTITION BY event_type ORDER BY timestamp ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""


def feature_frame(spark, sf):
    df = windows.history_features(v.load_hourly(spark, sf), {"load": [1, 24, 168]}, {"load": [24]}, {"load": [3]}, KEY)
    return df.withColumn("hour", F.hour("timestamp").cast("double"))


def _per_feature_sql(expr, name):
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, {q(expr.format(f=f), name)} FROM frame" for f in FEATURES)


@register("d23_target_correlations", with_views("load_hourly", f"{FRAME_SQL} {_per_feature_sql('corr(load, {f})', 'correlation')}"))
def d23(spark, sf):
    return v.r(SC.correlations(feature_frame(spark, sf), FEATURES, "load"))


_FSCORE = "power(corr(load, {f}), 2) / (1 - power(corr(load, {f}), 2)) * (count({f}) - 2)"


@register("k1_f2_f_scores", with_views("load_hourly", f"{FRAME_SQL} {_per_feature_sql(_FSCORE, 'score')}"))
def k1(spark, sf):
    return v.r(SC.ranked(SC.f_scores(feature_frame(spark, sf), FEATURES, "load")))


@register("f3_top_features", with_views("load_hourly", f"{FRAME_SQL} SELECT * FROM ({_per_feature_sql(_FSCORE, 'score')}) ORDER BY score DESC, feature LIMIT 3"))
def f3(spark, sf):
    return v.r(SC.top_features(SC.f_scores(feature_frame(spark, sf), FEATURES, "load"), 3))


def _mi_sql(bins):
    probs = "[" + ", ".join(str(i / bins) for i in range(1, bins)) + "]"
    each = " UNION ALL ".join(f"""SELECT '{f}' AS feature, len(list_filter((SELECT quantile_cont({f}, {probs}) FROM frame), lambda c: {f} > c)) AS bx,
      len(list_filter((SELECT quantile_cont(load, {probs}) FROM frame), lambda c: load > c)) AS bb FROM frame WHERE {f} IS NOT NULL""" for f in FEATURES)
    return f"""cells AS (SELECT feature, bx, bb, count(*)::DOUBLE AS c FROM ({each}) GROUP BY 1, 2, 3)
  SELECT feature, {q('sum(t)', 'score')} FROM (SELECT feature, c / sum(c) OVER (PARTITION BY feature) * ln(c * sum(c) OVER (PARTITION BY feature)
   / (sum(c) OVER (PARTITION BY feature, bx) * sum(c) OVER (PARTITION BY feature, bb))) AS t FROM cells) GROUP BY 1"""


@register("k2_mutual_information", with_views("load_hourly", f"{FRAME_SQL}, {_mi_sql(10)}"))
def k2(spark, sf):
    return v.r(SC.mutual_information(stage(feature_frame(spark, sf), "frame"), FEATURES, "load", 10))


_NAIVE = f"""naive AS (SELECT event_type, timestamp, load, lag(load, 168) OVER {_W} AS prediction, CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN 'train' ELSE 'test' END AS split FROM load_hourly)"""


@register("l11_d24_seasonal_naive_errors", with_views("load_hourly", f"""{_NAIVE} SELECT event_type, split, {q('sqrt(avg(power(load - prediction, 2)))', 'rmse')}, {q('avg(abs(load - prediction))', 'mae')},
  {q('avg(load)', 'mean_load')}, count(*) AS n FROM naive WHERE prediction IS NOT NULL GROUP BY 1, 2"""))
def l11(spark, sf):
    return v.r(forecast.naive_errors(v.load_hourly(spark, sf), "load", SPLIT, 168, KEY))


@register("l10_residual_table", with_views("load_hourly", f"{_NAIVE} SELECT event_type, timestamp, {q('load', 'actual')}, {q('prediction')}, {q('load - prediction', 'residual')} FROM naive WHERE split = 'test'"))
def l10(spark, sf):
    scored = forecast.seasonal_naive(v.load_hourly(spark, sf), "load", SPLIT, 168, KEY)
    return v.r(SC.residuals(scored.where("split = 'test'"), "load", "prediction", ["event_type", "timestamp"]))


@register("l13_walk_forward_naive", with_views("load_hourly", f"""{_NAIVE.replace('168', '1')} SELECT event_type, {q('avg(abs(load - prediction))', 'score')}, count(*) AS steps FROM naive WHERE timestamp >= TIMESTAMP '{SPLIT}' AND timestamp < TIMESTAMP '{END}' GROUP BY 1"""))
def l13(spark, sf):
    scored = forecast.seasonal_naive(v.load_hourly(spark, sf), "load", SPLIT, 1, KEY)
    return v.r(forecast.walk_forward_score(scored, "load", "prediction", SPLIT, END, KEY))


@register("c9_forecast_joined_to_actuals", with_views("load_hourly", f"""SELECT h.event_type, h.timestamp + INTERVAL 168 HOUR AS timestamp, {q('h.load', 'forecast')}, {q('a.load', 'actual')} FROM load_hourly h
  LEFT JOIN load_hourly a ON a.event_type = h.event_type AND a.timestamp = h.timestamp + INTERVAL 168 HOUR WHERE h.timestamp >= TIMESTAMP '{SPLIT}'"""))
def c9(spark, sf):
    load = v.load_hourly(spark, sf)
    ahead = load.where(F.col("timestamp") >= F.lit(SPLIT).cast("timestamp")).select(
        "event_type", F.timestamp_seconds(F.unix_seconds("timestamp") + 168 * 3600).alias("timestamp"), F.col("load").alias("forecast"))
    return v.r(ahead.join(load.withColumnRenamed("load", "actual"), ["event_type", "timestamp"], "left"))


@register("c8_features_with_target", with_views("load_hourly", f"{FRAME_SQL} SELECT event_type, timestamp, {q('load')}, {q('load_lag_24')}, {q('load_rw_24_sum')} FROM frame WHERE timestamp >= TIMESTAMP '{START}' + INTERVAL 168 HOUR"))
def c8(spark, sf):
    frame = feature_frame(spark, sf)
    x = frame.select("event_type", "timestamp", "load_lag_24", "load_rw_24_sum")
    y = frame.select("event_type", "timestamp", "load").where(F.col("timestamp") >= F.lit("2024-01-08").cast("timestamp"))
    return v.r(x.join(y, ["event_type", "timestamp"]))


# ---------------------------------------------------------------- L2, L4-L7: folds and runs


@register("l2_fold_table", with_views("load_hourly", f"""s AS (SELECT min(timestamp) AS lo, date_diff('hour', min(timestamp), max(timestamp)) + 1 AS n FROM load_hourly WHERE timestamp < TIMESTAMP '{SPLIT}')
  SELECT CAST(fold AS INTEGER) AS fold, lo AS train_start, lo + to_hours(n - (5 - fold) * (n // 6)) AS train_end, lo + to_hours(n - (5 - fold) * (n // 6) + n // 6) AS test_end, n // 6 AS test_size
  FROM s, (SELECT unnest(generate_series(0, 4)) AS fold)"""))
def l2(spark, sf):
    return v.r(folds.fold_table(C.train_rows(v.load_hourly(spark, sf), SPLIT, "timestamp"), 5))


def run_table(spark, sf):
    """Events read as tuning runs: every seventh event is a parent, the others are trials of their user's latest parent."""
    ev = v.events(spark, sf)
    parent = F.col("event_id") % 7 == 0
    return ev.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(~parent & (F.col("event_id") % 3 != 0), (F.col("event_id") - F.col("event_id") % 7).cast("string")).alias("parent_id"),
        F.concat(F.lit("exp "), (F.col("user_id") % 4).cast("string")).alias("experiment"),
        F.col("event_type").alias("model"), F.when(parent, "parent").otherwise("child").alias("level"),
        F.when(parent, (F.col("event_id") / 7).cast("int")).alias("run_number"), F.col("event_id").alias("trial"),
        F.when(F.col("user_id") % 10 == 3, "FAILED").otherwise("FINISHED").alias("status"),
        F.create_map(F.lit("depth"), (F.col("user_id") % 20).cast("string")).alias("params"),
        F.when(parent, F.create_map(F.lit("best_rmse"), F.col("value") + 1))
        .otherwise(F.create_map(F.lit("rmse"), F.col("value") + 1, F.lit("mae"), F.col("value") / 2)).alias("metrics"),
    )


_RUNS = """runs AS (SELECT event_id, CAST(event_id AS VARCHAR) AS run_id, CASE WHEN event_id % 7 != 0 AND event_id % 3 != 0 THEN CAST(event_id - event_id % 7 AS VARCHAR) END AS parent_id,
  'exp ' || CAST(user_id % 4 AS VARCHAR) AS experiment, event_type AS model, CASE WHEN event_id % 7 = 0 THEN 'parent' ELSE 'child' END AS level, value + 1 AS value,
  CASE WHEN user_id % 10 = 3 THEN 'FAILED' ELSE 'FINISHED' END AS status FROM events)"""


@register("l5_next_run_number", f"WITH {_RUNS} SELECT model, CAST(max(event_id // 7) + 1 AS INTEGER) AS next_run_number FROM runs WHERE level = 'parent' GROUP BY 1")
def l5(spark, sf):
    return runs.next_run_numbers(run_table(spark, sf))


@register("l6_f4_best_runs", f"""WITH {_RUNS}, best AS (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY value, run_id) AS rn FROM runs WHERE status = 'FINISHED' AND level = 'child')
  SELECT b.experiment, b.run_id, {q('b.value', 'value')}, coalesce(p.run_id, b.run_id) AS artifact_run_id FROM best b LEFT JOIN runs p ON p.run_id = b.parent_id WHERE rn = 1""")
def l6(spark, sf):
    return v.r(runs.best_runs(run_table(spark, sf), "rmse", True, ["experiment"]).drop("params"))


@register("l7_experiment_metrics", f"WITH {_RUNS} SELECT DISTINCT experiment, CASE WHEN level = 'parent' THEN 'best_rmse' ELSE unnest(['rmse', 'mae']) END AS metric FROM runs")
def l7(spark, sf):
    return runs.experiment_metrics(run_table(spark, sf))


@register("l4_champion_trace", f"""WITH {_RUNS}, t AS (SELECT model, event_id AS trial, value, min(value) OVER (PARTITION BY model ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM runs WHERE level = 'child')
  SELECT model, trial, {q('value')}, {q('least(prev, value)', 'best')}, prev IS NULL OR value < prev AS improved, {q('CASE WHEN value < prev THEN abs(prev - value) / value * 100 END', 'improvement_pct')} FROM t""")
def l4(spark, sf):
    trials = runs.with_metric(run_table(spark, sf).where("level = 'child'"), "rmse").select("model", "trial", "value")
    return v.r(runs.champion_trace(trials, "value", "trial", ["model"]))


# ---------------------------------------------------------------- M: streams


@register("m1_streaming_hourly_load", f"""SELECT event_type, date_trunc('hour', ts) AS timestamp, {q('sum(value)', 'load')} FROM events GROUP BY 1, 2
  HAVING date_trunc('hour', any_value(ts)) + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events)""")
def m1(spark, sf):
    source = v.events(spark, sf).select("ts", "event_type", "value")
    path = write_stage(source, new_path(spark, "event-stream"))
    stream = STR.file_stream(spark, path, source.schema)
    return v.r(STR.run_available(STR.hourly_load(stream, "ts", "value", KEY), "hourly-load"))


def _load_files(spark, sf, which=None):
    df = v.load_hourly(spark, sf) if which is None else which
    return write_stage(df, new_path(spark, "load-stream")), df.schema


@register("m2_streaming_frozen_flags", E7_SQL)
def m2(spark, sf):
    prepare(spark)
    train, test = _split(spark, sf)
    path, schema = _load_files(spark, sf, test)
    params = stage(S.seasonal_params(train, "load", KEY), "params")
    return v.r(STR.run_available(STR.frozen_flags(STR.file_stream(spark, path, schema), params, "load", 3.0, KEY), "frozen-flags"))


@register("m3_streaming_expanding_flags", SQL["e6_expanding_mad_flags"])
def m3(spark, sf):
    prepare(spark)
    path, schema = _load_files(spark, sf)
    return v.r(STR.run_available(STR.expanding_flags(STR.file_stream(spark, path, schema), "load", START, 3.5, 240, KEY), "expanding-flags"))


