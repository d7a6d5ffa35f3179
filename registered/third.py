"""Whole jobs: loading, enrichment, features, selection, training and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoload.operators import clean as C
from chronoload.operators import trend as TR
from chronoload.operators import windows
from chronoload.plans import enrich as E
from chronoload.plans import features as FE
from chronoload.plans import forecast as FC
from chronoload.plans import load as LD
from chronoload.plans import profile as PR
from chronoload.plans import select as SE
from chronoload.plans import train as TN
from chronoload.session import new_path, stage
from chronoload.sources import stages as ST
from chronoload.training import additive, fit, folds, forecast, importance, runs, search, selection, smoothing
from chronoload.training.registry import build_model
from registered import views as v
from registered.first import PERIOD, PIECES_SQL, TRIM_SQL, _incident_file, _session_file
from registered.second import FEATURES, feature_frame, frozen_flags_sql, past_flags_sql, rolling_sql
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

# ---------------------------------------------------------------- O1-O3: loading


@register("o1_load_sessions", with_views("sessions", """SELECT event_id AS plug_in_event_id, date_trunc('minute', starttime) AS starttime,
  date_trunc('minute', endtime) AS endtime, energy, plug_type FROM sessions WHERE event_id % 101 != 0 AND date_trunc('minute', endtime) < TIMESTAMP '2024-01-30'"""))
def o1(spark, sf):
    return v.r(LD.load_sessions(spark, _session_file(spark, sf), START, "2024-01-30", new_path(spark, "sessions-landed")))


@register("o2_load_weather", with_views("incidents", """SELECT event_id AS eventid, starttime, endtime, type, severity, 'C' || severity AS city, CASE WHEN distance < 5 THEN 'North' ELSE 'South' END AS county,
  'CA' AS state, distance FROM incidents WHERE severity IN ('0', '2', '4') AND endtime < TIMESTAMP '2024-01-30'"""))
def o2(spark, sf):
    return v.r(LD.load_incidents(spark, _incident_file(spark, sf), START, "2024-01-30", ["C0", "C2", "C4"], out=new_path(spark, "weather-landed")))


@register("o2_load_temperature", with_views("temps", "SELECT station AS temp_ws, starttime, temp FROM temps WHERE station IN (0, 1) AND starttime <= TIMESTAMP '2024-01-30'"))
def o2t(spark, sf):
    table = v.temps(spark, sf).withColumnRenamed("starttime", "time")
    return v.r(LD.load_temperature(table, [0, 1], START, "2024-01-30", new_path(spark, "temperature-landed")))


@register("o3_load_traffic", with_views("incidents", """SELECT event_id AS eventid, starttime, endtime, type, severity, 'C' || severity AS city, 'South' AS county,
  'CA' AS state, distance FROM incidents WHERE distance >= 5 AND endtime < TIMESTAMP '2024-01-30'"""))
def o3(spark, sf):
    return v.r(LD.load_incidents(spark, _incident_file(spark, sf), START, "2024-01-30", counties=["South"], states=["CA"]))


# ---------------------------------------------------------------- O4-O8: enrichment

RULES = E.SessionRules(power_quantile=0.001, mad_threshold=3.5, min_outlier_samples=240)
WEATHER = E.weather_rules(["click", "view", "error"], v.SEVERITIES, {"w_click_dur": "click", "w_view_dur": "view"})
TRAFFIC = E.traffic_rules(["signup", "purchase"], v.SEVERITIES, {
    "t_signup_dis": "distance_signup", "t_purchase_dis": "distance_purchase",
    "t_signup_dur": "duration_signup", "t_purchase_dur": "duration_purchase"})

LOAD_CTES = f"""{TRIM_SQL.format(q=0.001).replace('SELECT DISTINCT * FROM powered', 'SELECT DISTINCT starttime, endtime, energy, charging_time, plug_type, duration_hours, charger_kw FROM powered')},
  e_train AS (SELECT * FROM clean WHERE endtime < TIMESTAMP '{SPLIT}'),
  e_bounds AS (SELECT exp(min_val) - 1 AS lo, exp(max_val) - 1 AS hi FROM ({v.mad_sql('e_train', 'log_energy', 3.5)})),
  e_sum AS (SELECT date_trunc('hour', starttime) AS h, sum(CASE WHEN energy > hi THEN hi WHEN energy < lo THEN lo ELSE energy END) AS energy FROM trimmed, e_bounds GROUP BY 1),
  e_load AS MATERIALIZED (SELECT timestamp, coalesce(energy, 0) AS energy FROM hours LEFT JOIN e_sum ON h = timestamp),
  e_first AS (SELECT * FROM e_load WHERE timestamp < TIMESTAMP '{SPLIT}'), e_second AS (SELECT * FROM e_load WHERE timestamp >= TIMESTAMP '{SPLIT}'),
  e_out AS MATERIALIZED (SELECT timestamp, energy, hour, weekday, outlier AS energy_outlier FROM ({past_flags_sql('e_first', 'energy', 3.5, 240, '')})
    UNION ALL SELECT timestamp, energy, hour, weekday, outlier FROM ({frozen_flags_sql('e_first', 'e_second', 'energy', 3.5, ())}))"""


@register("o4_sessions_to_hourly_load", with_views("sessions hours", f"{LOAD_CTES} SELECT timestamp, {q('energy')}, hour, weekday, energy_outlier FROM e_out"))
def o4(spark, sf):
    return v.r(E.sessions_to_load(v.landed(v.sessions(spark, sf), "sessions"), PERIOD, RULES))


def incident_ctes(p, types, measures, out_name, rollups):
    cols = ["starttime", "endtime", "type", "severity", *measures]
    logs = ", ".join(f"ln(1 + {m}) AS log_{m}" for m in measures)
    positive = " AND ".join(f"{m} > 0" for m in measures)
    bounds = ", ".join(f"(SELECT exp(min_val) - 1 FROM ({v.mad_sql(f'{p}_train', f'log_{m}', 3.5)})) AS lo_{m}, (SELECT exp(max_val) - 1 FROM ({v.mad_sql(f'{p}_train', f'log_{m}', 3.5)})) AS hi_{m}" for m in measures)
    capped = ", ".join(f"CASE WHEN {m} > hi_{m} THEN hi_{m} WHEN {m} < lo_{m} THEN lo_{m} ELSE {m} END AS {'dur' if m == 'duration' else m}" for m in measures)
    names = {(m, t, s): out_name(m, (t, s)) for m in measures for t in types for s in v.SEVERITIES}
    sums = ", ".join(f"sum({'minutes' if m == 'duration' else m}) FILTER (type = '{t}' AND severity = '{s}') AS {n}" for (m, t, s), n in names.items())
    filled = ", ".join(f"coalesce({n}, 0) AS {n}" for n in names.values())
    rolled = ", ".join(" + ".join(f"coalesce({n}, 0)" for n in names.values() if part in n) + f" AS {r}" for r, part in rollups.items())
    tlist = ", ".join(f"'{t}'" for t in types)
    ctes = f"""{p}_clean AS MATERIALIZED (SELECT *, {logs} FROM (SELECT DISTINCT {', '.join(cols)}, event_id FROM (SELECT *, CAST(date_diff('minute', starttime, endtime) AS DOUBLE) AS duration FROM incidents))
    WHERE {positive} AND type IN ({tlist})),
  {p}_train AS (SELECT * FROM {p}_clean WHERE endtime < TIMESTAMP '{SPLIT}'),
  {p}_bounds AS MATERIALIZED (SELECT {bounds}),
  {p}_src AS (SELECT starttime, type, severity, {capped} FROM {p}_clean, {p}_bounds),
  {PIECES_SQL.format(src=f'{p}_src').replace('pieces AS', f'{p}_pieces AS')},
  {p}_sums AS (SELECT timestamp, {sums} FROM {p}_pieces GROUP BY 1),
  {p}_out AS MATERIALIZED (SELECT hours.timestamp, {filled}, {rolled} FROM hours LEFT JOIN {p}_sums USING (timestamp))"""
    return ctes, [*names.values(), *rollups]


W_CTES, W_COLS = incident_ctes("w", WEATHER.types, ["duration"], WEATHER.name, WEATHER.rollups)
T_CTES, T_COLS = incident_ctes("t", TRAFFIC.types, ["duration", "distance"], TRAFFIC.name, TRAFFIC.rollups)


def _cols(names, places=4):
    return ", ".join(q(n, n, places) for n in names)


@register("o5_weather_to_hours", with_views("incidents hours", f"{W_CTES} SELECT timestamp, {_cols(W_COLS)} FROM w_out"))
def o5(spark, sf):
    return v.r(E.incidents_to_hours(v.landed(v.incidents(spark, sf), "incidents"), PERIOD, WEATHER), 4)


TEMP_CTES = f"""m_mean AS (SELECT starttime, avg(CASE WHEN temp BETWEEN -1 AND 50 THEN temp END) AS temp FROM (SELECT DISTINCT * FROM temps) GROUP BY 1),
  m_grid AS (SELECT timestamp, temp, avg(temp) OVER (PARTITION BY hour(timestamp), dayofyear(timestamp) ORDER BY timestamp) AS seen FROM hours LEFT JOIN m_mean ON starttime = timestamp),
  m_out AS MATERIALIZED (SELECT timestamp, coalesce(temp, last_value(seen IGNORE NULLS) OVER (ORDER BY timestamp ROWS UNBOUNDED PRECEDING)) AS temp, CAST(temp IS NULL AS INTEGER) AS temp_imputed FROM m_grid)"""


@register("o6_temperature_to_hours", with_views("temps hours", f"{TEMP_CTES} SELECT timestamp, {q('temp')}, temp_imputed FROM m_out"))
def o6(spark, sf):
    return v.r(E.temperature_to_hours(v.temps(spark, sf), PERIOD))


@register("o7_traffic_to_hours", with_views("incidents hours", f"{T_CTES} SELECT timestamp, {_cols(T_COLS)} FROM t_out"))
def o7(spark, sf):
    return v.r(E.incidents_to_hours(v.landed(v.incidents(spark, sf), "incidents"), PERIOD, TRAFFIC), 4)


COMBINED_CTES = f"{LOAD_CTES}, {W_CTES}, {TEMP_CTES}, {T_CTES}, combined AS MATERIALIZED (SELECT * FROM e_out JOIN w_out USING (timestamp) JOIN m_out USING (timestamp) JOIN t_out USING (timestamp))"


def combined(spark, sf):
    log = v.landed(v.incidents(spark, sf), "incidents")
    parts = [
        stage(E.sessions_to_load(v.landed(v.sessions(spark, sf), "sessions"), PERIOD, RULES), "load"),
        stage(E.incidents_to_hours(log, PERIOD, WEATHER), "weather"),
        stage(E.temperature_to_hours(v.temps(spark, sf), PERIOD), "temperature"),
        stage(E.incidents_to_hours(log, PERIOD, TRAFFIC), "traffic"),
    ]
    return E.combine_sources(*parts, PERIOD)


@register("o8_combined_hours", with_views("sessions incidents temps hours", f"{COMBINED_CTES} SELECT timestamp, {_cols(['energy', 'temp', *W_COLS, *T_COLS])}, hour, weekday, energy_outlier, temp_imputed FROM combined"))
def o8(spark, sf):
    return v.r(combined(spark, sf), 4)


# ---------------------------------------------------------------- O9: features

FEATURE_RULES = FE.FeatureRules(substrings={
    "energy": ["energy"], "weather": ["click_dur", "view_dur", "storm_dur"], "temperature": ["temp"],
    "traffic": ["signup_dur", "purchase_dis", "event_dur"]})


def _feature_sql():
    order = "ORDER BY timestamp"
    rules = FEATURE_RULES
    columns = ["energy", "energy_outlier", *W_COLS, "temp", "temp_imputed", *T_COLS]
    lag = [q(f"lag({c}, {k}) OVER ({order})", f"{c}_lag_{k}", 4) for c, ks in rules.per_column(columns, rules.lags).items() for k in ks]
    sums = [rolling_sql(c, w, "sum", order, 4) for c, ws in rules.per_column(columns, rules.sums).items() for w in ws]
    means = [rolling_sql(c, w, "mean", order, 4) for c, ws in rules.per_column(columns, rules.means).items() for w in ws]
    cyc = [q(f"{fn}(2 * pi() * {part} / {period}.0)", f"{n}_{fn}", 4) for n, part, period in (
        ("month", "month(timestamp)", 12), ("weekday", "weekday", 7), ("hour", "hour", 24)) for fn in ("sin", "cos")]
    hol = [f"CAST({cond} AS INTEGER) AS \"{n}\"" for n, cond in {
        "Independence Day": "month(timestamp) = 7 AND day(timestamp) = 4", "Thanksgiving Day": "FALSE", "Christmas Eve": "FALSE",
        "Christmas Day": "FALSE", "Boxing Day": "FALSE", "New Year's Day": "month(timestamp) = 1 AND day(timestamp) = 1"}.items()]
    pos = f"date_diff('hour', TIMESTAMP '{START}', timestamp)"
    return f"""{COMBINED_CTES}, tr AS (SELECT regr_slope(energy, {pos}) AS slope, regr_intercept(energy, {pos}) AS intercept FROM combined WHERE timestamp < TIMESTAMP '{SPLIT}'),
  flat AS MATERIALIZED (SELECT * REPLACE (energy - (slope * {pos} + intercept) AS energy) FROM combined, tr)
  SELECT * FROM (SELECT timestamp, {q('energy', 'energy', 4)}, {', '.join([*cyc, *hol, *lag, *sums, *means])} FROM flat) WHERE timestamp >= TIMESTAMP '{START}' + INTERVAL 168 HOUR"""


def feature_table(spark, sf):
    return FE.make_features(combined(spark, sf), START, END, SPLIT, FEATURE_RULES)


@register("o9_b23_feature_table", with_views("sessions incidents temps hours", _feature_sql()))
def o9(spark, sf):
    frame, _ = feature_table(spark, sf)
    return v.r(frame, 4)


# ---------------------------------------------------------------- K: selection by models


def ml_frame(spark, sf):
    """Feature frame of all series, complete rows only, staged for repeated use."""
    return stage(feature_frame(spark, sf).dropna(), "frame")


def _chosen(spark, names, method):
    return spark.createDataFrame([(method, i, n) for i, n in enumerate(names)], "method string, position int, feature string")


@register("k3_forest_importance")
def k3(spark, sf):
    return selection.importance_ranking(ml_frame(spark, sf), FEATURES, "load", 42, 20, 5)


@register("k4_recursive_elimination")
def k4(spark, sf):
    return _chosen(spark, selection.select_features(ml_frame(spark, sf), FEATURES, "load", "rfe", 3, 42, 10, 5), "rfe")


@register("k5_recursive_elimination_with_folds")
def k5(spark, sf):
    return _chosen(spark, selection.select_features(ml_frame(spark, sf), FEATURES, "load", "rfecv", 2, 42, 5, 4), "rfecv")


@register("k7_o10_two_round_selection")
def k7(spark, sf):
    frame, names = feature_table(spark, sf)
    frame = stage(frame, "features")
    rules = SE.SelectionRules(method_1="f", k_1=8, method_2="rfe", k_2=4, trees=10, depth=4)
    store = new_path(spark, "store")
    SE.select_feature_set(frame, names, SPLIT, rules, store)
    return v.r(ST.read_versioned(spark, store, rules.version()))


# ---------------------------------------------------------------- L: models and forecasts


@register("l1_l8_final_fit")
def l8(spark, sf):
    frame = ml_frame(spark, sf)
    train, test = C.train_rows(frame, SPLIT, "timestamp"), C.test_rows(frame, SPLIT, "timestamp")
    model = fit.fit_final(train, FEATURES, "load", "XGBoost", {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.1, "reg_alpha": 1})
    return v.r(fit.predict(model, test).select("event_type", "timestamp", F.col("load").alias("actual"), "prediction"))


@register("l2_cross_validation")
def l2(spark, sf):
    frame = C.train_rows(ml_frame(spark, sf), SPLIT, "timestamp")
    scores = folds.cv_scores(frame, FEATURES, "load", build_model("Random Forest", {"n_estimators": 10, "max_depth": 5}, 42), 3)
    return spark.createDataFrame([(k, float(x)) for k, x in scores.items()], "metric string, value double")


@register("l3_random_search")
def l3(spark, sf):
    frame = C.train_rows(ml_frame(spark, sf), SPLIT, "timestamp")
    found = search.random_search(frame, FEATURES, "load", "Random Forest", {"n_estimators": [5, 15], "max_depth": [3, 6], "max_features": ["sqrt"], "min_split_loss": [0.0, 0.1]}, 3, 3)
    return spark.createDataFrame([(t["trial"], {k: str(x) for k, x in t["params"].items()}, t["rmse"], t["mae"]) for t in found], "trial int, params map<string,string>, rmse double, mae double")


@register("l9_permutation_importance")
def l9(spark, sf):
    frame = ml_frame(spark, sf)
    train = C.train_rows(frame, SPLIT, "timestamp")
    model = fit.fit_final(train, FEATURES, "load", "Random Forest", {"n_estimators": 10, "max_depth": 5})
    return v.r(importance.permutation_importance(model.stages[-1], train, FEATURES, "load", ["event_type", "timestamp"], 5, 42))


_LAG24 = "(SELECT event_type, timestamp, load, lag(load, 24) OVER (PARTITION BY event_type ORDER BY timestamp) AS x FROM load_hourly)"


def _shuffled_sql(rows, key, repeats, seed=42):
    """Errors of the one-lag model per repeat: as it is, and with each row holding the lag of the row before it in digest order."""
    return f"""ordered AS (SELECT rep, load, x, coalesce(lag(x) OVER w, first_value(x) OVER (PARTITION BY rep ORDER BY h DESC)) AS other
    FROM (SELECT *, md5('{seed}|' || rep || '|' || {key}) AS h FROM {rows}, (SELECT unnest(generate_series(0, {repeats - 1})) AS rep)) WINDOW w AS (PARTITION BY rep ORDER BY h)),
  rises AS (SELECT rep, sqrt(avg(power(load - (s * other + i), 2))) - sqrt(avg(power(load - (s * x + i), 2))) AS rise FROM ordered, fit GROUP BY 1)"""


_ONE_LAG = f"""known AS (SELECT * FROM {_LAG24} WHERE x IS NOT NULL), learn AS (SELECT * FROM known WHERE timestamp < TIMESTAMP '{SPLIT}'),
  fit AS (SELECT regr_slope(load, x) AS s, regr_intercept(load, x) AS i FROM learn), """
_ROW_KEY = "event_type || '|' || strftime(timestamp, '%Y-%m-%d %H:%M:%S')"


@register("l9_permutation_importance_one_lag", with_views("load_hourly", _ONE_LAG + _shuffled_sql("learn", _ROW_KEY, 5) + f"""
  SELECT 'load_lag_24' AS feature, {q('avg(rise)', 'importance', 4)}, {q('stddev_pop(rise)', 'std', 4)} FROM rises"""))
def l9s(spark, sf):
    frame = stage(windows.history_features(v.load_hourly(spark, sf), {"load": [24]}, series_cols=KEY).dropna(), "frame")
    train = C.train_rows(frame, SPLIT, "timestamp")
    model = fit.fit_final(train, ["load_lag_24"], "load", "Linear")
    return v.r(importance.permutation_importance(model.stages[-1], train, ["load_lag_24"], "load", ["event_type", "timestamp"], 5, 42), 4)


@register("l5_o11_stored_run_tables", with_views("load_hourly", _ONE_LAG + _shuffled_sql("learn", _ROW_KEY, 2) + f"""
  SELECT 'correlations' AS part, {q('corr(x, load)', 'value', 4)} FROM learn UNION ALL SELECT 'importances', {q('avg(rise)', 'value', 4)} FROM rises
  UNION ALL SELECT 'residuals', {q('sqrt(avg(power(load - (s * x + i), 2)))', 'value', 4)} FROM known, fit WHERE timestamp >= TIMESTAMP '{SPLIT}'
  UNION ALL SELECT 'run_number', 2"""))
def l5t(spark, sf):
    frame = stage(windows.history_features(v.load_hourly(spark, sf), {"load": [24]}, series_cols=KEY).dropna(), "frame")
    frame = frame.select("event_type", "timestamp", "load", "load_lag_24")
    runs_path, models = new_path(spark, "runs"), new_path(spark, "models")
    for _ in range(2):  # the second run gets a number of its own
        done = TN.train_model(frame, ["load_lag_24"], "load", SPLIT, "Linear", {}, runs_path, models, "demo", trials=1, n_splits=3,
                              key_cols=["event_type", "timestamp"], repeats=2)
    stored = {name: runs.read_table(spark, models, done.run_id, name) for name in ("correlations", "importances", "residuals")}
    parts = [
        stored["correlations"].select(F.lit("correlations").alias("part"), F.col("correlation").alias("value")),
        stored["importances"].select(F.lit("importances"), "importance"),
        stored["residuals"].select(F.lit("residuals"), F.col("residual")).groupBy("residuals").agg(F.sqrt(F.avg(F.col("residual") * F.col("residual")))),
        runs.read_runs(spark, runs_path).where(F.col("run_id") == done.run_id).select(F.lit("run_number"), F.col("run_number").cast("double")),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return v.r(out, 4)


# the smoothing recursion per series and parameter triple, with the season as a list
_L12 = f"""ys AS MATERIALIZED (SELECT event_type, list(load ORDER BY timestamp) AS y FROM load_hourly WHERE timestamp < TIMESTAMP '{SPLIT}' GROUP BY 1),
  grid AS (SELECT a, b, g FROM (SELECT unnest([0.05, 0.2, 0.5]::DOUBLE[]) AS a), (SELECT unnest([0.0, 0.01, 0.1]::DOUBLE[]) AS b), (SELECT unnest([0.05, 0.2, 0.5]::DOUBLE[]) AS g)),
  hw AS (SELECT event_type, a, b, g, 0 AS t, list_avg(y[1:24]) AS level, (list_avg(y[25:48]) - list_avg(y[1:24])) / 24 AS slope,
    list_transform(y[1:24], lambda x: x - list_avg(y[1:24])) AS season, 0.0::DOUBLE AS sse FROM ys, grid
  UNION ALL SELECT event_type, a, b, g, t + 1, nl, b * (nl - level) + (1 - b) * slope,
    list_concat(list_append(season[1:t % 24], g * (x - nl) + (1 - g) * s), season[t % 24 + 2:24]), sse + power(x - (level + slope + s), 2)
  FROM (SELECT *, a * (x - s) + (1 - a) * (level + slope) AS nl FROM (SELECT hw.*, y[t + 1] AS x, season[t % 24 + 1] AS s FROM hw JOIN ys USING (event_type) WHERE t < 504))),
  best AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY sse) AS rn FROM hw WHERE t = 504)
  SELECT event_type, TIMESTAMP '{SPLIT}' + to_hours(h - 1) AS timestamp, {q('level + h * slope + season[(504 + h - 1) % 24 + 1]', 'prediction')}, {q('a', 'alpha')}, {q('b', 'beta')}, {q('g', 'gamma')}, {q('sse', 'sse', 2)}
  FROM best, (SELECT unnest(generate_series(1, 216)) AS h) WHERE rn = 1"""


@register("l12_holt_winters", with_views("load_hourly", _L12).replace("WITH ", "WITH RECURSIVE ", 1))
def l12(spark, sf):
    out = smoothing.holt_winters(v.load_hourly(spark, sf), "load", SPLIT, 216, 24, KEY)
    return v.r(v.r(out, 6, ["prediction", "alpha", "beta", "gamma"]), 2, ["sse"])


#: Hours from the split to the end of the table.
HORIZON = 216


def _exogenous(frame):
    return frame.select("event_type", "timestamp", "hour")


@register("l14_recursive_forecast")
def l14(spark, sf):
    load = stage(v.load_hourly(spark, sf), "load")
    trend = stage(TR.ols_trend(C.train_rows(load, SPLIT, "timestamp"), "load", START, KEY), "trend")
    flat = TR.remove_trend(load, trend, "load", START, KEY)
    frame = windows.history_features(flat, {"load": [1, 24, 168]}, {"load": [24]}, {"load": [3]}, KEY).withColumn("hour", F.hour("timestamp").cast("double"))
    model = fit.fit_final(C.train_rows(frame.dropna(), SPLIT, "timestamp"), FEATURES, "load", "Linear")
    return v.r(forecast.recursive_forecast(
        model, load, _exogenous(frame), "load", SPLIT, HORIZON, series_cols=KEY, trend=trend, series_start=START))




@register("l8_l14_recursive_forecast_one_lag", with_views("load_hourly", f"""fit AS (SELECT regr_slope(load, x) AS s, regr_intercept(load, x) AS i FROM {_LAG24} WHERE timestamp < TIMESTAMP '{SPLIT}' AND x IS NOT NULL),
  last AS (SELECT event_type, timestamp, load FROM load_hourly WHERE timestamp >= TIMESTAMP '{SPLIT}' - INTERVAL 24 HOUR AND timestamp < TIMESTAMP '{SPLIT}'),
  ahead AS (SELECT event_type, timestamp + to_days(d) AS timestamp, power(s, d) * load + i * (power(s, d) - 1) / (s - 1) AS forecast FROM last, fit, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS d))
  SELECT b.event_type, b.timestamp, {q('forecast', places=4)}, {q('load', 'actual', 4)} FROM ahead b JOIN load_hourly l ON l.event_type = b.event_type AND l.timestamp = b.timestamp"""))
def l14s(spark, sf):
    load = stage(v.load_hourly(spark, sf), "load")
    frame = windows.history_features(load, {"load": [24]}, series_cols=KEY)
    model = fit.fit_final(C.train_rows(frame.dropna(), SPLIT, "timestamp"), ["load_lag_24"], "load", "Linear")
    times = frame.select("event_type", "timestamp")
    return v.r(forecast.recursive_forecast(model, load, times, "load", SPLIT, HORIZON, 24, series_cols=KEY), 4)


_MEAN3 = "(SELECT event_type, timestamp, load, CASE WHEN row_number() OVER w > 3 THEN avg(load) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS x FROM load_hourly WINDOW w AS (PARTITION BY event_type ORDER BY timestamp))"


@register("l14_recursive_forecast_rolling_mean", with_views("load_hourly", f"""fit AS MATERIALIZED (SELECT regr_slope(load, x) AS s, regr_intercept(load, x) AS i FROM {_MEAN3} WHERE timestamp < TIMESTAMP '{SPLIT}' AND x IS NOT NULL),
  walk AS (SELECT event_type, 0 AS h, list(load ORDER BY timestamp) AS y FROM load_hourly WHERE timestamp >= TIMESTAMP '{SPLIT}' - INTERVAL 3 HOUR AND timestamp < TIMESTAMP '{SPLIT}' GROUP BY 1
    UNION ALL SELECT event_type, h + 1, list_append(y[2:3], s * list_avg(y) + i) FROM walk, fit WHERE h < {HORIZON}),
  ahead AS (SELECT event_type, TIMESTAMP '{SPLIT}' + to_hours(h - 1) AS timestamp, y[3] AS forecast FROM walk WHERE h > 0)
  SELECT b.event_type, b.timestamp, {q('forecast', places=4)}, {q('load', 'actual', 4)} FROM ahead b JOIN load_hourly l ON l.event_type = b.event_type AND l.timestamp = b.timestamp""").replace("WITH ", "WITH RECURSIVE ", 1))
def l14m(spark, sf):
    load = stage(v.load_hourly(spark, sf), "load")
    frame = stage(windows.history_features(load, means={"load": [3]}, series_cols=KEY), "frame")
    name = next(c for c in frame.columns if c.startswith("load_rw_3"))
    model = fit.fit_final(C.train_rows(frame.dropna(), SPLIT, "timestamp"), [name], "load", "Linear")
    return v.r(forecast.recursive_forecast(model, load, frame.select("event_type", "timestamp"), "load", SPLIT, HORIZON, series_cols=KEY), 4)


@register("l13_walk_forward_one_lag", with_views("load_hourly", f"""fit AS (SELECT regr_slope(load, x) AS s, regr_intercept(load, x) AS i FROM {_LAG24} WHERE timestamp < TIMESTAMP '{SPLIT}' AND x IS NOT NULL)
  SELECT event_type, {q('avg(abs(load - (s * x + i)))', 'score', 4)}, count(*) AS steps FROM {_LAG24}, fit WHERE timestamp >= TIMESTAMP '{SPLIT}' GROUP BY 1"""))
def l13s(spark, sf):
    frame = stage(windows.history_features(v.load_hourly(spark, sf), {"load": [24]}, series_cols=KEY).dropna(), "frame")
    model = fit.fit_final(C.train_rows(frame, SPLIT, "timestamp"), ["load_lag_24"], "load", "Linear")
    return v.r(forecast.walk_forward_score(fit.predict(model, frame), "load", "prediction", SPLIT, END, KEY), 4)


def _fold_sql(i):
    lo, hi = f"TIMESTAMP '{START}' + to_hours({24 + 480 - (3 - i) * 120})", f"TIMESTAMP '{START}' + to_hours({24 + 480 - (2 - i) * 120})"
    return f"""SELECT sqrt(avg(power(load - (s * x + i), 2))) AS rmse, avg(abs(load - (s * x + i))) AS mae FROM pairs, (SELECT regr_slope(load, x) AS s, regr_intercept(load, x) AS i FROM pairs WHERE timestamp < {lo})
  WHERE timestamp >= {lo} AND timestamp < {hi}"""


@register("l2_cross_validation_one_lag", with_views("load_hourly", f"""pairs AS (SELECT * FROM {_LAG24} WHERE x IS NOT NULL AND timestamp < TIMESTAMP '{SPLIT}'),
  folds AS ({' UNION ALL '.join(_fold_sql(i) for i in range(3))}) SELECT 'rmse' AS metric, {q('avg(rmse)', 'value', 4)} FROM folds UNION ALL SELECT 'mae', {q('avg(mae)', 'value', 4)} FROM folds"""))
def l2s(spark, sf):
    frame = windows.history_features(v.load_hourly(spark, sf), {"load": [24]}, series_cols=KEY)
    train = C.train_rows(stage(frame.dropna(), "frame"), SPLIT, "timestamp")
    scores = folds.cv_scores(train, ["load_lag_24"], "load", build_model("Linear"), 3)
    return v.r(spark.createDataFrame([(k, float(x)) for k, x in scores.items()], "metric string, value double"), 4)


_WEIGHTS = [0.0, 0.5, 50.0, 5000.0]


def _ridge_sql(i, w):
    lo, hi = f"TIMESTAMP '{START}' + to_hours({24 + 480 - (3 - i) * 120})", f"TIMESTAMP '{START}' + to_hours({24 + 480 - (2 - i) * 120})"
    return f"""SELECT {w}::DOUBLE AS w, sqrt(avg(power(load - (my + s * (x - mx)), 2))) AS rmse, avg(abs(load - (my + s * (x - mx)))) AS mae FROM pairs,
    (SELECT avg(x) AS mx, avg(load) AS my, covar_pop(load, x) / (var_pop(x) + {w}::DOUBLE) AS s FROM pairs WHERE timestamp < {lo}) WHERE timestamp >= {lo} AND timestamp < {hi}"""


@register("l3_ridge_search_one_lag", with_views("load_hourly", f"""pairs AS (SELECT * FROM {_LAG24} WHERE x IS NOT NULL AND timestamp < TIMESTAMP '{SPLIT}'),
  folds AS ({' UNION ALL '.join(_ridge_sql(i, w) for w in _WEIGHTS for i in range(3))})
  SELECT w AS reg_lambda, {q('avg(rmse)', 'rmse', 4)}, {q('avg(mae)', 'mae', 4)} FROM folds GROUP BY 1"""))
def l3r(spark, sf):
    frame = windows.history_features(v.load_hourly(spark, sf), {"load": [24]}, series_cols=KEY)
    train = C.train_rows(stage(frame.dropna(), "frame"), SPLIT, "timestamp")
    found = additive.ridge_search(train, ["load_lag_24"], "load", _WEIGHTS, 3)
    return v.r(spark.createDataFrame([(t["params"]["reg_lambda"], t["rmse"], t["mae"]) for t in found], "reg_lambda double, rmse double, mae double"), 4, ["rmse", "mae"])


@register("l3_l16_additive_search")
def l3a(spark, sf):
    train = C.train_rows(stage(v.load_hourly(spark, sf), "load"), SPLIT, "timestamp")
    space = {
        "growth": ["linear"], "n_changepoints": [2, 20], "changepoint_range": [0.6, 0.95], "seasonality_mode": ["additive", "multiplicative"],
        "seasonality_prior_scale": [5, 50], "weekly_seasonality": [0, 6], "yearly_seasonality": [0, 2], "holidays_prior_scale": [5, 50],
        "changepoint_prior_scale": [0.01, 0.5], "interval_width": [0.9],
    }
    found = search.random_search(train, [], "load", "Prophet", space, 10, 4)
    return spark.createDataFrame([(t["trial"], {k: str(x) for k, x in t["params"].items()}, t["rmse"], t["mae"]) for t in found], "trial int, params map<string,string>, rmse double, mae double")


@register("l16_additive_regression")
def l16(spark, sf):
    load = stage(v.load_hourly(spark, sf), "load")
    spec = additive.AdditiveSpec(changepoints=5, orders={24.0: 3, 168.0: 2}, multiplicative=True, interval=0.9)
    model = additive.fit_additive(C.train_rows(load, SPLIT, "timestamp"), "load", spec)
    return model.predict(C.test_rows(load, SPLIT, "timestamp"))


@register("l16_trend_and_interval", with_views("load_hourly", f"""t AS (SELECT *, date_diff('second', min(timestamp) OVER (), timestamp) / 3600.0::DOUBLE AS h FROM load_hourly WHERE timestamp < TIMESTAMP '{SPLIT}'),
  f AS (SELECT regr_slope(load, h) AS s, regr_intercept(load, h) AS i FROM t), e AS (SELECT sqrt(avg(power(load - s * h - i, 2))) AS sigma FROM t, f),
  p AS (SELECT event_type, timestamp, load, s * date_diff('second', (SELECT min(timestamp) FROM load_hourly), timestamp) / 3600.0 + i AS p, sigma FROM load_hourly, f, e WHERE timestamp >= TIMESTAMP '{SPLIT}')
  SELECT event_type, timestamp, {q('load', 'load', 4)}, {q('p', 'prediction', 4)}, {q('p - 1.6448536269514722 * sigma', 'lower', 4)}, {q('p + 1.6448536269514722 * sigma', 'upper', 4)} FROM p"""))
def l16t(spark, sf):
    load = stage(v.load_hourly(spark, sf), "load")
    spec = additive.AdditiveSpec(changepoints=0, orders={}, interval=0.9, holiday_scale=1e-9)  # holidays shrink to nothing
    model = additive.fit_additive(C.train_rows(load, SPLIT, "timestamp"), "load", spec)
    return v.r(model.predict(C.test_rows(load, SPLIT, "timestamp")), 4)


@register("l15_model_features")
def l15(spark, sf):
    frame = ml_frame(spark, sf)
    model = fit.fit_final(C.train_rows(frame, SPLIT, "timestamp"), FEATURES, "load", "Linear")
    path = new_path(spark, "model")
    model.write().save(path)
    from pyspark.ml import PipelineModel

    return _chosen(spark, fit.feature_names(PipelineModel.load(path)), "saved")


@register("o11_o12_l5_l6_train_and_forecast")
def o11(spark, sf):
    frame = ml_frame(spark, sf)
    runs_path, models = new_path(spark, "runs"), new_path(spark, "models")
    TN.train_model(frame, FEATURES, "load", SPLIT, "Random Forest", {"n_estimators": [5, 8], "max_depth": [3, 5]}, runs_path, models,
                   "demo", "E_f_8_rfe_4", 2, 2, key_cols=["event_type", "timestamp"], repeats=2)
    return v.r(FC.forecast_best(frame, None, "load", SPLIT, HORIZON, runs_path, models, "demo",
                                series_cols=KEY, out=new_path(spark, "forecast")))


@register("o13_profile_sessions", with_views("sessions", """SELECT 'values_plug_type' AS part, coalesce(plug_type, 'none') AS item, count(*)::DOUBLE AS value FROM sessions GROUP BY 2
  UNION ALL SELECT 'distinct', 'energy', count(DISTINCT energy) FROM sessions UNION ALL SELECT 'nulls', 'plug_type', count(*) - count(plug_type) FROM sessions
  UNION ALL SELECT 'median', 'energy', round(quantile_cont(energy, 0.5) + 1.23e-8, 6) FROM sessions
  UNION ALL SELECT 'hours', 'used', count(DISTINCT date_trunc('hour', starttime)) FROM sessions UNION ALL SELECT 'repeated', 'rows', 0"""))
def o13(spark, sf):
    tables = PR.profile_source(v.sessions(spark, sf), "starttime", ["energy"], ["plug_type"])
    part = lambda df, name, item, value: df.select(F.lit(name).alias("part"), item.alias("item"), value.cast("double").alias("value"))
    columns = tables["columns"]
    out = part(tables["values_plug_type"], "values_plug_type", F.coalesce("plug_type", F.lit("none")), F.col("count"))
    out = out.unionByName(part(columns.where("column = 'energy'"), "distinct", F.col("column"), F.col("distinct_values")))
    out = out.unionByName(part(columns.where("column = 'plug_type'"), "nulls", F.col("column"), F.col("nulls")))
    out = out.unionByName(part(v.r(tables["describe"]), "median", F.col("column"), F.col("q50")))
    out = out.unionByName(part(tables["completeness_hour"], "hours", F.lit("used"), F.col("used_bins")))
    return out.unionByName(part(tables["repeated_rows"].agg(F.count("*").alias("n")), "repeated", F.lit("rows"), F.col("n")))


