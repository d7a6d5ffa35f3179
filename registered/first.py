"""Scans, cleaning, bounds, joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoload.functions import textfns, timefns
from chronoload.operators import bounds as B
from chronoload.operators import clean as C
from chronoload.operators import events as EV
from chronoload.operators import grid as G
from chronoload.operators import profile as P
from chronoload.operators import quantiles as Q
from chronoload.operators import trend as TR
from chronoload.operators import windows
from chronoload.plans import enrich as E
from chronoload.session import new_path, stage
from chronoload.sources import event_files as EF
from chronoload.sources import stages as ST
from chronoload.sources import stations as STN
from registered import views as v
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


PERIOD = E.Period(START, END, SPLIT)

# ---------------------------------------------------------------- flagship


@register(
    "hourly_load_features",
    with_views(
        "load_hourly",
        f"""SELECT event_type, timestamp, {q('load')},
  {q('lag(load, 1) OVER w', 'load_lag_1')}, {q('lag(load, 24) OVER w', 'load_lag_24')},
  {q('CASE WHEN count(load) OVER p = 24 THEN avg(load) OVER p END', 'load_rw_24_mean')}
  FROM load_hourly WINDOW w AS (PARTITION BY event_type ORDER BY timestamp),
  p AS (PARTITION BY event_type ORDER BY timestamp ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
    ),
)
def hourly_load_features(spark, sf):
    return v.r(windows.history_features(
        v.load_hourly(spark, sf), lags={"load": [1, 24]}, means={"load": [24]}, series_cols=["event_type"]))


# ---------------------------------------------------------------- A: sources and sinks


def _session_file(spark, sf):
    raw = v.sessions(spark, sf).select(
        F.when(F.col("event_id") % 101 != 0, F.date_format("starttime", EF.SESSION_TIME)).otherwise("not known").alias("Start Date"),
        F.date_format("endtime", EF.SESSION_TIME).alias("End Date"),
        F.col("event_id").alias("Plug In Event-Id"), F.col("energy").alias("Energy (kWh)"), F.col("plug_type").alias("Plug Type"),
    )
    path = EF.write_csv(raw, new_path(spark, "session-file"))
    schema = EF.schema_of({"Start Date": "string", "End Date": "string", "Plug In Event-Id": "bigint",
                           "Energy (kWh)": "double", "Plug Type": "string"})
    return EF.EventFile(path, schema, "Start Date", "End Date", EF.SESSION_TIME)


def _incident_file(spark, sf):
    raw = v.incidents(spark, sf).select(
        F.date_format("starttime", EF.EVENT_TIME).alias("StartTime(UTC)"),
        F.date_format("endtime", EF.EVENT_TIME).alias("EndTime(UTC)"),
        F.col("event_id").alias("EventId"), F.col("type").alias("Type"), F.col("severity").alias("Severity"),
        F.concat(F.lit("C"), F.col("severity")).alias("City"),
        F.when(F.col("distance") < 5, "North").otherwise("South").alias("County"), F.lit("CA").alias("State"),
        F.col("distance").alias("Distance(mi)"),
    )
    path = EF.write_csv(raw, new_path(spark, "incident-file"))
    schema = EF.schema_of({"StartTime(UTC)": "string", "EndTime(UTC)": "string", "EventId": "bigint", "Type": "string",
                           "Severity": "string", "City": "string", "County": "string", "State": "string",
                           "Distance(mi)": "double"})
    return EF.EventFile(path, schema, "StartTime(UTC)", "EndTime(UTC)", EF.EVENT_TIME)


@register(
    "a1_filtered_session_scan",
    with_views("sessions", """SELECT event_id AS plug_in_event_id, date_trunc('minute', starttime) AS starttime,
  date_trunc('minute', endtime) AS endtime, energy, plug_type FROM sessions
  WHERE event_id % 101 != 0 AND date_trunc('minute', starttime) >= TIMESTAMP '2024-01-05'
  AND date_trunc('minute', endtime) < TIMESTAMP '2024-01-25'"""),
)
def a1(spark, sf):
    return v.r(EF.load_events(spark, _session_file(spark, sf), min_ts="2024-01-05", max_ts="2024-01-25"))


@register(
    "a2_location_filtered_scan",
    with_views("incidents", """SELECT event_id AS eventid, starttime, endtime, type, severity, 'C' || severity AS city,
  'North' AS county, 'CA' AS state, distance FROM incidents
  WHERE severity IN ('1', '3') AND distance < 5 AND starttime >= TIMESTAMP '2024-01-03' AND endtime < TIMESTAMP '2024-01-29'"""),
)
def a2(spark, sf):
    source = _incident_file(spark, sf)
    return v.r(EF.load_events(spark, source, min_ts="2024-01-03", max_ts="2024-01-29", cities=["C1", "C3"],
                              counties=["North"], states=["CA"]))


@register(
    "a3_text_dates",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 11 != 0 THEN o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) END AS parsed
  FROM orders""",
)
def a3(spark, sf):
    orders = v.table(spark, sf, "orders")
    minute = F.timestamp_seconds(F.unix_seconds("o_orderdate") + (F.col("o_orderkey") % 1440) * 60)
    padded = F.date_format(minute, "MM/dd/yyyy HH:mm")
    plain = F.date_format(minute, EF.SESSION_TIME)
    text = F.when(F.col("o_orderkey") % 11 == 0, "13/45/x").when(F.col("o_orderkey") % 2 == 0, padded).otherwise(plain)
    return v.r(orders.select("o_orderkey", timefns.parse_time(text, EF.SESSION_TIME).alias("parsed")))


@register("a4_whole_seconds", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def a4(spark, sf):
    return v.r(v.events(spark, sf).select("event_id", F.date_trunc("SECOND", "ts").alias("ts")))


@register(
    "a5_standard_columns",
    with_views("sessions", "SELECT starttime, endtime, event_id AS plug_in_event_id, energy, plug_type AS site_type_a FROM sessions"),
)
def a5(spark, sf):
    raw = v.sessions(spark, sf).select(
        F.col("starttime").alias("Start Date"), F.col("endtime").alias(" End-Date "),
        F.col("event_id").alias("Plug In Event-Id"), F.col("energy").alias("Energy (kWh)"), F.col("plug_type").alias("Site/Type:A"))
    return v.r(textfns.standardise_columns(raw))


@register(
    "a6_station_temperature",
    with_views("temps", """SELECT station AS temp_ws, starttime, temp FROM temps WHERE station IN (0, 2)
  AND starttime BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-20'"""),
)
def a6(spark, sf):
    return v.r(STN.station_temperature(v.temps(spark, sf), [0, 2], "2024-01-04", "2024-01-20", time_col="starttime"))


@register(
    "a7_nearest_stations",
    f"""SELECT station, {q('km', 'distance_km')} FROM (SELECT *, 2 * 6371.0 * asin(sqrt(least(1.0,
  power(sin(radians(lat - 37.444178) / 2), 2) + cos(radians(lat)) * cos(radians(37.444178)) * power(sin(radians(lon + 122.154721) / 2), 2)))) AS km
  FROM (SELECT c_custkey AS station, c_acctbal / 150.0 AS lat, -90.0 - c_custkey % 80 AS lon FROM customer))
  ORDER BY km, station LIMIT 10""",
)
def a7(spark, sf):
    stations = v.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("station"), (F.col("c_acctbal") / 150.0).alias("latitude"),
        (F.lit(-90.0) - F.col("c_custkey") % 80).alias("longitude"))
    return v.r(STN.nearest_stations(stations, 37.444178, -122.154721, 10).select("station", "distance_km"))


@register("a8_a9_stage_round_trip", with_views("incidents", "SELECT * FROM incidents"))
def a8(spark, sf):
    df = v.incidents(spark, sf)
    path = ST.write_stage(df, new_path(spark, "interim"), "csv")
    return v.r(ST.read_stage(spark, path, df.schema, "csv"))


@register(
    "a10_versioned_feature_set",
    with_views("load_hourly", f"""SELECT event_type, timestamp, {q('load')}, 'EW_f_20_rfe_10' AS feature_version,
  CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN 'train' ELSE 'test' END AS split FROM load_hourly"""),
)
def a10(spark, sf):
    version = ST.feature_version(True, False, "f", 20, "rfe", 10)
    path = new_path(spark, "features")
    ST.write_versioned(v.load_hourly(spark, sf), path, version, SPLIT)
    return v.r(spark.read.parquet(path).select("event_type", "timestamp", "load", "feature_version", "split"))


TREND_SQL = f"""SELECT event_type, regr_slope(load, date_diff('hour', TIMESTAMP '{START}', timestamp)) AS slope,
  regr_intercept(load, date_diff('hour', TIMESTAMP '{START}', timestamp)) AS intercept
  FROM load_hourly WHERE timestamp < TIMESTAMP '{SPLIT}' GROUP BY 1"""


@register(
    "a11_trend_store_upsert",
    with_views("load_hourly", f"""t AS ({TREND_SQL})
  SELECT event_type, {q('slope')}, {q('intercept')}, '2024-01-01 00:00:00|2024-01-22 00:00:00|2024-01-31 00:00:00' AS date_key FROM t"""),
)
def a11(spark, sf):
    train = C.train_rows(v.load_hourly(spark, sf), SPLIT, "timestamp")
    trend = TR.trend_records(TR.ols_trend(train, "load", START, ["event_type"]), START, SPLIT, END)
    path, keys = new_path(spark, "trend"), ("event_type", "date_key")
    first = trend.where(F.col("event_type").isin("click", "view"))
    ST.upsert_trend(first, path, keys)
    return v.r(ST.upsert_trend(trend, path, keys))


@register(
    "a12_integers_to_double",
    "SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def a12(spark, sf):
    return C.ints_to_double(v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))


@register("a13_first_rows", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 100")
def a13(spark, sf):
    return ST.sample_rows(v.events(spark, sf).select("event_id", "event_type", "value"), 100, ("event_id",))


# ---------------------------------------------------------------- B: cleaning

CLEAN_SQL = """cleaned AS (SELECT *, ln(1 + duration) AS log_duration, ln(1 + distance) AS log_distance FROM (
  SELECT DISTINCT starttime, endtime, type, severity, distance,
    CAST(floor(date_diff('second', starttime, endtime) / 60.0) AS DOUBLE) AS duration FROM incidents)
  WHERE duration > 0 AND distance > 0 AND type IN ('click', 'view', 'error'))"""


def _cleaned_incidents(spark, sf, only_train=False):
    df = v.landed(v.incidents(spark, sf), "incidents").drop("event_id").withColumn("duration", timefns.minutes_between("starttime", "endtime").cast("double"))
    twice = df.unionByName(df)
    cleaned, train = C.clean_and_split(
        twice, SPLIT, keep_cols=["starttime", "endtime", "type", "severity", "distance", "duration"],
        positive_cols=["duration", "distance"], log_cols=["duration", "distance"], types=["click", "view", "error"])
    return train if only_train else cleaned


_CLEAN_COLS = f"starttime, endtime, type, severity, distance, duration, {q('log_duration')}, {q('log_distance')}"


@register("b0_clean_events", with_views("incidents", f"{CLEAN_SQL} SELECT {_CLEAN_COLS} FROM cleaned"))
def b0(spark, sf):
    return v.r(_cleaned_incidents(spark, sf), only=["log_duration", "log_distance"])


@register("b8_train_split", with_views("incidents", f"{CLEAN_SQL} SELECT {_CLEAN_COLS} FROM cleaned WHERE endtime < TIMESTAMP '{SPLIT}'"))
def b8(spark, sf):
    return v.r(_cleaned_incidents(spark, sf, True), only=["log_duration", "log_distance"])


@register("b1_distinct_rows", "SELECT DISTINCT l_suppkey, l_quantity, l_returnflag FROM lineitem")
def b1(spark, sf):
    return C.distinct_rows(v.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag"))


@register("b2_b4_drop_missing", with_views("sessions", """SELECT energy, plug_type, CASE WHEN plug_type IS NOT NULL THEN starttime END AS starttime
  FROM sessions WHERE plug_type IS NOT NULL"""))
def b2(spark, sf):
    df = v.sessions(spark, sf).select("energy", "plug_type", F.when(F.col("plug_type").isNotNull(), F.col("starttime")).alias("starttime"))
    return v.r(C.drop_untimed(df.dropna(how="all")))


@register("b5_positive_only", with_views("sessions", "SELECT event_id, energy FROM sessions WHERE energy > 0"))
def b5(spark, sf):
    return C.positive_only(v.sessions(spark, sf).select("event_id", "energy"), ["energy"])


@register("b6_type_filter", with_views("incidents", "SELECT event_id, type FROM incidents WHERE type IN ('click', 'view')"))
def b6(spark, sf):
    return v.incidents(spark, sf).where(F.col("type").isin("click", "view")).select("event_id", "type")


@register("b7_log_columns", with_views("sessions", f"SELECT event_id, energy, {q('ln(1 + energy)', 'log_energy', 8)} FROM sessions WHERE energy IS NOT NULL"))
def b7(spark, sf):
    return v.r(C.add_logs(v.sessions(spark, sf).select("event_id", "energy"), ["energy"]), 8, only=["log_energy"])


SESSION_COLS_SQL = """timed AS (SELECT *, (CAST(split_part(charging_time, ':', 1) AS INT) * 3600 + CAST(split_part(charging_time, ':', 2) AS INT) * 60
  + CAST(split_part(charging_time, ':', 3) AS INT)) / 3600.0::DOUBLE AS duration_hours FROM sessions),
  powered AS (SELECT *, CASE WHEN duration_hours <> 0 THEN energy / duration_hours END AS charger_kw FROM timed WHERE plug_type IS NOT NULL)"""


@register("b9_b11_b12_session_columns", with_views("sessions", f"""{SESSION_COLS_SQL}
  SELECT event_id, plug_type, {q('duration_hours')}, {q('charger_kw')} FROM powered"""))
def b9(spark, sf):
    return v.r(E.session_columns(v.sessions(spark, sf)).select("event_id", "plug_type", "duration_hours", "charger_kw"))


@register("b10_floor_minutes", with_views("sessions", """SELECT event_id, CAST(floor((epoch_us(endtime) - epoch_us(starttime)) / 60000000.0) AS BIGINT) AS minutes,
  CAST(floor((epoch_us(starttime) - epoch_us(endtime) - 30000000) / 60000000.0) AS BIGINT) AS backwards FROM sessions"""))
def b10(spark, sf):
    early = F.timestamp_micros(F.unix_micros("starttime") - 30_000_000)
    return v.sessions(spark, sf).select(
        "event_id", timefns.minutes_between("starttime", "endtime").alias("minutes"),
        timefns.minutes_between("endtime", early).alias("backwards"))


SESSION_CLEAN_SQL = SESSION_COLS_SQL + """,
  clean AS (SELECT *, ln(1 + energy) AS log_energy FROM (SELECT DISTINCT * FROM powered) WHERE duration_hours > 0 AND energy IS NOT NULL)"""
TRIM_SQL = SESSION_CLEAN_SQL + f""",
  power AS (SELECT plug_type, quantile_cont(charger_kw, {{q}}) AS low, quantile_cont(charger_kw, 1 - {{q}}) AS high FROM clean
    WHERE endtime < TIMESTAMP '{SPLIT}' GROUP BY 1),
  trimmed AS (SELECT c.* FROM clean c LEFT JOIN power p USING (plug_type)
    WHERE NOT coalesce(charger_kw <= low OR charger_kw >= high, FALSE))"""


@register("b13_quantile_trim", with_views("sessions", f"""{TRIM_SQL.format(q=0.01)}
  SELECT event_id, plug_type, {q('charger_kw')} FROM trimmed"""))
def b13(spark, sf):
    rules = E.SessionRules(keep_cols=(*E.SessionRules.keep_cols, "event_id"))
    cleaned = stage(E.clean_sessions(v.landed(v.sessions(spark, sf), "sessions"), rules), "sessions")
    train = C.train_rows(cleaned, SPLIT)
    power = stage(B.quantile_trim_bounds(train, "charger_kw", 0.01, ["plug_type"]), "power")
    return v.r(B.quantile_trim(cleaned, power, "charger_kw", ["plug_type"]).select("event_id", "plug_type", "charger_kw"))


@register("b14_impute_energy", with_views("sessions", f"""{SESSION_COLS_SQL} SELECT event_id, {q('coalesce(energy, CASE plug_type WHEN ' + "'J1772' THEN 6.0 WHEN 'NEMA 5-20R' THEN 1.5 END * duration_hours)", 'energy')} FROM powered
  WHERE energy IS NOT NULL OR duration_hours IS NOT NULL"""))
def b14(spark, sf):
    return v.r(C.impute_energy(E.session_columns(v.sessions(spark, sf))).select("event_id", "energy"))


@register("b15_b16_out_of_range_to_null", with_views("temps", """SELECT station, starttime, CASE WHEN temp BETWEEN -1 AND 50 THEN temp END AS temp,
  CAST(CASE WHEN temp BETWEEN -1 AND 50 THEN 0 ELSE 1 END AS INTEGER) AS temp_imputed FROM temps"""))
def b15(spark, sf):
    df = v.temps(spark, sf).withColumn("temp", C.null_outside("temp", -1, 50))
    return v.r(df.withColumn("temp_imputed", F.col("temp").isNull().cast("int")), only=[])


BOUNDS_SQL = f"""{CLEAN_SQL}, train AS (SELECT * FROM cleaned WHERE endtime < TIMESTAMP '{SPLIT}'),
  logs AS (SELECT 'duration' AS "column", * EXCLUDE ("column") FROM ({v.mad_sql('train', 'log_duration', 3.5)})
    UNION ALL SELECT 'distance', * EXCLUDE ("column") FROM ({v.mad_sql('train', 'log_distance', 3.5)})),
  bounds AS (SELECT "column", exp(median) - 1 AS median, skewed, exp(min_val) - 1 AS min_val, exp(max_val) - 1 AS max_val FROM logs)"""


@register("b18_log_bounds", with_views("incidents", f"""{BOUNDS_SQL} SELECT "column", skewed, {q('median')}, {q('min_val')}, {q('max_val')} FROM bounds"""))
def b18(spark, sf):
    train = stage(_cleaned_incidents(spark, sf, True), "train")
    return v.r(B.bounds_from_log(B.mad_bounds(train, ["log_duration", "log_distance"], 3.5)))


@register("b17_cap_to_bounds", with_views("incidents", f"""{BOUNDS_SQL}, w AS (SELECT max(min_val) FILTER ("column" = 'duration') AS lo, max(max_val) FILTER ("column" = 'duration') AS hi,
  max(min_val) FILTER ("column" = 'distance') AS lo2, max(max_val) FILTER ("column" = 'distance') AS hi2 FROM bounds)
  SELECT starttime, type, severity, {q('CASE WHEN duration > hi THEN hi WHEN duration < lo THEN lo ELSE duration END', 'duration')},
  {q('CASE WHEN distance > hi2 THEN hi2 WHEN distance < lo2 THEN lo2 ELSE distance END', 'distance')} FROM cleaned, w"""))
def b17(spark, sf):
    rules = E.traffic_rules(["click", "view", "error"], v.SEVERITIES, {})
    return v.r(E.incidents_capped(v.landed(v.incidents(spark, sf), "incidents").drop("event_id"), PERIOD, rules).select("starttime", "type", "severity", "duration", "distance"))


@register("b19_sum_matching_columns", """SELECT l_orderkey, l_linenumber, round(l_discount + l_tax + 1.23e-8, 6) AS rate_total, 0.0::DOUBLE AS none_total FROM (
  SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem)""")
def b19(spark, sf):
    df = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("rate_discount"), F.col("l_tax").alias("rate_tax"))
    out = C.sum_matching(C.sum_matching(df, "rate_total", "rate", "t"), "none_total", "storm")
    return v.r(out.select("l_orderkey", "l_linenumber", "rate_total", "none_total"), only=["rate_total"])


@register("b20_columns_by_substring", "SELECT l_orderkey, l_orderkey AS k, l_shipdate FROM (SELECT l_orderkey, l_shipdate FROM lineitem)")
def b20(spark, sf):
    df = v.table(spark, sf, "lineitem")
    chosen = textfns.matching(df.columns, ["order", "ship"])
    return v.r(df.select(*chosen, F.col("l_orderkey").alias("k")), only=[])


@register("b21_station_group", with_views("sessions", """SELECT event_id, station_group FROM (SELECT event_id,
  trim(substring(station_name, 15, greatest(CASE WHEN instr(station_name, '#') > 0 THEN instr(station_name, '#') - 1 ELSE length(station_name) - 1 END - 14, 0))) AS station_group
  FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN replace(station_name, '#', '') ELSE station_name END AS station_name FROM sessions)) WHERE NOT contains(station_group, 'SIGN')"""))
def b21(spark, sf):
    name = F.when(F.col("event_id") % 7 == 0, F.replace("station_name", F.lit("#"), F.lit(""))).otherwise(F.col("station_name"))
    df = v.sessions(spark, sf).select("event_id", textfns.station_group(name).alias("station_group"))
    return df.where(~F.col("station_group").contains("SIGN"))


@register("b22_time_ranges", """SELECT event_id, ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' AS half_open,
  CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AS closed FROM events""")
def b22(spark, sf):
    ts = F.col("ts")
    return v.events(spark, sf).select(
        "event_id", ((ts >= timefns.ts_lit("2024-01-10")) & (ts < timefns.ts_lit("2024-01-12"))).alias("half_open"),
        F.to_date(ts).between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date")).alias("closed"))


@register("b24_split_rows", with_views("load_hourly", f"SELECT event_type, timestamp, {q('load')} FROM load_hourly WHERE timestamp >= TIMESTAMP '{SPLIT}'"))
def b24(spark, sf):
    return v.r(C.test_rows(v.load_hourly(spark, sf), SPLIT, "timestamp"))


# ---------------------------------------------------------------- C, D: grid, joins, aggregates


@register("c4_d1_resample_sum_on_grid", with_views("load_hourly", f"SELECT event_type, timestamp, {q('load')} FROM load_hourly"))
def d1(spark, sf):
    return v.r(v.load_hourly(spark, sf))


@register("d1_resample_six_hours", f"""SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS timestamp, {q('sum(value)', 'load')},
  count(*) AS events FROM events GROUP BY 1, 2""")
def d1b(spark, sf):
    return v.r(G.resample(v.events(spark, sf), "ts", [F.sum("value").alias("load"), F.count("*").alias("events")], ["event_type"], 21_600))


@register("d1_resample_five_hours_from_origin", f"""SELECT time_bucket(INTERVAL 5 HOUR, ts, TIMESTAMP '2024-01-01') AS timestamp, {q('sum(value)', 'load')} FROM events GROUP BY 1""")
def d1c(spark, sf):
    return v.r(G.resample(v.events(spark, sf), "ts", [F.sum("value").alias("load")], (), 18_000, START))


@register("d2_resample_mean_on_grid", with_views("temps hours", f"""SELECT h.timestamp, {q('temp')} FROM hours h
  LEFT JOIN (SELECT starttime, avg(temp) AS temp FROM temps GROUP BY 1) t ON t.starttime = h.timestamp"""))
def d2(spark, sf):
    means = G.resample(v.temps(spark, sf), "starttime", [F.avg("temp").alias("temp")])
    return v.r(G.align(means, START, END))


PIECES_SQL = """pieces AS (SELECT * EXCLUDE (h, s, e), make_timestamp(h * 3600000000) AS timestamp,
  (least((h + 1) * 3600000000, e) - greatest(h * 3600000000, s)) / 60000000.0::DOUBLE AS minutes
  FROM (SELECT *, unnest(generate_series(s // 3600000000, (e - 1) // 3600000000)) AS h FROM (
    SELECT *, epoch_us(starttime) AS s, epoch_us(starttime) + CAST(round(dur * 60000000) AS BIGINT) AS e FROM {src}) WHERE e > s))"""


@register("i1_split_by_hour", with_views("incidents", f"""src AS (SELECT event_id, starttime, type, distance, date_diff('minute', starttime, endtime) + 0.5::DOUBLE AS dur FROM incidents),
  {PIECES_SQL.format(src='src')} SELECT event_id, timestamp, type, distance, {q('minutes', 'duration')} FROM pieces"""))
def i1(spark, sf):
    df = v.incidents(spark, sf).select(
        "event_id", "starttime", "type", "distance", (timefns.minutes_between("starttime", "endtime") + F.lit(0.5)).alias("duration"))
    return v.r(EV.split_by_hour(df), only=["duration"])


def _pivot_cols(values, types, prefix):
    return ", ".join(
        f"""{q(f"coalesce(sum({col}) FILTER (type = '{t}' AND severity = '{s}'), 0)", f"{prefix(name, t, s)}", 4)}"""
        for col, name in values for t in types for s in v.SEVERITIES)


def _rest_cols(values, types, prefix):
    listed = " OR ".join(f"(type = '{t}' AND severity = '{s}')" for t in types for s in v.SEVERITIES)
    return ", ".join(q(f"coalesce(sum({col}) FILTER (NOT coalesce({listed}, false)), 0)", prefix(name), 4) for col, name in values)


@register("d3_pivot_sum", with_views("incidents", f"""src AS (SELECT starttime, type, severity, date_diff('minute', starttime, endtime)::DOUBLE AS dur FROM incidents),
  {PIECES_SQL.format(src='src')} SELECT timestamp, {_pivot_cols([('minutes', 'duration')], ['click', 'view'], lambda n, t, s: f'w_{t}_{s}_dur')},
    {_rest_cols([('minutes', 'duration')], ['click', 'view'], lambda n: 'w_rest_dur')}
  FROM pieces GROUP BY 1"""))
def d3(spark, sf):
    df = v.incidents(spark, sf).withColumn("duration", timefns.minutes_between("starttime", "endtime").cast("double"))
    pairs = [(t, s) for t in ("click", "view") for s in v.SEVERITIES]
    return v.r(G.pivot_sums(EV.split_by_hour(df), ["timestamp"], ["type", "severity"], pairs, ["duration"],
                            lambda c, p: f"w_{'_'.join(p)}_dur", ("rest",)), 4)


@register("d4_pivot_two_sums", with_views("incidents", f"""src AS (SELECT starttime, type, severity, distance, date_diff('minute', starttime, endtime)::DOUBLE AS dur FROM incidents),
  {PIECES_SQL.format(src='src')} SELECT timestamp, {_pivot_cols([('minutes', 'duration'), ('distance', 'distance')], ['click', 'view'], lambda n, t, s: f't_{n}_{t}_{s}')},
    {_rest_cols([('minutes', 'duration'), ('distance', 'distance')], ['click', 'view'], lambda n: f't_{n}_rest')}
  FROM pieces GROUP BY 1"""))
def d4(spark, sf):
    df = v.incidents(spark, sf).withColumn("duration", timefns.minutes_between("starttime", "endtime").cast("double"))
    pairs = [(t, s) for t in ("click", "view") for s in v.SEVERITIES]
    return v.r(G.pivot_sums(EV.split_by_hour(df), ["timestamp"], ["type", "severity"], pairs, ["duration", "distance"],
                            lambda c, p: f"t_{c}_{'_'.join(p)}", ("rest",)), 4)


@register("c1_four_way_join", with_views("load_hourly incidents", f"""t AS (SELECT event_type, date_trunc('hour', ts) AS timestamp, avg(value) AS mean_value, count(*) AS sessions FROM events GROUP BY 1, 2),
  d AS (SELECT type AS event_type, date_trunc('hour', starttime) AS timestamp, count(*) AS incidents, sum(distance) AS distance FROM incidents GROUP BY 1, 2)
  SELECT event_type, timestamp, {q('load')}, coalesce(sessions, 0) AS sessions, {q('mean_value')}, coalesce(incidents, 0) AS incidents, {q('coalesce(distance, 0)', 'distance')}
  FROM load_hourly LEFT JOIN t USING (event_type, timestamp) LEFT JOIN d USING (event_type, timestamp)"""))
def c1(spark, sf):
    events, span = v.events(spark, sf), (v.START, v.END, ["event_type"])
    counts = G.align(G.resample(events, "ts", [F.count("*").alias("sessions")], ["event_type"]), *span, ["sessions"])
    means = G.align(G.resample(events, "ts", [F.avg("value").alias("mean_value")], ["event_type"]), *span)
    incidents = v.incidents(spark, sf).withColumnRenamed("type", "event_type")
    logged = G.align(
        G.resample(incidents, "starttime", [F.count("*").alias("incidents"), F.sum("distance").alias("distance")], ["event_type"]),
        *span, ["incidents", "distance"])
    parts = {"load": v.load_hourly(spark, sf), "counts": counts, "means": means, "incidents": logged}
    staged = {name: stage(part, name) for name, part in parts.items()}  # read by the validation and by the join
    return v.r(G.combine(staged, 720, ["event_type"]))


@register("c6_membership", "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def c6(spark, sf):
    wanted = v.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return v.events(spark, sf).join(wanted, "user_id", "left_semi").select("event_id", "user_id")


@register("d5_exact_quantiles", f"""SELECT l_returnflag, count(l_extendedprice) AS n, {q('quantile_cont(l_extendedprice, 0.001)', 'q0_1', 4)}, {q('quantile_cont(l_extendedprice, 0.5)', 'q50', 4)},
  {q('quantile_cont(l_extendedprice, 0.999)', 'q99_9', 4)} FROM lineitem GROUP BY 1""")
def d5(spark, sf):
    return v.r(Q.exact_quantiles(v.table(spark, sf, "lineitem"), "l_extendedprice", [0.001, 0.5, 0.999], ["l_returnflag"], accuracy=1000), 4)


@register("d6_mad_bounds", with_views("incidents sessions", f"""src AS (SELECT type, 1.0 * date_diff('minute', starttime, endtime) AS duration, distance, CASE WHEN distance < 5 THEN 1 ELSE 0 END AS flag FROM incidents),
  parts AS ({v.mad_sql('src', 'duration', 4, 'type')} UNION ALL {v.mad_sql('src', 'distance', 4, 'type')} UNION ALL {v.mad_sql('src', 'flag', 4, 'type')}
  UNION ALL SELECT 'sessions', * FROM ({v.mad_sql('sessions', 'energy', 4)}))
  SELECT type, "column", skewed, {q('median')}, {q('min_val')}, {q('max_val')} FROM parts"""))
def d6(spark, sf):
    incidents = v.incidents(spark, sf).select(
        "type", timefns.minutes_between("starttime", "endtime").alias("duration"), "distance", (F.col("distance") < 5).cast("int").alias("flag"))
    sessions = v.sessions(spark, sf).withColumn("type", F.lit("sessions"))
    values = B.long_values(incidents, ["duration", "distance", "flag"], ["type"]).unionByName(B.long_values(sessions, ["energy"], ["type"]))
    return v.r(B.mad_bounds_of(stage(values, "values"), 4, ["type"]))


_IQR = "quantile_cont(value, 0.75) - quantile_cont(value, 0.25)"


@register("d7_iqr_bounds", f"""SELECT event_type, 'value' AS "column", {q(f'quantile_cont(value, 0.25) - 2 * ({_IQR})', 'min_val')}, {q(f'quantile_cont(value, 0.75) + 2 * ({_IQR})', 'max_val')} FROM events GROUP BY 1""")
def d7(spark, sf):
    return v.r(B.iqr_bounds(v.events(spark, sf), ["value"], 2.0, ["event_type"]))


@register("d8_outlier_share", f"""SELECT e.event_type, 'value' AS "column", {q('100 * avg(CAST(value < lo OR value > hi AS INTEGER))', 'outlier_pct')} FROM events e
  JOIN (SELECT event_type, quantile_cont(value, 0.25) - 0.5 * ({_IQR}) AS lo, quantile_cont(value, 0.75) + 0.5 * ({_IQR}) AS hi FROM events GROUP BY 1) b ON b.event_type = e.event_type GROUP BY 1""")
def d8(spark, sf):
    df = v.events(spark, sf)
    limits = stage(B.iqr_bounds(df, ["value"], 0.5, ["event_type"]), "iqr")
    return v.r(B.outlier_share(df, limits, ["value"], ["event_type"]))


def _completeness_sql(n):
    return f"""SELECT user_id, {n} AS n, count(DISTINCT b) AS used_bins, max(b) - min(b) AS span_bins,
  CASE WHEN max(b) > min(b) THEN count(DISTINCT b) / (max(b) - min(b))::DOUBLE END AS completeness FROM (
  SELECT e.user_id, date_diff('hour', d0, ts) // {n} AS b FROM events e JOIN (SELECT user_id, date_trunc('day', min(ts)) AS d0 FROM events GROUP BY 1) f USING (user_id)) GROUP BY 1"""


@register("d9_completeness", " UNION ALL ".join(f"SELECT user_id, n, used_bins, span_bins, {q('completeness')} FROM ({_completeness_sql(n)})" for n in (1, 5, 24)))
def d9(spark, sf):
    parts = [P.completeness(v.events(spark, sf), "ts", "h", n, ["user_id"]).withColumn("n", F.lit(n)) for n in (1, 5, 24)]
    return v.r(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register("d10_period_totals", f"""SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period, {q('sum(o_totalprice)', 'value', 2)} FROM orders GROUP BY 1""")
def d10(spark, sf):
    return v.r(P.period_totals(v.table(spark, sf, "orders"), F.date_trunc("MONTH", "o_orderdate"), "o_totalprice"), 2)


@register("d10_period_means_by_weekday", f"""SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, {q('avg(value)', 'value')} FROM events WHERE isodow(ts) - 1 IN (0, 5, 6) GROUP BY 1, 2""")
def d10b(spark, sf):
    return v.r(P.period_totals(v.events(spark, sf), F.date_trunc("DAY", "ts"), "value", "mean", True, [0, 5, 6], "ts"))


_DESCRIBE = "count({c}) AS \"count\", " + ", ".join(q(e, n, 4) for e, n in [
    ("avg({c})", "mean"), ("stddev_samp({c})", "std"), ("min({c})", "min"), ("quantile_cont({c}, 0.25)", "q25"),
    ("quantile_cont({c}, 0.5)", "q50"), ("quantile_cont({c}, 0.75)", "q75"), ("max({c})", "max")])


@register("d11_describe", " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS \"column\", {_DESCRIBE.format(c=c)} FROM lineitem GROUP BY 1" for c in ("l_quantity", "l_extendedprice")))
def d11(spark, sf):
    return v.r(P.describe(v.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], ["l_returnflag"]), 4)


@register("d12_d13_distinct_and_null_counts", with_views("sessions", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values, count(*) - count({c}) AS nulls FROM sessions" for c in ("event_id", "charging_time", "energy", "plug_type", "station_name"))))
def d12(spark, sf):
    return P.column_counts(v.sessions(spark, sf), ["event_id", "charging_time", "energy", "plug_type", "station_name"])


@register("d14_repeated_rows", "SELECT * EXCLUDE (rn) FROM (SELECT l_suppkey, l_quantity, l_returnflag, row_number() OVER (PARTITION BY l_suppkey, l_quantity, l_returnflag) AS rn FROM lineitem) WHERE rn > 1")
def d14(spark, sf):
    return P.repeated_rows(v.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag"))


@register("d15_value_counts", with_views("sessions", 'SELECT station_name, count(*) AS "count" FROM sessions GROUP BY 1'))
def d15(spark, sf):
    return P.value_counts(v.sessions(spark, sf), "station_name")


@register("d16_crosstab", with_views("incidents", "SELECT type, " + ", ".join(f"count(*) FILTER (severity = '{s}') AS \"{s}\"" for s in v.SEVERITIES) + " FROM incidents GROUP BY 1"))
def d16(spark, sf):
    return P.crosstab(v.incidents(spark, sf), "type", "severity", v.SEVERITIES)


@register("d17_scalar_summary", 'SELECT min(c_acctbal) AS "min", max(c_acctbal) AS "max", ' + q("sum(c_acctbal)", "sum", 2) + ', count(*) FILTER (c_acctbal < 0) AS negatives, count(*) AS "rows" FROM customer')
def d17(spark, sf):
    return v.r(P.scalar_summary(v.table(spark, sf, "customer"), "c_acctbal"), 2, only=["sum"])


_ROUND_HOUR = """CASE WHEN epoch_us(ts) % 3600000000 > 1800000000 OR (epoch_us(ts) % 3600000000 = 1800000000 AND hour(ts) % 2 = 1)
  THEN date_trunc('hour', ts) + INTERVAL 1 HOUR ELSE date_trunc('hour', ts) END"""


@register("d18_active_hours", f"""SELECT CAST(hour(h) AS INTEGER) AS hour, count(*) AS "count", round(count(*) / (any_value(hours) / 24.0::DOUBLE), 3) AS normalised_count FROM (SELECT DISTINCT {_ROUND_HOUR} AS h FROM events),
  (SELECT floor((epoch(max(ts))::BIGINT - epoch(min(ts))::BIGINT) / 3600.0) AS hours FROM (SELECT date_trunc('second', ts) AS ts FROM events)) GROUP BY 1""")
def d18(spark, sf):
    return P.active_hours(v.events(spark, sf), timefns.round_hour("ts"))


@register("d19_zero_share", with_views("load_hourly", f"SELECT event_type, {q('100.0 * avg(CAST(load = 0 AS INTEGER))', 'zero_pct')} FROM load_hourly GROUP BY 1"))
def d19(spark, sf):
    return v.r(P.zero_share(v.load_hourly(spark, sf), "load", ["event_type"]))


@register("d20_histogram", """SELECT CAST(least(floor((l_quantity - 1) / 2.45::DOUBLE), 19) AS INTEGER) AS bin, count(*) AS "count", round(1 + least(floor((l_quantity - 1) / 2.45::DOUBLE), 19) * 2.45::DOUBLE + 1.23e-8, 6) AS bin_start
  FROM lineitem WHERE l_quantity BETWEEN 1 AND 50 GROUP BY 1, 3""")
def d20(spark, sf):
    return v.r(P.histogram(v.table(spark, sf, "lineitem"), "l_quantity", 1, 50, 20))


@register("d21_ols_trend", with_views("load_hourly", f"t AS ({TREND_SQL}) SELECT event_type, {q('slope')}, {q('intercept')} FROM t"))
def d21(spark, sf):
    train = C.train_rows(v.load_hourly(spark, sf), SPLIT, "timestamp")
    return v.r(TR.ols_trend(train, "load", START, ["event_type"]))


@register("d22_series_check", with_views("load_hourly", """SELECT event_type, count(*) AS "rows", count(DISTINCT timestamp) AS distinct_times, min(timestamp) AS first_time, max(timestamp) AS last_time FROM load_hourly GROUP BY 1"""))
def d22(spark, sf):
    df = v.load_hourly(spark, sf)
    G.require_complete(df, PERIOD.periods(), "load", ["event_type"])
    return v.r(G.check_series(df, ["event_type"]))


@register("g1_union_all", "SELECT event_id AS id, value FROM events UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def g1(spark, sf):
    a = v.events(spark, sf).select(F.col("event_id").alias("id"), "value")
    return a.unionByName(v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value")))


# ---------------------------------------------------------------- H: scalar functions


@register("h1_h3_h4_calendar_parts", """SELECT event_id, date_trunc('hour', ts) AS hour_start, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(dayofyear(ts) AS INTEGER) AS dayofyear, CAST(month(ts) AS INTEGER) AS month FROM events""")
def h1(spark, sf):
    return v.r(v.events(spark, sf).select(
        "event_id", timefns.floor_hour("ts").alias("hour_start"), F.date_trunc("MONTH", "ts").alias("month_start"), F.date_trunc("DAY", "ts").alias("day"),
        F.hour("ts").alias("hour"), timefns.weekday("ts").alias("weekday"), F.dayofyear("ts").alias("dayofyear"), F.month("ts").alias("month")))


@register("h2_round_half_even_hour", f"""SELECT event_id, {_ROUND_HOUR} AS rounded FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) + INTERVAL 30 MINUTE ELSE ts END AS ts FROM events)""")
def h2(spark, sf):
    half = F.timestamp_micros(F.unix_micros(F.date_trunc("HOUR", "ts")) + 1_800_000_000)
    ts = F.when(F.col("event_id") % 3 == 0, half).otherwise(F.col("ts"))
    return v.r(v.events(spark, sf).withColumn("ts", ts).select("event_id", timefns.round_hour("ts").alias("rounded")))


@register("h8_h10_number_functions", f"""SELECT event_id, {q('ln(1 + value)', 'a', 8)}, {q('exp(value / 100) - 1', 'b', 8)}, {q('abs(20 - value)', 'c', 8)},
  epoch(date_trunc('second', ts))::BIGINT - 1704067200 AS seconds FROM events""")
def h8(spark, sf):
    start = F.unix_seconds(timefns.ts_lit(START))
    return v.r(v.events(spark, sf).select("event_id", F.log1p("value").alias("a"), F.expm1(F.col("value") / 100).alias("b"),
                                          F.abs(F.lit(20) - F.col("value")).alias("c"), (F.unix_seconds("ts") - start).alias("seconds")), 8)


@register("h9_text_functions", """SELECT c_custkey, lower(c_name) AS low, replace(c_name, '#', '_') AS swapped, instr(c_name, '#') AS at, substring(c_name, 3, 4) AS part,
  contains(c_name, '99') AS has, 'w_' || lower(c_mktsegment) || '_dur' AS named, trim('  ' || c_mktsegment || ' ') AS trimmed FROM customer""")
def h9(spark, sf):
    c = F.col("c_name")
    return v.table(spark, sf, "customer").select(
        "c_custkey", F.lower(c).alias("low"), F.replace(c, F.lit("#"), F.lit("_")).alias("swapped"), F.locate("#", c).alias("at"),
        F.substring(c, 3, 4).alias("part"), c.contains("99").alias("has"),
        F.concat(F.lit("w_"), F.lower("c_mktsegment"), F.lit("_dur")).alias("named"),
        F.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("trimmed"))


@register("h11_safe_date_parse", "SELECT event_id, try_strptime(CASE WHEN event_id % 5 = 0 THEN 'x' || event_id ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S') AS parsed FROM events")
def h11(spark, sf):
    text = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), F.col("event_id"))).otherwise(F.date_format("ts", EF.EVENT_TIME))
    return v.r(v.events(spark, sf).select("event_id", timefns.parse_time(text, EF.EVENT_TIME).alias("parsed")))
