"""The given tables seen as sessions, incidents, temperatures and hourly loads: in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.operators.grid import align, resample
from chronoload.session import prepare, stage

START, END, SPLIT = "2024-01-01", "2024-01-31", "2024-01-22"
DAY_START, DAY_END, DAY_SPLIT = "1995-01-01", "2001-08-02", "2000-01-01"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SEVERITIES = ["0", "1", "2", "3", "4"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    for n, t in df.dtypes:
        if t == "timestamp_ntz":
            df = df.withColumn(n, F.col(n).cast("timestamp"))
    return df


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def sessions(spark, sf_dir):
    k = F.col("k")
    minutes = k * 3
    return events(spark, sf_dir).withColumn("k", _k()).select(
        "event_id",
        F.col("ts").alias("starttime"),
        F.timestamp_micros(F.unix_micros("ts") + minutes.cast("long") * 60_000_000).alias("endtime"),
        F.concat_ws(":", F.lpad(F.floor(minutes / 60).cast("string"), 2, "0"), F.lpad((minutes % 60).cast("string"), 2, "0"), F.lit("00")).alias("charging_time"),
        F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("energy"),
        F.when(F.col("event_id") % 211 != 0, F.when(F.col("event_type") == "signup", "NEMA 5-20R").otherwise("J1772")).alias("plug_type"),
        F.concat(F.lit("CHARGE SITE / "), F.upper("event_type"), F.lit(" #"), (F.col("user_id") % 3).cast("string")).alias("station_name"),
    )


def incidents(spark, sf_dir):
    return (
        events(spark, sf_dir)
        .withColumn("k", _k())
        .withColumn("starttime", F.date_trunc("MINUTE", "ts"))
        .select(
            "event_id",
            "starttime",
            F.timestamp_micros(F.unix_micros("starttime") + F.floor(F.col("value") * 10).cast("long") * 60_000_000).alias("endtime"),
            F.col("event_type").alias("type"),
            (F.col("k") % 5).cast("string").alias("severity"),
            (F.col("k") / 10.0).alias("distance"),
        )
    )


def landed(df: DataFrame, name: str) -> DataFrame:
    """The view as a landed table, as the loading jobs leave it: later passes do not parse it again."""
    return stage(df, f"landed-{name}")


def temps(spark, sf_dir):
    return events(spark, sf_dir).where("event_type = 'view'").select(
        (F.col("user_id") % 3).alias("station"), F.date_trunc("HOUR", "ts").alias("starttime"), F.col("value").alias("temp")
    )


def load_hourly(spark, sf_dir):
    sums = resample(events(spark, sf_dir), "ts", [F.sum("value").alias("load")], ["event_type"])
    return align(sums, START, END, ["event_type"], ["load"])


def load_daily(spark, sf_dir):
    sums = resample(table(spark, sf_dir, "orders"), "o_orderdate", [F.sum("o_totalprice").alias("load")], (), 86_400)
    return align(sums, DAY_START, DAY_END, (), ["load"], 86_400)


_K = "CAST(props->>'$.k' AS INTEGER)"

SQL_VIEWS = {
    "sessions": f"""SELECT event_id, ts AS starttime, ts + to_minutes(3 * k) AS endtime,
  lpad(CAST((3*k)//60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((3*k)%60 AS VARCHAR), 2, '0') || ':00' AS charging_time,
  CASE WHEN event_id % 97 != 0 THEN value END AS energy,
  CASE WHEN event_id % 211 != 0 THEN CASE WHEN event_type = 'signup' THEN 'NEMA 5-20R' ELSE 'J1772' END END AS plug_type,
  'CHARGE SITE / ' || upper(event_type) || ' #' || CAST(user_id % 3 AS VARCHAR) AS station_name
  FROM (SELECT *, {_K} AS k FROM events)""",
    "incidents": f"""SELECT event_id, date_trunc('minute', ts) AS starttime,
  date_trunc('minute', ts) + to_minutes(CAST(floor(value * 10) AS INTEGER)) AS endtime, event_type AS type,
  CAST(k % 5 AS VARCHAR) AS severity, k / 10.0::DOUBLE AS distance
  FROM (SELECT *, {_K} AS k FROM events)""",
    "temps": """SELECT user_id % 3 AS station, date_trunc('hour', ts) AS starttime, value AS temp
  FROM events WHERE event_type = 'view'""",
    "hours": f"""SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS timestamp""",
    "days": f"""SELECT unnest(generate_series(TIMESTAMP '{DAY_START}', TIMESTAMP '{DAY_END}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS timestamp""",
    "load_hourly": """SELECT s.event_type, h.timestamp, coalesce(a.load, 0) AS load
  FROM (SELECT DISTINCT event_type FROM events) s CROSS JOIN hours h
  LEFT JOIN (SELECT event_type, date_trunc('hour', ts) AS timestamp, sum(value) AS load FROM events GROUP BY 1, 2) a
  ON a.event_type = s.event_type AND a.timestamp = h.timestamp""",
    "load_daily": """SELECT d.timestamp, coalesce(a.load, 0) AS load FROM days d
  LEFT JOIN (SELECT date_trunc('day', o_orderdate) AS timestamp, sum(o_totalprice) AS load FROM orders GROUP BY 1) a
  ON a.timestamp = d.timestamp""",
}
_NEEDS = {"load_hourly": ["hours"], "load_daily": ["days"]}


def with_views(names: str, body: str) -> str:
    """``body`` (a SELECT, or further CTEs and a SELECT) behind the named views."""
    order: list[str] = []
    for n in names.split():
        for m in [*_NEEDS.get(n, []), n]:
            if m not in order:
                order.append(m)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({SQL_VIEWS[n]})" for n in order)
    body = body.strip()
    glue = "\n" if body.upper().startswith("SELECT") else ",\n"
    return f"WITH {ctes}{glue}{body}"


# Both sides round alike: the shift moves exact decimal ties and signed zeros off the boundary.
def r(df: DataFrame, places: int = 6, only: list[str] | None = None) -> DataFrame:
    shift = 1.23 * 10 ** -(places + 2)
    cols = []
    for n, t in df.dtypes:
        c = F.col(f"`{n}`")
        if t == "double" and (only is None or n in only):
            c = F.round(c + F.lit(shift), places).alias(n)
        elif t == "timestamp":
            c = c.cast("timestamp_ntz").alias(n)
        cols.append(c)
    return df.select(*cols)


def q(expr: str, name: str | None = None, places: int = 6) -> str:
    name = name or expr
    return f'round(CAST({expr} AS DOUBLE) + 1.23e-{places + 2}::DOUBLE, {places}) AS "{name}"'


def mad_sql(source: str, col: str, threshold: float, groups: str = "", name: str | None = None) -> str:
    """Median-deviation bounds of one column of ``source``; ``groups`` is a comma-separated key list."""
    part = f"PARTITION BY {groups}" if groups else ""
    key = f"{groups}, " if groups else ""
    by = f"GROUP BY {groups}" if groups else ""
    return f"""SELECT {key}'{name or col}' AS "column", CASE WHEN d > 2 THEN med END AS median, d > 2 AND skewed AS skewed,
  CASE WHEN d > 2 THEN med - {threshold} * CASE WHEN skewed THEN dn ELSE mad END END AS min_val,
  CASE WHEN d > 2 THEN med + {threshold} * CASE WHEN skewed THEN up ELSE mad END END AS max_val
  FROM (SELECT {key}any_value(med) AS med, count(DISTINCT x) + CAST(bool_or(x IS NULL) AS INTEGER) AS d,
    bool_or(x IS NULL) OR NOT coalesce(abs(avg(power(x - mu, 3)) / power(avg(power(x - mu, 2)), 1.5)) < 1, FALSE) AS skewed,
    median(abs(x - med)) AS mad, median(abs(x - med)) FILTER (x >= med) AS up, median(abs(x - med)) FILTER (x < med) AS dn
    FROM (SELECT {key}CAST({col} AS DOUBLE) AS x, median(CAST({col} AS DOUBLE)) OVER ({part}) AS med,
      avg(CAST({col} AS DOUBLE)) OVER ({part}) AS mu FROM {source}) {by})"""
