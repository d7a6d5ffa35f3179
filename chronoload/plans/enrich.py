"""Enrichment jobs: each cleaned source becomes a complete hourly table; then they are combined.

Cleaned events are staged once, because their bounds and the capped rows both read them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoload.functions.timefns import clock_hours, minutes_between, ts_lit
from chronoload.operators import bounds as B
from chronoload.operators import clean as C
from chronoload.operators import grid as G
from chronoload.operators import seasonal as S
from chronoload.operators.events import split_by_hour
from chronoload.session import stage


@dataclass(frozen=True)
class Period:
    """The half-open span of the hourly tables and the start of its test part."""

    start: str
    end: str
    split_date: str
    step_seconds: int = 3600

    def periods(self) -> int:
        from datetime import datetime

        span = datetime.fromisoformat(self.end) - datetime.fromisoformat(self.start)
        return int(span.total_seconds() // self.step_seconds)


@dataclass(frozen=True)
class SessionRules:
    keep_cols: Sequence[str] = (
        "starttime", "endtime", "energy", "charging_time", "plug_type", "duration_hours", "charger_kw",
    )
    power_quantile: float = 0.001
    mad_threshold: float = 3.5
    min_outlier_samples: int = 720
    impute_first: bool = False
    series_cols: Sequence[str] = field(default_factory=tuple)


def session_columns(df: DataFrame) -> DataFrame:
    """Hours from the charging time, mean power, and only rows with a plug type."""
    return (
        df.withColumn("duration_hours", clock_hours("charging_time"))
        .withColumn("charger_kw", F.try_divide(F.col("energy"), F.col("duration_hours")))
        .dropna(subset=["plug_type"])
    )


def clean_sessions(df: DataFrame, rules: SessionRules) -> DataFrame:
    base = session_columns(df)
    if rules.impute_first:
        base = C.impute_energy(base)
    keep = [*rules.keep_cols, *[c for c in rules.series_cols if c not in rules.keep_cols]]
    return C.clean_events(base, keep_cols=keep, positive_cols=["duration_hours"], log_cols=["energy"])


def sessions_capped(df: DataFrame, period: Period, rules: SessionRules = SessionRules()) -> DataFrame:
    """Cleaned sessions without extreme power, energy capped to bounds from the train rows.

    The energy bounds come from all cleaned train rows, those of extreme power included.
    """
    cleaned = stage(clean_sessions(df, rules), "sessions")
    train = C.train_rows(cleaned, period.split_date)
    power = stage(B.quantile_trim_bounds(train, "charger_kw", rules.power_quantile, ["plug_type"]), "power")
    kept = C.impute_energy(B.quantile_trim(cleaned, power, "charger_kw", ["plug_type"]))
    limits = stage(B.bounds_from_log(B.mad_bounds(train, ["log_energy"], rules.mad_threshold)), "energy-bounds")
    return B.cap_to_bounds(kept, limits, ["energy"])


def sessions_to_load(df: DataFrame, period: Period, rules: SessionRules = SessionRules()) -> DataFrame:
    """Hourly energy with hour, weekday and ``energy_outlier``; all energy is booked to the start hour."""
    series = list(rules.series_cols)
    capped = sessions_capped(df, period, rules)
    sums = G.resample(capped, "starttime", [F.sum("energy").alias("energy")], series, period.step_seconds)
    # read by both outlier rules; from here on the table is as small as the grid
    load = stage(G.align(sums, period.start, period.end, series, ["energy"], period.step_seconds), "hourly-load")
    return S.load_outliers(
        load, "energy", period.start, period.split_date, rules.mad_threshold, rules.min_outlier_samples, series,
        out="energy_outlier", step_seconds=period.step_seconds,
    )


@dataclass(frozen=True)
class IncidentRules:
    """``measures`` are capped, logged and summed; ``rollups`` maps a new column to the substring it sums.

    A severity that is not listed (or null) fails the job, unless ``other`` names one that takes all of them: each type then
    has columns for it, which the roll-ups of the type include.
    """

    types: Sequence[str]
    severities: Sequence[str]
    measures: Sequence[str]
    name: object
    rollups: Mapping[str, str] = field(default_factory=dict)
    mad_threshold: float = 3.5
    series_cols: Sequence[str] = field(default_factory=tuple)
    other: str | None = None


def _listed_severity(rules: IncidentRules) -> Column:
    own = F.col("severity").cast("string")
    if rules.other is not None:
        return F.when(own.isin(list(rules.severities)), own).otherwise(rules.other)
    unlisted = F.raise_error(F.concat(F.lit("severity not listed: "), F.coalesce(own, F.lit("null")))).cast("string")
    return F.when(own.isin(list(rules.severities)), own).otherwise(unlisted)


def weather_rules(types, severities, rollups, **more) -> IncidentRules:
    return IncidentRules(types, severities, ["duration"], lambda c, v: f"w_{'_'.join(map(str, v))}_dur".lower(), rollups, **more)


def traffic_rules(types, severities, rollups, **more) -> IncidentRules:
    return IncidentRules(
        types, severities, ["duration", "distance"], lambda c, v: f"t_{c}_{'_'.join(map(str, v))}".lower(), rollups, **more
    )


# The default event types, and the roll-up columns with the text their parts share.
WEATHER_TYPES = ("Rain", "Fog", "Storm")
WEATHER_ROLLUPS = {"w_rain_dur": "rain", "w_fog_dur": "fog"}
TRAFFIC_TYPES = ("Congestion", "Flow-Incident", "Event")
TRAFFIC_ROLLUPS = {
    "t_cong_dis": "distance_congestion",
    "t_flow_dis": "distance_flow",
    "t_cong_dur": "duration_congestion",
    "t_flow_dur": "duration_flow",
}


def clean_incidents(df: DataFrame, rules: IncidentRules) -> DataFrame:
    keep = ["starttime", "endtime", "type", "severity", *rules.measures, *rules.series_cols]
    return C.clean_events(
        df.withColumn("duration", minutes_between("starttime", "endtime").cast("double")),
        keep_cols=list(dict.fromkeys(keep)), positive_cols=rules.measures, log_cols=rules.measures, types=rules.types,
    )


def incidents_capped(df: DataFrame, period: Period, rules: IncidentRules) -> DataFrame:
    cleaned = stage(clean_incidents(df, rules), "incidents")
    train = C.train_rows(cleaned, period.split_date)
    logs = [f"log_{m}" for m in rules.measures]
    limits = stage(B.bounds_from_log(B.mad_bounds(train, logs, rules.mad_threshold)), "incident-bounds")
    return B.cap_to_bounds(cleaned, limits, list(rules.measures))


def incidents_to_hours(df: DataFrame, period: Period, rules: IncidentRules) -> DataFrame:
    """Minutes (and distances) per hour, type and severity, on the full grid, with roll-up columns."""
    series = list(rules.series_cols)
    capped = incidents_capped(df, period, rules).select("starttime", "type", "severity", *rules.measures, *series)
    pieces = split_by_hour(capped.withColumn("severity", _listed_severity(rules)))
    pairs = [(t, s) for t in rules.types for s in [*rules.severities, *([rules.other] if rules.other is not None else [])]]
    wide = G.pivot_sums(pieces, [*series, "timestamp"], ["type", "severity"], pairs, rules.measures, rules.name)
    values = [c for c in wide.columns if c not in (*series, "timestamp")]
    out = G.align(wide, period.start, period.end, series, values, period.step_seconds)
    for name, part in rules.rollups.items():
        out = C.sum_matching(out, name, part)
    return out


def temperature_to_hours(
    df: DataFrame, period: Period, low: float = -1.0, high: float = 50.0, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Mean temperature over stations per hour, missing hours flagged and filled from history."""
    series = list(series_cols)
    cleaned = C.clean_events(df).withColumn("temp", C.null_outside("temp", low, high))
    means = G.resample(cleaned, "starttime", [F.avg("temp").alias("temp")], series, period.step_seconds)
    hourly = stage(G.align(means, period.start, period.end, series, (), period.step_seconds), "hourly-temperature")
    return S.impute_from_history(hourly, "temp", series, step_seconds=period.step_seconds)


def combine_sources(
    load: DataFrame, weather: DataFrame, temperature: DataFrame, traffic: DataFrame, period: Period,
    series_cols: Sequence[str] = (), validate: bool = True,
) -> DataFrame:
    return G.combine(
        {"load": load, "weather": weather, "temperature": temperature, "traffic": traffic},
        period.periods(), series_cols, validate=validate,
    )


def in_period(df: DataFrame, period: Period, ts_col: str = "timestamp") -> DataFrame:
    return df.where((F.col(ts_col) >= ts_lit(period.start)) & (F.col(ts_col) < ts_lit(period.end)))
