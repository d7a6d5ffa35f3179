"""Feature job: one wide frame of target, calendar, holiday, lag and rolling columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.functions.holidays import add_holiday_flags, holidays
from chronoload.functions.textfns import matching, quoted
from chronoload.functions.timefns import cyclic, ts_lit
from chronoload.operators.trend import ols_trend, remove_trend
from chronoload.operators.windows import history_features
from chronoload.session import stage

# Default feature configuration.
HOLIDAYS = (
    "Independence Day", "Thanksgiving Day", "Christmas Eve", "Christmas Day", "Boxing Day", "New Year's Day",
)
SOURCE_SUBSTRINGS = {
    "energy": ("energy",),
    "weather": ("fog_dur", "rain_dur", "storm_dur"),
    "temperature": ("temp",),
    "traffic": ("cong_dur", "cong_dis", "flow_dur", "flow_dis", "event_dur", "event_dis"),
}
LAGS = {"energy": (1, 3, 6, 24, 168)}
ROLLING_SUMS = {"energy": (3, 6, 12, 24, 168), "weather": (1, 3, 6), "traffic": (1, 3, 6)}
ROLLING_MEANS = {"energy": (3, 6, 12, 24, 168), "temperature": (1, 3, 6, 12)}
CYCLES = {"month": (F.month, 12), "weekday": (F.weekday, 7), "hour": (F.hour, 24)}


@dataclass(frozen=True)
class FeatureRules:
    target: str = "energy"
    detrend: bool = True
    holidays: Sequence[str] = HOLIDAYS
    substrings: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(SOURCE_SUBSTRINGS))
    lags: Mapping[str, Sequence[int]] = field(default_factory=lambda: dict(LAGS))
    sums: Mapping[str, Sequence[int]] = field(default_factory=lambda: dict(ROLLING_SUMS))
    means: Mapping[str, Sequence[int]] = field(default_factory=lambda: dict(ROLLING_MEANS))
    series_cols: Sequence[str] = ()

    def max_lag(self) -> int:
        return max(k for group in (self.lags, self.sums, self.means) for ks in group.values() for k in ks)

    def per_column(self, columns: Sequence[str], steps: Mapping[str, Sequence[int]]) -> dict[str, list[int]]:
        """Source-level window sizes spread over the source's columns.

        A configured substring without a column is allowed: not every source rolls up every type.
        """
        out: dict[str, list[int]] = {}
        for source, sizes in steps.items():
            for c in matching(list(columns), list(self.substrings[source])):
                out[c] = list(sizes)
        return out


def cyclic_features(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Sine and cosine of month, weekday (Monday = 0) and hour."""
    columns = {}
    for name, (part, period) in CYCLES.items():
        columns[f"{name}_sin"], columns[f"{name}_cos"] = cyclic(part(ts_col), period)
    return df.withColumns(columns)


def fitted_trend(df: DataFrame, rules: FeatureRules, start: str, split_date: str, ts_col: str = "timestamp") -> DataFrame:
    """Trend of the train rows, one row per series."""
    train = df.where(F.col(ts_col) < ts_lit(split_date))
    return stage(ols_trend(train, rules.target, start, rules.series_cols, ts_col), "trend")


def make_features(
    combined: DataFrame, start: str, end: str, split_date: str, rules: FeatureRules = FeatureRules(),
    trend: DataFrame | None = None, ts_col: str = "timestamp", holiday_table: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """The feature frame ``(series…, timestamp, features…, target)`` and its feature names.

    Detrend, calendar, holidays, then all lags and windows in one pass; the first ``max_lag`` hours of a
    series, whose windows are not full, are cut by time.
    """
    df = combined
    if rules.detrend:
        trend = fitted_trend(df, rules, start, split_date, ts_col) if trend is None else trend
        df = remove_trend(df, trend, rules.target, start, rules.series_cols, ts_col)
    columns = df.columns
    table = holidays(df.sparkSession, start, end) if holiday_table is None else holiday_table
    df = add_holiday_flags(cyclic_features(df, ts_col), table, list(rules.holidays), ts_col)
    wide = history_features(
        df, rules.per_column(columns, rules.lags), rules.per_column(columns, rules.sums),
        rules.per_column(columns, rules.means), rules.series_cols, ts_col,
    )
    cut = F.timestamp_seconds(F.unix_seconds(ts_lit(start)) + rules.max_lag() * 3600)
    names = [c for c in wide.columns if any(mark in c for mark in ("_sin", "_cos", "_lag_", "_rw_"))]
    names += list(rules.holidays)
    out = wide.where(F.col(ts_col) >= cut).select(
        *rules.series_cols, ts_col, *[quoted(n) for n in names], quoted(rules.target)
    )
    return out, names
