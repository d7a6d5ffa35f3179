"""Event logs in CSV files: declared schema, date and place filters, whole-second times."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chronoload.functions.textfns import quoted, standardise_columns
from chronoload.functions.timefns import parse_time, ts_lit
from chronoload.operators.clean import location_filter
from chronoload.session import prepare

# Date text formats of the source files; both take padded and unpadded numbers.
SESSION_TIME = "M/d/yyyy H:mm"
EVENT_TIME = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class EventFile:
    """Where an event log lies and how its period and place are written."""

    path: str
    schema: T.StructType
    start_col: str
    end_col: str
    time_format: str = EVENT_TIME


def scan_events(
    spark: SparkSession,
    source: EventFile,
    min_ts: str = "1900-01-01",
    max_ts: str = "2100-01-01",
    states: Sequence[str] = (),
    counties: Sequence[str] = (),
    cities: Sequence[str] = (),
) -> DataFrame:
    """Rows with ``start >= min_ts`` and ``end < max_ts`` at the given places; bad dates drop the row.

    The place filters reach the CSV reader; the period is judged on the parsed columns.
    """
    raw = prepare(spark).read.schema(source.schema).csv(source.path, header=True)
    placed = location_filter(raw, states, counties, cities)
    return within_period(placed, source.start_col, source.end_col, source.time_format, min_ts, max_ts)


def within_period(df: DataFrame, start_col: str, end_col: str, fmt: str, min_ts: str, max_ts: str) -> DataFrame:
    start, end = parse_time(quoted(start_col), fmt), parse_time(quoted(end_col), fmt)
    return df.withColumns({start_col: start, end_col: end}).where(
        (quoted(start_col) >= ts_lit(min_ts)) & (quoted(end_col) < ts_lit(max_ts))
    )


def load_events(spark: SparkSession, source: EventFile, **filters) -> DataFrame:
    """Scan, filter and give the columns their standard names."""
    return standardise_columns(scan_events(spark, source, **filters))


def schema_of(columns: dict[str, str]) -> T.StructType:
    """Schema from ``{name: type}``; the names may hold any characters."""
    return T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in columns.items()])


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, header=True)
    return path
