"""Loading jobs: raw files to trimmed, standard-named stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from chronoload.sources.event_files import EventFile, load_events
from chronoload.sources.stages import read_stage, write_stage
from chronoload.sources.stations import station_temperature


def load_sessions(spark: SparkSession, source: EventFile, min_ts: str, max_ts: str, out: str | None = None) -> DataFrame:
    return _landed(load_events(spark, source, min_ts=min_ts, max_ts=max_ts), out)


def load_incidents(
    spark: SparkSession, source: EventFile, min_ts: str, max_ts: str, cities: Sequence[str] = (),
    counties: Sequence[str] = (), states: Sequence[str] = (), out: str | None = None,
) -> DataFrame:
    """Weather or traffic events of the chosen places."""
    return _landed(
        load_events(spark, source, min_ts=min_ts, max_ts=max_ts, states=states, counties=counties, cities=cities), out
    )


def load_temperature(table: DataFrame, stations: Sequence, min_ts: str, max_ts: str, out: str | None = None) -> DataFrame:
    return _landed(station_temperature(table, stations, min_ts, max_ts), out)


def _landed(df: DataFrame, out: str | None) -> DataFrame:
    if out is None:
        return df
    return read_stage(df.sparkSession, write_stage(df, out), df.schema)
