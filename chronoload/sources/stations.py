"""Weather stations: hourly temperatures of listed stations, and the stations nearest to a point."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoload.functions.timefns import ts_lit

# Fixed value: mean earth radius in km.
EARTH_RADIUS_KM = 6371.0


def station_temperature(
    df: DataFrame, stations: Sequence, min_ts: str, max_ts: str,
    station_col: str = "station", time_col: str = "time", temp_col: str = "temp",
) -> DataFrame:
    """``(temp_ws, starttime, temp)`` of the listed stations between the two times, both included."""
    return df.where(
        F.col(station_col).isin(list(stations)) & F.col(time_col).between(ts_lit(min_ts), ts_lit(max_ts))
    ).select(F.col(station_col).alias("temp_ws"), F.col(time_col).alias("starttime"), F.col(temp_col).alias("temp"))


def great_circle_km(lat: Column, lon: Column, to_lat: float, to_lon: float) -> Column:
    dlat, dlon = F.radians(lat - F.lit(to_lat)), F.radians(lon - F.lit(to_lon))
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(F.lit(to_lat))) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def nearest_stations(df: DataFrame, lat: float, lon: float, k: int, id_col: str = "station") -> DataFrame:
    """The k stations closest to a point; equal distances go by id. Each task keeps only its own k."""
    return (
        df.withColumn("distance_km", great_circle_km(F.col("latitude"), F.col("longitude"), lat, lon))
        .orderBy("distance_km", id_col)
        .limit(k)
    )
