"""Events as intervals, and their minutes per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.functions.timefns import MICROS_PER_HOUR


def split_by_hour(
    df: DataFrame, start_col: str = "starttime", duration_col: str = "duration", ts_col: str = "timestamp"
) -> DataFrame:
    """One row per hour an event touches, with the minutes it spends there.

    ``duration`` is in minutes and may be fractional. Other columns are copied, not apportioned. An
    event that ends on the hour adds no empty row and a duration of 0 or less gives no rows. The
    hours come from integer arithmetic on the row itself, so nothing is shuffled.
    """
    begin = F.unix_micros(start_col)
    end = begin + F.round(F.col(duration_col) * F.lit(60_000_000.0)).cast("long")
    hour = F.lit(MICROS_PER_HOUR).cast("long")
    rows = (
        df.withColumn("_begin", begin)
        .withColumn("_end", end)
        .where(F.col("_end") > F.col("_begin"))
        .withColumn(
            "_h",
            F.explode(
                F.sequence(
                    F.floor(F.col("_begin") / hour).cast("long"), F.floor((F.col("_end") - 1) / hour).cast("long")
                )
            ),
        )
    )
    inside = F.least((F.col("_h") + 1) * hour, F.col("_end")) - F.greatest(F.col("_h") * hour, F.col("_begin"))
    others = [c for c in df.columns if c not in (start_col, duration_col, ts_col)]
    return rows.select(
        F.timestamp_micros(F.col("_h") * hour).alias(ts_col),
        (inside / F.lit(60_000_000.0)).alias(duration_col),
        *others,
    )
