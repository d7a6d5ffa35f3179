"""US federal holidays with observed days, as date arithmetic over a column of years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.functions.textfns import quoted
from chronoload.functions.timefns import ts_lit

# Fixed values: (name, month, day) of holidays moved to the nearest workday, with the first year
# they apply where there is one.
FIXED_DATE = [
    ("New Year's Day", 1, 1, None),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas Day", 12, 25, None),
]
# Fixed values: (name, month, weekday with Monday = 0, which one; -1 is the last), first year.
NTH_WEEKDAY = [
    ("Birthday of Martin Luther King, Jr.", 1, 0, 3, 1986),
    ("Washington's Birthday", 2, 0, 3, None),
    ("Memorial Day", 5, 0, -1, None),
    ("Labor Day", 9, 0, 1, None),
    ("Columbus Day", 10, 0, 2, None),
    ("Thanksgiving Day", 11, 3, 4, None),
]
# Further days, never moved.
EXTRA = [("Christmas Eve", 12, 24), ("Boxing Day", 12, 26)]


def _nearest_workday(d: Column) -> Column:
    return F.when(F.weekday(d) == 5, F.date_sub(d, 1)).when(F.weekday(d) == 6, F.date_add(d, 1)).otherwise(d)


def _nth_weekday(year: Column, month: int, day: int, nth: int) -> Column:
    if nth > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        return F.date_add(first, (F.lit(day + 7) - F.weekday(first)) % 7 + 7 * (nth - 1))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, (F.weekday(last) - F.lit(day) + 7) % 7)


def holidays_for(span: DataFrame) -> DataFrame:
    """``(ds date, holiday)`` for a one-row frame ``(min_ts, max_ts)``.

    Federal days are kept when the observed date lies in the span; the further days are listed for
    each year the span touches. The table has 13 rows per calendar year.
    """
    years = span.select(
        "min_ts",
        "max_ts",
        # one year each side: an observed day can fall into the neighbouring year
        F.explode(F.sequence(F.year("min_ts") - 1, F.year("max_ts") + 1)).alias("year"),
    )
    year = F.col("year")

    def entry(name: str, ds: Column, federal: bool, since: int | None) -> Column:
        ds = ds if since is None else F.when(year >= since, ds)
        return F.struct(F.lit(name).alias("holiday"), ds.alias("ds"), F.lit(federal).alias("federal"))

    entries = [
        entry(name, _nearest_workday(F.make_date(year, F.lit(m), F.lit(d))), True, since)
        for name, m, d, since in FIXED_DATE
    ]
    entries += [entry(name, _nth_weekday(year, m, wd, nth), True, since) for name, m, wd, nth, since in NTH_WEEKDAY]
    entries += [entry(name, F.make_date(year, F.lit(m), F.lit(d)), False, None) for name, m, d in EXTRA]
    rows = years.select("min_ts", "max_ts", "year", F.explode(F.array(*entries)).alias("h")).select(
        "min_ts", "max_ts", "year", "h.*"
    )
    midnight = F.col("ds").cast("timestamp")
    in_span = F.when(
        F.col("federal"), (midnight >= F.col("min_ts")) & (midnight <= F.col("max_ts"))
    ).otherwise(year.between(F.year("min_ts"), F.year("max_ts")))
    return rows.where(F.col("ds").isNotNull() & in_span).select("ds", "holiday")


def holidays(spark: SparkSession, min_ts: str, max_ts: str) -> DataFrame:
    span = spark.range(1).select(ts_lit(min_ts).alias("min_ts"), ts_lit(max_ts).alias("max_ts"))
    return holidays_for(span)


def holiday_flags(table: DataFrame, names: list[str]) -> DataFrame:
    """One row per date, one 0/1 column per holiday; a date that is two holidays carries both flags."""
    return table.groupBy("ds").agg(
        *[F.max((F.col("holiday") == name).cast("int")).alias(name) for name in names]
    )


def add_holiday_flags(df: DataFrame, table: DataFrame, names: list[str], ts_col: str = "timestamp") -> DataFrame:
    """0/1 holiday columns by calendar date. There is no broadcast hint: Catalyst knows the table's size or sort-merges."""
    flags = holiday_flags(table.where(F.col("holiday").isin(names)), names)
    joined = df.withColumn("_ds", F.to_date(ts_col)).join(flags.withColumnRenamed("ds", "_ds"), "_ds", "left")
    return joined.select(
        *[quoted(c) for c in df.columns], *[F.coalesce(quoted(n), F.lit(0)).alias(n) for n in names]
    )
