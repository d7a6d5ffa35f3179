from __future__ import annotations

from datetime import date, datetime

import pandas as pd
import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from chronoload.functions import holidays as H
from chronoload.functions import textfns, timefns


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "given, wanted",
    [("12:30:00", 12), ("13:30:00", 14), ("12:29:59", 12), ("12:30:01", 13), ("13:29:59", 13), ("23:30:00", 24)],
)
def test_round_hour_ties_go_to_the_even_hour(spark, given, wanted):
    got = one(spark, timefns.round_hour("t").cast("string"), t=datetime.fromisoformat(f"2024-03-01 {given}"))
    day, hour = divmod(wanted, 24)
    assert got == f"2024-03-0{1 + day} {hour:02d}:00:00"


def test_round_hour_matches_pandas(spark):
    times = pd.date_range("2024-01-01", periods=200, freq="17min37s")
    got = spark.createDataFrame(pd.DataFrame({"t": times})).select(timefns.round_hour("t").alias("r")).toPandas()["r"]
    assert list(got) == list(times.round("h"))


def test_clock_hours(spark):
    df = spark.createDataFrame([("01:30:00",), ("00:00:36",), ("bad",), (None,), ("27:00:00",)], "c string")
    assert [r.x for r in df.select(timefns.clock_hours("c").alias("x")).collect()] == [1.5, 0.01, None, None, 27.0]


def test_parse_time_takes_padded_and_plain_and_nulls_the_rest(spark):
    df = spark.createDataFrame([("1/2/2020 3:04",), ("01/02/2020 03:04",), ("31/31/2020 3:04",), ("",)], "c string")
    got = [r.x for r in df.select(timefns.parse_time("c", "M/d/yyyy H:mm").cast("string").alias("x")).collect()]
    assert got == ["2020-01-02 03:04:00", "2020-01-02 03:04:00", None, None]


def test_minutes_round_down_for_negatives_too(spark):
    a, b = datetime(2024, 1, 1, 0, 0, 30), datetime(2024, 1, 1, 0, 2, 0)
    assert one(spark, timefns.minutes_between("a", "b"), a=a, b=b) == 1
    assert one(spark, timefns.minutes_between("b", "a"), a=a, b=b) == -2


def test_floor_interval_needs_an_origin_when_bins_do_not_divide_a_day(spark):
    t = datetime(2024, 1, 2, 1, 0)
    assert one(spark, timefns.floor_interval("t", 21600).cast("string"), t=t) == "2024-01-02 00:00:00"
    assert one(spark, timefns.floor_interval("t", 18000, "2024-01-01").cast("string"), t=t) == "2024-01-02 01:00:00"
    with pytest.raises(ValueError):
        timefns.floor_interval("t", 18000)


def test_standard_names(spark):
    assert textfns.standard_name(" Energy (kWh)") == "energy"
    assert textfns.standard_name("Charging Time (hh:mm:ss)") == "charging_time"
    assert textfns.standard_name("Plug In Event-Id/A:B") == "plug_in_event_id_a_b"
    df = spark.createDataFrame([(1, 2)], ["Start Date", "EndTime(UTC)"])
    assert textfns.standardise_columns(df).columns == ["starttime", "endtime"]
    with pytest.raises(ValueError, match="collide"):
        textfns.standardise_columns(spark.createDataFrame([(1, 2)], ["A b", "a-b"]))


def test_station_group(spark):
    def plain(x):
        return x[14 : x.find("#")].strip()

    names = ["CITY LONG NAME / HIGH #3", "CITY LONG NAME  BRYANT", "CITY LONG NAME#1", "CITY LONG NAME / A #"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    assert [r.x for r in df.select(textfns.station_group("c").alias("x")).collect()] == [plain(n) for n in names]


def test_federal_holidays_match_the_calendar(spark):
    table = H.holidays(spark, "2015-01-01", "2030-12-31 23:00:00").toPandas()
    extra = table[table.holiday.isin(["Christmas Eve", "Boxing Day"])]
    federal = table.drop(extra.index)
    wanted = USFederalHolidayCalendar().holidays("2015-01-01", "2030-12-31", return_name=True)
    assert sorted(zip(federal.ds, federal.holiday)) == sorted((d.date(), n) for d, n in wanted.items())
    assert len(extra) == 2 * 16


def test_observed_new_year_of_the_next_year_counts_when_inside(spark):
    rows = H.holidays(spark, "2021-12-01", "2021-12-31 23:00:00").collect()
    assert {(r.ds, r.holiday) for r in rows} == {
        (date(2021, 12, 24), "Christmas Day"), (date(2021, 12, 24), "Christmas Eve"),
        (date(2021, 12, 26), "Boxing Day"), (date(2021, 12, 31), "New Year's Day"),
    }


def test_days_that_are_two_holidays_carry_both_flags(spark):
    table = H.holidays(spark, "2021-01-01", "2022-12-31 23:00:00")
    days = spark.createDataFrame(
        [(datetime(2021, 12, 24, 5),), (datetime(2022, 12, 26, 23),), (datetime(2022, 12, 25),), (datetime(2022, 3, 1),)], "timestamp timestamp"
    )
    names = ["Christmas Eve", "Christmas Day", "Boxing Day", "Thanksgiving Day"]
    got = {r.timestamp: tuple(r)[1:] for r in H.add_holiday_flags(days, table, names).collect()}
    assert got[datetime(2021, 12, 24, 5)] == (1, 1, 0, 0)
    assert got[datetime(2022, 12, 26, 23)] == (0, 1, 1, 0)
    assert got[datetime(2022, 12, 25)] == (0, 0, 0, 0)
    assert got[datetime(2022, 3, 1)] == (0, 0, 0, 0)


def test_weekday_starts_on_monday(spark):
    assert one(spark, timefns.weekday("t"), t=datetime(2024, 1, 1)) == 0
    assert one(spark, timefns.weekday(F.col("t")), t=datetime(2024, 1, 7)) == 6
