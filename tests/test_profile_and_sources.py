from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoload.operators import profile as P
from chronoload.plans.profile import profile_source
from chronoload.session import new_path, shared_dir, stage
from chronoload.sources import event_files as EF
from chronoload.sources import stages as ST
from chronoload.sources import stations as STN


def at(*hours, minute=0):
    return [(datetime(2024, 1, 1) + timedelta(hours=h, minutes=minute),) for h in hours]


def plain_completeness(times, hours):
    counts = pd.Series(1, index=pd.DatetimeIndex(times)).groupby(pd.Grouper(freq=f"{hours}h")).count()
    span = (counts.index.max() - counts.index.min()) / pd.Timedelta(hours=hours)
    return counts[counts > 0].count() / span if span else None


@pytest.mark.parametrize("n", [1, 2, 5, 24])
def test_completeness_counts_bins_from_the_first_midnight(spark, n):
    times = at(5, 6, 11, 27, 40, 41, 77, minute=10)
    got = P.completeness(spark.createDataFrame(times, "t timestamp"), "t", "h", n).first().completeness
    assert got == pytest.approx(plain_completeness([t[0] for t in times], n))


def test_completeness_of_a_single_bin_and_per_group(spark):
    df = spark.createDataFrame([("a", t[0]) for t in at(5, 5)] + [("b", t[0]) for t in at(1, 2, 4)], "g string, t timestamp")
    got = {r.g: r.completeness for r in P.completeness(df, "t", "h", 1, ["g"]).collect()}
    assert got == {"a": None, "b": 1.0}
    both = {r.g: r.completeness for r in P.completeness(df, "t", "h", 1, ["g"], inclusive=True).collect()}
    assert both == {"a": 1.0, "b": 0.75}


def test_repeated_rows_are_listed_whole_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(P, "DUPLICATE_CHUNK", 7)
    df = spark.createDataFrame([(1, "x")] * 30 + [(2, "y")] * 2 + [(3, None)] * 3 + [(4, "z")], "a int, b string")
    got = P.repeated_rows(df).groupBy("a").count().collect()
    assert {r.a: r["count"] for r in got} == {1: 29, 2: 1, 3: 2}


def test_small_profile_tables(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", -2.0), ("b", "x", None), ("b", "x", 4.0)], "g string, h string, v double")
    counts = {r["column"]: (r.distinct_values, r.nulls) for r in P.column_counts(df).collect()}
    assert counts == {"g": (2, 0), "h": (2, 0), "v": (3, 1)}
    assert {r["column"]: r.nulls for r in P.column_counts(df, approx=True).collect()} == {"g": 0, "h": 0, "v": 1}
    assert sorted(tuple(r) for r in P.crosstab(df, "g", "h", ["x", "y"]).collect()) == [("a", 1, 1), ("b", 2, 0)]
    s = P.scalar_summary(df, "v").first()
    assert (s.min, s.max, s.sum, s.negatives, s.rows) == (-2.0, 4.0, 3.0, 1, 4)
    d = P.describe(df, ["v"]).first()
    ref = pd.Series([1.0, -2.0, 4.0]).describe()
    assert [d["count"], d["mean"], d["std"], d["min"], d["q25"], d["q50"], d["q75"], d["max"]] == pytest.approx(list(ref))
    assert P.zero_share(df.fillna(0), "v").first().zero_pct == 25.0


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0.5, 1, 9.99, 10, 11, -1)], "v double")
    assert {r.bin: r["count"] for r in P.histogram(df, "v", 0, 10, 10).collect()} == {0: 2, 1: 1, 9: 2}


def test_period_totals(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1.0), (datetime(2024, 1, 1, 5), 3.0), (datetime(2024, 1, 2), 5.0)], "ts timestamp, v double")
    day = F.date_trunc("DAY", "ts")
    assert sorted(r.value for r in P.period_totals(df, day, "v").collect()) == [4.0, 5.0]
    only_monday = P.period_totals(df, day, "v", "mean", True, [0], "ts").collect()
    assert [(r.weekday, r.value) for r in only_monday] == [(0, 2.0)]


def test_profile_source(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, h), float(h), "p") for h in range(5)], "t timestamp, v double, c string")
    tables = profile_source(df, "t", ["v"], ["c"])
    assert tables["values_c"].first()["count"] == 5 and tables["describe"].first()["count"] == 5


# ------------------------------------------------------------------ sources and stages


def event_file(spark):
    rows = [
        ("1/5/2024 00:00", "1/5/2024 1:00", "a", "X", "N", "CA", 1.0),  # start exactly at min: kept
        ("1/9/2024 23:00", "1/10/2024 00:00", "b", "X", "N", "CA", 2.0),  # end exactly at max: dropped
        ("not a date", "1/6/2024 00:00", "c", "X", "N", "CA", 3.0),
        ("1/6/2024 0:30", "01/06/2024 02:00", "d", "Y", "N", "CA", 4.0),
        ("1/6/2024 0:30", "", "e", "X", "N", "CA", 5.0),
        ("1/4/2024 23:59", "1/6/2024 2:00", "f", "X", "N", "CA", 6.0),
    ]
    names = ["Start Date", "End Date", "Id", "City", "County", "State", "Energy (kWh)"]
    path = EF.write_csv(spark.createDataFrame(rows, names), new_path(spark, "events"))
    schema = EF.schema_of({**dict.fromkeys(names[:-1], "string"), names[-1]: "double"})
    return EF.EventFile(path, schema, "Start Date", "End Date", EF.SESSION_TIME)


def test_filtered_scan(spark):
    source = event_file(spark)
    got = EF.load_events(spark, source, min_ts="2024-01-05", max_ts="2024-01-10")
    assert got.columns == ["starttime", "endtime", "id", "city", "county", "state", "energy"]
    assert sorted(r.id for r in got.collect()) == ["a", "d"]
    by_place = EF.load_events(spark, source, min_ts="2024-01-05", max_ts="2024-01-10", cities=["Y"], states=["CA"])
    assert [r.id for r in by_place.collect()] == ["d"]
    assert EF.load_events(spark, source, counties=["S"]).count() == 0
    plan = EF.scan_events(spark, source, cities=["Y"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(City" in plan or "PushedFilters: [IsNotNull(City), EqualTo(City,Y)" in plan


def test_nearest_and_temperature(spark):
    stations = spark.createDataFrame([("far", 10.0, 10.0), ("near", 37.45, -122.15), ("mid", 38.0, -122.0), ("twin", 37.45, -122.15)], "station string, latitude double, longitude double")
    got = STN.nearest_stations(stations, 37.444178, -122.154721, 3).collect()
    assert [r.station for r in got] == ["near", "twin", "mid"] and got[0].distance_km == pytest.approx(0.769, abs=0.01)
    temps = spark.createDataFrame([(s, t[0], 1.0) for s in ("a", "b") for t in at(0, 1, 2, 3)], "station string, time timestamp, temp double")
    out = STN.station_temperature(temps, ["a"], "2024-01-01 01:00:00", "2024-01-01 02:00:00")
    assert out.columns == ["temp_ws", "starttime", "temp"] and out.count() == 2


def test_versioned_store(spark):
    path = new_path(spark, "store")
    df = spark.createDataFrame([(t[0], float(i)) for i, t in enumerate(at(0, 24, 48))], "timestamp timestamp, v double")
    version = ST.feature_version(True, True, "f", 30, "rfe", 20)
    assert version == "EWT_f_30_rfe_20" and ST.feature_version(False, False, "mi", 5, "imp", 2) == "E_mi_5_imp_2"
    ST.write_versioned(df, path, version, "2024-01-02")
    ST.write_versioned(df.limit(1), path, "E_mi_5_imp_2", "2024-01-02")
    assert ST.read_versioned(spark, path, version, "train").count() == 1
    assert ST.read_versioned(spark, path, version).count() == 3
    with pytest.raises(ValueError, match="not in"):
        ST.read_versioned(spark, path, "E_f_1_f_1")


def test_stage_formats(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1.5, "x")], "t timestamp, v double, s string")
    for fmt in ("parquet", "csv"):
        path = ST.write_stage(df, new_path(spark, "stage"), fmt)
        assert ST.read_stage(spark, path, df.schema, fmt).collect() == df.collect()
    with pytest.raises(ValueError):
        ST.read_stage(spark, path, None, "csv")
    assert ST.sample_rows(spark.range(9), 2, ("id",)).count() == 2


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3).toDF("x"), "t")
    assert staged.inputFiles()[0].replace("file://", "").startswith(shared_dir(spark))


def test_without_a_named_folder_only_a_local_master_gets_one(spark):
    from types import SimpleNamespace

    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: "set")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
