from __future__ import annotations

from pathlib import Path

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from chronoload.operators import seasonal as S
from chronoload.session import new_path
from chronoload.streaming import load as STR


def test_late_rows_beyond_the_watermark_are_dropped(spark):
    t = datetime(2024, 1, 1)
    schema = "ts timestamp, g string, v double"
    path = new_path(spark, "late")

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    progress, table = new_path(spark, "progress"), new_path(spark, "table")

    def run():
        stream = STR.hourly_load(STR.file_stream(spark, path, spark.createDataFrame([], schema).schema), "ts", "v", ["g"], "2 hours")
        return STR.run_available(stream, "late", table, progress)

    land([(t, "a", 1.0), (t + timedelta(minutes=30), "a", 2.0), (t + timedelta(hours=4), "a", 5.0)])
    assert [(r.timestamp, r.load) for r in run().collect()] == [(t, 3.0)]
    # the watermark stands at 02:00: the first hour is closed, the third still open
    land([(t + timedelta(minutes=10), "a", 100.0), (t + timedelta(hours=2, minutes=5), "a", 7.0), (t + timedelta(hours=9), "a", 1.0)])
    got = {(r.timestamp - t).seconds // 3600: r.load for r in run().collect()}
    assert got == {0: 3.0, 2: 7.0, 4: 5.0}


def test_stateful_flags_equal_batch_over_several_batches(spark, hourly):
    df, _ = hourly
    spiked = df.withColumn("y", F.when(F.dayofmonth("timestamp") == 23, F.col("y") + 30).otherwise(F.col("y")))
    path = new_path(spark, "load")
    for low, high in ((1, 10), (10, 20), (20, 32)):
        day = F.dayofmonth("timestamp")
        spiked.where((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(path)
    stream = STR.file_stream(spark, path, spiked.schema, files_per_trigger=1)
    got = STR.run_available(STR.expanding_flags(stream, "y", "2024-01-01", 3.0, 100, ["s"]), "flags")
    want = S.expanding_mad_flags(spiked, "y", "2024-01-01", 3.0, 100, ["s"])
    columns = ["s", "timestamp", "y", "hour", "weekday", "outlier"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert want.where("outlier = 1").count() > 5


def test_streaming_frozen_flags_equal_batch(spark, hourly):
    df, _ = hourly
    path = new_path(spark, "load")
    df.write.parquet(path)
    params = S.seasonal_params(df, "y", ["s"])
    got = STR.run_available(STR.frozen_flags(STR.file_stream(spark, path, df.schema), params, "y", 2.0, ["s"]), "frozen")
    want = S.frozen_mad_flags(df, params, "y", 2.0, ["s"])
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_every_sql_has_its_query():
    queries, sql = entry_point.queries(), entry_point.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100
    numbered = [n for n in queries if n.startswith("op")]
    assert bool(numbered) == (Path(entry_point.__file__).parent / "chronoload" / "llm").is_dir()


def test_entry_runs(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["event_type", "timestamp", "load"] and df.count() > 0


@pytest.mark.parametrize("name", ["hourly_load_features", "e2_rolling_sums", "e6_expanding_mad_flags", "j1_autocorrelation", "d9_completeness"])
def test_plans_have_no_unpartitioned_window_and_no_cross_join(spark, name):
    df = entry_point.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
