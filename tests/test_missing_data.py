"""Missing paths, missing trend rows, missing values in a stream's state, and workers without the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from chronoload.operators.trend import remove_trend
from chronoload.sources.stages import upsert_trend
from chronoload.streaming.load import _SlotHistory
from chronoload.training.runs import read_runs


def test_only_a_missing_path_is_an_empty_store(spark, tmp_path):
    row = spark.createDataFrame([("a", 1.0)], "date_key string, slope double")
    assert upsert_trend(row, str(tmp_path / "trend")).count() == 1
    assert upsert_trend(row, str(tmp_path / "trend")).count() == 1
    with pytest.raises(AnalysisException):
        upsert_trend(row, str(tmp_path / "trend"), ("no_such_key",)).count()
    assert read_runs(spark, str(tmp_path / "runs")).count() == 0


def test_a_series_without_a_trend_is_refused(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "s string, y double").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp"))
    trend = spark.createDataFrame([("a", 0.5, 1.0)], "s string, slope double, intercept double")
    assert remove_trend(rows.where("s = 'a'"), trend, "y", "2024-01-01", ["s"]).first().y == 0.0
    with pytest.raises(PySparkException, match="no row in the trend table"):
        remove_trend(rows, trend, "y", "2024-01-01", ["s"]).collect()


class _Past:
    def __init__(self):
        self.rows = []

    def get(self):
        return iter(self.rows)

    def exists(self):
        return bool(self.rows)

    def appendList(self, rows):  # noqa: N802
        self.rows += rows


def test_a_missing_value_leaves_no_trace_in_the_state():
    history = _SlotHistory("t", "y", 3.5, 0, ["t", "y"], "outlier")
    history.past = _Past()
    y = [1, 2, 1.5, None, 1.2, 1.8, 1.1, 500]
    flags = []
    for part in (slice(0, 5), slice(5, 8)):
        batch = pd.DataFrame({"t": range(8), "y": pd.Series(y, dtype=float), "grid_pos": range(8)})[part]
        flags += next(history.handleInputRows(None, iter([batch]), None))["outlier"].tolist()
    assert flags == [0] * 7 + [1] and len(history.past.rows) == 7


def test_queries_run_from_an_empty_folder(tmp_path):
    entry = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
spec = importlib.util.spec_from_file_location("entry_module", {str(entry)!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
for name in ("j2_partial_autocorrelation", "l12_holt_winters"):
    print(name, module.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
