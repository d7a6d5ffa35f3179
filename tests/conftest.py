from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hourly(spark):
    """Two series of 600 hours: trend, daily and weekly seasons, seeded noise."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    t = np.arange(600)
    frames = []
    for name, scale in (("a", 1.0), ("b", 4.0)):
        y = scale * (20 + 0.01 * t + 5 * np.sin(2 * np.pi * t / 24) + 2 * np.cos(2 * np.pi * t / 168) + rng.normal(0, 1, 600))
        frames.append(pd.DataFrame({"s": name, "timestamp": pd.date_range("2024-01-01", periods=600, freq="h"), "y": y}))
    pdf = pd.concat(frames, ignore_index=True)
    return spark.createDataFrame(pdf).cache(), pdf
