"""The run table: tuning runs with parameters, metrics and tags, kept as parquet."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from hashlib import sha256

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoload.operators.blocks import least_before
from chronoload.session import is_missing

RUN_SCHEMA = (
    "run_id string, parent_id string, experiment string, model string, level string, run_number int, trial int, "
    "status string, params map<string,string>, metrics map<string,double>, tags map<string,string>, logged timestamp"
)


def run_record(experiment: str, model: str, level: str, **fields) -> dict:
    base = {
        "run_id": uuid.uuid4().hex, "parent_id": None, "experiment": experiment, "model": model, "level": level,
        "run_number": None, "trial": None, "status": "FINISHED", "params": {}, "metrics": {}, "tags": {},
        "logged": datetime.now(timezone.utc),
    }
    unknown = fields.keys() - base.keys()
    if unknown:
        raise ValueError(f"not a run field: {sorted(unknown)}")
    base.update(fields)
    base["params"] = {k: str(x) for k, x in base["params"].items()}
    return base


def append_runs(spark: SparkSession, path: str, records: Sequence[dict]) -> None:
    order = T.StructType.fromDDL(RUN_SCHEMA).names
    spark.createDataFrame([tuple(r[c] for c in order) for r in records], RUN_SCHEMA).coalesce(1).write.mode(
        "append"
    ).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(RUN_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if not is_missing(missing):
            raise
        return spark.createDataFrame([], RUN_SCHEMA)


def next_run_number(runs: DataFrame, model: str, experiment: str | None = None) -> int:
    mine = runs.where((F.col("model") == model) & (F.col("level") == "parent"))
    if experiment is not None:
        mine = mine.where(F.col("experiment") == experiment)
    return (mine.agg(F.max("run_number")).first()[0] or 0) + 1


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file unless it is there; of several writers one gets True.

    The store must make a file and refuse an existing one in a single step, as HDFS and local disks do.
    """
    java = spark._jvm.java
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    if store.getScheme() == "file":  # its ``create`` looks first and writes later
        return java.io.File(target.toUri().getPath()).createNewFile()
    try:
        store.create(target, False).close()
    except Py4JJavaError as refused:
        if refused.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException" or store.exists(target):
            return False
        raise
    return True


def claim_run_number(spark: SparkSession, path: str, model: str, experiment: str) -> int:
    """A run number of (experiment, model) that no other writer has or gets; a run that fails leaves a gap.

    The claims are empty files in ``_claims`` of the run table's folder, which Spark does not read as data.
    """
    number = next_run_number(read_runs(spark, path), model, experiment)
    owner = sha256(f"{experiment}\0{model}".encode()).hexdigest()[:32]
    while not claim(spark, f"{path.rstrip('/')}/_claims/{owner}/{number:09d}"):
        number += 1
    return number


def store_tables(models_path: str, run_id: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Write a run's evaluation tables beside its model and return them as read back."""
    for name, df in tables.items():
        df.write.parquet(f"{models_path}/{run_id}-{name}")
    return {name: read_table(df.sparkSession, models_path, run_id, name) for name, df in tables.items()}


def read_table(spark: SparkSession, models_path: str, run_id: str, name: str) -> DataFrame:
    """A run's table: ``correlations``, ``importances`` or ``residuals``."""
    return spark.read.parquet(f"{models_path}/{run_id}-{name}")


def next_run_numbers(runs: DataFrame) -> DataFrame:
    """Next number per model."""
    return (
        runs.where("level = 'parent'").groupBy("model").agg((F.max("run_number") + 1).alias("next_run_number"))
    )


def with_metric(runs: DataFrame, metric: str) -> DataFrame:
    return runs.withColumn("value", F.try_element_at("metrics", F.lit(metric))).where(F.col("value").isNotNull())


def best_runs(
    runs: DataFrame, metric: str = "rmse", ascending: bool = True, by: Sequence[str] = (), where: str | None = None
) -> DataFrame:
    """The best finished run (per ``by`` group) with its parent, or with itself when it has none.

    Error metrics are better when small, hence the default order. The winner is an aggregate, not a sort.
    """
    finished = runs.where("status = 'FINISHED'")
    scored = with_metric(finished.where(where) if where else finished, metric)
    key = F.struct((F.col("value") if ascending else -F.col("value")).alias("v"), F.col("run_id"))
    winner = scored.groupBy(*by).agg(F.min_by(F.struct("run_id", "parent_id", "model", "value", "params"), key).alias("w"))
    best = winner.where("w is not null").select(
        *by, F.col("w.run_id").alias("run_id"), F.col("w.value").alias("value"), F.col("w.parent_id").alias("_parent"),
        F.col("w.params").alias("params"),
    )
    parents = runs.select(F.col("run_id").alias("_pid"), F.col("model").alias("_pmodel"))
    joined = best.join(parents, F.col("_parent") == F.col("_pid"), "left")
    return joined.select(*by, "run_id", "value", F.coalesce("_pid", "run_id").alias("artifact_run_id"), "params")


def best_run(spark: SparkSession, path: str, experiment: str, metric: str = "rmse", ascending: bool = True,
             where: str | None = None):
    """The best finished run of an experiment as one row; an error names what is missing."""
    runs = read_runs(spark, path).where(F.col("experiment") == experiment)
    row = best_runs(runs, metric, ascending, where=where).first()
    if row is None:
        raise ValueError(f"no finished run with metric {metric} in experiment {experiment}")
    return row


def experiment_metrics(runs: DataFrame) -> DataFrame:
    """Names of the metrics present per experiment."""
    return runs.select("experiment", F.explode(F.map_keys("metrics")).alias("metric")).distinct()


def champion_trace(
    trials: DataFrame, value: str, trial_col: str = "trial", study_cols: Sequence[str] = (), block_rows: int = 100_000
) -> DataFrame:
    """Per trial: best value so far, whether this trial improved it, and by how many percent.

    Trial numbers may be sparse; a study of any length spreads over ranges of about ``block_rows`` trials.
    """
    seen = least_before(trials, value, "_before", study_cols, trial_col, block_rows)
    best = F.least(F.col("_before"), F.col(value))
    improved = F.coalesce(F.col(value) < F.col("_before"), F.lit(True))
    pct = F.abs(F.col("_before") - F.col(value)) / F.col(value) * 100
    return seen.select(
        *study_cols, trial_col, value, best.alias("best"), improved.alias("improved"),
        F.when(improved & F.col("_before").isNotNull(), pct).alias("improvement_pct"),
    )
