"""Stage tables between jobs, versioned feature sets and the trend-parameter store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoload.operators.trend import new_records
from chronoload.session import is_missing, prepare


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Replace a stage table. Parquet keeps types and lets the next job prune columns; CSV is for export."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by) if partition_by else df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)
    return path


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a stage table with its declared types; CSV needs the schema."""
    reader = prepare(spark).read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("reading CSV needs a schema")
        return reader.csv(path, header=True)
    return reader.format(fmt).load(path)


def feature_version(weather: bool, traffic: bool, method_1: str, k_1: int, method_2: str, k_2: int) -> str:
    """Name of a feature set: its sources, then both selection rounds."""
    sources = "E" + ("W" if weather else "") + ("T" if traffic else "")
    return "_".join([sources, method_1, str(k_1), method_2, str(k_2)])


def versioned(df: DataFrame, version: str, split_date: str, ts_col: str = "timestamp") -> DataFrame:
    """Mark rows with the feature version and their split."""
    part = F.when(F.col(ts_col) < F.lit(split_date).cast("timestamp"), "train").otherwise("test")
    return df.withColumns({"feature_version": F.lit(version), "split": part})


def write_versioned(df: DataFrame, path: str, version: str, split_date: str, ts_col: str = "timestamp") -> None:
    """Write one version's train and test rows; other versions in the store stay as they are."""
    marked = versioned(df, version, split_date, ts_col).drop("feature_version")
    marked.write.mode("overwrite").partitionBy("split").parquet(f"{path}/feature_version={version}")


def read_versioned(spark: SparkSession, path: str, version: str, split: str | None = None) -> DataFrame:
    """Rows of one version; only its folders are listed and read."""
    try:
        df = prepare(spark).read.parquet(f"{path}/feature_version={version}")
    except AnalysisException as missing:
        if not is_missing(missing):
            raise
        raise ValueError(f"feature version {version} is not in {path}") from missing
    return df.where(F.col("split") == split).drop("split") if split else df


def upsert_trend(candidate: DataFrame, path: str, key_cols: tuple[str, ...] = ("date_key",)) -> DataFrame:
    """Append trend rows whose key the store does not hold yet, and return the store."""
    spark = candidate.sparkSession
    try:
        stored = spark.read.schema(candidate.schema).parquet(path)
    except AnalysisException as missing:
        if not is_missing(missing):
            raise
        fresh = candidate
    else:
        fresh = new_records(stored, candidate, key_cols)
    fresh.write.mode("append").parquet(path)
    return spark.read.schema(candidate.schema).parquet(path)


def sample_rows(df: DataFrame, n: int, order_cols: tuple[str, ...] = ()) -> DataFrame:
    """First n rows, of a given order where one is named."""
    return (df.orderBy(*order_cols) if order_cols else df).limit(n)
