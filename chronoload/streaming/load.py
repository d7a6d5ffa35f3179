"""Streaming forms: hourly load under a watermark, and outlier flags with frozen or growing parameters."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chronoload.functions.arrays import MAD_TO_SIGMA
from chronoload.functions.timefns import steps_since
from chronoload.operators.seasonal import SLOT, frozen_mad_flags, with_slot
from chronoload.session import new_path
from chronoload.streaming.ordered import OrderedCounts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def hourly_load(
    stream: DataFrame, ts_col: str, value: str, series_cols: Sequence[str] = (), delay: str = "2 hours",
    step: str = "1 hour", out: str = "load",
) -> DataFrame:
    """Sum per series and tumbling window. A window is emitted once the watermark has passed its end;
    rows later than that are dropped."""
    window = F.window(ts_col, step)
    sums = stream.withWatermark(ts_col, delay).groupBy(*series_cols, window).agg(F.sum(value).alias(out))
    return sums.select(*series_cols, F.col("window.start").alias("timestamp"), out)


def frozen_flags(
    stream: DataFrame, params: DataFrame, value: str, k: float = 3.5, series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", out: str = "outlier",
) -> DataFrame:
    """The batch operator on a stream: the static parameters are joined to every micro-batch."""
    return frozen_mad_flags(stream, params, value, k, series_cols, ts_col, out)


class _SlotHistory(StatefulProcessor):
    """Judges each new value of one (series, hour, weekday) on those before it, which are kept as a plain list.

    The list is read whole once a batch; ``_OrderedSlotHistory`` has the same rule over a state that is not.
    """

    def __init__(self, ts_col: str, value: str, k: float, min_samples: int, columns: list[str], out: str):
        self.ts_col, self.value, self.k, self.min_samples = ts_col, value, k, min_samples
        self.columns, self.out = columns, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.past = handle.getListState("past", T.StructType([T.StructField("v", T.DoubleType())]))

    def _seen(self) -> OrderedCounts:
        seen = OrderedCounts({}.get)
        for (x,) in self.past.get() if self.past.exists() else ():
            seen.add(x)
        return seen

    def _keep(self, seen: OrderedCounts, new: list[float]) -> None:
        if new:
            self.past.appendList([(x,) for x in new])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.ts_col, kind="stable")
        flags = np.zeros(len(batch), dtype="int32")
        seen, new = self._seen(), []
        values = batch[self.value].to_numpy(dtype=float).tolist()
        for i, (x, pos) in enumerate(zip(values, batch["grid_pos"], strict=True)):
            if math.isnan(x):  # missing values are flagged 0 and leave no trace in the state, as in the batch rule
                continue
            if pos >= self.min_samples and len(seen):
                median = seen.median()
                sigma = MAD_TO_SIGMA * seen.deviation(median)
                flags[i] = int(sigma > 0 and abs(x - median) > self.k * sigma)
            seen.add(x)
            new.append(x)
        self._keep(seen, new)
        yield batch.assign(**{self.out: flags})[[*self.columns, self.out]]

    def close(self) -> None:
        pass


class _OrderedSlotHistory(_SlotHistory):
    """The values in order, as a map of small nodes (``ordered``): a new row reads and writes a few of them whatever has
    come before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.past = handle.getMapState("past", "name string", "vals array<double>, counts array<bigint>")

    def _read(self, name: str):
        if not self.past.containsKey((name,)):
            return None
        values, counts = self.past.getValue((name,))
        return list(values), list(counts)

    def _seen(self) -> OrderedCounts:
        return OrderedCounts(self._read)

    def _keep(self, seen: OrderedCounts, new: list[float]) -> None:
        for name, node in seen.changed().items():
            self.past.updateValue((name,), node)


def expanding_flags(
    stream: DataFrame, value: str, start: str, k: float = 3.5, min_samples: int = 0, series_cols: Sequence[str] = (),
    ts_col: str = "timestamp", out: str = "outlier", step_seconds: int = 3600,
) -> DataFrame:
    """The expanding seasonal rule with keyed state. A key's rows must arrive in time order between
    micro-batches; inside one they are sorted. The state grows by one value per week, and the work
    of a row by its logarithm."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    slotted = with_slot(stream, ts_col)
    columns = slotted.columns
    schema = T.StructType([*slotted.schema.fields, T.StructField(out, T.IntegerType())])
    return (
        slotted.withColumn("grid_pos", steps_since(ts_col, start, step_seconds))
        .groupBy(*series_cols, *SLOT)
        .transformWithStateInPandas(
            statefulProcessor=_OrderedSlotHistory(ts_col, value, k, min_samples, columns, out),
            outputStructType=schema, outputMode="append", timeMode="none",
        )
    )


def run_available(stream: DataFrame, name: str, table: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process what is there and stop; rows land in a parquet table of the shared folder."""
    spark = stream.sparkSession
    table = table or new_path(spark, name)
    checkpoint = checkpoint or new_path(spark, f"{name}-progress")
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", table)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(table)
