"""Windows over long series, cut into blocks so that no task holds a whole series.

Two shapes cover every window operator here:

* bounded frames (lags, rolling sums): ``with_halo`` copies the rows a block needs from its
  neighbours into it, the window runs per (series, block), and the copies are dropped again;
* running values (forward fill, running sum / minimum): ``block_scan`` runs per block and adds
  what earlier blocks carry over, taken from one row per block.

Both need a complete grid, which ``grid.check_series`` verifies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoload.functions.timefns import steps_since
from chronoload.operators.keys import join_on
from chronoload.session import stage

BLOCK_ROWS = 1344  # eight weeks of hours
EPOCH = "1970-01-01 00:00:00"
BLOCK = "_block"


def with_halo(
    df: DataFrame,
    series_cols: Sequence[str],
    ts_col: str,
    back: int,
    ahead: int = 0,
    step_seconds: int = 3600,
    block_rows: int | None = None,
) -> DataFrame:
    """Add ``_block`` and ``_halo``; each row also appears, as halo, in the blocks that look at it.

    ``back`` and ``ahead`` are how many earlier and later rows a frame reaches. A row is copied
    into at most one later and one earlier block, so a block is never shorter than the reach.
    """
    size = max(block_rows or BLOCK_ROWS, back, ahead, 1)
    pos = steps_since(ts_col, EPOCH, step_seconds)
    block = F.floor(pos / size).cast("long")
    within = F.pmod(pos, F.lit(size))
    homes = [F.struct(block.alias(BLOCK), F.lit(False).alias("_halo"))]
    if back:
        homes.append(F.when(within >= size - back, F.struct((block + 1).alias(BLOCK), F.lit(True).alias("_halo"))))
    if ahead:
        homes.append(F.when(within < ahead, F.struct((block - 1).alias(BLOCK), F.lit(True).alias("_halo"))))
    copies = F.array_compact(F.array(*homes)) if len(homes) > 1 else F.array(*homes)
    return df.withColumn("_home", F.explode(copies)).select("*", "_home.*").drop("_home")


def block_window(series_cols: Sequence[str], ts_col: str):
    return Window.partitionBy(*series_cols, BLOCK).orderBy(ts_col)


def without_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_halo")).drop(BLOCK, "_halo")


def block_scan(
    df: DataFrame,
    value: Column,
    out: str,
    kind: str,
    series_cols: Sequence[str],
    pos: Column,
    order_col: str,
    block_rows: int = BLOCK_ROWS,
    inclusive: bool = True,
) -> DataFrame:
    """Running ``last`` non-null, ``sum``, ``min`` or ``max`` of ``value`` along ``order_col``.

    The current row counts unless ``inclusive`` is false.

    ``pos`` numbers the rows of a series and only has to grow with ``order_col``; blocks are cut on
    it. What crosses block borders is one row per block.
    """
    keys = list(series_cols)
    rows = df.withColumn("_v", value).withColumn(BLOCK, F.floor(pos / block_rows).cast("long"))
    local = Window.partitionBy(*keys, BLOCK).orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("_v")
    if kind == "last":
        total = F.max_by(v, F.when(v.isNotNull(), F.col(order_col)))
        running, carry = F.last(v, True).over(local), F.last("_total", True).over(before)
        merged = F.coalesce(F.col("_run"), F.col("_carry"))
    elif kind == "sum":
        total, running, carry = F.sum(v), F.sum(v).over(local), F.sum("_total").over(before)
        merged = F.when(
            F.col("_run").isNotNull() | F.col("_carry").isNotNull(),
            F.coalesce(F.col("_run"), F.lit(0.0)) + F.coalesce(F.col("_carry"), F.lit(0.0)),
        )
    elif kind in ("min", "max"):
        agg = F.min if kind == "min" else F.max
        pick = F.least if kind == "min" else F.greatest
        total, running, carry = agg(v), agg(v).over(local), agg("_total").over(before)
        merged = pick(F.col("_run"), F.col("_carry"))
    else:
        raise ValueError(f"unknown running value: {kind}")
    # one row per block; without series columns the block table itself is the only group
    carries = rows.groupBy(*keys, BLOCK).agg(total.alias("_total")).select(*keys, BLOCK, carry.alias("_carry"))
    joined = rows.join(carries.withColumnsRenamed({k: f"_c_{k}" for k in [*keys, BLOCK]}),
                       [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in [*keys, BLOCK]], "left")
    return joined.withColumn("_run", running).withColumn(out, merged).select(
        *[F.col(f"`{c}`") for c in df.columns if c != out], out
    )


RANGES = 4096


def least_before(
    df: DataFrame, value: str, out: str, series_cols: Sequence[str], order_col: str, range_rows: int = 100_000
) -> DataFrame:
    """``df`` with the least ``value`` of the rows before each one in its series, whatever ``order_col`` counts.

    The rows are cut into ranges of (series, order) of about ``range_rows`` rows (``RANGES`` of them at most), so a range
    is as full where the order is sparse as where it is dense, and a long series spans many ranges. The first level runs
    inside a range; the second over one least value per series and range. Ties in the order go by the value.
    """
    keys = list(series_cols)
    order = [*keys, order_col]
    ranges = min(RANGES, max(1, -(-df.count() // range_rows)))
    ranged = df.repartitionByRange(ranges, *order) if ranges > 1 else df.coalesce(1)
    # written, so that a range keeps its number whatever is recomputed later
    rows = stage(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    least = rows.groupBy(*keys, "_range").agg(F.min(value).alias("_least"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = least.select(*keys, "_range", F.min("_least").over(earlier).alias("_carried"))
    own = Window.partitionBy(*keys, "_range").orderBy(order_col, value).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("_inside", F.min(value).over(own))
    joined = join_on(inside, carried, [*keys, "_range"])
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.least("_inside", "_carried").alias(out))
