"""Exact quantiles of groups of any size, by recursive selection of ranks.

``percentile`` gathers a group's distinct values in one task, which a group with a third of all rows does not survive. Here
a first pass counts the rows of each group in bins of a fixed logarithmic grid and keeps the least and greatest value of each
bin; running counts over the bins say which one holds a wanted rank. A rank at either end of its bin, or in a bin of one
value, is found. The others go round again: only the rows inside the open brackets are counted, in ``accuracy`` even parts of
the bracket, or value by value once it holds no more than ``accuracy`` rows, until every rank is found. Everything is counted
before it is shuffled, and what an ordered window sees is bounded by the grid and by ``accuracy``, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from chronoload.operators.keys import join_on
from chronoload.session import stage

ACCURACY = 4096


def quantile_name(p: float) -> str:
    return f"q{100 * p:g}".replace(".", "_")


def _names(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


#: Place on a logarithmic scale that keeps the order of all doubles: log2 of one lies within -1074 and 1024.
_SCALE = "CASE WHEN isnan(_v) THEN 2300D WHEN _v = 0 THEN 0D ELSE signum(_v) * least(log2(abs(_v)) + 1100D, 2200D) END"


def _counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.expr("count(*) AS _c"), F.expr("min(_v) AS _lo"), F.expr("max(_v) AS _hi"))


def grid_counts(v: DataFrame, keys: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """``keys, _bin, _c, _lo, _hi``: rows, least and greatest value of each bin; accuracy / 16 bins a power of two."""
    binned = v.selectExpr(*_names(keys), "_v", f"floor({_SCALE} * {max(1, accuracy // 16)}) AS _bin")
    return _counted(binned, [*keys, "_bin"])


def bracket_counts(v: DataFrame, brackets: DataFrame, keys: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """``keys, _below, _bin, _c, _lo, _hi`` of the rows inside the group's open brackets, which do not overlap."""
    own = "get(filter(_open, b -> _v >= b.lo AND _v <= b.hi), 0)"
    marked = join_on(v, brackets, keys).selectExpr(*_names(keys), "_v", f"{own} AS _b").where("_b IS NOT NULL")
    part = f"CAST(floor((_v - _b.lo) / (_b.hi - _b.lo) * {accuracy}) AS DOUBLE)"
    marked = marked.selectExpr(*_names(keys), "_v", "_b.below AS _below", f"if(_b.inside <= {accuracy}, _v, {part}) AS _bin")
    return _counted(marked, [*keys, "_below", "_bin"])


def _wanted(p: float) -> tuple[str, str]:
    """Both order statistics of a probability, as ranks from 0, over column ``n``."""
    low = f"floor({float(p)!r}D * (n - 1))"
    return low, f"least({low} + 1, n - 1)"


_FIRST, _LAST = "_rank = _below", "_rank = _below + _inside - 1"
_OPEN = f"(_lo < _hi AND NOT {_FIRST} AND NOT {_LAST})"
_STATE = ("n", "_rank", "_lo", "_hi", "_upto - _c AS _below", "_c AS _inside")


def _order_statistics(v: DataFrame, keys: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """``keys, n, _rank, _value`` for every rank that a probability asks for."""
    names = _names(keys)
    group = f"PARTITION BY {', '.join(names)}" if names else ""
    bins = grid_counts(v, keys, accuracy).selectExpr(
        "*", f"sum(_c) OVER ({group}) AS n", f"sum(_c) OVER ({group} ORDER BY _bin ROWS UNBOUNDED PRECEDING) AS _upto")
    ranks = ", ".join(r for p in probs for r in _wanted(p))
    here = f"explode(filter(array_distinct(array({ranks})), r -> r >= _upto - _c AND r < _upto)) AS _rank"
    found = bins.selectExpr("*", here).selectExpr(*names, *_STATE)
    while True:  # a round cuts a bracket into ``accuracy`` parts, so six rounds end it
        seen = Observation()  # rides on the write of the ranks
        found = stage(found.observe(seen, F.expr(f"max(if({_OPEN}, _inside, NULL)) AS widest")), "ranks")
        widest = seen.get["widest"]
        if widest is None:
            break
        still = found.where(_OPEN)
        bracket = "collect_set(named_struct('lo', _lo, 'hi', _hi, 'below', _below, 'inside', _inside)) AS _open"
        brackets = still.groupBy(*keys).agg(F.expr(bracket))  # two a probability at most
        own = f"PARTITION BY {', '.join([*names, '_below'])} ORDER BY _bin ROWS UNBOUNDED PRECEDING"
        parts = bracket_counts(v, brackets, keys, accuracy).selectExpr("*", f"_below + sum(_c) OVER ({own}) AS _upto")
        narrower = join_on(parts, still.select(*keys, "n", "_rank", "_below"), [*keys, "_below"])
        narrower = narrower.where("_rank >= _upto - _c AND _rank < _upto").selectExpr(*names, *_STATE)
        found = found.where(f"NOT {_OPEN}").unionByName(narrower)
        if widest <= accuracy:
            break  # that round goes value by value, so it finds all that are left
    return found.selectExpr(*names, "n", "_rank", f"if({_FIRST}, _lo, _hi) AS _value")


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    accuracy: int = ACCURACY,
    extras: Sequence[Column] = (),
) -> DataFrame:
    """One row per group: ``n`` and one linearly interpolated quantile column per probability.

    ``extras`` are further named aggregates (over ``df``'s columns) per group; with them, groups without any value appear
    too, with null quantiles. ``df`` is read once for the grid, once for each round and once for the extras. Nulls are
    ignored; NaN is greater than any number.
    """
    keys = list(group_cols)
    probs = sorted(probs)
    column = F.col(value) if isinstance(value, str) else value
    valued = df.withColumn("_v", column.cast("double"))
    statistics = _order_statistics(valued.select(*keys, "_v").where(F.col("_v").isNotNull()), keys, probs, accuracy)
    picks, outputs = [], []
    for i, p in enumerate(probs):
        picks += [F.expr(f"max(if(_rank = {rank}, _value, NULL)) AS _{side}{i}") for side, rank in zip("ab", _wanted(p))]
        position = f"({float(p)!r}D * (n - 1))"
        outputs.append(f"_a{i} + (_b{i} - _a{i}) * ({position} - floor({position})) AS {quantile_name(p)}")
    found = statistics.groupBy(*keys).agg(F.max("n").alias("n"), *picks)
    if not keys:  # a global aggregate of no rows is one row of nulls
        found = found.where("n IS NOT NULL")
    found = found.selectExpr(*_names(keys), "n", *outputs)
    return join_on(valued.groupBy(*keys).agg(*extras), found, keys, "left") if extras else found
