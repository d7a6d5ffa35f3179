"""Connected components of a links table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoload.session import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: the greater ones; small: the smaller ones) linked to its least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    else:
        out = joined.select(F.col("b").alias("x"), F.col("m").alias("y")).unionByName(
            least.select(F.col("a").alias("x"), F.col("m").alias("y"))
        )
    return out.where("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (a, b) to ``node, root``: the least node of each component, for every node but the root itself.

    Every round is written to the shared folder, so the plan of a round does not grow and a lost executor costs a
    re-read. No link or component comes to the driver, only a count and a sum a round.
    """
    mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    now = stage(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), name)
    before = now.agg(*mark).first()
    while before[0]:
        now = stage(_star(_star(now, True), False), name)
        after = now.agg(*mark).first()
        if tuple(after) == tuple(before):
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
