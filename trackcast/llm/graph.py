"""Connected components by alternating large-star and small-star steps.

Edges and labels stay DataFrames; every step is a grouped minimum (combined
before the shuffle) and one join of two stored tables, whose hot nodes Spark can
split.  Steps write their edges to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over stored (u, v), u > v.  Large: every neighbour above u goes to u's
    least neighbour (or u); small: u and its lesser neighbours go to the least of them."""
    both = edges.union(edges.select("v", "u")) if large else edges
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("m", "u").alias("m")), "star-least")
    met = both.join(least, F.col("u") == F.col("c"))
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return stored(out.where(F.col("u") != F.col("v")).distinct(), "star")


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one root, and no root hangs on another."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (two columns of one type, any
    direction); the root is the least node of the component.

    Null ends and loops are left out; repeated edges count once; no edges give no rows.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "star-0")
    while not _settled(now):
        now = _star(_star(now, True), False)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stored(roots.union(roots.select("root", "root").distinct()), "components")
