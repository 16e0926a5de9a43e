"""Connected components of an edge table, by alternating star operations.

Every round rewires each node to the smallest node it knows of: the large star
links larger neighbours to the minimum, the small star links smaller ones.
Minima are plain grouped aggregates (pre-aggregated before the shuffle) and hubs
meet their edges in sort-merge joins that adaptive execution may split, so no
component, however large, is gathered in one task or on the driver.  Rounds grow
with the logarithm of the longest path; each is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored


def _star(both: DataFrame) -> DataFrame:
    """Adds ``m``: the smallest of a node ``u`` and its neighbours ``v``."""
    low = both.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("k"), F.least("u", "w").alias("m"))
    return both.join(low, F.col("u") == F.col("k")).select("u", "v", "m")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    x = _star(down)
    return x.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .unionAll(x.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal marks mean that a round changed nothing."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_xor(h)).head())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v; longs, no nulls):
    component is the smallest node reachable, the node itself included.  Self
    links and repeated edges do no harm; nodes without edges are not listed."""
    now = stored(edges.where("u != v").select("u", "v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small(_large(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    star = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    loops = edges.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    return star.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).unionAll(loops) \
        .groupBy("node").agg(F.min("component").alias("component"))
