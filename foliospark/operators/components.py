"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .joins import salted_join

SPREAD = 4  # places that a hub's neighbours are spread over

def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. Each node links its larger (or, for the small star, smaller) neighbours to the least node of its
    neighbourhood."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = salted_join(both, least, ["u"], F.col("v"), SPREAD).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = salted_join(down, least, ["u"], F.col("v"), SPREAD)
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node of its component.

    Large-star and small-star steps (Kiveris et al. 2014) alternate until nothing changes; each round needs only
    joins and a minimum per node, never a component in one place, and is written to the shared folder. Self-loops,
    repeated edges and nulls have no effect; a node that only has those is left out.
    """
    now = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u is not null and v is not null and u <> v").distinct())
    before = None
    for _ in range(most_rounds):
        now = cut(_star(_star(now, True), False))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
