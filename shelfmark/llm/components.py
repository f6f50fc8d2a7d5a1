"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

MOST_TURNS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each node's component, from links (x, y).

    Large-star and small-star steps in turn (Kiveris et al. 2014): every node
    links its larger neighbours, then its smaller ones and itself, to the
    smallest it knows, until nothing changes. The links of a hub are never brought
    together; only minima are. Each turn is written to the shared folder, so a
    lost executor costs one turn at most. Without links there are no rows.
    """
    links = links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    links, before = stored(links, "links"), None
    for _ in range(MOST_TURNS):
        links = stored(_small_star(_large_star(links)), "stars")
        after = links.agg(F.count(F.lit(1)), F.sum(F.col("y").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    ends = links.select(F.col("x").alias("node"), F.col("y").alias("component"))
    roots = links.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    return ends.unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest node it knows."""
    both = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("_m"))
    return both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("_m").alias("y")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    least = down.groupBy("x").agg(F.min("y").alias("_m"))
    moved = down.join(least, "x").where("y <> _m").select(F.col("y").alias("x"), F.col("_m").alias("y"))
    return moved.unionByName(least.select("x", F.col("_m").alias("y"))).distinct()
