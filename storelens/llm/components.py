"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import plain_key, write_once


def _is_star(links: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on anything."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs")), F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs")))).alias("e"))
    nodes = ends.select("e.*").groupBy("node").agg(F.sum("hangs").alias("hangs"), F.count("*").alias("ends"))
    return nodes.where("hangs > 1 or (hangs = 1 and ends > 1)").isEmpty()


def components(links: DataFrame, src: str, dst: str) -> DataFrame:
    """``node, root`` for every node that has a link; ``root`` is the smallest node it can reach.

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones
    likewise; the number of rounds grows with the logarithm of a component's size. Only minima are
    kept per node, combined before the shuffle; a node with very many links is a skewed join key, which
    AQE splits, since the minima meet it through a shuffle of their own. Every round is written to the shared folder, so a lost executor costs a
    re-read. Links with a null end are ignored; an empty table gives an empty result.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    table = write_once(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    while True:
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(plain_key(lowest, "u"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(plain_key(lowest, "u"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        table = write_once(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        if _is_star(table):
            break
    roots = table.select("v").distinct()
    return table.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
