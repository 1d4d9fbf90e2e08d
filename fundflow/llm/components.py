"""Connected components of links between documents, by alternating stars.

Each round ties every node to the smallest node of its neighbourhood, first for
greater neighbours (large star), then for smaller ones (small star); rounds go
on until the links are stars around the smallest node of each component. A
node's neighbours are never gathered: their minimum is a partial aggregate, and
it goes back to them by a join that can split a node with very many links. A link
is kept once, greater end first; a round is two such joins and no union of both
directions: the driver keeps account of every stage and task of a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fundflow.llm.common import staged, unstage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of links ``a, b``. Nodes that are the
    smallest of their component, or have no links, have no row. Null ends and loops are no links."""
    def written(found: DataFrame) -> tuple[DataFrame, dict]:
        # Taken while the links are written: how many, and a sum that tells them from others.
        seen = Observation()
        out = staged(found.observe(seen, F.count(F.lit(1)).alias("n"),
                                   F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "links")
        return out, seen.get

    edges, last = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .where("a is not null and b is not null and u <> v").distinct())
    while True:
        # Large star: the greater neighbours of v go to v's smallest neighbour, or v itself.
        least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "v")
        large = edges.join(least, "v", "left").selectExpr("u", "coalesce(m, v) v")
        # Small star: u and its smaller neighbours go to the smallest of them, m; u's own link takes the place of m's.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        before = edges
        edges, now = written(large.join(least, "u").selectExpr("if(v = m, u, v) u", "m v").distinct())
        unstage(before)
        if now == last:
            return edges.selectExpr("u node", "v component")
        last = now
