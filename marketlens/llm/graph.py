"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v; hubs of any size: a partial minimum and a join that splits skew.

    An edge may come out of a large star more than once, but no oftener than it has edges.
    """
    if large:  # all neighbours, the larger ones move to the minimum
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # smaller neighbours only
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ends = F.explode(F.array("u", "v"))
    return joined.select(ends.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): the smallest node reachable from every node u that is not its own root.

    ``edges`` has columns (u, v) in any order; loops and repeats do no harm.
    Large-star and small-star steps alternate until every edge points at a
    root; each round is written to the shared folder.
    """
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, seen = stored(ordered.where(F.col("u") != F.col("v")).distinct(), "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or not now[0]:
            return edges.select("u", F.col("v").alias("root"))
        seen = now
        edges = stored(_star(_star(edges, True), False), "edges")
