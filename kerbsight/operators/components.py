"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.session import cut_observed, dropped

c = F.col


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link between two longs; root is the smallest node that links reach.

    Each round hangs the larger neighbours of every node on its smallest neighbour, then the smaller ones. Nodes keep
    one row for each neighbour, minima are pre-aggregated before the shuffle, and the joins back can be split by the
    adaptive skew join, so a node with very many links is no single task. Rounds end when a round changes no row.
    Null ends and links of a node with itself are left out; an empty table has no components.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(c("u") > c("v")).distinct()
    marks = {"rows": F.count(F.lit(1)), "mark": F.bit_xor(F.xxhash64("u", "v"))}
    edges, seen = cut_observed(edges, "links", **marks)
    while seen["rows"]:
        before, last = edges, seen
        edges, seen = cut_observed(_small_star(_large_star(edges)), "stars", **marks)
        dropped(before)
        if seen == last:
            break
    roots = edges.select(c("v").alias("node"), c("v").alias("root")).distinct()
    return edges.select(c("u").alias("node"), c("v").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(c("v").alias("u"), c("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), c("u")).alias("m"))
    return both.where(c("v") > c("u")).join(least, "u").select(c("v").alias("u"), c("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where(c("v") != c("m")).select(c("v").alias("u"), c("m").alias("v"))
    return rest.unionByName(least.select("u", c("m").alias("v"))).where(c("u") > c("v")).distinct()
