"""Which nodes of a directed network can reach which: strongly connected cores and a labelled condensation.

Nodes that two-way edges join can reach each other, so their components are contracted first; of a street network little is left.
From the largest cores, searches run forwards and backwards over the contracted edges. A node's label has two bits for each core:
whether the core reaches it, and whether it reaches the core. Along an edge the first bits can only be added and the second only be
lost, so labels refute most pairs that no way connects, and tell which nodes a way to a target cannot use.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.operators.components import components
from kerbsight.session import cut, cut_observed, dropped

# ship the helpers below with the job; workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

c = F.col
CORES = 16
#: contracted nodes of a block, and the most rounds that put nodes together to blocks
BLOCK, MAX_MERGES = 20_000, 40


def can_reach(from_: Column, to: Column) -> Column:
    """Whether labels (structs of ``after`` and ``before``) allow a way; False is certain."""
    lost = from_["after"].bitwiseAND(F.bitwise_not(to["after"])) != 0
    return ~(lost | (to["before"].bitwiseAND(F.bitwise_not(from_["before"])) != 0))


def labels(edges: DataFrame) -> DataFrame:
    """(node, after, before) of every node of ``edges`` (u, v): bits of the cores that reach it, and of those that it reaches.

    Null ends and loops are left out; without edges there are no rows."""
    ways = cut(edges.select("u", "v").where(c("u") != c("v")).distinct(), "ways")
    back = ways.select(c("v").alias("u"), c("u").alias("v"))
    roots = components(ways.join(back, ["u", "v"]), "u", "v")
    nodes = ways.select(c("u").alias("node")).unionByName(back.select(c("u").alias("node"))).distinct()
    nodes = cut(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "two-way")
    here, there = (nodes.select(c("node").alias(n), c("root").alias(f"{n}_root")) for n in ("u", "v"))
    links = ways.join(here, "u").join(there, "v").where(c("u_root") != c("v_root")).select("u_root", "v_root").distinct()
    links = cut(
        links.select(F.lit(True).alias("ahead"), c("u_root").alias("at"), c("v_root").alias("to"))
        .unionByName(links.select(F.lit(False).alias("ahead"), c("v_root").alias("at"), c("u_root").alias("to"))), "contracted")
    sizes = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("n")).orderBy(c("n").desc(), "root").limit(CORES)
    cores = [r["root"] for r in sizes.collect()]  # CORES rows at most
    found = _searched(links, cores)
    bits = found.groupBy("at").agg(*(
        F.coalesce(F.bit_or(F.when(c("ahead") == side, c("core"))), F.lit(0)).alias(name)
        for name, side in (("after", True), ("before", False))))
    known = nodes.join(bits.withColumnRenamed("at", "root"), "root", "left")
    return known.select("node", *(F.coalesce(n, F.lit(0)).alias(n) for n in ("after", "before")))


def _blocks(links: DataFrame, size: int) -> DataFrame:
    """(at, block): the contracted nodes in blocks of neighbours, of about ``size`` nodes.

    In a round two clusters of five, drawn by a hash, are heads, and every other joins its smallest neighbour among them. Clusters
    that stay small as they have no neighbour are put together."""
    ways = links.where("ahead").select(c("at").alias("a"), c("to").alias("b"))
    sizes, seen = cut_observed(links.select("at").distinct().select("at", F.lit(1).cast("bigint").alias("n")), "cluster-sizes", n=F.count(F.lit(1)))
    wanted, clusters, maps = -(-(seen["n"] or 0) // size), seen["n"] or 0, []
    for number in range(MAX_MERGES):
        if clusters <= 2 * wanted:
            break
        head = lambda x: F.pmod(F.xxhash64(c(x), F.lit(number)), F.lit(5)) < 2
        both = ways.unionByName(ways.select(c("b").alias("a"), c("a").alias("b"))).where(~head("a") & head("b")).distinct()
        known = both.join(sizes.select(c("at").alias("a"), c("n").alias("an")), "a").join(sizes.select(c("at").alias("b"), c("n").alias("bn")), "b")
        joins = known.where(c("an") + c("bn") <= size).groupBy("a").agg(F.min_by("b", F.struct("bn", "b")).alias("root"))
        step, seen = cut_observed(
            sizes.join(joins.withColumnRenamed("a", "at"), "at", "left").select("at", "n", F.coalesce("root", "at").alias("root")),
            "clusters", joined=F.count_if(c("root") != c("at")))
        maps.append(step.select("at", "root"))
        clusters -= seen["joined"]
        sizes = cut(step.groupBy(c("root").alias("at")).agg(F.sum("n").alias("n")), "cluster-sizes")
        for end in ("a", "b"):
            ways = ways.join(maps[-1].select(c("at").alias(end), c("root").alias(f"{end}_root")), end)
            ways = ways.drop(end).withColumnRenamed(f"{end}_root", end)
        ways = cut(ways.where(c("a") != c("b")).distinct(), "cluster-links")
    # small clusters share blocks
    together = F.struct(F.lit(True).alias("shared"), F.pmod(F.xxhash64("at"), F.lit(max(1, wanted))).alias("id"))
    alone = F.struct(F.lit(False).alias("shared"), c("at").alias("id"))
    found = sizes.select("at", F.xxhash64(F.when(c("n") * 8 < size, together).otherwise(alone)).alias("block"))
    for step in reversed(maps):
        found = step.join(found.withColumnRenamed("at", "root"), "root").select("at", "block")
    return cut(found, "blocks")


def _closed(outs: np.ndarray, first: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The bits of all nodes of a block after they went along its edges: those of node i end at ``outs[first[i]:first[i + 1]]``."""
    moving = np.flatnonzero(bits)
    while len(moving):
        n = first[moving + 1] - first[moving]
        ends = outs[np.repeat(first[moving] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        offered = np.zeros(len(bits), dtype=bits.dtype) if len(ends) > len(bits) // 8 else None
        if offered is None:
            near, at = np.unique(ends, return_inverse=True)
            offered = np.zeros(len(near), dtype=bits.dtype)
        else:
            near, at = np.arange(len(bits)), ends
        np.bitwise_or.at(offered, at, np.repeat(bits[moving], n))
        news = (offered & ~bits[near]) != 0
        moving = near[news]
        bits[moving] |= offered[news]
    return bits


def _spread(inside: bool):
    """A task's blocks: what their arrivals reach; the nodes themselves (``inside``) or what leaves the block."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(len(frame)):
                ahead, at, to, block, came, core = (frame.column(n)[i].values.to_numpy() if n not in ("ahead",) else frame.column(n)[i].as_py()
                                                    for n in ("ahead", "at", "to", "to_block", "came", "core"))
                mine = frame.column("block")[i].as_py()
                nodes = np.unique(np.concatenate([at, came, to[block == mine]]))
                bits = np.zeros(len(nodes), dtype=np.int32)
                np.bitwise_or.at(bits, np.searchsorted(nodes, came), core)
                order = np.argsort(at, kind="stable")
                at, to, block = np.searchsorted(nodes, at[order]), to[order], block[order]
                stays = block == mine
                first = np.searchsorted(at[stays], np.arange(len(nodes) + 1))
                bits = _closed(np.searchsorted(nodes, to[stays]), first, bits)
                if inside:
                    found = np.full(len(nodes), mine), nodes, bits
                else:
                    found = block[~stays], to[~stays], bits[at[~stays]]
                some = found[2] != 0
                columns = [pa.array(x[some]) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array([ahead] * int(some.sum()), pa.bool_()), *columns], ["ahead", "block", "at", "core"])

    return batches


def _searched(links: DataFrame, cores: list[int], size: int | None = None) -> DataFrame:
    """(ahead, core, at): contracted nodes that cores (bits) reach (ahead) or that reach them.

    The network lies in blocks of neighbours. A round searches the blocks at which something new has arrived to their ends, and sends
    on what leaves them; so there are as many rounds as a way enters blocks, however long it is inside them."""
    spark = links.sparkSession
    seeds = spark.createDataFrame([(ahead, 1 << i, at) for i, at in enumerate(cores) for ahead in (True, False)], "ahead boolean, core int, at long")
    blocks = _blocks(links, size or BLOCK)
    packed = links.join(blocks, "at").join(blocks.select(c("at").alias("to"), c("block").alias("to_block")), "to")
    steps = F.collect_list(F.struct("at", "to", "to_block")).alias("s")
    packed = cut(packed.groupBy("ahead", "block").agg(steps).select("ahead", "block", "s.at", "s.to", "s.to_block"), "packed-links")
    every = seeds.join(blocks, "at").select("ahead", "block", "at", "core", F.lit(True).alias("fresh"))
    every, seen = cut_observed(every, "core-reach", fresh=F.count_if("fresh"))
    out = "ahead boolean, block long, at long, core int"

    def searched(arrived: DataFrame, inside: bool) -> DataFrame:
        came = arrived.groupBy("ahead", "block").agg(F.collect_list(F.struct("at", "core")).alias("c"))
        met = packed.join(came.select("ahead", "block", c("c.at").alias("came"), "c.core"), ["ahead", "block"])
        return met.mapInArrow(_spread(inside), out)

    while seen["fresh"]:
        active = every.where("fresh").select("ahead", "block").distinct()
        sent = searched(every.join(active, ["ahead", "block"], "left_semi"), False)
        merged = every.select("ahead", "block", "at", "core", c("core").alias("old")).unionByName(sent.withColumn("old", F.lit(0)))
        merged = merged.groupBy("ahead", "block", "at").agg(F.bit_or("core").alias("core"), F.bit_or("old").alias("old"))
        before = every
        every, seen = cut_observed(
            merged.select("ahead", "block", "at", "core", (c("core") != c("old")).alias("fresh")), "core-reach", fresh=F.count_if("fresh"))
        dropped(before)
    reached = searched(every, True).select("ahead", "core", "at")
    return reached.unionByName(seeds.select("ahead", "core", "at"))
