"""Shortest paths for many (from, to) pairs at once, and their polylines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbsight.functions import geo
from kerbsight.operators.network import Adjacency, adjacency
from kerbsight.operators.reach import can_reach, labels
from kerbsight.session import Buckets, cut


#: up to this many improved nodes, the sources that still move are broadcast
FEW_ROWS = 20_000
#: rows that rounds have written for a source that still moves, on average, beyond which targets that no way can reach are looked for at the latest
WIDE = 2_000
#: levels of one round
LEVELS = 8


def shortest_paths(pairs: DataFrame, edges: DataFrame, max_levels: int = 100_000,
                   net: Adjacency | None = None) -> DataFrame:
    """Node sequence of the shortest path per pair: ``src, dst, pos, node, length``.

    ``pairs`` holds ``src, dst`` nodes. Pairs without a path, or with equal ends, give
    no rows. Of equally long paths the one with fewer edges wins, then the one with
    the smallest node before each node, counted from the end.
    """
    net = net or adjacency(edges)
    wanted = pairs.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct()
    wanted = cut(wanted, "pairs")
    state, hops = _distances(wanted, net, max_levels, edges)
    return _walk_back(wanted, state, hops)


def _distances(wanted: DataFrame, net: Adjacency, max_levels: int, edges: DataFrame) -> tuple[DataFrame, int]:
    """Relax all sources together until no distance improves: the best row of every (src, node), and the most hops.

    Everything about a source lies in its bucket, so a round of several levels needs no shuffle while the network is small enough to
    broadcast; it reads the sources that still move, and appends the rows that it has improved. When the search grows wide, the
    network is labelled (:mod:`reach`): targets that a source cannot reach are put aside, as they would keep it unbounded, and nodes
    that lead to none of a source's targets spread no more.

    Target nodes are in the table from the start with an infinite distance. The largest target distance of a source bounds its search
    as soon as all of its targets are reached; nodes beyond the bound are not expanded.
    """
    c = F.col
    never = float("inf")
    targets = wanted.select("src", c("dst").alias("node"), F.lit(never).alias("dist"), F.lit(True).alias("target"))
    starts = wanted.select("src", c("src").alias("node"), F.lit(0.0).alias("dist"), F.lit(False).alias("target")).distinct()
    relax = _Relax(net)
    table = Buckets(wanted.sparkSession, "reach", ["src"], folders=("round",))
    first = targets.unionByName(starts).select(
        "src", "node", "dist", F.lit(0).alias("hops"), F.lit(None).cast("bigint").alias("pred"),
        (c("dist") == 0).alias("fresh"), "target", F.lit(0).alias("round"))
    seen = table.append(table.placed(first), fresh=F.count_if("fresh"))
    done, number, hops, wide, known, apart = 0, 0, 0, 0.0, None, None
    while seen["fresh"]:
        if done >= max_levels:
            raise RuntimeError(f"distances still improving after {max_levels} levels")
        levels = (LEVELS if number else LEVELS // 2) if net.small else 1  # most targets are near
        done, number, few = done + levels, number + 1, seen["fresh"] <= FEW_ROWS
        out = _round(table, relax, levels, number, few, known, apart)
        seen = table.append(
            out, fresh=F.count_if("fresh"), hops=F.max("hops"), rows=F.count(F.lit(1)),
            moving=F.approx_count_distinct(F.when(c("fresh"), c("src"))))
        hops, wide = max(hops, seen["hops"] or 0), wide + seen["rows"] / max(1, seen["moving"])
        if known is None and seen["fresh"] and wide > WIDE:
            known = cut(labels(edges), "reach-labels")
            apart = cut(_unreachable(table.table(), known), "reach-apart")
    every = table.close()
    best = every.groupBy("src", "node").agg(F.min(F.struct("dist", "hops", "pred")).alias("best"))
    return best.select("src", "node", "best.*"), hops


def _round(table: Buckets, relax: "_Relax", levels: int, number: int, few: bool, known: DataFrame | None, apart: DataFrame | None) -> DataFrame:
    """The rows that some levels improve."""
    c = F.col
    state = table.table()
    newest = c("round") == number - 1
    active = state.filter(newest & c("fresh")).select("src").distinct()
    state = state.join(F.broadcast(active) if few else active, "src", "left_semi")
    if apart is not None:
        state = state.join(apart.withColumn("apart", F.lit(True)), ["src", "node"], "left")
        state = state.filter(~(F.coalesce(c("apart"), F.lit(False)) & (c("dist") == float("inf")))).drop("apart")
    state = state.withColumn("fresh", c("fresh") & newest).groupBy("src", "node").agg(*relax.kept, F.bool_or("fresh").alias("moves"))
    state = state.select(*relax.result, F.lit(False).alias("changed"), c("moves")).withColumn("fresh", c("moves")).drop("moves")
    if known is not None:
        state = _useful(state, known)
    state = state.withColumn("bound", F.max(F.when(c("target"), c("dist"))).over(Window.partitionBy("src")))
    for _ in range(levels):
        state = relax.level(state)
    out = state.filter("changed").select("src", "node", "dist", "hops", "pred", "fresh", "target", F.lit(number).alias("round"))
    return out if relax.net.small and known is None else table.placed(out)


def _unreachable(state: DataFrame, known: DataFrame) -> DataFrame:
    """(src, node) of the targets that their source certainly cannot reach."""
    here, there = (known.select(F.col("node").alias(n), F.struct("after", "before").alias(f"{n}_label")) for n in ("src", "node"))
    asked = state.filter("target").select("src", "node").distinct().join(here, "src", "left").join(there, "node", "left")
    return asked.filter(~F.coalesce(can_reach(F.col("src_label"), F.col("node_label")), F.lit(False))).select("src", "node")


def _useful(state: DataFrame, known: DataFrame) -> DataFrame:
    """Rows from which no target of their source may be reached spread no more."""
    label = F.when(F.col("after").isNotNull(), F.struct("after", "before"))
    met = state.join(known, "node", "left")
    goals = met.filter("target").groupBy(F.col("src").alias("of")).agg(F.collect_set(label).alias("goals"))
    met = met.join(goals, F.col("src") == F.col("of"), "left")
    leads = F.exists("goals", lambda g: can_reach(label, g))
    return met.withColumn("fresh", F.col("fresh") & F.coalesce(leads, F.lit(False))).select(state.columns)


class _Relax:
    """Improved nodes offer a distance to their neighbours; the smallest offer stays."""

    def __init__(self, net: Adjacency):
        c = F.col
        self.net = net
        self.outs = net.joinable().withColumnRenamed("node", "at")

        def row(node: Column, dist: Column, hops: Column, pred: Column, fresh: Column, target: Column, changed: Column) -> Column:
            return F.struct(
                node.alias("node"), dist.alias("dist"), hops.alias("hops"), pred.alias("pred"), fresh.alias("fresh"),
                target.alias("target"), changed.alias("changed"),
            )

        old = row(c("node"), c("dist"), c("hops"), c("pred"), F.lit(False), c("target"), c("changed"))
        own = F.when(F.coalesce(c("chunk"), F.lit(0)) == 0, F.array(old)).otherwise(F.array())
        offers = F.coalesce(F.transform(
            "outs", lambda o: row(o["v"], c("dist") + o["length"], c("hops") + 1, c("node"), F.lit(True), F.lit(False), F.lit(True)),
        ), F.array())
        self.at = F.when(c("fresh") & (c("dist") < c("bound")), c("node"))
        self.old, self.offers, self.both = F.inline(F.array(old)), F.inline(offers), F.inline(F.concat(own, offers))
        self.kept = [
            F.min(F.struct("dist", "hops", "pred")).alias("best"),
            # False sorts before True: an offer that only equals the old value is not news
            F.min(F.struct("dist", "hops", "fresh")).alias("news"),
            F.bool_or("target").alias("target"),
        ]
        # a row that was there before this round and is as good stays unchanged
        self.change = F.min(F.struct("dist", "hops", "changed")).alias("change")
        self.result = ["src", "node", "best.dist", "best.hops", "best.pred", "news.fresh", "target"]

    def level(self, state: DataFrame) -> DataFrame:
        at = state.withColumn("at", self.at)
        if self.net.small:
            met = at.join(self.outs, "at", "left").select("src", "bound", self.both)
        else:
            # only rows that move meet the adjacency
            moved = at.filter("at is not null").join(self.outs, "at").select("src", "bound", self.offers)
            met = at.select("src", "bound", self.old).unionByName(moved)
        best = met.groupBy("src", "node").agg(*self.kept, self.change, F.first("bound").alias("bound"))
        return best.select(*self.result, F.col("change.changed").alias("changed"), "bound")


def _walk_back(wanted: DataFrame, state: DataFrame, hops: int) -> DataFrame:
    """All nodes of each path by pointer doubling: log2(hops) joins instead of one per edge."""
    c = F.col
    reached = state.filter((c("dist") < float("inf")) & (c("hops") > 0))
    ends = wanted.join(
        reached.select("src", c("node").alias("dst"), c("dist").alias("length"), c("hops").alias("last")), ["src", "dst"]
    )
    # one row per path position; ``back`` = steps from the end still to be walked
    rows = ends.withColumn("pos", F.explode(F.sequence(F.lit(0), c("last")))).select(
        "src", "dst", "pos", "length", (c("last") - c("pos")).alias("back"), c("dst").alias("node")
    )
    jump = reached.select("src", "node", c("pred").alias("to"))
    for bit in range(max(hops, 1).bit_length()):
        moved = c("back").bitwiseAND(F.lit(1 << bit)) != 0
        step = jump.select("src", c("node").alias("here"), "to")
        rows = (
            rows.withColumn("here", F.when(moved, c("node"))).join(step, ["src", "here"], "left")
            .withColumn("node", F.coalesce("to", "node")).drop("here", "to")
        )
        if 1 << (bit + 1) <= hops:
            half = jump.select("src", c("node").alias("to"), c("to").alias("far"))
            jump = cut(jump.join(half, ["src", "to"]).select("src", "node", c("far").alias("to")), "jump")
    return rows.select("src", "dst", "pos", "node", "length")


def path_lines(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """One polyline per (src, dst): ``geom`` with a single part of node coordinates."""
    at = nodes.select("node_id", "x", "y")
    return (
        paths.join(at, paths["node"] == at["node_id"])
        .groupBy("src", "dst")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("steps"), F.max("length").alias("length"))
        .filter(F.size("steps") > 1)
        .select(
            "src", "dst", "length",
            F.array(F.transform("steps", lambda s: geo.point(s["x"], s["y"]))).alias("geom"),
        )
    )
