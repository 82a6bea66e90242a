"""Spreading station counts over a directed network, level by level.

Both models are loops of DataFrame steps. A step joins the rows that still flow to
their node's out-edges and explodes the children; rows are independent of each
other, so the work spreads over all stations, directions and hours at once. Written
tables cut the lineage between jobs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbsight.functions import direction
from kerbsight.operators.network import Adjacency, adjacency
from kerbsight.session import Buckets, cut_observed, row_count


@dataclass(frozen=True)
class PathModel:
    """Parameters of the comfort-weighted model."""

    max_distance: float
    min_flow: float
    alpha: float
    max_arc: float
    exponent: float
    comfort: tuple


@dataclass(frozen=True)
class CarModel:
    """Parameters of the directional model."""

    max_distance: float = 5000.0
    min_flow: float = 5.0
    decay: float = 0.985
    max_arc: float = 135.0
    min_share: float = 0.01


# The models' default parameters.
BIKE = PathModel(3000.0, 5.0, 0.0015, 90.0, 2.0, direction.COMFORT_BIKE)
PED = PathModel(800.0, 3.0, 0.003, 120.0, 1.0, direction.COMFORT_PED)
CARS = CarModel()

#: with at most this many moving rows a job does several levels
FEW_ROWS = 20_000
#: levels of a round of the directional model, and the moving rows from which on a round has fewer of them
MANY_LEVELS, FEW_LEVELS, TAIL_ROWS = 3, 4, 3_000
KNOWN, BEST, ARRIVAL, CREDIT = 0, 1, 2, 3
#: seeds that go as one bundle, and the neighbouring seeds that bundles are made of
MEMBERS, SEED_BLOCK = 24, 4_096


# --------------------------------------------------------------- bike and pedestrian
def path_seeds(stations: DataFrame, edges: DataFrame, total: str, in_share: str, out_share: str) -> DataFrame:
    """Start rows on the station's edge and on the first edge of the way back.

    ``stations`` carries ``hour``, the snapped ``u, v, key``, the hourly count and its
    two shares. Stations without a positive count or without their edge start nothing.
    """
    known = edges.select("u", "v", "key", F.col("bearing").alias("_b"))
    here = stations.filter(F.col(total) > 0).join(known, ["u", "v", "key"])
    # first parallel edge of the opposite direction
    back = edges.groupBy("u", "v").agg(F.min_by(F.struct("key", "bearing"), "key").alias("_back"))
    forth = here.select(
        "hour", F.col("_b").alias("bearing"), "u", "v", "key", (F.col(total) * F.col(in_share)).alias("flow")
    )
    turned = here.select(
        "hour", F.col("v").alias("u"), F.col("u").alias("v"), (F.col(total) * F.col(out_share)).alias("flow")
    ).join(back, ["u", "v"])
    returning = turned.select(
        "hour", F.col("_back.bearing").alias("bearing"), "u", "v", F.col("_back.key").alias("key"), "flow"
    )
    return forth.unionByName(returning).filter(F.col("flow") > 0).withColumn("dist", F.lit(0.0))


def propagate_paths(seeds: DataFrame, edges: DataFrame, model: PathModel, max_levels: int = 10_000,
                    net: Adjacency | None = None) -> DataFrame:
    """Flow per ``u, v, key, hour`` of the comfort-weighted model.

    Every reached edge is credited the arriving flow. Arrivals are never merged: the
    thresholds apply to each path. Shares sum to one and flow only decays, so a seed
    has at most ``flow / min_flow`` live rows in a level.
    """
    net = net or adjacency(edges, model.comfort)
    step = _PathStep(net, model)
    may_flow = (F.col("dist") < model.max_distance) & (F.col("flow") >= model.min_flow)
    rows = seeds.select(*step.columns, may_flow.alias("live"))
    credits: list[DataFrame] = []
    # the hub branch reads a level's rows twice, so it may not be chained within a job
    done, levels = 0, 1 if net.many_chunks else 3
    while done < max_levels:
        for _ in range(levels):
            rows = step.apply(rows)
        done += levels
        rows, seen = cut_observed(rows, "paths", live=F.count_if(F.col("live")))
        credits.append(rows.filter(~F.col("live")))
        if not seen["live"]:
            break
        rows = rows.filter("live")
        # few rows left: more levels per job; many: write often, which also rebalances
        if not net.many_chunks:
            levels = 6 if seen["live"] <= FEW_ROWS else 3
    else:
        raise RuntimeError(f"flows still moving after {max_levels} levels")
    every = reduce(DataFrame.unionByName, credits)
    return every.groupBy("u", "v", "key", "hour").agg(F.sum("flow").alias("flow"))


def _sum(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w)


class _PathStep:
    """One level: live rows settle (credited, no longer live), followed by their children.

    The column expressions name columns only, so they are built once for all levels.
    """

    columns = ["hour", "bearing", "u", "v", "key", "dist", "flow"]

    def __init__(self, net: Adjacency, model: PathModel):
        c = F.col
        self.net = net

        def weight(o: Column) -> Column:
            w = direction.power_weight(c("bearing"), o["bearing"], model.max_arc, model.exponent) * o["comfort"]
            allowed = (o["length"] > 0) & (c("dist") + o["length"] <= model.max_distance)
            return F.when(F.coalesce(allowed, F.lit(False)), F.greatest(w, F.lit(0.0))).otherwise(0.0)

        def child(o: Column, i: Column) -> Column:
            arriving = direction.decay_per_metre(
                c("flow") * F.try_divide(F.get("ws", i), c("total")), o["length"], model.alpha
            )
            return F.struct(
                c("hour").alias("hour"), c("bearing").alias("bearing"), c("v").alias("u"), o["v"].alias("v"),
                o["key"].alias("key"), (c("dist") + o["length"]).alias("dist"), arriving.alias("flow"),
                ((F.get("ws", i) > 0) & (arriving >= model.min_flow)).alias("live"),
            )

        settled = F.struct(*[c(n).alias(n) for n in self.columns], F.lit(False).alias("live"))
        own = F.when(F.coalesce(c("chunk"), F.lit(0)) == 0, F.array(settled)).otherwise(F.array())
        onward = F.filter(F.transform("outs", child), lambda r: F.coalesce(r["live"], F.lit(False)))
        self.outs = net.joinable().withColumnRenamed("node", "at")
        # settled rows meet nothing; without a node of their own they would all lie in one task
        self.node = F.when(c("live"), c("v")).otherwise(F.xxhash64(*self.columns))
        self.weights = F.transform("outs", weight)
        self.partial = _sum(self.weights)
        self.total = _sum(c("ws"))
        self.emitted = F.explode(F.concat(own, F.coalesce(onward, F.array()))).alias("r")
        # a child at the distance limit is credited and goes no further
        self.live = c("live") & (c("dist") < model.max_distance)

    def apply(self, rows: DataFrame) -> DataFrame:
        c = F.col
        at = rows.withColumn("node", self.node)
        if self.net.many_chunks:
            totals = (
                at.filter("live").select("node", "bearing", "dist").distinct()
                .join(self.net.joinable(), "node").withColumn("part", self.partial)
                .groupBy("node", "bearing", "dist").agg(F.sum("part").alias("total"))
                .withColumnsRenamed({"node": "tn", "bearing": "tb", "dist": "td"})
            )
            at = at.join(
                totals, (c("node") == c("tn")) & c("bearing").eqNullSafe(c("tb")) & (c("dist") == c("td")), "left"
            ).drop("tn", "tb", "td")
        met = at.join(self.outs, c("live") & (c("node") == c("at")), "left").withColumn("ws", self.weights)
        if not self.net.many_chunks:
            met = met.withColumn("total", self.total)
        return met.select(self.emitted).select(*[c(f"r.{n}") for n in self.columns], c("r.live").alias("live")).withColumn(
            "live", self.live
        )


# ---------------------------------------------------------------------------- cars
def propagate_cars(seeds: DataFrame, edges: DataFrame, model: CarModel = CARS, max_levels: int = 10_000,
                   net: Adjacency | None = None) -> DataFrame:
    """Undamped flow per ``u, v, key, hour`` of the directional model.

    ``seeds`` carries ``seed`` (unique), ``hour``, ``bearing``, ``node`` and ``flow``.
    A node is expanded again only by a strictly shorter arrival. Which arrival counts
    as earlier is first-in-first-out order: level by level and, within a level, by the
    path of edge positions. The path is kept as fixed-width text, so text order is
    arrival order and one window per (bundle, node) reproduces the queue exactly.

    Seeds with the same start and bearing, the hours of a station, take the same paths: they go as one bundle, a row with the flow of
    each member and bits for the members that it still concerns. Distances are judged member by member.

    A bundle's rows are of no concern to other bundles, so everything lies in buckets by bundle and a level needs no shuffle while the
    network is small enough to broadcast. The distances that a bundle has found so far are a table beside the frontier: a round
    appends the distances that it has improved, and the arrivals and credits that it has made, and writes nothing again.
    """
    net = net or adjacency(edges)
    step = _CarStep(net, model)
    c = F.col
    rows = Buckets(seeds.sparkSession, "cars", ["bundle"], folders=("kind", "round"))
    moving = rows.append(rows.placed(_bundles(seeds, model)), moving=row_count())["moving"]
    done, last = 0, 0
    while moving and done < max_levels:
        few = moving <= FEW_ROWS
        levels = 1 if net.many_chunks or not net.small else (FEW_LEVELS if moving <= TAIL_ROWS else MANY_LEVELS)
        done, last = done + levels, last + 1
        moving = rows.append(_car_round(rows, step, levels, last, few), moving=F.count_if(c("kind") == ARRIVAL))["moving"]
    every = rows.close()
    if moving:
        raise RuntimeError(f"flows still moving after {max_levels} levels")
    credited = every.filter(c("u").isNotNull()).select("u", "node", "key", "credited", F.posexplode(F.arrays_zip("hours", "flows")).alias("member", "m"))
    credited = credited.filter(F.get(_bits(), c("member")).bitwiseAND(c("credited")) != 0).select("u", "node", "key", c("m.hours").alias("hour"), c("m.flows").alias("flow"))
    return credited.groupBy("u", c("node").alias("v"), "key", "hour").agg(F.sum("flow").alias("total_flow"))


def _bits() -> Column:
    """The bit of each member of a bundle."""
    return F.array(*[F.lit(1 << i).cast("bigint") for i in range(MEMBERS)])


def _bundles(seeds: DataFrame, model: CarModel) -> DataFrame:
    """The first arrivals: one row for at most ``MEMBERS`` seeds of the same start and bearing, the largest flow first.

    Members are numbered among ``SEED_BLOCK`` neighbouring seeds, so that a crowded start is no single task."""
    c = F.col
    starts = seeds.filter(c("flow").isNotNull() & c("bearing").isNotNull()).select(
        "seed", c("hour").cast("int").alias("hour"), "bearing", "node", c("flow").cast("double").alias("flow"),
        F.floor(c("seed").try_cast("bigint") / SEED_BLOCK).alias("block"),
    ).filter((F.lit(0.0) <= model.max_distance) & (c("flow") >= model.min_flow) & (c("flow") > 0))
    place = F.row_number().over(Window.partitionBy("bearing", "node", "block").orderBy("seed")) - 1
    members = F.sort_array(F.collect_list(F.struct("flow", "seed", "hour")), asc=False)
    bundles = starts.withColumn("part", F.floor(place / MEMBERS)).groupBy("bearing", "node", "block", "part").agg(members.alias("m"))
    everyone = F.aggregate(F.slice(_bits(), F.lit(1), F.size("m")), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    return bundles.select(
        F.array_min("m.seed").alias("bundle"), c("m.hour").alias("hours"), "bearing", F.lit(ARRIVAL).alias("kind"), "node",
        F.lit(0.0).alias("dist"), c("m.flow").alias("flows"), F.lit(1.0).alias("decay"), everyone.alias("alive"),
        F.lit(0).cast("bigint").alias("credited"), F.lit("").alias("path"), F.lit(None).cast("bigint").alias("u"),
        F.lit(None).cast("int").alias("key"), F.lit(0).alias("round"),
    )


def _car_round(rows: Buckets, step: "_CarStep", levels: int, number: int, few: bool) -> DataFrame:
    """What some levels add: arrivals to be judged next, improved distances, and credits."""
    c = F.col
    table = rows.table()
    arrives = (c("kind") == ARRIVAL) & (c("round") == number - 1)
    at = table.filter((c("kind") == BEST) | arrives)
    if few:
        # bundles at rest need their node distances no more
        at = at.join(F.broadcast(table.filter(arrives).select("bundle").distinct()), "bundle", "left_semi")
    # arrivals were credited by the round that made them
    at = at.withColumns({"u": F.lit(None).cast("bigint"), "kind": F.when(c("kind") == BEST, KNOWN).otherwise(c("kind"))}).drop("round")
    for _ in range(levels):
        at = step.apply(at)
    # children that go no further are judged in vain within a round, and kept as credits
    kind = F.when((c("kind") == ARRIVAL) & (c("alive") == 0), CREDIT).otherwise(c("kind"))
    at = at.filter(c("kind") != KNOWN).withColumns({"kind": kind, "round": F.lit(number)})
    return at if step.net.small and not step.net.many_chunks else rows.placed(at)


class _CarStep:
    """One level: arrivals nearer than all before them go on, and emit their children.

    Rows are of four kinds: ``KNOWN`` (a distance that is in the table), ``BEST`` (one that is not yet), ``ARRIVAL`` (to be judged in
    this level) and ``CREDIT`` (only a flow to be counted). ``flows`` has what each member brings onto the edge, ``decay`` what is left
    of it at its end; ``alive`` and ``credited`` are bits of the members that arrive (or have found a distance) and are counted.
    ``bundle``, ``hours`` and ``bearing`` pass through as they are, so that Spark knows that the rows of a bundle stay where they are.
    """

    bundle = ["bundle", "hours", "bearing"]

    def __init__(self, net: Adjacency, model: CarModel):
        c = F.col
        self.net = net
        none = F.lit(0).cast("bigint")
        before = Window.partitionBy("bundle", "node").orderBy("kind", "path").rowsBetween(Window.unboundedPreceding, -1)
        self.outs = net.joinable().withColumnRenamed("node", "at")
        has = [c("alive").bitwiseAND(F.lit(1 << i)) != 0 for i in range(MEMBERS)]
        self.earlier = {f"e{i}": F.min(F.when(h, c("dist"))).over(before) for i, h in enumerate(has)}
        nearer = [F.when(h & (c(f"e{i}").isNull() | (c("dist") < c(f"e{i}"))), F.lit(1 << i)).otherwise(0) for i, h in enumerate(has)]
        self.goes = F.when(c("kind") == ARRIVAL, reduce(Column.bitwiseOR, nearer)).otherwise(0).cast("bigint")
        found = c("kind") < ARRIVAL
        goes = c("goes") != 0
        credited = ~found & c("u").isNotNull()
        self.matters = goes | found | credited

        def weight(o: Column) -> Column:
            w = direction.linear_weight(c("bearing"), o["bearing"], model.max_arc)
            return F.when(w >= model.min_share, w).otherwise(0.0)

        def row(kind: Column, node: Column, dist: Column, flows: Column, decay: Column, alive: Column, paid: Column, path: Column, u: Column, key: Column, share: Column) -> Column:
            return F.struct(
                kind.alias("kind"), node.alias("node"), dist.alias("dist"), flows.alias("flows"), decay.alias("decay"),
                alive.alias("alive"), paid.alias("credited"), path.alias("path"), u.alias("u"), key.alias("key"), share.alias("share"),
            )

        nothing, no_node, no_key = F.lit(None).cast("double"), F.lit(None).cast("bigint"), F.lit(None).cast("int")
        no_flows = F.lit(None).cast("array<double>")

        def child(o: Column, i: Column) -> Column:
            length = F.coalesce(o["length"], F.lit(0.0))
            position = F.lpad(F.lower(F.hex(o["ord"])), net.ord_digits, "0")
            return row(
                F.lit(ARRIVAL), o["v"], c("dist") + length, c("flows"), direction.decay_per_100m(F.lit(1.0), length, model.decay),
                none, c("goes"), F.concat(c("path"), position), c("node"), o["key"].cast("int"),
                F.try_divide(F.get("ws", i), c("total")),
            )

        # a distance that was found stays, and an arrival that goes on has found one
        state = row(F.when(found, c("kind")).otherwise(BEST), c("node"), c("dist"), no_flows, nothing,
                    F.when(found, c("alive")).otherwise(c("goes")), none, F.lit(""), no_node, no_key, nothing)
        counted = row(F.lit(CREDIT), c("node"), nothing, c("flows"), nothing, none, c("credited"), F.lit(""), c("u"), c("key"), nothing)
        once = F.coalesce(c("chunk"), F.lit(0)) == 0
        kept = F.concat(
            F.when(found | goes, F.array(state)).otherwise(F.array()),
            F.when(credited, F.array(counted)).otherwise(F.array()),
        )
        onward = F.coalesce(F.filter(F.transform("outs", child), lambda r: r["share"] > 0), F.array())
        self.at = F.when(goes, c("node"))
        self.weights = F.transform("outs", weight)
        self.partial = _sum(self.weights)
        self.total = _sum(c("ws"))
        self.kept, self.onward = F.inline(kept), F.inline(onward)
        own = F.when(once, kept).otherwise(F.array())
        self.emitted = F.inline(F.concat(own, F.when(goes, onward).otherwise(F.array())))

        # a child comes with the flows of the row that it comes from; those of all members fall alike, so the first ones go on
        new = c("share").isNotNull()
        self.flows = F.when(new, F.transform("flows", lambda f: f * c("spent") * c("share"))).otherwise(c("flows"))
        going = F.when(c("dist") <= model.max_distance, F.size(F.filter("flows", lambda f: f * c("decay") >= model.min_flow)))
        first = F.get(F.array(*[F.lit((1 << i) - 1).cast("bigint") for i in range(MEMBERS + 1)]), going)
        self.alive = F.when(new, F.coalesce(first, none).bitwiseAND(c("credited"))).otherwise(c("alive"))

    def apply(self, rows: DataFrame) -> DataFrame:
        judged = rows.withColumns(self.earlier).withColumn("goes", self.goes).filter(self.matters).withColumn("at", self.at)
        judged = judged.drop(*self.earlier)
        if self.net.many_chunks:
            totals = (
                judged.filter("goes != 0").select("at", "bearing").distinct()
                .join(self.outs, "at").withColumn("part", self.partial)
                .groupBy("at", "bearing").agg(F.sum("part").alias("total"))
            )
            judged = judged.join(totals, ["at", "bearing"], "left")
        if not self.net.small:
            # only arrivals that go on meet the adjacency; other rows have no node and would all meet in one task
            met = self._weighed(judged.filter("goes != 0").join(self.outs, "at"))
            return judged.select(*self.bundle, self.kept).drop("share").unionByName(self._children(met, self.onward))
        return self._children(self._weighed(judged.join(self.outs, "at", "left")), self.emitted)

    def _weighed(self, met: DataFrame) -> DataFrame:
        met = met.withColumn("ws", self.weights)
        return met if self.net.many_chunks else met.withColumn("total", self.total)

    def _children(self, met: DataFrame, emitted: Column) -> DataFrame:
        rows = met.withColumnRenamed("decay", "spent").select(*self.bundle, "spent", emitted)
        rows = rows.withColumn("flows", self.flows).withColumn("alive", self.alive)
        return rows.drop("spent", "share")


def mass_balance(flows: DataFrame, seeds: DataFrame, flow: str = "total_flow", seed_flow: str = "flow") -> DataFrame:
    """Scale each hour so that its edge flows sum to its seed flows (unless they sum to 0)."""
    have = flows.groupBy("hour").agg(F.sum(flow).alias("_have"))
    want = seeds.groupBy("hour").agg(F.sum(seed_flow).alias("_want"))
    # one row per hour of the day on both sides
    scale = have.join(F.broadcast(want), "hour").select(
        "hour", F.when(F.col("_have") > 0, F.col("_want") / F.col("_have")).alias("_scale")
    )
    return (
        flows.join(F.broadcast(scale), "hour", "left")
        .withColumn(flow, F.col(flow) * F.coalesce("_scale", F.lit(1.0)))
        .drop("_scale")
    )


def normalize_per_hour(flows: DataFrame, flow: str = "total_flow", name: str = "flow_norm") -> DataFrame:
    """Flow divided by the hour's largest flow, 0 where that is not positive."""
    top = flows.groupBy("hour").agg(F.max(flow).alias("_top"))
    share = F.when(F.col("_top") > 0, F.col(flow) / F.col("_top")).otherwise(0.0)
    return flows.join(F.broadcast(top), "hour").withColumn(name, share).drop("_top")


def normalize_overall(flows: DataFrame, flow: str = "flow", name: str = "flow_norm") -> DataFrame:
    """Flow divided by the largest flow of the whole table, 0 where that is not positive."""
    top = flows.agg(F.max(flow)).scalar()
    return flows.withColumn("_top", top).withColumn(
        name, F.when(F.col("_top") > 0, F.col(flow) / F.col("_top")).otherwise(0.0)
    ).drop("_top")
