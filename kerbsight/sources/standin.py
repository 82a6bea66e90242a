"""Mobility-shaped tables derived from the generic star-schema tables.

The engine's inputs (road network, counts, transit runs, frontages, gold flows)
are projected from the whole driver tables, so their size grows with them. The
definitions are in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.session import cut

GRID = 40

#: the corner of the crowded square metre
CROWD = (2676100.0, 1241100.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def net_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    at_col, at_row = c("c_custkey") % GRID, F.floor(c("c_custkey") / GRID)
    return table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("node_id"),
        at_col.alias("gx"), at_row.alias("gy"),
        (2676000 + 100 * at_col + 3 * (c("c_nationkey") % 7)).cast("double").alias("x"),
        (1241000 + 100 * at_row + 2 * (c("c_nationkey") % 5)).cast("double").alias("y"),
        (c("c_acctbal") < 0).alias("one_way"),
        (c("c_mktsegment") == "BUILDING").alias("doubled"),
    )


def crowded_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The network and one short segment for every order, all within one square metre."""
    k = F.col("o_orderkey")

    def at(corner: float, factor: int) -> Column:
        return F.lit(corner) + (k * factor % 10007) / 10007.0

    ends = [geo.point(at(CROWD[0], 7), at(CROWD[1], 13)), geo.point(at(CROWD[0], 17), at(CROWD[1], 29))]
    crowd = table(spark, sf_dir, "orders").select(
        (-k).alias("u"), F.lit(-1).cast("bigint").alias("v"), F.lit(0).alias("key"), F.array(F.array(*ends)).alias("geom"))
    return net_edges(spark, sf_dir).select("u", "v", "key", "geom").unionByName(crowd)


def net_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions of every grid step; some one-way, some doubled, some bent."""
    nodes = net_nodes(spark, sf_dir)
    # a table of one small file is read by one task; what comes of it is larger
    a = nodes.repartition("node_id").select(
        F.col("node_id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), "one_way", "doubled",
        F.explode(F.array(
            F.struct((F.col("gx") + 1).alias("gx"), F.col("gy").alias("gy")),
            F.struct(F.col("gx").alias("gx"), (F.col("gy") + 1).alias("gy")),
        )).alias("to"),
    ).select("a", "ax", "ay", "one_way", "doubled", "to.gx", "to.gy")
    b = nodes.select("gx", "gy", F.col("node_id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    step = a.join(b, ["gx", "gy"])
    there = F.struct(F.col("a").alias("u"), F.col("b").alias("v"), F.lit(0).alias("key"),
                     F.col("ax").alias("x1"), F.col("ay").alias("y1"), F.col("bx").alias("x2"), F.col("by").alias("y2"))
    twin = there.withField("key", F.lit(1))
    back = F.struct(F.col("b").alias("u"), F.col("a").alias("v"), F.lit(0).alias("key"),
                    F.col("bx").alias("x1"), F.col("by").alias("y1"), F.col("ax").alias("x2"), F.col("ay").alias("y2"))
    ways = F.concat(
        F.array(there),
        F.when(~F.col("one_way"), F.array(back)).otherwise(F.array()),
        F.when(F.col("doubled"), F.array(twin)).otherwise(F.array()),
    )
    e = step.select(F.explode(ways).alias("e")).select("e.*")
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    both = F.col("u") + F.col("v")
    bent = both % 4 == 0
    mx, my = (x1 + x2) / 2 + 7, (y1 + y2) / 2 + 5

    def dist(p: Column, q: Column, r: Column, s: Column) -> Column:
        return F.sqrt((r - p) * (r - p) + (s - q) * (s - q))

    angle = F.degrees(F.atan2(x2 - x1, y2 - y1))
    kinds = ["cycleway", "residential", "primary", "footway", "pedestrian", "service", "path;secondary"]
    return e.select(
        "u", "v", "key", "x1", "y1", "x2", "y2",
        F.when(bent, dist(x1, y1, mx, my) + dist(mx, my, x2, y2)).otherwise(dist(x1, y1, x2, y2)).alias("length"),
        F.when(both % 53 == 0, F.lit(None).cast("double")).when(angle < 0, angle + 360.0).otherwise(angle).alias("bearing"),
        F.split(F.element_at(F.array(*[F.lit(k) for k in kinds]), (both % 7 + 1).cast("int")), ";").alias("highway"),
        F.concat(F.lit("Street "), (F.col("u") % 17).cast("string")).alias("name"),
        F.array(F.when(bent, F.array(geo.point(x1, y1), geo.point(mx, my), geo.point(x2, y2)))
                 .otherwise(F.array(geo.point(x1, y1), geo.point(x2, y2)))).alias("geom"),
    )


def counts_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    s = F.floor(c("user_id") / 10)
    text = F.concat
    return table(spark, sf_dir, "events").select(
        c("event_id").alias("id"),
        F.when(c("event_id") % 401 == 0, "kaputt")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("messung_dat_zeit"),
        text(F.lit("Z"), s.cast("string")).alias("msid"),
        text(F.lit("Station "), s.cast("string")).alias("msname"),
        text(F.lit("Z"), (s % 12).cast("string")).alias("zsname"),
        text(F.lit("Axis "), (s % 7).cast("string")).alias("achse"),
        F.when(c("event_type") == "view", " Einwärts").when(c("event_type") == "click", "auswaerts")
        .when(c("event_type") == "signup", "Oerlikon").when(c("event_type") == "purchase", "Höngg")
        .when(c("event_id") % 5 == 0, F.lit(None)).otherwise("unbekannt").alias("richtung"),
        F.when(c("event_id") % 97 == 0, "n/a").otherwise(F.floor(c("value") * 10).cast("string")).alias("anz_fahrzeuge"),
        F.when(c("event_id") % 211 != 0, (2676010 + (s * 211) % 3900).cast("string")).alias("ekoord"),
        (1241005 + s * 240 + (s * 53) % 97).cast("string").alias("nkoord"),
    )


def counts_pedbike(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    s = F.floor(c("user_id") / 6)
    kind, value = c("event_type"), c("value")

    def text(x: Column) -> Column:
        return x.cast("bigint").cast("string")

    return table(spark, sf_dir, "events").select(
        c("event_id").alias("id"),
        s.alias("fk_standort"),
        F.when(c("event_id") % 401 == 0, "kaputt").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias("datum"),
        F.when(kind.isin("view", "signup"), text(F.floor(value * 4))).otherwise("0").alias("velo_in"),
        F.when(kind == "click", text(F.floor(value * 5))).when(c("event_id") % 13 != 0, "0").alias("velo_out"),
        F.when(s % 25 == 3, "0").when(kind == "purchase", text(F.floor(value * 3))).otherwise("1").alias("fuss_in"),
        F.when(s % 25 == 3, "0").when(kind == "error", text(F.floor(value * 2))).otherwise("0").alias("fuss_out"),
        F.when(c("event_id") % 7 != 0, (2676010 + (s * 151) % 3900).cast("string")).alias("ost"),
        F.when(c("event_id") % 7 != 0, (1241005 + s * 145 + (s * 47) % 90).cast("string")).alias("nord"),
    )


def transit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    hour = c("l_partkey") % 26
    return table(spark, sf_dir, "lineitem").select(
        c("l_suppkey").alias("haltestellen_id"),
        F.when(c("l_linenumber") != 7, c("l_suppkey") + 1 + c("l_linenumber") % 3).alias("nach_hst_id"),
        c("l_orderkey").alias("plan_fahrt_id"),
        (c("l_linenumber") % 5).alias("tagtyp_id"),
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":15:00")).alias("fz_ab"),
        F.when(c("l_orderkey") % 89 != 0, c("l_quantity").cast("bigint").cast("string")).alias("besetzung"),
    )


def day_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        c.alias("tagtyp_id"),
        F.when(c == 0, "Mo-Fr 15-A1-24").when(c == 1, "15-a1-24 alt").when(c == 2, "Samstag")
        .when(c == 3, "Sonntag").alias("tagtypname"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    suffix = (
        F.when(c("s_nationkey") % 3 == 0, " (Stadt Zürich)").when(c("s_nationkey") % 3 == 1, " (Zürich)").otherwise(" ")
    )
    return table(spark, sf_dir, "supplier").select(
        c("s_suppkey").alias("haltestellen_id"), F.concat("s_name", suffix).alias("haltestellenlangname")
    )


def gtfs_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two platforms per stop; every tenth stop has another name there."""
    c = F.col
    name = F.when(c("s_suppkey") % 10 == 9, F.concat(F.lit("depot "), F.lower("s_name"))).otherwise(F.lower("s_name"))
    return table(spark, sf_dir, "supplier").select(
        name.alias("stop_name"), "s_suppkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("n")
    ).select(
        "stop_name",
        (47.3154 + 0.0009 * F.floor(c("s_suppkey") / GRID) + 0.00002 * c("n")).alias("stop_lat"),
        (8.4438 + 0.00132 * (c("s_suppkey") % GRID)).alias("stop_lon"),
    )


def frontages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One or two wall lines per frontage, some without length, three per building."""
    c = F.col
    p = c("p_partkey")
    length = F.when(p % 101 == 0, 0).otherwise(c("p_size")).cast("double")
    x0 = (2676000 + 100 * (p % GRID) + (p * 37) % 100).cast("double")
    y0 = (1241000 + 75 * F.floor(p / GRID) + (p * 53) % 75).cast("double")

    def wall(x: Column, y: Column) -> Column:
        dx = F.when(p % 4 == 0, length).when(p % 4 == 2, -length).otherwise(0.0)
        dy = F.when(p % 4 == 1, length).when(p % 4 == 3, -length).otherwise(0.0)
        return F.array(geo.point(x, y), geo.point(x + dx, y + dy))

    # as for the network; written, because the planner would move the filters of later steps back into the one reading task
    rows = cut(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name").repartition("p_partkey"), "frontages")
    return rows.select(
        p.alias("objectid"), F.floor(p / 3).alias("gwr_egid"), c("p_name").alias("bezeichnung"),
        F.when(p % 5 == 0, F.array(wall(x0, y0), wall(x0 + 12, y0 + 180))).otherwise(F.array(wall(x0, y0))).alias("geom"),
    )


# flows of an edge table with ``u, v, key`` and, where it has one, ``edge_id``
def _hourly(edges: DataFrame, hours: list[int]) -> DataFrame:
    return edges.withColumn("hour", F.explode(F.array(*[F.lit(h) for h in hours])))


def flows_bike(edges: DataFrame) -> DataFrame:
    u, v, h = F.col("u"), F.col("v"), F.col("hour")
    flow = (
        F.when((u + h) % 19 == 0, F.lit(None))
        .when((u + v) % 3 == 0, (u * 7 + v * 3 + h) % 200).otherwise(0).cast("double")
    )
    return _hourly(edges, [7, 8, 17]).withColumn("flow", flow)


def flows_ped(edges: DataFrame) -> DataFrame:
    u, v, h = F.col("u"), F.col("v"), F.col("hour")
    flow = F.when((u + v) % 7 == 0, (u * 5 + v + h) % 90).otherwise(0).cast("double")
    return _hourly(edges, [12, 17]).withColumn("flow", flow)


def flows_cars(edges: DataFrame) -> DataFrame:
    u, v, h = F.col("u"), F.col("v"), F.col("hour")
    flow = F.when((F.col("key") == 0) & ((u + v) % 2 == 1), (u * 11 + v * 2 + h * 13) % 900).otherwise(0).cast("double") / 4
    return _hourly(edges, [6, 8, 13, 18]).withColumn("total_flow", flow)


def flows_transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = net_nodes(spark, sf_dir)
    a = nodes.repartition("node_id").select(
        F.col("node_id").alias("a"), (F.col("node_id") + 2).alias("b"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = nodes.select(F.col("node_id").alias("b"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return _hourly(a.join(b, "b"), [8, 17]).select(
        F.col("a").cast("string").alias("haltestellen_id"), F.col("b").cast("string").alias("nach_hst_id"), "hour",
        ((F.col("a") + F.col("hour")) % 120).cast("double").alias("flow_besetzung"),
        (F.col("a") % 9).cast("int").alias("n_runs"),
        F.array(F.array(geo.point(F.col("x1"), F.col("y1")), geo.point(F.col("x2"), F.col("y2")))).alias("geom"),
    )
