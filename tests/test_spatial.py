"""Grid joins against brute force, also with crowded cells."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.operators import nearest
from kerbsight.operators.impressions import sight_areas
from kerbsight.operators.nearest import nearest_edges, nearest_nodes
from kerbsight.operators.spatial_join import meets
from kerbsight.sources import standin

LINES = "k int, geom array<array<struct<x:double,y:double>>>"


def part(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def make(spark, seed, walls=60, roads=60, span=400.0, crowd=0):
    rng = random.Random(seed)
    fronts, lines = [], []
    for i in range(walls):
        x, y = rng.uniform(0, span), rng.uniform(-span, span)
        parts = [part((x, y), (x + rng.uniform(-30, 30), y + rng.uniform(-30, 30)))]
        if i % 4 == 0:
            parts.append(part((x + 5, y), (x + 25, y + 9)))
        fronts.append((i, parts))
    for i in range(roads):
        p = [(rng.uniform(0, span), rng.uniform(-span, span)) for _ in range(rng.choice([2, 3]))]
        lines.append((i, [part(*p)]))
    for i in range(crowd):
        x, y = 20 + rng.uniform(0, 20), 20 + rng.uniform(0, 20)
        lines.append((roads + i, [part((x, y), (x + rng.uniform(-8, 8), y + rng.uniform(-8, 8)))]))
    areas = sight_areas(spark.createDataFrame(fronts, LINES).withColumnRenamed("k", "objectid"))
    return areas, spark.createDataFrame(lines, LINES)


def brute(areas, lines):
    quads = areas.select("objectid", F.explode("rings").alias("q"))
    segs = lines.select("k", F.explode(geo.geom_segments(F.col("geom"))).alias("s"))
    q = [(F.element_at("q", i)["x"], F.element_at("q", i)["y"]) for i in range(1, 5)]
    both = quads.crossJoin(segs).filter(
        geo.quad_meets_segment(q, F.col("s.x1"), F.col("s.y1"), F.col("s.x2"), F.col("s.y2"))
    )
    return {tuple(r) for r in both.select("objectid", "k").distinct().collect()}


@pytest.mark.parametrize("seed,crowd,hot_rows", [(1, 0, 4096), (2, 0, 3), (3, 120, 20), (4, 120, 2)])
def test_meets_equals_brute_force(spark, seed, crowd, hot_rows):
    areas, lines = make(spark, seed, crowd=crowd)
    found = [tuple(r) for r in meets(areas, ["objectid"], lines, ["k"], hot_rows=hot_rows).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(areas, lines)


def test_meets_ignores_the_partitioning(spark):
    areas, lines = make(spark, 7, crowd=40)
    first = set(map(tuple, meets(areas, ["objectid"], lines, ["k"]).collect()))
    second = set(map(tuple, meets(areas.repartition(5), ["objectid"], lines.repartition(3), ["k"], cell=20.0).collect()))
    assert first == second


def distance(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = 0.0 if dx == dy == 0 else max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def network(rng, n, span):
    rows = []
    for i in range(n):
        a, b = [(rng.uniform(0, span), rng.uniform(0, span)) for _ in range(2)]
        rows += [(i, i + 1, 0, a, b), (i + 1, i, 0, b, a)]
    return rows


@pytest.mark.parametrize("span", [300.0, 9000.0])
def test_nearest_edges_equal_brute_force(spark, span):
    rng = random.Random(11)
    rows = network(rng, 40, span)
    edges = spark.createDataFrame(
        [(u, v, k, [part(a, b)]) for u, v, k, a, b in rows], "u long, v long, key int, geom array<array<struct<x:double,y:double>>>"
    )
    points = [(i, rng.uniform(-span / 2, span * 1.5), rng.uniform(-span / 2, span * 1.5)) for i in range(30)]
    points += [(100, points[0][1], points[0][2]), (101, None, 1.0)]
    df = spark.createDataFrame(points, "id long, px double, py double")
    one = {r["id"]: (r["u"], r["v"], r["key"], r["dist"]) for r in nearest_edges(df, ["id"], edges, ties=False).collect()}
    ties = {}
    for r in nearest_edges(df, ["id"], edges, ties=True).collect():
        ties.setdefault(r["id"], set()).add((r["u"], r["v"], r["key"]))
    assert 101 not in one and set(one) == set(ties) == {p[0] for p in points if p[0] != 101}
    for i, x, y in points:
        if x is None:
            continue
        best = min(distance((x, y), a, b) for *_, a, b in rows)
        near = {(u, v, k) for u, v, k, a, b in rows if distance((x, y), a, b) < best + 1e-7}
        assert ties[i] == near and len(near) >= 2
        assert one[i][:3] == min(near) and one[i][3] == pytest.approx(best, abs=1e-4)


def test_nearest_edges_with_crowded_cells_and_copies(spark):
    rng = random.Random(4)
    rows = network(rng, 60, 12.0) + [(1000 + i, 2000 + i, 0, (3.0, 3.0), (9.0, 3.0)) for i in range(50)]
    edges = spark.createDataFrame(
        [(u, v, k, [part(a, b)]) for u, v, k, a, b in rows], "u long, v long, key int, geom array<array<struct<x:double,y:double>>>"
    )
    df = spark.createDataFrame([(i, rng.uniform(0, 12), rng.uniform(0, 12)) for i in range(20)] + [(99, 5.0, 3.0)], "id long, px double, py double")
    crowded = nearest_edges(df, ["id"], edges, hot_rows=5)
    plain = nearest_edges(df, ["id"], edges)
    assert sorted(map(tuple, crowded.collect())) == sorted(map(tuple, plain.collect()))
    assert plain.filter("id = 99").count() == 50


def test_nearest_node_takes_the_smallest_on_a_tie(spark):
    nodes = spark.createDataFrame([(5, 0.0, 0.0), (3, 10.0, 0.0), (9, 5000.0, 5000.0)], "node_id long, x double, y double")
    points = spark.createDataFrame([(1, 5.0, 0.0), (2, 4000.0, 4000.0)], "id long, px double, py double")
    assert {(r["id"], r["node_id"]) for r in nearest_nodes(points, ["id"], nodes).collect()} == {(1, 3), (2, 9)}


def test_a_point_without_any_network_is_an_error(spark):
    edges = spark.createDataFrame([], "u long, v long, key int, geom array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, 5.0, 0.0)], "id long, px double, py double")
    with pytest.raises(ValueError):
        nearest_edges(points, ["id"], edges)


def test_a_crowded_square_metre_does_not_shrink_the_grid(spark):
    """6,000 segments in one square metre next to a plain network of 4,000."""
    plain = [(i, 0, 0, 100.0 * (i % 60), 100.0 * (i // 60), 100.0 * (i % 60) + 100, 100.0 * (i // 60)) for i in range(4000)]
    crowd = [(10_000 + i, 0, 0, 50 + i * 7 % 6007 / 6007, 50 + i * 13 % 6007 / 6007, 50 + i * 17 % 6007 / 6007, 50 + i * 29 % 6007 / 6007) for i in range(6000)]

    def pieces(rows):
        df = spark.createDataFrame(rows, "u long, v long, key int, sx1 double, sy1 double, sx2 double, sy2 double")
        unique = df.groupBy("sx1", "sy1", "sx2", "sy2").agg(F.min(F.struct("u", "v", "key")).alias("line"))
        return nearest._pieces_and_cells(unique, 32.0, 1024)

    alone, _, cell = pieces(plain)
    both, occupied, same = pieces(plain + crowd)
    assert cell == same == 32.0 and both.count() <= 2 * (alone.count() + 6000)
    assert occupied.agg(F.max("shares")).first()[0] > 1
    assert both.groupBy("cx", "cy", "share").count().agg(F.max("count")).first()[0] <= 2 * 1024


def test_meets_broadcasts_no_exploded_side(spark, tmp_path):
    """Small files say nothing about the rows that their geometries explode to."""
    areas, lines = make(spark, 5)
    areas.write.parquet(f"{tmp_path}/areas")
    found = meets(spark.read.parquet(f"{tmp_path}/areas"), ["objectid"], lines, ["k"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {tuple(r) for r in found.collect()} == brute(areas, lines)


def test_meets_stays_within_what_the_jvm_compiles(spark):
    """The JVM runs methods beyond 8,000 bytes uncompiled, some ten times slower."""
    areas, lines = make(spark, 6)
    found = meets(areas, ["objectid"], lines, ["k"])
    context = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = meets(areas, ["objectid"], lines, ["k"])._jdf.queryExecution().executedPlan()
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", context.package.codegenString(plan))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) <= 8000
    assert {tuple(r) for r in found.collect()} == brute(areas, lines)


def test_frontages_of_one_file_are_dealt_to_all_tasks(spark, tmp_path):
    """A single file is read by one task; its sight areas are computed by all, and no filter is moved back into the reading task."""
    rows = spark.range(1000).selectExpr("id AS p_partkey", "'name' AS p_name", "CAST(id % 50 AS INT) AS p_size")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        areas = sight_areas(standin.frontages(spark, str(tmp_path)))
        assert areas.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert areas.count() == 1000 - len({p for p in range(1000) if p % 101 == 0 or p % 50 == 0})


def test_points_to_place_are_read_once(spark, tmp_path):
    """What places are made from may be a large table; it is not read again to attach the keys."""
    rows = [(i, 10.0 * i, 5.0) for i in range(9)] + [(9, None, 5.0)]
    spark.createDataFrame(rows, "k int, px double, py double").write.parquet(f"{tmp_path}/points")
    edges = spark.createDataFrame([(1, 2, 0, [part((0, 0), (100, 0))])], "u long, v long, key int, geom array<array<struct<x:double,y:double>>>")
    found = nearest_edges(spark.read.parquet(f"{tmp_path}/points"), ["k"], edges)
    assert not [f for f in found.inputFiles() if f"{tmp_path}/points" in f]
    assert sorted(tuple(r) for r in found.collect()) == [(i, 1, 2, 0, 5.0) for i in range(9)]
