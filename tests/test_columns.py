"""Micro-cases of the column functions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbsight.functions import cleaning, direction, geo
from kerbsight.operators.centroid import area_centroid, union_centroid

c = F.col


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, expression):
    return [r["v"] for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def test_numbers(spark):
    df = texts(spark, ["12", " 3.5 ", "1e3", "-.5", "n/a", "", None, "NaN", "12d", "Infinity"])
    assert column(df, cleaning.number("t")) == [12.0, 3.5, 1000.0, -0.5, None, None, None, None, None, None]
    assert column(df, cleaning.number("t", 0.0))[4:] == [0.0] * 6


def test_ids_and_moments(spark):
    df = texts(spark, ["123", "123.0", "x", None, "123.7", "9007199254740993.0", " -5. ", "99999999999999999999"])
    assert column(df, cleaning.whole_id("t")) == [123, 123, None, None, None, 9007199254740993, -5, None]
    df = texts(spark, ["2025-03-01T07:15", "2025-03-01 07:15:30", "2025-13-01", None, "12:34"])
    assert column(df, cleaning.hour_of(cleaning.moment("t"))) == [7, 7, None, None, None]


def test_clock_hours(spark):
    df = texts(spark, ["00:00:00", "23:59:59", "24:10:00", "25:10:00", "7", None])
    assert column(df, cleaning.clock_hour("t")) == [0, 23, -1, -1, -1, -1]


def test_day_types_and_stop_names(spark):
    df = texts(spark, ["Mo-Fr 15-A1-24", "15-a1-24 alt", "15.A1.24", None])
    assert column(df, cleaning.has_day_type("t", "15-A1-24")) == [True, True, False, False]
    df = texts(spark, ["Bellevue (Stadt Zürich)", " Central (Zürich) ", None])
    assert column(df, cleaning.stop_name("t")) == ["BELLEVUE", "CENTRAL", ""]


def test_shares_and_rounding(spark):
    assert one(spark, cleaning.share(F.lit(0.0), F.lit(0.0))) == 0.0
    assert one(spark, cleaning.share(F.lit(1.0), F.lit(4.0))) == 0.25
    assert [float(one(spark, cleaning.rounded(F.lit(x), 0))) for x in (0.5, 1.5, -2.5)] == [1.0, 2.0, -3.0]


def test_direction_kinds(spark):
    df = texts(spark, [" Einwärts ", "EINWAERTS", "stadtauswärts", "auswaerts", "Oerlikon", None])
    assert column(df, direction.direction_kind(c("t"))) == ["in", "in", "out", "out", "label", "label"]


def test_every_label_gives_its_first_hit(spark):
    words = list(direction.LABEL_BEARINGS)
    labels = [w.title() for w in words] + ["Richtung Höngg", "Hoenggerberg", "nichts", None]

    def expected(label):
        if label is None:
            return None
        folded = label.lower().strip().replace("ö", "oe").replace("ü", "ue").replace("ä", "ae")
        return next((float(b) for w, b in direction.LABEL_BEARINGS.items() if w in folded), None)

    assert column(texts(spark, labels), direction.label_bearing(c("t"))) == [expected(x) for x in labels]


def test_seed_bearings(spark):
    rows = [(0, "einwärts", 8.5390, 47.0), (1, "auswärts", 8.5390, 47.0), (2, "Oerlikon", 8.5, 47.0),
            (3, "einwärts See", None, None), (4, "unbekannt", 8.5, 47.0)]
    df = spark.createDataFrame(rows, "i int, t string, lon double, lat double")
    assert column(df, direction.seed_bearing(c("t"), c("lon"), c("lat"))) == [0.0, 180.0, 45.0, 135.0, None]


def test_arcs_and_weights(spark):
    b = F.lit

    def value(x):
        return one(spark, x)

    assert value(direction.arc_between(b(350.0), b(10.0))) == 20.0
    assert value(direction.arc_between(b(None).cast("double"), b(10.0))) == 180.0
    assert value(direction.arc_or_null(b(10.0), b(350.0))) == 20.0
    assert value(direction.arc_or_null(b(10.0), b(None).cast("double"))) is None
    assert value(direction.linear_weight(b(0.0), b(135.0))) == 0.0
    assert value(direction.linear_weight(b(0.0), b(None).cast("double"))) == 0.0
    assert value(direction.power_weight(b(0.0), b(None).cast("double"), 90.0, 2.0)) == 1.0
    assert value(direction.power_weight(b(0.0), b(90.0), 90.0, 2.0)) == 0.0
    assert value(direction.power_weight(b(0.0), b(45.0), 90.0, 2.0)) == 0.25
    mixed = F.array(b("path"), b("secondary"))
    assert value(direction.comfort_weight(mixed, direction.COMFORT_BIKE)) == 2.5
    assert value(direction.comfort_weight(mixed, direction.COMFORT_PED)) == 1.5
    assert value(direction.comfort_weight(b(None).cast("array<string>"), direction.COMFORT_PED)) == 1.0
    assert value(direction.decay_per_100m(b(10.0), b(100.0))) == pytest.approx(9.85)
    assert value(direction.decay_per_metre(b(10.0), b(-1.0), 0.5)) == 10.0


def test_reprojection_round_trip(spark):
    e, n = F.lit(2683200.0), F.lit(1247500.0)
    lon, lat = geo.lv95_to_lon(e, n), geo.lv95_to_lat(e, n)
    r = spark.range(1).select(lon.alias("lon"), lat.alias("lat"), geo.wgs84_to_east(lon, lat).alias("e"),
                              geo.wgs84_to_north(lon, lat).alias("n")).first()
    assert (r.lon, r.lat) == (pytest.approx(8.5407, abs=1e-3), pytest.approx(47.3725, abs=1e-3))
    assert abs(r.e - 2683200) < 1 and abs(r.n - 1247500) < 1


# ------------------------------------------------------------------------ sight quads
def quads(spark, lines, **options):
    df = spark.createDataFrame(
        [(i, [{"x": float(x), "y": float(y)} for x, y in line]) for i, line in enumerate(lines)],
        "i int, part array<struct<x:double,y:double>>",
    )
    rows = df.select("i", geo.sight_quad(c("part"), **options).alias("q")).orderBy("i").collect()
    return [None if r["q"] is None else [(p["x"], p["y"]) for p in r["q"]] for r in rows]


def test_left_quad(spark):
    (ring,) = quads(spark, [[(0, 0), (10, 0)]])
    k = 30 * math.sqrt(0.5)
    assert ring == [pytest.approx(p) for p in [(0, 0), (10, 0), (10 + k, k), (-k, k)]]


def test_lines_without_length_and_closed_lines(spark):
    assert quads(spark, [[(1, 1), (1, 1)], [(1, 1)]]) == [None, None]
    (ring,) = quads(spark, [[(0, 0), (5, 0), (5, 5), (0, 0)]])
    assert ring[0] == ring[1] == (0, 0) and ring[2] != ring[3]


def convex(ring):
    turns = []
    for i in range(4):
        (ax, ay), (bx, by), (cx, cy) = ring[i], ring[(i + 1) % 4], ring[(i + 2) % 4]
        turns.append((bx - ax) * (cy - by) - (by - ay) * (cx - bx))
    return all(t >= -1e-6 for t in turns) or all(t <= 1e-6 for t in turns)


@pytest.mark.parametrize("side", ["left", "right"])
@pytest.mark.parametrize("sign", [1, -1])
def test_quads_are_always_convex(spark, side, sign):
    rng = random.Random(3)
    lines = [[(rng.uniform(-50, 50), rng.uniform(-50, 50)) for _ in range(2)] for _ in range(200)]
    for half in (10.0, 45.0, 80.0):
        rings = quads(spark, lines, side=side, ray_sign=sign, half_angle=half)
        assert all(convex(r) for r in rings)


def test_quad_options_are_checked():
    with pytest.raises(ValueError):
        geo.sight_quad(F.col("part"), half_angle=90.0)


def segment_touches(ring, a, b, steps=400):
    """Sampled closed test, good for cases that are clear of the border."""
    pts = np.array(ring)
    area = sum(pts[i][0] * pts[(i + 1) % 4][1] - pts[(i + 1) % 4][0] * pts[i][1] for i in range(4))
    for t in np.linspace(0, 1, steps):
        p = np.array(a) * (1 - t) + np.array(b) * t
        inside = all(
            np.sign(area) * ((pts[(i + 1) % 4][0] - pts[i][0]) * (p[1] - pts[i][1])
                             - (pts[(i + 1) % 4][1] - pts[i][1]) * (p[0] - pts[i][0])) >= 0 for i in range(4)
        )
        if inside:
            return True
    return False


def test_quad_meets_segment(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        length = rng.uniform(1, 50)
        k = 30 * math.sqrt(0.5)
        ring = [(0, 0), (length, 0), (length + k, k), (-k, k)]
        a, b = [(rng.uniform(-60, 90), rng.uniform(-40, 60)) for _ in range(2)]
        rows.append((i, *[float(v) for p in ring for v in p], *a, *b))
    names = "i int, " + ", ".join(f"{axis}{k} double" for k in range(4) for axis in "xy") + ", ax double, ay double, bx double, by double"
    df = spark.createDataFrame(rows, names)
    quad = [(c(f"x{k}"), c(f"y{k}")) for k in range(4)]
    found = column(df, geo.quad_meets_segment(quad, c("ax"), c("ay"), c("bx"), c("by")))
    wrong = 0
    for r, hit in zip(rows, found):
        ring = [(r[1 + 2 * k], r[2 + 2 * k]) for k in range(4)]
        sampled = segment_touches(ring, r[9:11], r[11:13])
        assert hit or not sampled
        wrong += hit != sampled
    assert wrong <= 4  # grazing corners between two samples


def test_touching_counts_and_points_work(spark):
    quad = [(F.lit(x), F.lit(y)) for x, y in [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]]

    def hit(*xy):
        return one(spark, geo.quad_meets_segment(quad, *[F.lit(float(v)) for v in xy]))

    assert hit(10, 5, 20, 5) and hit(10, 10, 20, 20) and hit(-5, 0, 15, 0) and hit(5, 5, 5, 5)
    assert not hit(10.001, 5, 20, 5) and not hit(11, 11, 11, 11) and not hit(-1, 12, 12, 25)


def test_buffer_variant(spark):
    line = F.array(geo.point(F.lit(0.0), F.lit(0.0)), geo.point(F.lit(200.0), F.lit(0.0)))

    def seen(x, y):
        return one(spark, geo.within_buffer_sight(F.lit(float(x)), F.lit(float(y)), line))

    assert seen(100, 40) and not seen(100, 60) and not seen(-20, 0) and not seen(10, 10)


# -------------------------------------------------------------------------- centroids
def raster_centroid(rings, n=900):
    pts = np.vstack(rings)
    (x0, y0), (x1, y1) = pts.min(axis=0), pts.max(axis=0)
    gx, gy = np.meshgrid(x0 + (np.arange(n) + 0.5) * (x1 - x0) / n, y0 + (np.arange(n) + 0.5) * (y1 - y0) / n)
    hit = np.zeros_like(gx, dtype=bool)
    for ring in rings:
        area = sum(ring[i][0] * ring[(i + 1) % len(ring)][1] - ring[(i + 1) % len(ring)][0] * ring[i][1] for i in range(len(ring)))
        inside = np.ones_like(hit)
        for i in range(len(ring)):
            (ax, ay), (bx, by) = ring[i], ring[(i + 1) % len(ring)]
            inside &= np.sign(area) * ((bx - ax) * (gy - ay) - (by - ay) * (gx - ax)) >= 0
        hit |= inside
    return gx[hit].mean(), gy[hit].mean()


@pytest.mark.parametrize("seed", range(6))
def test_union_centroid_against_a_raster(seed):
    rng = np.random.default_rng(seed)
    rings = []
    for _ in range(1 + seed):
        x, y, length = rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(5, 40)
        turn = rng.uniform(0, 2 * math.pi)
        k = 30 * math.sqrt(0.5)
        base = np.array([(0, 0), (length, 0), (length + k, k), (-k, k)])
        spin = np.array([[math.cos(turn), -math.sin(turn)], [math.sin(turn), math.cos(turn)]])
        rings.append(base @ spin.T + (x, y))
    assert area_centroid(rings) == pytest.approx(raster_centroid(rings), abs=0.15)
    assert union_centroid(rings) == pytest.approx(area_centroid(rings), abs=1e-6)


def test_overlapping_parts_use_the_union(spark):
    from kerbsight.operators.centroid import with_centroid
    from kerbsight.operators.impressions import sight_areas

    walls = [[{"x": 2683000.0, "y": 1247000.0}, {"x": 2683020.0, "y": 1247000.0}],
             [{"x": 2683010.0, "y": 1247000.0}, {"x": 2683030.0, "y": 1247000.0}]]
    df = spark.createDataFrame([(1, walls)], "objectid int, geom array<array<struct<x:double,y:double>>>")
    row = with_centroid(sight_areas(df)).first()
    # mirror image of itself about x = 2683015
    x = one(spark, geo.lv95_to_lon(F.lit(2683015.0), F.lit(1247011.0)))
    assert row["x_lon_center"] == pytest.approx(x, abs=1e-6)


def test_whole_numbers_are_not_parsed(spark):
    """Ids that come as whole numbers are taken as they are; as text they are parsed, with the same result."""
    from kerbsight import schemas
    from kerbsight.operators.conform import conform

    ids = [0, -7, 2**63 - 1, -(2**63), None]
    typed = spark.createDataFrame([(i, "08:00:00") for i in ids], "plan_fahrt_id long, fz_ab string")
    text = typed.withColumn("plan_fahrt_id", F.col("plan_fahrt_id").cast("string"))
    assert [r[0] for r in conform(typed, schemas.TRANSIT_RUNS).collect()] == [r[0] for r in conform(text, schemas.TRANSIT_RUNS).collect()] == ids
    plan = lambda df: conform(df, schemas.TRANSIT_RUNS)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike" not in plan(typed) and "rlike" in plan(text)
