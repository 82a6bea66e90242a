"""Propagation and paths against plain single-machine walks on small graphs."""

import heapq
import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from kerbsight.operators import network, propagate, reach
from kerbsight.operators import paths as paths_module
from kerbsight.operators.components import components
from kerbsight.operators.network import adjacency, attach_edge_ids, dense_ids, edge_bearings, with_edge_ids
from kerbsight.operators.paths import path_lines, shortest_paths

EDGES = "u long, v long, key int, length double, bearing double, highway array<string>"
KINDS = [["cycleway"], ["primary"], ["residential", "path"], ["footway"], ["service"]]


def graph(seed, nodes=12, edges=45, hub=False, short=False):
    rng = random.Random(seed)
    rows = {}
    for _ in range(edges):
        u, v = rng.randrange(nodes), rng.randrange(nodes)
        if hub and rng.random() < 0.5:
            u = 0
        key = sum((u, v, k) in rows for k in range(9))
        bearing = None if rng.random() < 0.1 else rng.uniform(0, 360)
        length = 0.0 if rng.random() < 0.05 else rng.choice([50.0, 100.0, 150.0, 225.0]) / (4 if short else 1)
        rows[(u, v, key)] = (length, bearing, rng.choice(KINDS))
    return [(u, v, k, *data) for (u, v, k), data in sorted(rows.items())]


def out_edges(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def arc(a, b):
    d = abs(a - b) % 360
    return min(d, 360 - d)


def queue_walk(rows, seeds, m):
    """The directional model as a first-in-first-out walk of one seed after the other."""
    out, credit = out_edges(rows), defaultdict(float)
    for _, hour, bearing, node, flow in seeds:
        todo, best = deque([(node, 0.0, flow)]), {}
        while todo:
            at, dist, flow = todo.popleft()
            if dist > m.max_distance or flow < m.min_flow or best.get(at, float("inf")) <= dist:
                continue
            best[at] = dist
            ways = [(r, 1 - arc(bearing, r[4]) / m.max_arc) for r in out[at] if r[4] is not None]
            ways = [(r, w) for r, w in ways if w >= m.min_share]
            total = sum(w for _, w in ways)
            for r, w in ways:
                part = flow * w / total
                credit[(at, r[1], r[2], hour)] += part
                todo.append((r[1], dist + r[3], part * m.decay ** (r[3] / 100)))
    return credit


def car_seeds(rng, nodes, n):
    return [(f"s{i}", rng.randrange(3), rng.uniform(0, 360), rng.randrange(nodes), rng.choice([3.0, 60.0, 400.0, 900.0])) for i in range(n)]


def run_cars(spark, rows, seeds, model, parts=3):
    edges = spark.createDataFrame(rows, EDGES).repartition(parts)
    df = spark.createDataFrame(seeds, "seed string, hour int, bearing double, node long, flow double").repartition(parts)
    found = propagate.propagate_cars(df, edges, model).collect()
    return {(r["u"], r["v"], r["key"], r["hour"]): r["total_flow"] for r in found}


@pytest.mark.parametrize("seed", range(4))
def test_cars_follow_the_queue(spark, seed):
    rows, rng = graph(seed), random.Random(100 + seed)
    seeds = car_seeds(rng, 12, 12)
    model = propagate.CarModel(max_distance=900.0, min_flow=2.0)
    found, wanted = run_cars(spark, rows, seeds, model), queue_walk(rows, seeds, model)
    assert set(found) == set(wanted)
    assert all(found[k] == pytest.approx(wanted[k], rel=1e-9) for k in wanted)


def test_cars_with_shuffled_networks(spark, monkeypatch):
    monkeypatch.setattr(network, "BROADCAST_EDGES", 0)
    monkeypatch.setattr(propagate, "FEW_ROWS", 0)
    test_cars_follow_the_queue(spark, 1)


def test_cars_with_hubs_and_single_level_jobs(spark, monkeypatch):
    monkeypatch.setattr(network, "CHUNK", 2)
    monkeypatch.setattr(propagate, "FEW_ROWS", 0)
    rows, rng = graph(9, hub=True), random.Random(9)
    assert adjacency(spark.createDataFrame(rows, EDGES)).many_chunks
    seeds = car_seeds(rng, 12, 8)
    model = propagate.CarModel(max_distance=600.0, min_flow=2.0)
    found, wanted = run_cars(spark, rows, seeds, model, parts=1), queue_walk(rows, seeds, model)
    assert found == pytest.approx(dict(wanted), rel=1e-9)


def path_walk(rows, seeds, m):
    out, credit = out_edges(rows), defaultdict(float)
    table = {(r[0], r[1], r[2]): r for r in rows}

    def comfort(kinds):
        return 1 + sum(bonus for bonus, wanted in m.comfort if set(kinds) & set(wanted))

    for hour, bearing, u, v, key, flow in seeds:
        assert (u, v, key) in table
        todo = [(u, v, key, 0.0, flow)]
        while todo:
            a, b, k, dist, f = todo.pop()
            credit[(a, b, k, hour)] += f
            if dist >= m.max_distance or f < m.min_flow:
                continue
            ways = []
            for r in out[b]:
                if r[3] <= 0 or dist + r[3] > m.max_distance:
                    continue
                if bearing is None or r[4] is None:
                    w = 1.0
                else:
                    d = arc(bearing, r[4])
                    w = 0.0 if d >= m.max_arc else (1 - d / m.max_arc) ** m.exponent
                if w * comfort(r[5]) > 0:
                    ways.append((r, w * comfort(r[5])))
            total = sum(w for _, w in ways)
            for r, w in ways:
                nxt = f * w / total * 2.718281828459045 ** (-m.alpha * r[3])
                if nxt >= m.min_flow:
                    todo.append((b, r[1], r[2], dist + r[3], nxt))
    return credit


@pytest.mark.parametrize("seed,mode,chunk", [(1, propagate.BIKE, 64), (2, propagate.PED, 64), (3, propagate.BIKE, 2), (4, propagate.PED, 3)])
def test_paths_follow_every_branch(spark, monkeypatch, seed, mode, chunk):
    monkeypatch.setattr(network, "CHUNK", chunk)
    rows, rng = graph(seed, hub=chunk < 64, short=mode is propagate.PED), random.Random(seed)
    seeds = []
    for _ in range(8):
        r = rng.choice(rows)
        seeds.append((rng.randrange(24), r[4], r[0], r[1], r[2], rng.choice([1.0, 20.0, 90.0])))
    df = spark.createDataFrame([(*s, 0.0) for s in seeds], "hour int, bearing double, u long, v long, key int, flow double, dist double")
    found = propagate.propagate_paths(df, spark.createDataFrame(rows, EDGES), mode).collect()
    got = {(r["u"], r["v"], r["key"], r["hour"]): r["flow"] for r in found}
    assert got == pytest.approx(dict(path_walk(rows, seeds, mode)), rel=1e-9)


def test_path_seeds(spark):
    rows = [(1, 2, 0, 10.0, 90.0, ["path"]), (2, 1, 3, 10.0, 270.0, ["path"]), (2, 1, 5, 10.0, None, ["path"]), (2, 3, 0, 10.0, 90.0, ["path"])]
    stations = [(7, 1, 2, 0, 10.0, 0.75, 0.25), (8, 2, 3, 0, 4.0, 0.5, 0.5), (9, 1, 2, 0, 0.0, 0.0, 0.0), (9, 5, 6, 0, 4.0, 1.0, 0.0)]
    df = spark.createDataFrame(stations, "hour int, u long, v long, key int, total double, i double, o double")
    seeds = propagate.path_seeds(df, spark.createDataFrame(rows, EDGES), "total", "i", "o")
    assert sorted((r.hour, r.u, r.v, r.key, r.bearing, r.flow) for r in seeds.collect()) == [
        (7, 1, 2, 0, 90.0, 7.5), (7, 2, 1, 3, 270.0, 2.5), (8, 2, 3, 0, 90.0, 2.0)
    ]


def test_mass_balance_is_exact_and_norms(spark):
    flows = spark.createDataFrame([(1, 7, 2.0), (2, 7, 6.0), (1, 8, 0.0), (3, 9, 5.0)], "edge_id long, hour int, total_flow double")
    seeds = spark.createDataFrame([(7, 100.0), (7, 20.0), (8, 5.0), (9, 10.0)], "hour int, flow double")
    rows = propagate.normalize_per_hour(propagate.mass_balance(flows, seeds)).collect()
    assert {(r.edge_id, r.hour): (r.total_flow, r.flow_norm) for r in rows} == {
        (1, 7): (30.0, pytest.approx(1 / 3)), (2, 7): (90.0, 1.0), (1, 8): (0.0, 0.0), (3, 9): (10.0, 1.0)
    }
    overall = propagate.normalize_overall(flows.withColumnRenamed("total_flow", "flow")).collect()
    assert {(r.edge_id, r.hour): r.flow_norm for r in overall}[(1, 7)] == pytest.approx(1 / 3)


def test_dense_ids_are_complete_and_ordered(spark):
    rows = [(i * 7919 % 1000, i % 13, 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "u long, v long, key int").repartition(7)
    found = with_edge_ids(df).orderBy("edge_id").collect()
    assert [(r.u, r.v, r.key) for r in found] == sorted(rows)
    assert [r.edge_id for r in found] == list(range(1, 1001))
    assert dense_ids(df, ["v", "u"], "n").agg(F.max("n")).first()[0] == 1000


def test_missing_edges_are_an_error_or_null(spark):
    edges = with_edge_ids(spark.createDataFrame([(1, 2, 0)], "u long, v long, key int"))
    flows = spark.createDataFrame([(1, 2, 0, 5.0), (3, 4, 0, 6.0)], "u long, v long, key int, flow double")
    assert sorted(r.edge_id or 0 for r in attach_edge_ids(flows, edges, strict=False).collect()) == [0, 1]
    with pytest.raises(Exception, match="a flow row has no edge"):
        attach_edge_ids(flows, edges).collect()


def test_bearings_and_loops(spark):
    nodes = spark.createDataFrame([(1, 8.5, 47.0), (2, 8.5, 47.1), (3, 8.6, 47.0)], "node_id long, lon double, lat double")
    edges = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (1, 1)], "u long, v long")
    got = {(r.u, r.v): r.bearing for r in edge_bearings(edges, nodes).collect()}
    assert got[(1, 2)] == pytest.approx(0.0) and got[(2, 1)] == pytest.approx(180.0)
    assert got[(1, 3)] == pytest.approx(90.0, abs=0.1) and got[(1, 1)] is None


# ------------------------------------------------------------------------------ paths
def dijkstra(rows, source):
    out, best, heap = out_edges(rows), {}, [((0.0, 0), source)]
    while heap:
        d, at = heapq.heappop(heap)
        if at in best:
            continue
        best[at] = d
        for r in out[at]:
            heapq.heappush(heap, ((d[0] + r[3], d[1] + 1), r[1]))
    return best


@pytest.mark.parametrize("seed,chunk,large", [(1, 64, False), (2, 64, True), (3, 2, False)])
def test_shortest_paths(spark, monkeypatch, seed, chunk, large):
    """``large``: the plans of a network and a search that are too large to broadcast."""
    monkeypatch.setattr(network, "CHUNK", chunk)
    if large:
        monkeypatch.setattr(network, "BROADCAST_EDGES", 0)
        monkeypatch.setattr(paths_module, "FEW_ROWS", 0)
        monkeypatch.setattr(paths_module, "WIDE", 0)
    rows = graph(seed, nodes=25, edges=60, hub=chunk < 64)
    rng = random.Random(seed)
    pairs = {(rng.randrange(25), rng.randrange(25)) for _ in range(25)} | {(3, 3), (3, 999)}
    found = shortest_paths(spark.createDataFrame(list(pairs), "src long, dst long"), spark.createDataFrame(rows, EDGES)).collect()
    paths = defaultdict(dict)
    for r in found:
        paths[(r.src, r.dst)][r.pos] = (r.node, r.length)
    lengths = defaultdict(lambda: float("inf"))
    for r in rows:
        lengths[(r[0], r[1])] = min(lengths[(r[0], r[1])], r[3])
    for src, dst in pairs:
        best = dijkstra(rows, src).get(dst)
        if src == dst or best is None:
            assert (src, dst) not in paths
            continue
        nodes = [paths[(src, dst)][i][0] for i in range(len(paths[(src, dst)]))]
        assert nodes[0] == src and nodes[-1] == dst and len(nodes) == best[1] + 1
        assert sum(lengths[e] for e in zip(nodes, nodes[1:])) == pytest.approx(best[0])
        assert paths[(src, dst)][0][1] == pytest.approx(best[0])


def test_unreachable_targets_do_not_flood(spark, monkeypatch):
    """A 30 x 30 grid, eight near targets, and for every source one in another component."""
    monkeypatch.setattr(paths_module, "WIDE", 20)
    rows = []
    for i in range(30):
        for j in range(30):
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < 30 and y < 30:
                    a, b = 30 * i + j, 30 * x + y
                    rows += [(a, b, 0, 100.0, 0.0, []), (b, a, 0, 100.0, 0.0, [])]
    edges = spark.createDataFrame([*rows, (5000, 5001, 0, 1.0, 0.0, [])], EDGES)
    near = [(30 * k, 30 * k + 2) for k in range(0, 24, 3)]
    wanted = spark.createDataFrame(near + [(s, 5001) for s, _ in near], "src long, dst long")
    state, _ = paths_module._distances(wanted, adjacency(edges), 1000, edges)
    assert state.count() < 8 * 200  # 8 x 900 if every source spreads over the whole grid
    found = shortest_paths(wanted, edges)
    assert sorted((r.src, r.dst) for r in found.select("src", "dst").distinct().collect()) == near


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)]
    root = list(range(200))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for pair in links if pair[0] != pair[1] for x in pair}


def test_path_lines(spark):
    paths = spark.createDataFrame([(1, 3, 0, 1, 20.0), (1, 3, 1, 2, 20.0), (1, 3, 2, 3, 20.0)], "src long, dst long, pos int, node long, length double")
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 10.0, 10.0)], "node_id long, x double, y double")
    (row,) = path_lines(paths, nodes).collect()
    assert [(p.x, p.y) for p in row.geom[0]] == [(0, 0), (10, 0), (10, 10)]


# ------------------------------------------------------------------------- growing tables
def test_a_level_writes_what_it_adds(spark, monkeypatch):
    """Distances are appended, never written again: at most one for each arrival that was judged, and no credit twice."""
    written = []
    append = propagate.Buckets.append

    def counted(self, df, **metrics):
        more = {f"kind{k}": F.count_if(F.col("kind") == k) for k in range(4)}
        seen = append(self, df, **metrics, **more)
        written.append([seen[f"kind{k}"] for k in range(4)])
        return seen

    monkeypatch.setattr(propagate.Buckets, "append", counted)
    monkeypatch.setattr(propagate, "MANY_LEVELS", 1)
    monkeypatch.setattr(propagate, "FEW_LEVELS", 1)
    rows, rng = graph(2, nodes=30, edges=110), random.Random(5)
    seeds = car_seeds(rng, 30, 40)
    model = propagate.CarModel(max_distance=1200.0, min_flow=2.0)
    found, wanted = run_cars(spark, rows, seeds, model), queue_walk(rows, seeds, model)
    assert found == pytest.approx(dict(wanted), rel=1e-9) and len(written) > 5
    for (_, _, judged, _), (known, best, arrivals, credits) in zip(written, written[1:]):
        frontier = judged + arrivals + credits  # rows judged, and offers made (an arrival's own credit comes with it)
        assert known == 0 and best <= judged and best + arrivals + credits <= 2 * frontier


def test_the_hours_of_a_start_go_together(spark, monkeypatch):
    """Seeds of one start and bearing share their rows, more of them than a bundle holds make two, and each hour keeps its own queue."""
    written = []
    append = propagate.Buckets.append

    def counted(self, df, **metrics):
        seen = append(self, df, **metrics, rows=F.count(F.lit(1)))
        written.append(seen["rows"])
        return seen

    rows, rng = graph(6, nodes=20, edges=70), random.Random(11)
    model = propagate.CarModel(max_distance=900.0, min_flow=2.0)
    seeds = [(f"s{i:02}", i, 40.0, 3, rng.choice([3.0, 20.0, 60.0, 400.0, 900.0])) for i in range(propagate.MEMBERS + 4)]
    largest = [max(seeds, key=lambda s: s[4])]
    monkeypatch.setattr(propagate.Buckets, "append", counted)
    found, wanted = run_cars(spark, rows, seeds, model), queue_walk(rows, seeds, model)
    together, written[:] = sum(written), []
    run_cars(spark, rows, largest, model)
    assert found == pytest.approx(dict(wanted), rel=1e-9)
    assert together <= 5 * sum(written)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("large", [False, True])
def test_a_round_of_cars_moves_the_frontier_only(spark, monkeypatch, large):
    """No shuffle with a broadcast network; beyond it two of the frontier, and none of the adjacency."""
    if large:
        monkeypatch.setattr(network, "BROADCAST_EDGES", 0)
    plans = []
    plan = propagate._car_round

    def kept(*args):
        out = plan(*args)
        plans.append(exchanges(out))
        return out

    monkeypatch.setattr(propagate, "_car_round", kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run_cars(spark, graph(1), car_seeds(random.Random(101), 12, 12), propagate.CarModel(max_distance=900.0, min_flow=2.0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans and set(plans) == ({2} if large else {0})


def test_paths_read_a_stored_adjacency(spark, monkeypatch):
    """Beyond the broadcast limit a level of the comfort-weighted model shuffles its rows only."""
    monkeypatch.setattr(network, "BROADCAST_EDGES", 0)
    net = adjacency(spark.createDataFrame(graph(4), EDGES), propagate.BIKE.comfort)
    rows = spark.createDataFrame([(7, 90.0, 1, 2, 0, 0.0, 50.0, True)], "hour int, bearing double, u long, v long, key int, dist double, flow double, live boolean")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(propagate._PathStep(net, propagate.BIKE).apply(rows)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_settled_rows_spread(spark, monkeypatch):
    """Beyond the broadcast limit, rows that flow no further are no single task."""
    monkeypatch.setattr(network, "BROADCAST_EDGES", 0)
    net = adjacency(spark.createDataFrame(graph(3), EDGES), propagate.BIKE.comfort)
    rows = spark.range(4000).select(
        F.lit(8).alias("hour"), F.lit(0.0).alias("bearing"), F.col("id").alias("u"), (F.col("id") % 12).alias("v"), F.lit(0).alias("key"),
        F.lit(0.0).alias("dist"), F.lit(9.0).alias("flow"), F.lit(False).alias("live"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = propagate._PathStep(net, propagate.BIKE).apply(rows)
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 4000 and max(tasks) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# ------------------------------------------------------------------------------ reachability
def reached_from(rows, start):
    out, seen, todo = out_edges(rows), {start}, [start]
    while todo:
        for r in out[todo.pop()]:
            if r[1] not in seen:
                seen.add(r[1])
                todo.append(r[1])
    return seen


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_labels_refute_only_what_no_way_connects(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(40), rng.randrange(40), 0, 1.0, None, []) for _ in range(45)]
    rows += [(b, a, *rest) for a, b, *rest in rows[:12]]
    known = {r.node: (r.after, r.before) for r in reach.labels(spark.createDataFrame(rows, EDGES)).collect()}
    assert known.keys() == {x for r in rows if r[0] != r[1] for x in r[:2]}
    allowed = ways = 0
    for a in known:
        there = reached_from(rows, a)
        for b in known:
            may = known[a][0] & ~known[b][0] == 0 and known[b][1] & ~known[a][1] == 0
            assert may or b not in there
            allowed, ways = allowed + may, ways + (b in there)
    assert ways <= allowed < 0.8 * len(known) ** 2


def test_long_ways_take_few_rounds(spark, monkeypatch):
    """A one-way street of 600 nodes is searched block by block, not node by node."""
    rounds, written = [], reach.cut_observed

    def counted(df, label="stage", **metrics):
        rounds.append(label)
        return written(df, label, **metrics)

    monkeypatch.setattr(reach, "cut_observed", counted)
    monkeypatch.setattr(reach, "BLOCK", 200, raising=False)
    rows = [(i, i + 1, 0, 1.0, None, []) for i in range(600)] + [(301, 300, 0, 1.0, None, [])]
    known = {r.node: (r.after & 1, r.before & 1) for r in reach.labels(spark.createDataFrame(rows, EDGES)).collect()}
    assert known == {i: (int(i >= 300), int(i <= 301)) for i in range(601)}
    assert rounds.count("core-reach") < 40


def test_targets_behind_one_way_streets_do_not_flood(spark, monkeypatch):
    """A 30 x 30 grid of two-way streets; each source has a near target, and one behind a street that only leads out of it."""
    rows = []
    for i in range(30):
        for j in range(30):
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < 30 and y < 30:
                    a, b = 30 * i + j, 30 * x + y
                    rows += [(a, b, 0, 100.0, 0.0, []), (b, a, 0, 100.0, 0.0, [])]
    sources = [30 * k + 3 for k in range(0, 24, 3)]
    rows += [(2000 + k, s, 0, 50.0, 0.0, []) for k, s in enumerate(sources)]  # from the dead end into the grid
    rows += [(3000 + k, 2000 + k, 0, 50.0, 0.0, []) for k in range(len(sources))]
    monkeypatch.setattr(paths_module, "WIDE", 20)
    near = [(s, s + 2) for s in sources]
    behind = [(s, 2000 + k) for k, s in enumerate(sources)]
    inside = [(3000 + k, 2000 + k) for k in range(len(sources))]  # from one dead end into the next: a way that avoids the grid
    across = [(2000, 2001)]
    wanted = spark.createDataFrame(near + behind + inside + across, "src long, dst long")
    edges = spark.createDataFrame(rows, EDGES)
    state, _ = paths_module._distances(wanted, adjacency(edges), 1000, edges)
    assert state.count() < 17 * 120  # 17 x 916 if every source spreads over the whole grid
    found = shortest_paths(wanted, edges)
    assert sorted((r.src, r.dst) for r in found.select("src", "dst").distinct().collect()) == sorted(near + inside)
