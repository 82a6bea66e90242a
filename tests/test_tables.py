"""Profiles, ingest, publishing, WKB and streaming."""

import json
import random
import statistics
import struct
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbsight import schemas
from kerbsight.operators import checks, conform, impressions, profiles
from kerbsight.plans import gold, ingest, release
from kerbsight.sources import landing, publish, standin, tables, wkb
from kerbsight.streaming import counts as streaming
from kerbsight.streaming import envelopes

CAR = "msid string, richtung string, messung_dat_zeit string, anz_fahrzeuge string, ekoord string, nkoord string, msname string, id long"


# --------------------------------------------------------------------------- profiles
def test_car_profile_skips_null_counts_and_keys(spark):
    rows = [
        ("Z1", "in", "2025-01-01T07:10", "10", "2683000", "1247000", None, 1),
        ("Z1", "in", "2025-01-02T07:20", "n/a", "2683000", "1247000", "late", 2),
        ("Z1", "in", "2025-01-01T07:30", "20", "2683009", "1247009", "early", 3),
        ("Z1", None, "2025-01-01T07:30", "20", "2683000", "1247000", "x", 4),
        ("Z1", "in", "kaputt", "20", "2683000", "1247000", "x", 5),
        ("Z2", "out", "2025-01-01T07:30", "n/a", "2683000", "1247000", "x", 6),
    ]
    got = profiles.typical_day_cars(profiles.clean_car_counts(spark.createDataFrame(rows, CAR))).collect()
    by = {r.msid: r for r in got}
    assert len(got) == 2 and by["Z1"].flow_value == 15.0 and by["Z1"].msname == "early" and by["Z1"].ekoord == 2683000.0
    assert by["Z2"].flow_value is None


def test_pedbike_counts_null_as_zero(spark):
    rows = [(1, "2025-01-01T07:10", "4", None, None, None), (1, "2025-01-02T07:10", None, "2", "2683000", "1247000")]
    raw = spark.createDataFrame(rows, "fk_standort long, datum string, velo_in string, velo_out string, ost string, nord string")
    (row,) = profiles.station_hours(profiles.clean_pedbike_counts(raw)).collect()
    assert (row.velo_in, row.velo_out, row.velo_hour, row.fuss_hour) == (2.0, 1.0, 3.0, 0.0)
    assert row.velo_in_share == pytest.approx(2 / 3) and row.fuss_in_share == 0.0 and row.ost == 2683000.0
    with pytest.raises(ValueError):
        profiles.clean_pedbike_counts(raw.drop("fk_standort"))


def test_exact_quantiles(spark):
    import random

    rng = random.Random(1)
    values = {g: [rng.choice([0, 1, 2, 5, -3, 1000, 12.5]) * rng.choice([1, 1, 1e4]) for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 501), ("d", 500))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g string, x double")
    got = {r.g: r.x for r in profiles.exact_median(df, ["g"], ["x"]).collect()}
    assert got == {g: statistics.median(vs) for g, vs in values.items()}
    quart = {(r.g, r.quantile): r.value for r in profiles.exact_quantiles(df, ["g"], ["x"], {"q1": 0.25, "q3": 0.75}).collect()}
    want = statistics.quantiles(values["c"], n=4, method="inclusive")
    assert (quart[("c", "q1")], quart[("c", "q3")]) == (pytest.approx(want[0]), pytest.approx(want[2]))


def test_segments(spark):
    rows = [(1, 2, 10, "07:00:00", "5"), (1, 2, 10, "07:30:00", None), (1, 2, 11, "08:00:00", "3"), (1, None, 10, "07:00:00", "9"),
            (1, 2, 12, "24:10:00", "9"), (3, 4, 12, "09:00:00", None)]
    runs = spark.createDataFrame(rows, "haltestellen_id long, nach_hst_id long, plan_fahrt_id long, fz_ab string, besetzung string")
    hourly = profiles.segment_hours(profiles.clean_transit_runs(runs))
    assert sorted(map(tuple, hourly.collect())) == [(1, 2, 7, 5.0, 1), (1, 2, 8, 3.0, 1), (3, 4, 9, 0.0, 1)]
    assert sorted(map(tuple, profiles.segment_days(hourly).collect())) == [(1, 2, 8.0, 2), (3, 4, 0.0, 1)]
    with pytest.raises(ValueError):
        profiles.weekday_runs(runs, spark.createDataFrame([(1, "x")], "tagtyp_id long, tagtypname string"))


def test_null_stop_names_never_match(spark):
    stops = spark.createDataFrame([(1, None), (2, "A (Zürich)"), (3, "")], "haltestellen_id long, haltestellenlangname string")
    feed = spark.createDataFrame([(None, 1.0, 2.0), ("a", 47.0, 8.0), ("A ", 49.0, 9.0)], "stop_name string, stop_lat double, stop_lon double")
    got = {r.haltestellen_id: (r.stop_lat, r.stop_lon) for r in profiles.match_stops(stops, feed).collect()}
    assert got == {1: (None, None), 2: (48.0, 8.5), 3: (None, None)}


def test_corridor_text_collision(spark):
    geom = [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]]
    rows = [("1", "23", 8, 5.0, geom), ("12", "3", 8, 6.0, geom)]
    flows = spark.createDataFrame(rows, "haltestellen_id string, nach_hst_id string, hour int, flow_besetzung double, geom array<array<struct<x:double,y:double>>>")
    walls = [[{"x": -5.0, "y": 0.0}, {"x": 5.0, "y": 0.0}]]
    areas = impressions.sight_areas(spark.createDataFrame([(1, walls)], "objectid long, geom array<array<struct<x:double,y:double>>>"))
    plain = impressions.impressions(areas, [impressions.transit_items(flows)]).first()
    exact = impressions.impressions(areas, [impressions.transit_items(flows, exact_pairs=True)]).first()
    assert (plain.affected_corridors, exact.affected_corridors) == (1, 2)
    assert (float(plain.total_impressions), float(plain.avg_flow)) == (11.0, 5.5)


# ---------------------------------------------------------------------------- conform
def test_snake_names():
    assert conform.snake_names(["MessungDatZeit", "_id", "anz Fahrzeuge", "anz-fahrzeuge", "2nd", "  ", "Größe"]) == [
        "messung_dat_zeit", "id", "anz_fahrzeuge", "anz_fahrzeuge_2", "col_2nd", "col", "größe"
    ]


def test_fit_target(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x")], "U double, Hour double, other string")
    fitted, missing, extra = conform.fit_target(df, ["hour", "u", "v", "created_at"])
    assert fitted.columns == ["hour", "u"] and dict(fitted.dtypes) == {"hour": "bigint", "u": "bigint"}
    assert (missing, extra) == (["v"], ["other"])


# ------------------------------------------------------------------------------ files
def test_readers(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").coalesce(1).write.parquet(str(tmp_path / "in"))
    for f in (tmp_path / "in").glob("*.parquet"):
        f.rename(tmp_path / "in" / "counts_pedestrian_2025.parquet")
    assert tables.read_counts(spark, str(tmp_path / "in"), "pedestrian").count() == 1
    with pytest.raises(FileNotFoundError):
        tables.read_counts(spark, str(tmp_path / "in"), "cars")
    (tmp_path / "t.csv").write_text("a;b\n1;x\n2;y\n")
    assert tables.read_csv(spark, str(tmp_path / "t.csv"), ";").count() == 2
    (tmp_path / "d.json").write_text(json.dumps({"date": "2025-01-01", "data": [{"a": 1}, {"a": 2}]}))
    assert sorted(r.a for r in tables.read_envelopes(spark, str(tmp_path / "d.json")).collect()) == [1, 2]
    (tmp_path / "r.json").write_text(json.dumps({"result": {"records": [{"a": 3}]}}))
    assert [r.a for r in tables.read_envelopes(spark, str(tmp_path / "r.json"), "result.records").collect()] == [3]
    assert tables.versioned("/out/", "bike_edges", "V2") == "/out/V2_bike_edges" and tables.versioned("/out", "x") == "/out/x"


def test_normalized_write(spark, tmp_path):
    edges = spark.createDataFrame([(1, ["a", "b"])], "edge_id long, highway array<string>")
    flows = spark.createDataFrame([(1, 7, 2.0), (1, 8, 3.0)], "edge_id long, hour int, flow double")
    tables.write_normalized(edges, flows, str(tmp_path), "bike", "V1", ["hour"])
    assert spark.read.parquet(str(tmp_path / "V1_bike_edges")).first().highway == "a,b"
    assert spark.read.parquet(str(tmp_path / "V1_bike_flows")).filter("hour = 8").first().flow == 3.0


def test_wkb(spark):
    line = struct.pack("<BII", 1, 2, 2) + struct.pack("<4d", 1, 2, 3, 4)
    with_z = struct.pack(">BII", 0, 1002, 2) + struct.pack(">6d", 1, 2, 9, 3, 4, 9)
    with_srid = struct.pack("<BIII", 1, 2 | 0x20000000, 2056, 2) + struct.pack("<4d", 1, 2, 3, 4)
    expected = [[{"x": 1.0, "y": 2.0}, {"x": 3.0, "y": 4.0}]]
    assert wkb.decode(line) == wkb.decode(with_z) == wkb.decode(with_srid) == expected
    two = struct.pack("<BII", 1, 5, 2) + line + line
    assert wkb.decode(two) == expected * 2 and wkb.encode(expected * 2, False) == two
    ring = [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]]
    assert wkb.decode(wkb.encode(ring, True)) == ring and wkb.decode(None) is None
    with pytest.raises(ValueError):
        wkb.decode(struct.pack("<BI2d", 1, 1, 0, 0))
    df = spark.createDataFrame([(1, line), (2, None)], "i int, geometry binary")
    assert wkb.drop_empty(wkb.from_wkb(df)).count() == 1


# ----------------------------------------------------------------------------- ingest
def test_month_slice_keeps_the_last_day(spark):
    df = spark.createDataFrame([("2025-12-31T23:00",), ("2026-01-01T00:00",), ("2025-11-30T10:00",)], "datum string")
    assert [r.datum[:10] for r in landing.month_slice(df, "datum", 2025, 12).collect()] == ["2025-12-31"]


def test_land_by_day(spark, tmp_path):
    df = spark.createDataFrame([("2025-01-02T03:00", 1), ("2025-01-03T03:00", 2), ("2025-01-03T04:00", 3)], "datum string, n int")
    landing.land_by_day(df, "datum", str(tmp_path / "raw"))
    assert sorted(p.name for p in (tmp_path / "raw/year=2025/month=01").iterdir()) == ["day=02", "day=03"]
    assert {(r.date, r.records_fetched) for r in landing.day_counts(df, "datum").collect()} == {("2025-01-02", 1), ("2025-01-03", 2)}


def source(spark, rows):
    return spark.createDataFrame(rows, "_id long, MessungDatZeit string, Flow string")


def test_ingest_runs(spark, tmp_path):
    folders = ingest.Folders(*[str(tmp_path / n) for n in ("raw", "months", "state", "audit")])
    first = [(1, "2025-01-01T01:00:00", "a"), (2, "2025-02-01T01:00:00", "b"), (3, "2024-12-31T01:00:00", "old")]

    def run(rows, run_id):
        return ingest.ingest_year(source(spark, rows), 2025, "cars", run_id, folders)

    assert run(first, "r1") == "success"
    assert landing.read_state(spark, folders.state, 2025) == ("2025-02-01T01:00:00", 2)
    assert run(first, "r2") == "no_new_data"
    # same time, higher id counts as new; a lower one does not
    assert run(first + [(4, "2025-02-01T01:00:00", "c"), (0, "2025-02-01T01:00:00", "late")], "r3") == "success"
    months = spark.read.parquet(folders.months)
    assert sorted((r.id, r.flow) for r in months.collect()) == [(1, "a"), (2, "b"), (4, "c")]
    assert spark.read.parquet(folders.raw).count() == 3
    with pytest.raises(Exception):
        ingest.ingest_year(spark.range(1), 2025, "cars", "r4", folders)
    audit = {r.run_id: r for r in landing.run_summary(spark.read.parquet(folders.audit)).collect()}
    assert {k: v.status for k, v in audit.items()} == {"r1": "success", "r2": "success", "r3": "success", "r4": "partial"}
    assert (audit["r1"].records, audit["r2"].units_no_new_data, audit["r4"].units_failed) == (2, 1, 1)


def test_an_ingest_run_copies_its_rows_no_further(spark, tmp_path, monkeypatch):
    """The raw table is the copy that a run goes on with; only months that were there before are staged."""
    folders = ingest.Folders(*[str(tmp_path / n) for n in ("raw", "months", "state", "audit")])
    staged, write = [], landing.cut
    monkeypatch.setattr(landing, "cut", lambda df, label: staged.append(label) or write(df, label))
    monkeypatch.setattr(landing, "cut_observed", lambda df, label, **metrics: staged.append(label))
    first = [(1, "2025-01-05T00:00:00", "a"), (2, "2025-13-05T00:00:00", "b")]
    assert ingest.ingest_year(source(spark, first), 2025, "cars", "r1", folders) == "success" and staged == []
    more = [*first, (3, "2025-13-06T00:00:00", "c"), (3, "2025-13-06T00:00:00", "d"), (4, "2025-13-07T00:00:00", "e")]
    assert ingest.ingest_year(source(spark, more), 2025, "cars", "r2", folders) == "success" and staged == []
    assert spark.read.parquet(folders.raw).count() == 5 and spark.read.parquet(folders.months).count() == 1


def test_upsert_rewrites_only_touched_months(spark, tmp_path):
    folder = str(tmp_path / "months")
    make = lambda rows: spark.createDataFrame(rows, "id long, messung_dat_zeit string, v string")
    landing.upsert_months(make([(1, "2025-01-05T00:00:00", "a"), (2, "2025-02-05T00:00:00", "b"), (2, "2025-02-05T00:00:00", "b")]), folder)
    untouched = sorted((tmp_path / "months/year=2025/month=01").glob("*.parquet"))
    landing.upsert_months(make([(2, "2025-02-05T00:00:00", "B"), (3, "2025-02-06T00:00:00", "c")]).withColumn("extra", F.lit(1)), folder)
    assert sorted((tmp_path / "months/year=2025/month=01").glob("*.parquet")) == untouched
    got = spark.read.option("mergeSchema", "true").parquet(folder).collect()
    assert sorted((r.id, r.v) for r in got) == [(1, "a"), (2, "B"), (3, "c")]


def test_keep_last_and_whole_rows(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 2)], "id int, v string, n int")
    assert [tuple(r) for r in landing.keep_last(df, ["id"], F.col("n")).collect()] == [(1, "b", 2)]
    assert landing.keep_last(df, None, F.col("n")).count() == 2


def test_fingerprint_sees_changes_not_order(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i == 3 else str(i)) for i in range(50)], "a int, b string")
    mark = lambda d: landing.fingerprint(d).first()["sha256"]
    assert mark(df) == mark(df.orderBy(F.desc("a")).repartition(4))
    assert mark(df) != mark(df.withColumn("b", F.coalesce("b", F.lit("")))) and mark(df) != mark(df.union(df.limit(1)))
    args = (str(tmp_path / "t"), str(tmp_path / "s"), "stops")
    assert [landing.refresh_if_changed(df, *args), landing.refresh_if_changed(df, *args)] == ["success", "no_new_data"]
    assert landing.refresh_if_changed(df.filter("a > 1"), *args) == "success"


# ---------------------------------------------------------------------------- publish
def test_publish_and_checks(spark, tmp_path):
    edges = spark.createDataFrame([(1, b"x", 1, 2, 0), (2, None, 2, 3, 0)], "EDGE_ID long, geometry binary, u long, v long, key int")
    flows = spark.createDataFrame([(1, 7, 2.0, 1.0), (1, 7, 2.0, 1.0), (9, 8, 1.0, 0.5)], "edge_id long, hour int, flow double, flow_norm double")
    counts, report = gold.publish_checked({"bike_edges": edges, "bike_flows": flows, "ped_flows": flows.limit(0)}, str(tmp_path))
    assert counts == {"bike_edges": 2, "bike_flows": 3, "ped_flows": 0, "total": 5}
    got = {r.table_name: (r.n_rows, r.repeated, r.nulls, r.orphans) for r in report.collect()}
    assert got == {"bike_edges": (2, 0, 1, 0), "bike_flows": (3, 1, 0, 1)}
    assert publish.publish_parquet(flows.limit(0), str(tmp_path / "bike_flows"), schemas.GOLD["bike_flows"]["schema"].names) == 0
    assert spark.read.parquet(str(tmp_path / "bike_flows")).count() == 3
    assert [tuple(r) for r in checks.repeated_keys(flows, ["edge_id", "hour"]).collect()] == [(1, 7, 2)]
    assert checks.null_counts(edges, ["geometry"]).first()["geometry"] == 1
    with pytest.raises(ValueError):
        publish.publish_gold({"other": flows}, str(tmp_path))


def test_a_release_is_whole_or_nothing(spark, tmp_path):
    folder = str(tmp_path)
    edges = spark.createDataFrame([(1, b"x", 1, 2, 0), (2, b"y", 2, 3, 0)], "edge_id long, geometry binary, u long, v long, key int")
    flows = spark.createDataFrame([(1, 7, 2.0, 1.0), (2, 7, 4.0, 1.0)], "edge_id long, hour int, flow double, flow_norm double")
    good = {
        "frontage_visibility": spark.createDataFrame(
            [(1, 5, "a", b"x", 8.5, 47.4)], "objectid long, gwr_egid long, bezeichnung string, geometry binary, x_lon_center double, y_lat_centre double"),
        "transit_flows_hourly": spark.createDataFrame(
            [("a", "b", 7, 3.0, 1, b"x")], "haltestellen_id string, nach_hst_id string, hour int, flow_besetzung double, n_runs int, geometry binary"),
        "bike_edges": edges, "ped_edges": edges, "motorized_traffic_edges": edges, "bike_flows": flows, "ped_flows": flows,
        "motorized_traffic_flows": flows.withColumnRenamed("flow", "total_flow"),
    }
    with pytest.raises(FileNotFoundError):
        release.released(spark, folder, "bike_flows")
    assert release.release(good, folder, "v1") == []
    total = lambda: release.released(spark, folder, "bike_flows").agg(F.sum("flow")).first()[0]
    faults = {
        "bike_flows": flows.union(flows), "ped_flows": flows.limit(0), "bike_edges": edges.filter("edge_id = 1"),
        "ped_edges": edges.withColumn("geometry", F.lit(None).cast("binary")),
    }
    for name, table in faults.items():
        want = ["bike_flows"] if name == "bike_edges" else [name]  # a lost edge makes orphans of its flows
        assert release.release({**good, name: table}, folder, "v2") == want
    broken = flows.withColumn("flow", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        release.release({**good, "motorized_traffic_flows": broken.withColumnRenamed("flow", "total_flow")}, folder, "v2")
    with pytest.raises(ValueError, match="published already"):
        release.release(good, folder, "v1")
    with pytest.raises(ValueError, match="has no"):
        release.release({**good, "bike_flows": flows.drop("hour")}, folder, "v2")
    with pytest.raises(ValueError, match="has the tables"):
        release.release({"bike_flows": flows}, folder, "v2")
    assert release.switches(spark, folder) == ["v1"] and total() == 6.0
    assert release.release({**good, "bike_flows": flows.withColumn("flow", F.col("flow") * 2)}, folder, "v2") == []
    assert release.switches(spark, folder) == ["v1", "v2"] and total() == 12.0


def test_envelopes_put_aside_what_they_cannot_use(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    texts = [
        '{"data": [{"id": 1, "t": "2025-01-02T03:00", "v": "a"},\n {"id": 2, "t": "2025-01-03", "v": null}], "total": 2}',
        '{"data": [{"id": 3, "t": "2025-01-0', '{"other": []}', '{"data": []}', '{"data": [{"id": "x", "t": "2025-01-02"}]}', "",
        '{"data": [{"id": 4, "t": "2025-02-30"}, {"id": 5}, {"id": 6, "t": "2025-01-02 x", "more": 1}]}',
    ]
    for k, text in enumerate(texts):
        (landed / f"{k}.json").write_text(text)
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        documents = envelopes.read_documents(spark, str(landed), files_per_batch=3)
        envelopes.land_envelopes(documents, out, str(tmp_path / "state"), "id bigint, t string, v string", "t")
    days = spark.read.parquet(f"{out}/days")
    assert sorted((r.id, str(r.day), r.v) for r in days.collect()) == [(1, "2025-01-02", "a"), (2, "2025-01-03", None), (6, "2025-01-02", None)]
    aside = Counter((r.kind, r.content) for r in spark.read.parquet(f"{out}/aside").collect())
    want = [("document", texts[k]) for k in (1, 2, 4)] + [("record", '{"id":4,"t":"2025-02-30"}'), ("record", '{"id":5}')]
    assert {k: n for k, n in aside.items() if k[1]} == dict.fromkeys(want, 1)
    audit = spark.read.parquet(f"{out}/audit").agg(F.sum("records"), F.sum("undated")).first()
    assert tuple(audit) == (5, 2)


def test_only_changed_partitions_are_rewritten(spark, tmp_path):
    folder, args = str(tmp_path / "rows"), (str(tmp_path / "state"), "p", "unit")
    rows = [(i, "a/b" if i % 4 == 0 else "c d" if i % 4 == 1 else None if i % 4 == 2 else "e") for i in range(40)]
    first = spark.createDataFrame(rows, "i int, p string")

    def run(df, name):
        report = landing.refresh_partitions(df, folder, *args, name, str(tmp_path / "audit"))
        return {r.p: r.action for r in report.collect()}, Counter(tuple(r) for r in spark.read.schema("i int, p string").parquet(folder).collect())

    def files():
        return {str(f.relative_to(folder)) for f in (tmp_path / "rows").rglob("*.parquet")}

    assert run(first, "1") == ({"a/b": "new", "c d": "new", None: "new", "e": "new"}, Counter(rows))
    before = files()
    assert run(first.orderBy(F.desc("i")), "2")[0] == {"a/b": "same", "c d": "same", None: "same", "e": "same"} and files() == before
    changed = first.filter("p is not null and p != 'a/b'").withColumn("i", F.when(F.col("p") == "e", -F.col("i")).otherwise(F.col("i")))
    actions, stored = run(changed, "3")
    assert actions == {"a/b": "gone", "c d": "same", None: "gone", "e": "changed"}
    assert stored == Counter((-i if p == "e" else i, p) for i, p in rows if p in ("e", "c d"))
    assert {f for f in files() if f.startswith("p=c")} == {f for f in before if f.startswith("p=c")}
    assert run(first, "4")[0] == {"a/b": "new", "c d": "same", None: "new", "e": "changed"}
    audit = spark.read.parquet(str(tmp_path / "audit")).orderBy("run_id").collect()
    assert [(r.status, r.records) for r in audit] == [("success", 40), ("no_new_data", 0), ("success", 10), ("success", 30)]


@pytest.mark.parametrize("polygon", [False, True])
def test_wkb_columns_are_as_geometry_by_geometry(polygon):
    rng = random.Random(5)
    point = lambda: {"x": rng.random(), "y": rng.random()}
    geoms = [None if rng.random() < 0.1 else [[point() for _ in range(rng.randrange(polygon, 5))] for _ in range(rng.choice([0, 1, 1, 2]))] for _ in range(80)]
    written = [wkb.encode(g, polygon) for g in geoms]
    column = pa.array([None, *geoms], wkb.ARROW_GEOM)[1:]
    assert wkb.encode_column(column, polygon).to_pylist() == written
    read = wkb.decode_column(pa.array([b"no", *written], pa.binary())[1:])
    assert read.type == wkb.ARROW_GEOM and read.to_pylist() == [wkb.decode(g) for g in written]


def test_the_network_is_not_made_by_one_task(spark):
    edges = standin.net_edges(spark, "/root/testdata/sf0.001")
    assert "hashpartitioning(node_id" in edges._jdf.queryExecution().executedPlan().toString()


def test_a_month_is_no_single_task(spark):
    """All rows lie in one month; looking it up spreads them."""
    rows = spark.range(4000).select("id", F.lit("2024-01-01T00:00:00").alias("t"), (F.col("id") % 3).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        old = landing._of_months(rows, rows.where("id = 7"), "t")
        tasks = [r["count"] for r in old.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 4000 and max(tasks) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert landing._of_months(rows, rows.where("id < 0"), "t").count() == 0


# -------------------------------------------------------------------------- streaming
def test_streamed_months(spark, tmp_path):
    landed = str(tmp_path / "landed")
    schema = "id long, messung_dat_zeit string, v string"
    for rows in ([(1, "2025-01-01T00:00:00", "a")], [(1, "2025-01-01T00:00:00", "A"), (2, "2025-02-01T00:00:00", "b")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        stream = streaming.read_landed(spark, landed, spark.createDataFrame([], schema).schema)
        streaming.ingest_months(stream, str(tmp_path / "months"), str(tmp_path / "state"))
    assert sorted((r.id, r.v) for r in spark.read.parquet(str(tmp_path / "months")).collect()) == [(1, "A"), (2, "b")]


def test_batches_of_a_month_are_merged_together(spark, tmp_path, monkeypatch):
    """Every batch corrects an id and has a row without a month; the month is written once."""
    landed, calls = str(tmp_path / "landed"), []
    schema = "id long, messung_dat_zeit string, v string"
    for i in range(4):
        rows = [(1, "2025-01-01T00:00:00", "zyxw"[i]), (10 + i, "2025-01-01T00:00:00", "n"), (1, "2025-13-01", str(i))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
    once = streaming.upsert_months
    monkeypatch.setattr(streaming, "upsert_months", lambda *given: calls.append(1) or once(*given))
    stream = streaming.read_landed(spark, landed, spark.createDataFrame([], schema).schema, files_per_batch=2)
    folder = str(tmp_path / "months")
    streaming.ingest_months(stream, folder, str(tmp_path / "state"))
    assert len(calls) == 1
    stored = {r.id: r.v for r in spark.read.parquet(folder).collect()}
    assert stored.keys() == {1, 10, 11, 12, 13} and stored[1] in "wx"
    bad = spark.read.parquet(landing.rejects_folder(folder)).collect()
    assert sorted(r.v for r in bad) == ["0", "1", "2", "3"] and Counter(r.run.split("-")[0] for r in bad) == {"batch": 4}


@pytest.mark.parametrize("per_batch", [1, 1000])
def test_streams_lose_nothing(spark, tmp_path, per_batch):
    """Files whose times jump back by days, copies in different files, more batches than one merge takes."""
    landed, schema = str(tmp_path / "landed"), "id long, ts timestamp_ntz, msid long, flow double"
    times = ["2024-01-09 10:00:00", "2024-01-01 10:30:00", "2024-01-20 10:00:00", "2024-01-01 10:45:00"]
    rows = [(i, times[i % 4], i % 2, float(i)) for i in range(24)]
    for i, row in enumerate(rows):
        both = [row, rows[(i + 7) % 24]]
        spark.createDataFrame(both, "id long, ts string, msid long, flow double").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(landed)
    read = lambda: streaming.read_landed(spark, landed, spark.read.parquet(landed).schema, files_per_batch=per_batch)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    streaming.collect_parts(read(), out, state, streaming.first_copies, streaming.first_copies)
    once = streaming.first_copies(streaming.read_parts(spark, out))
    assert sorted(r.id for r in once.collect()) == list(range(24))
    streaming.collect_parts(read(), out + "2", state + "2", streaming.hour_parts, streaming.added)
    got = {(str(r.hour_start), r.msid): (r.mean_flow, r.n) for r in streaming.hourly_means(streaming.read_parts(spark, out + "2")).collect()}
    want: dict = {}
    for _, ts, station, flow in rows:
        want.setdefault((ts[:14] + "00:00", station), []).append(flow)
    assert got == {k: (sum(v) / len(v), 2 * len(v)) for k, v in want.items()}


def test_rejects_are_counted(spark, tmp_path):
    folders = ingest.Folders(*[str(tmp_path / n) for n in ("raw", "months", "state", "audit")])
    rows = [(1, "2025-01-01T01:00:00", "a"), (2, "2025-13-01T01:00:00", "b"), (3, "2025-xx", "c")]

    def fail():
        raise ConnectionError

    with pytest.raises(ConnectionError):
        ingest.ingest_year(source(spark, rows), 2025, "cars", "r1", folders, before_state=fail)
    assert ingest.ingest_year(source(spark, rows), 2025, "cars", "r2", folders) == "success"
    assert spark.read.parquet(folders.raw).count() == 3 and spark.read.parquet(folders.months).count() == 1
    assert sorted(r.id for r in spark.read.parquet(landing.rejects_folder(folders.months)).collect()) == [2, 3]
    note = spark.read.parquet(folders.audit).filter("run_id = 'r2'").first()["message"]
    assert note == '{"records_arrived": 3, "records_written": 1, "records_rejected": 2}'


# ------------------------------------------------------------------------------ plans
def test_plans_have_no_cross_joins_and_prune_columns(spark, capsys):
    import __spark_entry__ as entry

    def plan(name):
        entry.queries()[name](spark, "/root/testdata/sf0.001").explain("formatted")
        return capsys.readouterr().out

    for name in ("impressions_all", "spatial_intersects", "upsert_month", "extent_clip", "time_of_day_buckets", "mass_balance"):
        text = plan(name)
        assert "Scan" in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
    assert "l_extendedprice" not in plan("transit_segment_hour")
