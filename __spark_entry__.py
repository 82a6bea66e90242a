
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from kerbsight.functions import cleaning, direction, geo
from kerbsight.operators import checks, network, profiles, reach
from kerbsight.operators import impressions as imp
from kerbsight.operators import propagate
from kerbsight.operators.centroid import with_centroid
from kerbsight.operators.nearest import nearest_edges, nearest_nodes
from kerbsight.operators.paths import shortest_paths
from kerbsight.operators.spatial_join import meets
from kerbsight.plans import car_flows, frontage_impressions, gold, ingest, pedbike_flows, release, transit_flows, visibility
from kerbsight.session import cut, scratch_root
from kerbsight.sources import landing, standin, tables, wkb
from kerbsight.streaming import counts as streaming
from kerbsight.streaming import envelopes

c = F.col
LANDED_FILES = 20


def _round(df: DataFrame, **places: int) -> DataFrame:
    """Round result columns, so that the last bits of double sums do not matter."""
    return df.withColumns({name: F.round(c(name), n) for name, n in places.items()})


def _clean_cars(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.clean_car_counts(standin.counts_cars(spark, sf))


def conform_counts(spark, sf):
    return _round(_clean_cars(spark, sf), lon=8, lat=8).select(
        "id", "msid", "richtung", "anz_fahrzeuge", "ekoord", "nkoord", "hour", "lon", "lat"
    )


def typical_day_cars(spark, sf):
    return _round(profiles.typical_day_cars(_clean_cars(spark, sf)), flow_value=6, lon=8, lat=8).select(
        "msid", "richtung", "hour", "flow_value", "lon", "lat", "msname", "zsname", "achse"
    )


def station_hour(how: str):
    def run(spark, sf):
        hours = profiles.station_hours(profiles.clean_pedbike_counts(standin.counts_pedbike(spark, sf)), how)
        return _round(hours, **{n: 6 for n in hours.columns if n not in ("fk_standort", "hour")})

    return run


def classify_direction(spark, sf):
    return standin.counts_cars(spark, sf).select("id", direction.direction_kind(c("richtung")).alias("richtung_typ"))


def label_bearing(spark, sf):
    return standin.counts_cars(spark, sf).select("id", direction.label_bearing(c("richtung")).alias("bearing"))


def _seeds(spark, sf):
    return profiles.car_seeds(profiles.typical_day_cars(_clean_cars(spark, sf)))


def seed_bearing(spark, sf):
    return _round(_seeds(spark, sf), bearing_seed=6).select("msid", "richtung", "hour", "richtung_typ", "bearing_seed")


def direction_weights(spark, sf):
    seed = (c("u") * 37 % 360).cast("double")
    e = standin.net_edges(spark, sf)
    return _round(e.select(
        "u", "v", "key",
        direction.arc_between(seed, c("bearing")).alias("wide_arc"),
        direction.arc_or_null(seed, c("bearing")).alias("narrow_arc"),
        direction.linear_weight(seed, c("bearing")).alias("linear_weight"),
        direction.power_weight(seed, c("bearing"), 90.0, 2.0).alias("bike_weight"),
        direction.power_weight(seed, c("bearing"), 120.0, 1.0).alias("ped_weight"),
        direction.comfort_weight(c("highway"), direction.COMFORT_BIKE).alias("bike_comfort"),
        direction.comfort_weight(c("highway"), direction.COMFORT_PED).alias("ped_comfort"),
        direction.decay_per_100m(F.lit(1000.0), c("length")).alias("car_decay"),
        direction.decay_per_metre(F.lit(1000.0), c("length"), 0.0015).alias("bike_decay"),
    ), wide_arc=6, narrow_arc=6, linear_weight=6, bike_weight=6, ped_weight=6, car_decay=6, bike_decay=6)


def _geographic_nodes(spark, sf):
    return standin.net_nodes(spark, sf).select(
        "node_id", geo.lv95_to_lon(c("x"), c("y")).alias("lon"), geo.lv95_to_lat(c("x"), c("y")).alias("lat")
    )


def lv95_to_wgs84(spark, sf):
    nodes = _geographic_nodes(spark, sf)
    back = nodes.select("*", geo.wgs84_to_east(c("lon"), c("lat")).alias("east"),
                        geo.wgs84_to_north(c("lon"), c("lat")).alias("north"))
    return _round(back, lon=8, lat=8, east=4, north=4)


def edge_bearings(spark, sf):
    edges = standin.net_edges(spark, sf).select("u", "v", "key")
    return _round(network.edge_bearings(edges, _geographic_nodes(spark, sf)), bearing=5).select("u", "v", "key", "bearing")


def _areas(spark, sf):
    return imp.sight_areas(standin.frontages(spark, sf)).select("objectid", "gwr_egid", "bezeichnung", "rings")


def visibility_quads(spark, sf):
    parts = _areas(spark, sf).select("objectid", F.posexplode("rings").alias("pos", "ring"))
    corners = parts.select("objectid", "pos", F.posexplode("ring").alias("k", "p"))
    return _round(corners.select("objectid", "pos", "k", "p.x", "p.y"), x=4, y=4)


def visibility_centroid(spark, sf):
    return _round(visibility.sight_table(standin.frontages(spark, sf)), x_lon_center=7, y_lat_centre=7).select(
        "objectid", "x_lon_center", "y_lat_centre"
    )


def _numbered(spark, sf):
    return network.with_edge_ids(standin.net_edges(spark, sf))


def edge_ids(spark, sf):
    return _numbered(spark, sf).select("edge_id", "u", "v", "key")


def flow_edge_ids(spark, sf):
    flows = standin.flows_bike(standin.net_edges(spark, sf).select("u", "v", "key"))
    return network.attach_edge_ids(flows, _numbered(spark, sf)).select("edge_id", "hour", "flow")


def _cars_with_ids(spark, sf):
    return standin.flows_cars(_numbered(spark, sf).select("u", "v", "key", "edge_id"))


def time_of_day_buckets(spark, sf):
    per = profiles.period_flows(_cars_with_ids(spark, sf), ["edge_id"], "total_flow")
    return _round(profiles.line_widths(per, "total_flow"), weight=6)


def time_of_day_means(spark, sf):
    return _round(profiles.period_flows(_cars_with_ids(spark, sf), ["edge_id"], "total_flow", "mean"), total_flow=6)


def transit_time_of_day(spark, sf):
    flows = standin.flows_transit(spark, sf).withColumn("edge_id", F.concat_ws("_", "haltestellen_id", "nach_hst_id"))
    per = profiles.period_flows(flows, ["edge_id"], "flow_besetzung")
    return _round(profiles.line_widths(per, "flow_besetzung", 0.3, 3.5), weight=6)


def incremental_pull(spark, sf):
    return landing.new_records(standin.counts_cars(spark, sf), 2024, "2024-01-15T12:00:00", 1000)


def next_watermark(spark, sf):
    return landing.watermark(standin.counts_cars(spark, sf))


def landing_by_day(spark, sf):
    return landing.day_counts(landing.month_slice(standin.counts_pedbike(spark, sf), "datum", 2024, 1), "datum")


def upsert_month(spark, sf):
    stored = standin.counts_cars(spark, sf)
    arrived = stored.filter(c("richtung") == "Oerlikon").withColumn("anz_fahrzeuge", F.lit("corrected"))
    return landing.merge_months(stored, arrived).select("id", "messung_dat_zeit", "msid", "anz_fahrzeuge")


def audit_summary(spark, sf):
    kind = c("event_type")
    audit = standin.table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.floor("value").alias("records"),
        F.when(kind == "view", "success").when(kind == "error", "error").otherwise("no_new_data").alias("status"),
    )
    return landing.run_summary(audit)


def table_fingerprint(spark, sf):
    """Over all columns; the price in whole cents and the date as days, so that both sides write them alike."""
    orders = standin.table(spark, sf, "orders")
    return landing.fingerprint(orders.withColumns({
        "o_totalprice": F.round(c("o_totalprice") * 100).cast("bigint"), "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    }))


def _events(spark, sf):
    return standin.table(spark, sf, "events").select(
        c("event_id").alias("id"), c("ts").cast("timestamp").alias("ts"), c("user_id").alias("msid"), c("value").alias("flow")
    )


def _run_folder(spark, label: str) -> str:
    return f"{scratch_root(spark)}/kerbsight/{label}-{uuid.uuid4().hex}"


def _stream(spark, sf, folder: str, copies: int = 1):
    """The events landed as files whose times overlap, one file for each micro-batch."""
    rows = _events(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    rows.repartition(LANDED_FILES, F.xxhash64("id", F.rand(7))).write.parquet(f"{folder}/landed")
    return streaming.read_landed(spark, f"{folder}/landed", rows.schema, files_per_batch=1)


def stream_hourly_counts(spark, sf):
    folder = _run_folder(spark, "stream")
    streaming.collect_parts(
        _stream(spark, sf, folder), f"{folder}/out", f"{folder}/state", streaming.hour_parts, streaming.added)
    rows = streaming.hourly_means(streaming.read_parts(spark, f"{folder}/out"))
    return _round(rows, mean_flow=6).withColumn("hour_start", c("hour_start").cast("timestamp_ntz"))


def stream_deduped(spark, sf):
    """Every event arrives twice, in any two files; one copy of each stays."""
    folder = _run_folder(spark, "stream")
    streaming.collect_parts(
        _stream(spark, sf, folder, copies=2), f"{folder}/out", f"{folder}/state", streaming.first_copies, streaming.first_copies)
    rows = streaming.first_copies(streaming.read_parts(spark, f"{folder}/out"))
    return rows.withColumn("ts", c("ts").cast("timestamp_ntz"))


def nearest_edge_ties(spark, sf):
    places = profiles.station_places(profiles.clean_pedbike_counts(standin.counts_pedbike(spark, sf)))
    points = places.select("fk_standort", c("ost").alias("px"), c("nord").alias("py"))
    return _round(nearest_edges(points, ["fk_standort"], standin.net_edges(spark, sf)), dist=4)


def nearest_edge_crowded(spark, sf):
    """The same, with a segment for every order inside one square metre."""
    places = profiles.station_places(profiles.clean_pedbike_counts(standin.counts_pedbike(spark, sf)))
    points = places.select("fk_standort", c("ost").alias("px"), c("nord").alias("py"))
    return _round(nearest_edges(points, ["fk_standort"], standin.crowded_edges(spark, sf)), dist=4)


def nearest_edge_one(spark, sf):
    placed = car_flows.placed_seeds(standin.counts_cars(spark, sf), standin.net_edges(spark, sf))
    return _round(placed, dist=4).select("msid", "richtung", "hour", "u", "v", "key", "dist", "start_node")


def _near_network(spark, sf):
    matched = profiles.match_stops(standin.stops(spark, sf), standin.gtfs_stops(spark, sf))
    return transit_flows.network_near_stops(matched, standin.net_nodes(spark, sf), standin.net_edges(spark, sf))


def _stop_nodes(spark, sf):
    nodes, _ = _near_network(spark, sf)
    return transit_flows.stop_nodes(standin.stops(spark, sf), standin.gtfs_stops(spark, sf), nodes)


def nearest_node(spark, sf):
    return _stop_nodes(spark, sf)


def spatial_intersects(spark, sf):
    return meets(_areas(spark, sf), ["objectid"], _numbered(spark, sf), ["edge_id"])


def propagate_mode(mode: str):
    def run(spark, sf):
        return _round(pedbike_flows.raw_flows(
            standin.counts_pedbike(spark, sf), _numbered(spark, sf), mode
        ), flow=4)

    return run


def path_gold(mode: str):
    def run(spark, sf):
        _, flows = pedbike_flows.path_flows(standin.counts_pedbike(spark, sf), standin.net_edges(spark, sf), mode)
        return _round(flows, flow=4, flow_norm=6)

    return run


def propagate_cars(spark, sf):
    edges = standin.net_edges(spark, sf)
    seeds = car_flows.propagation_seeds(car_flows.placed_seeds(standin.counts_cars(spark, sf), edges))
    return _round(propagate.propagate_cars(seeds, edges), total_flow=4)


def car_flow_gold(spark, sf):
    _, flows = car_flows.car_flows(standin.counts_cars(spark, sf), standin.net_edges(spark, sf))
    return _round(flows, total_flow=4, flow_norm=6).select("edge_id", "hour", "total_flow", "flow_norm")


def mass_balance(spark, sf):
    seeds = profiles.typical_day_cars(_clean_cars(spark, sf))
    balanced = propagate.mass_balance(_cars_with_ids(spark, sf), seeds, seed_flow="flow_value")
    return _round(propagate.normalize_per_hour(balanced), total_flow=6, flow_norm=6).select(
        "edge_id", "hour", "total_flow", "flow_norm"
    )


def _segment_hours(spark, sf):
    runs = profiles.weekday_runs(
        profiles.clean_transit_runs(standin.transit_runs(spark, sf)), standin.day_types(spark, sf)
    )
    return profiles.segment_hours(runs)


def network_core(spark, sf):
    """What the largest core reaches, and what reaches it, if two streets of three lead to the larger node only."""
    edges = standin.net_edges(spark, sf).where((c("u") < c("v")) | ((c("u") + c("v")) % 3 == 0))
    bit = lambda name: c(name).bitwiseAND(F.lit(1)) == 1  # noqa: E731 - the first bit is that of the largest core
    return reach.labels(edges).select("node", bit("after").alias("reached"), bit("before").alias("reaches"))


def stop_paths(spark, sf):
    at = cut(_stop_nodes(spark, sf))
    start = at.select("haltestellen_id", c("node_id").alias("src"))
    end = at.select(c("haltestellen_id").alias("nach_hst_id"), c("node_id").alias("dst"))
    pairs = _segment_hours(spark, sf).join(start, "haltestellen_id").join(end, "nach_hst_id").select("src", "dst")
    return _round(shortest_paths(pairs, _near_network(spark, sf)[1]), length=4)


def transit_segment_daily(spark, sf):
    return profiles.segment_days(_segment_hours(spark, sf))


def transit_flow_gold(spark, sf):
    _, daily = transit_flows.transit_flows(
        standin.transit_runs(spark, sf), standin.day_types(spark, sf), standin.stops(spark, sf),
        standin.gtfs_stops(spark, sf), standin.net_nodes(spark, sf), standin.net_edges(spark, sf),
    )
    return _round(daily.withColumn("n_vertices", F.size(F.element_at("geom", 1))), length=4).drop("geom")


def stop_match(spark, sf):
    matched = profiles.match_stops(standin.stops(spark, sf), standin.gtfs_stops(spark, sf))
    return _round(matched, stop_lat=8, stop_lon=8).select("haltestellen_id", "name_norm", "stop_lat", "stop_lon")


def stop_coverage(spark, sf):
    matched = profiles.match_stops(standin.stops(spark, sf), standin.gtfs_stops(spark, sf))
    return _round(profiles.match_coverage(matched), coverage_pct=6)


def extent_clip(spark, sf):
    return _near_network(spark, sf)[1].select("u", "v", "key")


def _items(spark, sf):
    """Gold edge and flow tables of the four modes, reduced to items."""
    edges = _numbered(spark, sf).select("u", "v", "key", "edge_id", "geom")
    ids = edges.select("u", "v", "key", "edge_id")
    return frontage_impressions.mode_items(
        (edges, standin.flows_bike(ids)), (edges, standin.flows_ped(ids)), (edges, standin.flows_cars(ids)),
        standin.flows_transit(spark, sf),
    )


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(*[
        c(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else c(f.name) for f in df.schema.fields
    ])


def impressions_of(mode: str | None):
    def run(spark, sf):
        areas, items = _areas(spark, sf), _items(spark, sf)
        if mode:
            items = [items[imp.MODES.index(mode)]]
        rows = imp.with_frontage(imp.impressions(areas, items), areas)
        return _plain(rows.withColumnRenamed("mode", "flow_type")).select(
            "gwr_egid", "objectid", "bezeichnung", "flow_type", "affected_corridors", "total_impressions", "avg_flow"
        )

    return run


def impressions_summary(spark, sf):
    areas = cut(_areas(spark, sf), "areas")
    table = frontage_impressions.impressions_summary(with_centroid(areas), _items(spark, sf), areas)
    return _plain(imp.top_frontages(table))


def summary_check(spark, sf):
    return imp.summary_check(imp.summary(imp.impressions(_areas(spark, sf), _items(spark, sf))))


def _gold_tables(spark, sf):
    """All eight gold tables, with rows that break each rule: repeated keys, missing geometries, flows without an edge."""
    edges = cut(_numbered(spark, sf).select("edge_id", "u", "v", "key", "geom"))

    def repeated(df):
        return df.unionByName(df.filter(c("edge_id") % 10 == 0))

    def lost(df):
        return repeated(df).withColumn("edge_id", F.when(c("edge_id") % 17 == 0, c("edge_id") + 10**9).otherwise(c("edge_id")))

    def blank(df):
        return repeated(df).withColumn("geometry", F.when(c("edge_id") % 13 != 0, c("geometry")))

    written = blank(wkb.to_wkb(edges))
    plain = lambda flows: propagate.normalize_overall(flows.drop("geom"))
    return {
        "frontage_visibility": visibility.visibility_gold(standin.frontages(spark, sf)),
        "bike_edges": written, "ped_edges": written, "motorized_traffic_edges": written,
        "bike_flows": lost(plain(standin.flows_bike(edges))), "ped_flows": lost(plain(standin.flows_ped(edges))),
        "motorized_traffic_flows": lost(standin.flows_cars(edges).drop("geom")),
        "transit_flows_hourly": wkb.to_wkb(standin.flows_transit(spark, sf)),
    }


def gold_checks(spark, sf):
    return gold.gold_checks(_gold_tables(spark, sf))


def publish_gold(spark, sf):
    """Publish all gold tables, then check what was written."""
    _, report = gold.publish_checked(_gold_tables(spark, sf), _run_folder(spark, "gold"))
    return report


def released_summary(spark, sf):
    """The models' tables under a version, released and summarised from what is published, after a broken release was refused."""
    folder = _run_folder(spark, "release")
    edges = cut(_numbered(spark, sf).select("edge_id", "u", "v", "key", "geom"))
    flows = {"bike": standin.flows_bike(edges), "ped": standin.flows_ped(edges), "motorized_traffic": standin.flows_cars(edges)}
    gold_tables = {
        "frontage_visibility": visibility.visibility_gold(standin.frontages(spark, sf)),
        "transit_flows_hourly": wkb.to_wkb(standin.flows_transit(spark, sf)),
    }
    for name, rows in flows.items():
        rows = rows if name == "motorized_traffic" else propagate.normalize_overall(rows.drop("geom"))
        tables.write_normalized(wkb.to_wkb(edges), rows, f"{folder}/models", name, "v1", ["hour"])
        for part in (f"{name}_edges", f"{name}_flows"):
            gold_tables[part] = spark.read.parquet(tables.versioned(f"{folder}/models", part, "v1"))
    release.release(gold_tables, folder, "v1")
    refused = release.release(_gold_tables(spark, sf), folder, "v2")
    table = imp.top_frontages(release.rebuild_summary(spark, folder))
    return _plain(table).withColumns({"released": F.lit(",".join(release.switches(spark, folder))), "refused": F.lit(",".join(refused))})


def partition_refresh(spark, sf):
    """Orders by month: a first load, one without changes, and one with a changed month and one month gone."""
    folder = _run_folder(spark, "refresh")
    orders = standin.table(spark, sf, "orders").select(
        "o_orderkey", F.round(c("o_totalprice") * 100).cast("bigint").alias("cents"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    ends = orders.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    later = orders.where(c("month") < hi).withColumn("cents", c("cents") + (c("month") == lo).cast("bigint"))
    for run, rows in enumerate((orders, orders, later)):
        report = landing.refresh_partitions(rows, f"{folder}/rows", f"{folder}/state", "month", "orders", str(run), f"{folder}/audit")
    stored = spark.read.schema(orders.schema).parquet(f"{folder}/rows").groupBy("month").agg(F.sum("cents").alias("cents"))
    audit = spark.read.parquet(f"{folder}/audit")
    return report.join(stored, "month", "left").withColumns({
        "idle_runs": audit.agg(F.count_if(c("status") == "no_new_data")).scalar(), "rows_written": audit.agg(F.sum("records")).scalar()})


def envelope_landing(spark, sf):
    """An envelope for every user and day of the events, some cut off in the middle, landed by day from a stream."""
    folder = _run_folder(spark, "envelopes")
    time = F.when(c("event_id") % 11 == 0, "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    event = F.struct("event_id", time.alias("time"), F.round(c("value") * 100).cast("bigint").alias("cents"))
    packed = standin.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.collect_list(event).alias("data"))
    text = F.to_json(F.struct("user_id", "data"))
    cut_off = F.when(c("user_id") % 7 == 0, F.substring(text, F.lit(1), F.length(text) - 9)).otherwise(text)
    packed.select(cut_off.alias("value")).repartition(6).write.text(f"{folder}/landed")
    documents = envelopes.read_documents(spark, f"{folder}/landed", whole_files=False, files_per_batch=2)
    envelopes.land_envelopes(documents, f"{folder}/out", f"{folder}/state", "event_id bigint, time string, cents bigint", "time")
    days = spark.read.parquet(f"{folder}/out/days").groupBy(c("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    aside = spark.read.parquet(f"{folder}/out/aside").agg(F.count_if(c("kind") == "document").alias("d"), F.count_if(c("kind") == "record").alias("r"))
    audit = spark.read.parquet(f"{folder}/out/audit").agg(F.sum("documents").alias("d"), F.sum("records").alias("r"))
    return days.withColumns({
        "broken": aside.select("d").scalar(), "undated": aside.select("r").scalar(),
        "documents": audit.select("d").scalar(), "records": audit.select("r").scalar()})


def landed_days(spark, sf):
    """Raw records of a month in one folder per day, counted from the folders."""
    folder = _run_folder(spark, "landed")
    landing.land_by_day(landing.month_slice(standin.counts_pedbike(spark, sf), "datum", 2024, 1), "datum", folder)
    parts = spark.read.parquet(folder).select(*[c(n).cast("int").alias(n) for n in ("year", "month", "day")])
    return parts.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


def named_files(spark, sf):
    return tables.read_counts(spark, sf, "suppl")


def csv_tables(spark, sf):
    """A reference table as semicolon-separated text and back."""
    folder = _run_folder(spark, "csv")
    standin.stops(spark, sf).write.option("header", "true").option("sep", ";").option("ignoreTrailingWhiteSpace", "false").csv(folder)
    return tables.read_csv(spark, folder, ";", "haltestellen_id bigint, haltestellenlangname string")


def snap_stats(spark, sf):
    placed = car_flows.placed_seeds(standin.counts_cars(spark, sf), standin.net_edges(spark, sf))
    stats = checks.describe(cut(placed), "dist")
    return _round(stats, **{n: 4 for n in stats.columns if n != "n"})


def direction_counts(spark, sf):
    return checks.value_counts(_seeds(spark, sf), "richtung_typ")


def network_extent(spark, sf):
    west, south, east, north = geo.extent(c("geom"))
    return standin.net_edges(spark, sf).agg(
        F.min(west).alias("min_x"), F.min(south).alias("min_y"), F.max(east).alias("max_x"), F.max(north).alias("max_y")
    )


def visibility_gold(spark, sf):
    table = visibility.visibility_gold(standin.frontages(spark, sf))
    return _round(table, x_lon_center=7, y_lat_centre=7).select(
        "objectid", "gwr_egid", "bezeichnung", "x_lon_center", "y_lat_centre", F.octet_length("geometry").alias("n_bytes")
    )


def ingest_run(spark, sf):
    """A first half, a run that fails before its watermark is stored, its repetition, and a run without anything new.

    Months, raw rows and rejects are compared row by row; the audit gives the sums."""
    base = _run_folder(spark, "ingest")
    folders = ingest.Folders(*[f"{base}/{n}" for n in ("raw", "months", "state", "audit")])
    no_month = F.when(c("id") % 389 == 0, F.regexp_replace("messung_dat_zeit", r"^2024-\d\d", "2024-00")).otherwise(c("messung_dat_zeit"))
    source = standin.counts_cars(spark, sf).withColumn("messung_dat_zeit", no_month)
    source = source.withColumnsRenamed({"id": "_id", "messung_dat_zeit": "MessungDatZeit"})
    early = F.coalesce(c("MessungDatZeit") < "2024-01-16", F.lit(False))
    ingest.ingest_year(source.filter(early), 2024, "cars", "half", folders)
    try:
        ingest.ingest_year(source, 2024, "cars", "failed", folders, before_state=_broken)
    except ConnectionError:
        pass
    for run_id in ("repeated", "idle"):
        ingest.ingest_year(source, 2024, "cars", run_id, folders)
    audit = spark.read.parquet(folders.audit)
    runs = landing.run_summary(audit).agg(F.sum("units_no_new_data")).scalar()
    note = F.from_json("message", "records_arrived long, records_written long, records_rejected long")
    sums = audit.filter("status = 'success'").select(note.alias("m")).agg(
        F.sum("m.records_arrived").alias("arrived"), F.sum(c("m.records_written") + c("m.records_rejected")).alias("accounted"))
    months = spark.read.parquet(folders.months).select(c("id").cast("string").alias("id"), "messung_dat_zeit", "msid", "anz_fahrzeuge", F.lit("months").alias("place"))
    raw = spark.read.parquet(folders.raw).select(c("_id").cast("string").alias("id"), c("MessungDatZeit").alias("messung_dat_zeit"), "msid", "anz_fahrzeuge", F.lit("raw").alias("place"))
    rows = months.unionByName(raw)
    if landing.exists(spark, landing.rejects_folder(folders.months)):
        bad = spark.read.parquet(landing.rejects_folder(folders.months))
        rows = rows.unionByName(bad.select(c("id").cast("string").alias("id"), "messung_dat_zeit", "msid", "anz_fahrzeuge", F.lit("rejects").alias("place")))
    return rows.withColumns({"idle_runs": runs, "arrived": sums.select("arrived").scalar(), "accounted": sums.select("accounted").scalar()})


def _broken() -> None:
    raise ConnectionError("the state store cannot be reached")


def stream_upsert(spark, sf):
    """Month partitions filled from a stream of landed records."""
    folder = _run_folder(spark, "stream")
    counts = _stream(spark, sf, folder).select(
        "id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("messung_dat_zeit"), "msid", "flow"
    )
    streaming.ingest_months(counts, f"{folder}/months", f"{folder}/state")
    return spark.read.parquet(f"{folder}/months").select("id", "messung_dat_zeit", "msid", "flow")


def geometry_roundtrip(spark, sf):
    edges = standin.net_edges(spark, sf).select("u", "v", "key", "geom")
    line = F.element_at("geom", 1)
    return wkb.from_wkb(wkb.to_wkb(edges)).select(
        "u", "v", "key", F.element_at(line, 1)["x"].alias("x1"), F.element_at(line, 1)["y"].alias("y1"),
        F.element_at(line, -1)["x"].alias("x2"), F.element_at(line, -1)["y"].alias("y2"), F.size(line).alias("n_vertices"),
    )


def _text_queries():
    """The module of the training-data queries, or None where that subpackage or its pipeline is not installed."""
    try:
        from kerbsight.llm import queries as module
    except ModuleNotFoundError as missing:
        if missing.name not in ("kerbsight.llm", "corpus_pipeline"):
            raise
        return None
    return module


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator, each over the whole driver tables."""
    texts = _text_queries()
    return {
        **(texts.QUERIES if texts else {}),
        "conform_counts": conform_counts,
        "typical_day_cars": typical_day_cars,
        **{f"station_hour_{how}": station_hour(how) for how in ("mean", "sum", "median")},
        "classify_direction": classify_direction,
        "label_bearing": label_bearing,
        "seed_bearing": seed_bearing,
        "direction_weights": direction_weights,
        "lv95_to_wgs84": lv95_to_wgs84,
        "edge_bearings": edge_bearings,
        "visibility_quads": visibility_quads,
        "visibility_centroid": visibility_centroid,
        "edge_ids": edge_ids,
        "flow_edge_ids": flow_edge_ids,
        "time_of_day_buckets": time_of_day_buckets,
        "time_of_day_means": time_of_day_means,
        "transit_time_of_day": transit_time_of_day,
        "incremental_pull": incremental_pull,
        "next_watermark": next_watermark,
        "landing_by_day": landing_by_day,
        "upsert_month": upsert_month,
        "audit_summary": audit_summary,
        "table_fingerprint": table_fingerprint,
        "stream_hourly_counts": stream_hourly_counts,
        "stream_deduped": stream_deduped,
        "nearest_edge_ties": nearest_edge_ties,
        "nearest_edge_crowded": nearest_edge_crowded,
        "nearest_edge_one": nearest_edge_one,
        "nearest_node": nearest_node,
        "spatial_intersects": spatial_intersects,
        "propagate_bike": propagate_mode("bike"),
        "propagate_ped": propagate_mode("pedestrian"),
        "bike_flows": path_gold("bike"),
        "ped_flows": path_gold("pedestrian"),
        "propagate_cars": propagate_cars,
        "car_flows": car_flow_gold,
        "mass_balance": mass_balance,
        "shortest_paths": stop_paths,
        "transit_segment_hour": _segment_hours,
        "transit_segment_daily": transit_segment_daily,
        "transit_flows": transit_flow_gold,
        "stop_match": stop_match,
        "stop_coverage": stop_coverage,
        "extent_clip": extent_clip,
        **{f"impressions_{mode}": impressions_of(mode) for mode in imp.MODES},
        "impressions_all": impressions_of(None),
        "impressions_summary": impressions_summary,
        "summary_check": summary_check,
        "gold_checks": gold_checks,
        "snap_stats": snap_stats,
        "direction_counts": direction_counts,
        "geometry_roundtrip": geometry_roundtrip,
        "network_extent": network_extent,
        "network_core": network_core,
        "publish_gold": publish_gold,
        "released_summary": released_summary,
        "envelope_landing": envelope_landing,
        "partition_refresh": partition_refresh,
        "landed_days": landed_days,
        "named_files": named_files,
        "csv_tables": csv_tables,
        "visibility_gold": visibility_gold,
        "ingest_run": ingest_run,
        "stream_upsert": stream_upsert,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Which frontages are seen most? Smoke run on the smallest tables."""
    return impressions_summary(spark, "/root/testdata/sf0.001")


def oracle_sql() -> dict[str, str]:
    texts = _text_queries()
    return {**oracles.oracle_sql(), **(texts.ORACLES if texts else {})}
