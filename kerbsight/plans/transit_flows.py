"""Transit runs to flows on street-following lines between stops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.functions.cleaning import whole_id
from kerbsight.operators.checks import clip_to_extent
from kerbsight.operators.nearest import nearest_nodes
from kerbsight.operators.paths import path_lines, shortest_paths
from kerbsight.operators.profiles import clean_transit_runs, match_stops, segment_days, segment_hours, weekday_runs
from kerbsight.session import cut


def stop_nodes(stops: DataFrame, feed_stops: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nearest network node per stop that has a position."""
    placed = match_stops(stops, feed_stops).dropna(subset=["stop_lat", "stop_lon"]).select(
        whole_id("haltestellen_id").alias("haltestellen_id"),
        geo.wgs84_to_east(F.col("stop_lon"), F.col("stop_lat")).alias("px"),
        geo.wgs84_to_north(F.col("stop_lon"), F.col("stop_lat")).alias("py"),
    ).groupBy("haltestellen_id").agg(F.min(F.struct("px", "py")).alias("p")).select("haltestellen_id", "p.*")
    return nearest_nodes(placed, ["haltestellen_id"], nodes).select("haltestellen_id", "node_id")


def segment_lines(segments: DataFrame, at_node: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Routed line per distinct stop pair; pairs without a route give no row."""
    start = at_node.select("haltestellen_id", F.col("node_id").alias("src"))
    end = at_node.select(F.col("haltestellen_id").alias("nach_hst_id"), F.col("node_id").alias("dst"))
    pairs = cut(
        segments.select("haltestellen_id", "nach_hst_id").distinct()
        .join(start, "haltestellen_id").join(end, "nach_hst_id"), "stop-pairs",
    )
    lines = path_lines(shortest_paths(pairs, edges), nodes)
    return pairs.join(lines, ["src", "dst"]).select("haltestellen_id", "nach_hst_id", "length", "geom")


def network_near_stops(matched: DataFrame, nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Network inside the extent of the placed stops plus a margin."""
    points = matched.dropna(subset=["stop_lat", "stop_lon"]).select(
        F.col("stop_lon").alias("lon"), F.col("stop_lat").alias("lat")
    )
    geographic = nodes.withColumn("lon", geo.lv95_to_lon(F.col("x"), F.col("y"))).withColumn(
        "lat", geo.lv95_to_lat(F.col("x"), F.col("y"))
    )
    return clip_to_extent(points, geographic, edges)


def transit_flows(runs: DataFrame, day_types: DataFrame, stops: DataFrame, feed_stops: DataFrame, nodes: DataFrame,
                  edges: DataFrame, level: str = "daily") -> tuple[DataFrame, DataFrame]:
    """Routed edges per stop pair, and flows per pair (``daily``) or pair and hour (``hourly``)."""
    if level not in ("daily", "hourly"):
        raise ValueError(f"unknown level {level!r}")
    hourly = cut(segment_hours(weekday_runs(clean_transit_runs(runs), day_types)), "segment-hours")
    near_nodes, near_edges = network_near_stops(match_stops(stops, feed_stops), nodes, edges)
    near_nodes, near_edges = cut(near_nodes, "near-nodes"), cut(near_edges, "near-edges")
    lines = cut(segment_lines(hourly, stop_nodes(stops, feed_stops, near_nodes), near_nodes, near_edges), "segment-lines")
    routed = hourly.join(lines, ["haltestellen_id", "nach_hst_id"])
    return lines, (routed if level == "hourly" else segment_days(routed, carry=["geom", "length"]))
