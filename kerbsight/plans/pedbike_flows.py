"""Bike and pedestrian counts to hourly flows on their networks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.operators import propagate
from kerbsight.operators.nearest import nearest_edges
from kerbsight.operators.network import attach_edge_ids, with_edge_ids
from kerbsight.operators.profiles import clean_pedbike_counts, station_hours
from kerbsight.session import cut

# Which count columns belong to which model.
MODES = {
    "bike": ("velo_hour", "velo_in_share", "velo_out_share", propagate.BIKE),
    "pedestrian": ("fuss_hour", "fuss_in_share", "fuss_out_share", propagate.PED),
}


def snapped_hours(raw_counts: DataFrame, edges: DataFrame, mode: str, how: str = "mean") -> DataFrame:
    """Station hours with a positive count on all their nearest edges."""
    total = MODES[mode][0]
    hours = cut(station_hours(clean_pedbike_counts(raw_counts), how).filter(F.col(total) > 0), "station-hours")
    # a station has one place for all its hours
    places = hours.select("fk_standort", F.col("ost").alias("px"), F.col("nord").alias("py")).distinct()
    return hours.join(nearest_edges(places, ["fk_standort"], edges, ties=True), "fk_standort")


def raw_flows(raw_counts: DataFrame, edges: DataFrame, mode: str, how: str = "mean",
              model: propagate.PathModel | None = None) -> DataFrame:
    """Propagated flow per ``u, v, key, hour``; all hours run together."""
    total, in_share, out_share, default = MODES[mode]
    snapped = snapped_hours(raw_counts, edges, mode, how)
    seeds = cut(propagate.path_seeds(snapped, edges, total, in_share, out_share), "path-seeds")
    return propagate.propagate_paths(seeds, edges, model or default)


def path_flows(raw_counts: DataFrame, edges: DataFrame, mode: str, how: str = "mean",
               model: propagate.PathModel | None = None) -> tuple[DataFrame, DataFrame]:
    """Edge table with ``edge_id``, and flows normalized over the whole table."""
    numbered = with_edge_ids(edges)
    flows = cut(raw_flows(raw_counts, numbered, mode, how, model), f"{mode}-flows")
    with_ids = attach_edge_ids(flows, numbered, strict=True)
    return numbered, propagate.normalize_overall(with_ids).select("edge_id", "hour", "flow", "flow_norm")
