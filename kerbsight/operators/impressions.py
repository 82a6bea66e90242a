"""Impressions per frontage: flows on the edges that its sight area touches.

Flows are reduced to one row per edge (sum and number of positive hours) before the
spatial join, and the four modes share one join, so the frontage side is read and
exploded once and no hourly row takes part in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.functions.cleaning import rounded
from kerbsight.operators.spatial_join import meets
from kerbsight.session import cut

MODES = ["transit", "bike", "pedestrian", "motorized"]
#: flows are summed as exact decimals, so the totals do not depend on the row order
EXACT = "decimal(28,8)"


def sight_areas(frontages: DataFrame, **options) -> DataFrame:
    """Frontages with their sight ``rings``; those without any ring go."""
    walls = frontages.filter(F.exists("geom", geo.has_length))
    return walls.withColumn("rings", geo.sight_rings(F.col("geom"), **options))


def edge_items(edges: DataFrame, flows: DataFrame, mode: str, flow: str = "flow") -> DataFrame:
    """One row per edge with a positive flow."""
    exact = F.col(flow).cast(EXACT)
    per_edge = flows.filter(F.col(flow) > 0).groupBy("edge_id").agg(
        F.sum(exact).alias("flow_sum"), F.count(F.lit(1)).alias("flow_n")
    )
    return edges.join(per_edge, "edge_id").select(
        F.lit(mode).alias("mode"), F.col("edge_id").cast("string").alias("corridor"),
        F.col("edge_id").cast("string").alias("item"), "geom", "flow_sum", "flow_n",
    )


def transit_items(flows: DataFrame, exact_pairs: bool = False) -> DataFrame:
    """One row per stop pair and line with a positive flow.

    A corridor is the two ids written together without a separator; ``exact_pairs``
    keeps pairs apart whose ids happen to give the same text.
    """
    corridor = F.concat_ws("_" if exact_pairs else "", "haltestellen_id", "nach_hst_id")
    item = F.concat_ws("_", "haltestellen_id", "nach_hst_id")
    return (
        flows.filter(F.col("flow_besetzung") > 0)
        .groupBy(corridor.alias("corridor"), item.alias("item"), "geom")
        .agg(F.sum(F.col("flow_besetzung").cast(EXACT)).alias("flow_sum"), F.count(F.lit(1)).alias("flow_n"))
        .select(F.lit("transit").alias("mode"), "corridor",
                F.concat_ws("|", "item", F.hex(F.xxhash64("geom"))).alias("item"), "geom", "flow_sum", "flow_n")
    )


def impressions(areas: DataFrame, items: list[DataFrame], hot_rows: int = 4096) -> DataFrame:
    """Per frontage and mode: corridors, total (0 places) and mean flow (2 places)."""
    # one row per edge; measured and joined, so it is written once
    lines = cut(reduce(DataFrame.unionByName, items), "items")
    pairs = meets(areas, ["objectid"], lines, ["mode", "item"], ["corridor", "flow_sum", "flow_n"], hot_rows=hot_rows)
    total = F.sum("flow_sum")
    return pairs.groupBy("objectid", "mode").agg(
        F.count_distinct("corridor").alias("affected_corridors"),
        F.round(total, 0).alias("total_impressions"),
        rounded(total / F.sum("flow_n").cast("decimal(12,0)"), 2).alias("avg_flow"),
    )


def with_frontage(measures: DataFrame, areas: DataFrame) -> DataFrame:
    return measures.join(areas.select("objectid", "gwr_egid", "bezeichnung"), "objectid")


def summary(measures: DataFrame) -> DataFrame:
    """One row per frontage with three measures per mode and the grand total."""

    def of(mode: str, name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("mode") == mode, F.col(name))), F.lit(0))

    columns = []
    for mode, short, count in (("transit", "transit", "transit_corridors"), ("bike", "bike", "bike_edges"),
                               ("pedestrian", "ped", "ped_edges"), ("motorized", "motorized", "motorized_edges")):
        columns += [
            of(mode, "total_impressions").alias(f"{short}_total_impressions"),
            of(mode, "avg_flow").alias(f"{short}_avg_flow"), of(mode, "affected_corridors").alias(count),
        ]
    everything = F.coalesce(F.sum("total_impressions"), F.lit(0)).alias("total_all_impressions")
    return measures.groupBy("objectid").agg(*columns, everything)


def building_places(visibility: DataFrame) -> DataFrame:
    """One position per building: that of its frontage with the lowest id."""
    place = F.min_by(F.struct("x_lon_center", "y_lat_centre"), "objectid")
    return visibility.groupBy("gwr_egid").agg(place.alias("at")).select(
        "gwr_egid", rounded("at.x_lon_center", 6).alias("longitude"), rounded("at.y_lat_centre", 6).alias("latitude")
    )


def top_frontages(table: DataFrame) -> DataFrame:
    """Frontages with impressions, most first."""
    return table.filter(F.col("total_all_impressions") > 0).orderBy(F.desc("total_all_impressions"), "objectid")


def summary_check(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("total_all_impressions") > 0).alias("with_data")
    )
