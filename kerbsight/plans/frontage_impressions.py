"""The final product: one row per frontage with impressions of every mode."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbsight.operators import impressions as imp


def mode_items(bike: tuple[DataFrame, DataFrame], pedestrian: tuple[DataFrame, DataFrame],
               motorized: tuple[DataFrame, DataFrame], transit: DataFrame) -> list[DataFrame]:
    """Items of the four modes from ``(edges, flows)`` pairs and the transit table."""
    return [
        imp.transit_items(transit),
        imp.edge_items(*bike, "bike"),
        imp.edge_items(*pedestrian, "pedestrian"),
        imp.edge_items(*motorized, "motorized", flow="total_flow"),
    ]


def impressions_summary(visibility: DataFrame, items: list[DataFrame], areas: DataFrame | None = None) -> DataFrame:
    """Summary per frontage with the position of its building.

    ``visibility`` is the published sight table (rings and centroid). ``areas`` may give
    the same frontages without centroids, where those are still to be computed.
    Frontages without any positive hit have no row.
    """
    areas = visibility if areas is None else areas
    table = imp.with_frontage(imp.summary(imp.impressions(areas, items)), areas)
    return table.join(imp.building_places(visibility), "gwr_egid")
