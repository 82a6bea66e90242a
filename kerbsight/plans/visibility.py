"""Frontage lines to the published sight-area table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.operators.centroid import with_centroid
from kerbsight.operators.impressions import sight_areas
from kerbsight.session import cut
from kerbsight.sources.wkb import drop_empty, to_wkb


def sight_table(frontages: DataFrame, wgs84: bool = False, max_rows: int | None = None, **options) -> DataFrame:
    """Sight rings (LV95) and WGS84 centroid per frontage.

    ``frontages`` has ``objectid, gwr_egid, bezeichnung, geom``; with ``wgs84`` the
    lines are degrees and are brought to metres first. ``max_rows`` is for dry runs.
    """
    lines = drop_empty(frontages if max_rows is None else frontages.limit(max_rows))
    if wgs84:
        lines = lines.withColumn("geom", geo.geom_to_lv95(F.col("geom")))
    areas = sight_areas(lines, **options).select("objectid", "gwr_egid", "bezeichnung", "rings")
    return with_centroid(cut(areas, "areas"))


def visibility_gold(frontages: DataFrame, **options) -> DataFrame:
    """The published table: attributes, WKB polygon and centroid."""
    return to_wkb(sight_table(frontages, **options), "rings", "geometry", polygon=True)
