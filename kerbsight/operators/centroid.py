"""WGS84 centroid of a sight area, also where its rings overlap."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbsight.functions import geo

# ship the helpers below with the job; workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def union_centroid(rings: list[np.ndarray]) -> tuple[float, float]:
    """Centroid of the union of a few convex rings, by vertical slabs.

    Between two neighbouring x values of vertices and edge crossings every ring is a
    trapezoid, and the order of its borders does not change; the union of the
    intervals at the slab's two sides is then exact.
    """
    edges = np.array([
        (*ring[i], *ring[(i + 1) % len(ring)]) for ring in rings for i in range(len(ring))
    ])
    origin = edges[:, :2].mean(axis=0)
    edges = edges - np.tile(origin, 2)
    owner = np.repeat(np.arange(len(rings)), [len(r) for r in rings])
    flip = edges[:, 0] > edges[:, 2]
    edges[flip] = edges[flip][:, [2, 3, 0, 1]]
    steep = edges[:, 0] < edges[:, 2]
    edges, owner = edges[steep], owner[steep]
    x1, y1, x2, y2 = edges.T
    slope = (y2 - y1) / (x2 - x1)
    rise = y1 - slope * x1
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = (rise[None, :] - rise[:, None]) / (slope[:, None] - slope[None, :])
    inside = np.isfinite(cross) & (cross > np.maximum.outer(x1, x1)) & (cross < np.minimum.outer(x2, x2))
    xs = np.unique(np.concatenate([x1, x2, cross[inside]]))
    area = mx = my = 0.0
    for left, right in zip(xs[:-1], xs[1:]):
        middle, width = (left + right) / 2, right - left
        here = (x1 <= middle) & (middle <= x2)
        spans = []
        for ring in np.unique(owner[here]):
            at = np.flatnonzero(here & (owner == ring))
            heights = rise[at] + slope[at] * middle
            spans.append((heights.min(), at[heights.argmin()], heights.max(), at[heights.argmax()]))
        spans.sort()
        merged: list[list] = []
        for low, low_edge, high, high_edge in spans:
            if merged and low <= merged[-1][2]:
                if high > merged[-1][2]:
                    merged[-1][2:] = [high, high_edge]
            else:
                merged.append([low, low_edge, high, high_edge])
        for _, b, _, t in merged:
            for edge, sign in ((t, 1.0), (b, -1.0)):
                ya, yb = rise[edge] + slope[edge] * left, rise[edge] + slope[edge] * right
                piece = sign * (ya + yb) / 2 * width
                area += piece
                mx += sign * width * (left * (2 * ya + yb) + right * (ya + 2 * yb)) / 6
                my += sign * width * (ya * ya + ya * yb + yb * yb) / 6
    if area <= 0:
        return float("nan"), float("nan")
    return mx / area + origin[0], my / area + origin[1]


def _apart(rings: list[np.ndarray]) -> bool:
    """True when no two bounding boxes overlap."""
    low, high = np.array([r.min(axis=0) for r in rings]), np.array([r.max(axis=0) for r in rings])
    meet = (low[:, None] <= high[None]).all(axis=2) & (low[None] <= high[:, None]).all(axis=2)
    return int(meet.sum()) == len(rings)


def area_centroid(rings: list[np.ndarray]) -> tuple[float, float]:
    """Centroid of the union of convex rings; a plain weighted mean when they are apart."""
    if not _apart(rings):
        return union_centroid(rings)
    origin = rings[0][0]
    area, first = 0.0, np.zeros(2)
    for ring in rings:
        a = ring - origin
        b = np.roll(a, -1, axis=0)
        cross = a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1]
        turn = 1.0 if cross.sum() >= 0 else -1.0
        area += turn * cross.sum() / 2
        first += turn * ((a + b) * cross[:, None]).sum(axis=0) / 6
    return (float(origin[0] + first[0] / area), float(origin[1] + first[1] / area)) if area else (float("nan"),) * 2


def with_centroid(areas: DataFrame, rings: str = "rings") -> DataFrame:
    """Add ``x_lon_center, y_lat_centre``, computed in degrees like the published table.

    An area of one quad is a formula on its eight coordinates. Only areas of several
    quads, which may overlap, go to Arrow batches for the centroid of their union.
    """
    degrees = areas.withColumn("_w", geo.geom_to_wgs84(F.col(rings)))
    ring = F.element_at("_w", 1)
    flat = degrees.filter(F.size(rings) == 1).withColumns({
        f"_{axis}{i}": F.element_at(ring, i + 1)[axis] for i in range(4) for axis in ("x", "y")
    })
    x, y = geo.polygon_centroid([(F.col(f"_x{i}"), F.col(f"_y{i}")) for i in range(4)])
    single = flat.withColumn("x_lon_center", x).withColumn("y_lat_centre", y).select(
        *areas.columns, "x_lon_center", "y_lat_centre"
    )
    several = degrees.filter(F.size(rings) > 1)
    out = T.StructType([
        *areas.schema.fields, T.StructField("x_lon_center", T.DoubleType()), T.StructField("y_lat_centre", T.DoubleType())
    ])

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            centres = [
                area_centroid([np.array([(v["x"], v["y"]) for v in part]) for part in shape]) for shape in frame["_w"]
            ]
            yield frame.drop(columns="_w").assign(
                x_lon_center=[c[0] for c in centres], y_lat_centre=[c[1] for c in centres]
            )

    return single.unionByName(several.mapInPandas(batches, out))
