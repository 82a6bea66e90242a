"""Nearest-edge and nearest-node joins on a growing grid.

Round k uses cells of ``cell * 4^k`` metres. A point looks at its own cell and the
eight around it; it is settled once its best distance is no more than its distance
to the border of that block, because nothing outside can be nearer. Only unsettled
points go to the next, coarser round, so dense areas are served by small cells.

A coarse block may reach into a dense area. It is therefore not joined with segments
but narrowed down: level by level its occupied cells are divided, and cells that are
farther than the nearest occupied one could possibly be are dropped. Segments are
met in cells of the first size only.

Copies do no work: points that share coordinates and segments that share both ends
are searched once. The first cell size is made smaller while cells are crowded all
over the network. A few crowded cells do not change it: their pieces are dealt into
shares of bounded size, and a point that looks there asks every share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbsight.functions import geo
from kerbsight.operators.spatial_join import box_cells, piece_rows, segment_rows
from kerbsight.session import cut, cut_observed, dropped, row_count

MAX_ROUNDS = 12


ENDS = ["sx1", "sy1", "sx2", "sy2"]
BOX = ("sl", "sb", "sr", "st")
SMALLEST_CELL = 0.5
FEW_CROWDED = 100


def _distance(places: int = 6) -> Column:
    """Squared distance, rounded so that equal distances compare equal."""
    return F.round(
        geo.point_segment_sq(F.col("px"), F.col("py"), F.col("sx1"), F.col("sy1"), F.col("sx2"), F.col("sy2")), places
    )


def _same_way(segments: DataFrame) -> DataFrame:
    """Segments from their smaller end, so that both directions of a street are equal."""
    x1, y1, x2, y2 = (F.col(n) for n in ENDS)
    swap = (x2 < x1) | ((x2 == x1) & (y2 < y1))
    return segments.withColumns({
        "sx1": F.when(swap, x2).otherwise(x1), "sy1": F.when(swap, y2).otherwise(y1),
        "sx2": F.when(swap, x1).otherwise(x2), "sy2": F.when(swap, y1).otherwise(y2),
    })


def _pieces_and_cells(unique: DataFrame, cell: float, hot_rows: int) -> tuple[DataFrame, DataFrame, float]:
    """Segment pieces per cell and share, written once; the occupied cells with their number of shares; the cell size.

    The size is divided while more than one occupied cell in ``FEW_CROWDED`` holds over ``hot_rows`` pieces."""
    while True:
        pieces = cut(box_cells(piece_rows(unique, ["line"], cell), BOX, cell), "pieces")
        counted = pieces.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / hot_rows).cast("int").alias("shares"))
        occupied, seen = cut_observed(counted, "occupied", crowded=F.count_if(F.col("shares") > 1), cells=row_count())
        if seen["crowded"] * FEW_CROWDED <= seen["cells"] or cell <= SMALLEST_CELL:
            break
        dropped(pieces, occupied)
        cell /= 4
    if not seen["crowded"]:
        return pieces.withColumn("share", F.lit(0)), occupied, cell
    crowded = occupied.filter("shares > 1")
    dealt = pieces.join(crowded, ["cx", "cy"], "left")
    share = F.coalesce(F.pmod(F.xxhash64(*ENDS), F.col("shares")).cast("int"), F.lit(0))
    return dealt.withColumn("share", share).drop("shares"), occupied, cell


def _met(near: DataFrame, pieces: DataFrame, occupied: DataFrame) -> DataFrame:
    """Rows of points in cells with every piece there, share by share."""
    asked = near.join(occupied, ["cx", "cy"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    return asked.drop("shares").join(pieces, ["cx", "cy", "share"])


def _nearest(points: DataFrame, point_keys: list[str], lines: DataFrame, line_keys: list[str],
             ties: bool, cell: float, hot_rows: int) -> DataFrame:
    """``points`` has unique ``point_keys`` and ``px, py``; ``lines`` has ``geom``."""
    segments = _same_way(segment_rows(lines, line_keys))
    # the smallest line stands for all lines that share a segment
    unique, size = cut_observed(
        segments.groupBy(*ENDS).agg(F.min(F.struct(*line_keys)).alias("line")), "segments", n=row_count()
    )
    if not size["n"]:
        raise ValueError("the network is empty")
    pieces, occupied, cell = _pieces_and_cells(unique, cell, hot_rows)
    todo = points.select(*point_keys, "px", "py")
    settled: list[DataFrame] = []
    for step in range(MAX_ROUNDS):
        near, margin = _near_cells(todo, point_keys, occupied, cell, step)
        winner = F.min(F.struct(_distance().alias("d2"), "line")).alias("w")
        best = _met(near, pieces, occupied).groupBy(*point_keys).agg(winner)
        tried = todo.join(best, point_keys, "left").withColumn(
            "done", F.coalesce(F.sqrt(F.col("w.d2")) <= margin, F.lit(False))
        )
        tried, seen = cut_observed(
            tried, f"nearest-{step}", done=F.count_if(F.col("done")), left=F.count_if(~F.col("done"))
        )
        if seen["done"]:
            found = tried.filter("done")
            if ties:
                # second look with the known distance: only the tied segments leave the join
                cells, _ = _near_cells(found, point_keys, occupied, cell, step)
                known = found.select(*point_keys, F.col("w.d2").alias("d2"))
                hits = _met(cells.join(known, point_keys), pieces, occupied).filter(_distance() <= F.col("d2"))
                tied = hits.select(*point_keys, *ENDS, F.sqrt("d2").alias("dist")).distinct()
                settled.append(tied.join(segments, ENDS).select(*point_keys, *line_keys, "dist").distinct())
            else:
                settled.append(found.select(
                    *point_keys, *[F.col("w.line")[k].alias(k) for k in line_keys], F.sqrt("w.d2").alias("dist")
                ))
        if not seen["left"]:
            break
        todo = tried.filter(~F.col("done")).select(*point_keys, "px", "py")
    else:
        raise ValueError("no network within reach of some points")
    return reduce(DataFrame.unionByName, settled)


def _near_cells(points: DataFrame, point_keys: list[str], occupied: DataFrame, cell: float,
                step: int) -> tuple[DataFrame, Column]:
    """First-size cells that can hold a point's nearest segment, if it lies in the 3 x 3
    block of round ``step``; and the point's distance to the border of that block."""
    size = cell * 4**step
    gx, gy = F.floor(F.col("px") / size), F.floor(F.col("py") / size)
    margin = F.least(
        F.col("px") - (gx - 1) * size, (gx + 2) * size - F.col("px"),
        F.col("py") - (gy - 1) * size, (gy + 2) * size - F.col("py"),
    )
    near = (
        points.select(*point_keys, "px", "py")
        .withColumn("cx", F.explode(F.sequence(gx - 1, gx + 1))).withColumn("cy", F.explode(F.sequence(gy - 1, gy + 1)))
    )
    per_point = Window.partitionBy(*point_keys)
    for level in range(step - 1, -1, -1):
        side, scale = cell * 4**level, 4**level
        there = occupied.select(F.floor(F.col("cx") / scale).alias("cx"), F.floor(F.col("cy") / scale).alias("cy")).distinct()
        quarter = F.sequence(F.lit(0), F.lit(3))
        parts = (
            near.withColumn("_i", F.explode(quarter)).withColumn("_j", F.explode(quarter))
            .select(*point_keys, "px", "py", (F.col("cx") * 4 + F.col("_i")).alias("cx"), (F.col("cy") * 4 + F.col("_j")).alias("cy"))
            .join(there, ["cx", "cy"])
        )
        left, bottom = F.col("cx") * side - F.col("px"), F.col("cy") * side - F.col("py")
        dx = F.greatest(left, -(left + side), F.lit(0.0))
        dy = F.greatest(bottom, -(bottom + side), F.lit(0.0))
        far_x, far_y = F.greatest(F.abs(left), F.abs(left + side)), F.greatest(F.abs(bottom), F.abs(bottom + side))
        # a piece in the cell may lie beside it, but by less than its own box
        reach = F.min(F.sqrt(far_x * far_x + far_y * far_y)).over(per_point) + 1.5 * cell
        near = (
            parts.withColumn("_lo", F.sqrt(dx * dx + dy * dy)).withColumn("_reach", reach)
            .filter(F.col("_lo") <= F.col("_reach")).drop("_lo", "_reach")
        )
    return near, margin


def nearest_edges(points: DataFrame, point_keys: list[str], edges: DataFrame, ties: bool = True,
                  cell: float = 32.0, hot_rows: int = 4096) -> DataFrame:
    """Edge(s) ``u, v, key`` nearest to each point and the distance in metres.

    With ``ties`` all equally near edges are kept (both directions of a street share
    their geometry); otherwise the smallest ``u, v, key`` wins.
    """
    return _per_place(points, point_keys, edges, ["u", "v", "key"], ties, cell, hot_rows)


def nearest_nodes(points: DataFrame, point_keys: list[str], nodes: DataFrame, cell: float = 32.0,
                  hot_rows: int = 4096) -> DataFrame:
    """The node nearest to each point, the smallest ``node_id`` on a tie."""
    here = geo.point(F.col("x"), F.col("y"))
    dots = nodes.select("node_id", F.array(F.array(here, here)).alias("geom"))
    return _per_place(points, point_keys, dots, ["node_id"], False, cell, hot_rows)


def _per_place(points: DataFrame, point_keys: list[str], lines: DataFrame, line_keys: list[str],
               ties: bool, cell: float, hot_rows: int) -> DataFrame:
    # read twice, as places to search and as keys to place; written once, as what they come from may be many rows
    known = cut(points.select(*point_keys, "px", "py").filter(F.col("px").isNotNull() & F.col("py").isNotNull()), "points")
    places, seen = cut_observed(known.select(F.col("px").alias("ix"), F.col("py").alias("iy")).distinct(), "places", n=row_count())
    if not seen["n"]:
        raise ValueError("no points to place")
    found = _nearest(
        places.withColumn("px", F.col("ix")).withColumn("py", F.col("iy")), ["ix", "iy"], lines, line_keys, ties, cell, hot_rows
    )
    return (
        known.join(found, (known["px"] == found["ix"]) & (known["py"] == found["iy"]))
        .select(*[known[k] for k in point_keys], *[found[k] for k in line_keys], found["dist"])
    )
