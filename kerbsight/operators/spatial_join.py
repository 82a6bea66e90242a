"""Polygon-meets-line join on grid cells.

Both sides are exploded to the grid cells their bounding boxes touch, joined on the
cell and tested exactly. A pair that shares several cells is tested in one of them
only: the cell of the lower left corner of the two boxes' overlap.

Crowded cells: the number of line pieces per cell is measured first. Cells beyond
``hot_rows`` pieces are divided into an 8 x 8 sub-grid on both sides; sub-cells that
stay beyond it are split over salts, so neither a task nor a polygon row meets an
unbounded group. Without crowded cells the plan is one equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.session import cut_observed, row_count

SUB = 8
PAD = 1e-6
QUAD = [f"q{axis}{i}" for i in range(4) for axis in ("x", "y")]


def quad_rows(polygons: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """One row per ring: keys, the eight vertex coordinates, the turn and the bounding box."""
    ring = F.col("_ring")
    flat = polygons.select(*keys, F.explode(rings).alias("_ring")).select(
        *keys,
        *[F.element_at(ring, i + 1)[axis].alias(f"q{axis}{i}") for i in range(4) for axis in ("x", "y")],
    )
    xs, ys = [F.col(f"qx{i}") for i in range(4)], [F.col(f"qy{i}") for i in range(4)]
    return flat.select(
        "*", geo.quad_turn(list(zip(xs, ys))).alias("turn"),
        F.least(*xs).alias("pl"), F.least(*ys).alias("pb"), F.greatest(*xs).alias("pr"), F.greatest(*ys).alias("pt")
    )


def segment_rows(lines: DataFrame, carry: list[str], geom: str = "geom") -> DataFrame:
    """One row per line segment: carried columns and ``sx1, sy1, sx2, sy2``."""
    return lines.select(*carry, F.explode(geo.geom_segments(F.col(geom))).alias("_s")).select(
        *carry, *[F.col("_s")[n].alias(f"s{n}") for n in ("x1", "y1", "x2", "y2")]
    )


def piece_rows(segments: DataFrame, carry: list[str], piece: float = 64.0) -> DataFrame:
    """One row per segment piece: carried columns, the whole segment and the piece's box.

    Long segments are divided so that a diagonal does not fill a square of cells;
    exact tests later use the undivided segment.
    """
    dx, dy = F.col("sx2") - F.col("sx1"), F.col("sy2") - F.col("sy1")
    n = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / piece).cast("int"))
    step = segments.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))

    def at(start: str, delta: Column, k: Column) -> Column:
        return F.col(start) + delta * k / F.col("_n")

    xa, xb = at("sx1", dx, F.col("_i")), at("sx1", dx, F.col("_i") + 1)
    ya, yb = at("sy1", dy, F.col("_i")), at("sy1", dy, F.col("_i") + 1)
    return step.select(
        *carry, "sx1", "sy1", "sx2", "sy2",
        (F.least(xa, xb) - PAD).alias("sl"), (F.least(ya, yb) - PAD).alias("sb"),
        (F.greatest(xa, xb) + PAD).alias("sr"), (F.greatest(ya, yb) + PAD).alias("st"),
    )


def box_cells(df: DataFrame, box: tuple[str, str, str, str], cell: float) -> DataFrame:
    """Repeat each row for every grid cell its box touches (columns ``cx, cy``)."""
    left, bottom, right, top = (F.col(b) for b in box)
    return df.withColumn("cx", F.explode(F.sequence(F.floor(left / cell), F.floor(right / cell)))).withColumn(
        "cy", F.explode(F.sequence(F.floor(bottom / cell), F.floor(top / cell)))
    )


def _sub_cells(df: DataFrame, hot: DataFrame, box: tuple[str, str, str, str], cell: float) -> DataFrame:
    """Add ``fx, fy``: the sub-cells within a crowded cell, (-1, -1) elsewhere."""
    fine = cell / SUB
    left, bottom, right, top = (F.floor(F.col(b) / fine) for b in box)
    marked = df.join(hot.select("cx", "cy", F.lit(True).alias("_hot")), ["cx", "cy"], "left")

    def inside(base: str, lo: Column, hi: Column) -> Column:
        first = F.col(base) * SUB
        return F.when(
            F.col("_hot"), F.sequence(F.greatest(lo, first), F.least(hi, first + SUB - 1))
        ).otherwise(F.array(F.lit(-1).cast("bigint")))

    return (
        marked.withColumn("fx", F.explode(inside("cx", left, right)))
        .withColumn("fy", F.explode(inside("cy", bottom, top)))
        .drop("_hot")
    )


def _crowded(cells: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame, int]:
    counted = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
    found, seen = cut_observed(counted, "crowded-cells", n=row_count())
    return found, seen["n"]


def meets(polygons: DataFrame, polygon_keys: list[str], lines: DataFrame, line_keys: list[str],
          carry: list[str] | None = None, cell: float = 64.0, hot_rows: int = 4096) -> DataFrame:
    """Distinct (polygon, line) pairs that touch; ``carry`` names further line columns.

    ``polygons`` holds convex four-vertex rings in ``rings``, ``lines`` parts in ``geom``.
    """
    carry = carry or []
    quads = box_cells(quad_rows(polygons, polygon_keys), ("pl", "pb", "pr", "pt"), cell)
    columns = line_keys + carry
    pieces = box_cells(piece_rows(segment_rows(lines, columns), columns, cell), ("sl", "sb", "sr", "st"), cell)
    corner_x, corner_y = F.greatest("pl", "sl"), F.greatest("pb", "sb")
    in_cell = (F.floor(corner_x / cell) == F.col("cx")) & (F.floor(corner_y / cell) == F.col("cy"))
    keys = ["cx", "cy"]

    hot, n_hot = _crowded(pieces, keys, hot_rows)
    if n_hot:
        fine = cell / SUB
        quads = _sub_cells(quads, hot, ("pl", "pb", "pr", "pt"), cell)
        pieces = _sub_cells(pieces, hot, ("sl", "sb", "sr", "st"), cell)
        in_cell = in_cell & (
            (F.col("fx") == -1)
            | ((F.floor(corner_x / fine) == F.col("fx")) & (F.floor(corner_y / fine) == F.col("fy")))
        )
        keys = keys + ["fx", "fy"]
        still, n_still = _crowded(pieces, keys, hot_rows)
        if n_still:
            salts = still.select(*keys, F.ceil(F.col("n") / hot_rows).cast("int").alias("_salts"))
            slots = F.coalesce("_salts", F.lit(1))
            spread = F.pmod(F.xxhash64(*line_keys, "sx1", "sy1", "sx2", "sy2"), slots).cast("int")
            pieces = pieces.join(salts, keys, "left").withColumn("salt", spread).drop("_salts")
            quads = quads.join(salts, keys, "left").withColumn(
                "salt", F.explode(F.sequence(F.lit(0), slots - 1))
            ).drop("_salts")
            keys = keys + ["salt"]

    corners = [(F.col(f"qx{i}"), F.col(f"qy{i}")) for i in range(4)]
    boxes_meet = (
        (F.col("pl") <= F.col("sr")) & (F.col("sl") <= F.col("pr"))
        & (F.col("pb") <= F.col("st")) & (F.col("sb") <= F.col("pt"))
    )
    # the planner takes exploded rows to be as few as those they come from, and would broadcast either side whole
    touching = quads.hint("merge").join(pieces, keys).filter(
        boxes_meet & in_cell
        & geo.quad_meets_segment(corners, F.col("sx1"), F.col("sy1"), F.col("sx2"), F.col("sy2"), F.col("turn"))
    )
    # a line has several pieces and a polygon several rings: keep each pair once; the
    # carried columns belong to the line, so they do not make more groups
    return touching.select(*polygon_keys, *line_keys, *carry).distinct()
