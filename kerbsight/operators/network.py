"""Road-network preparation: bearings, dense edge ids and adjacency rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbsight.functions import direction, geo
from kerbsight.session import Buckets, cut, cut_observed, row_count

CHUNK = 64
#: adjacency tables up to this many edges are broadcast (about 60 bytes an edge)
BROADCAST_EDGES = 500_000


def edge_bearings(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add the great-circle ``bearing`` u -> v from node ``lon, lat``; NULL for loops."""
    start = nodes.select(F.col("node_id").alias("u"), F.col("lon").alias("_lon1"), F.col("lat").alias("_lat1"))
    end = nodes.select(F.col("node_id").alias("v"), F.col("lon").alias("_lon2"), F.col("lat").alias("_lat2"))
    bearing = geo.compass_bearing(F.col("_lon1"), F.col("_lat1"), F.col("_lon2"), F.col("_lat2"))
    return (
        edges.join(start, "u").join(end, "v")
        .withColumn("bearing", F.when(F.col("u") != F.col("v"), bearing))
        .drop("_lon1", "_lat1", "_lon2", "_lat2")
    )


def dense_ids(df: DataFrame, order: list[str], name: str = "edge_id") -> DataFrame:
    """Number rows 1..n in ``order`` without sorting them in one task.

    Rows are range-partitioned and sorted; a row's number is the size of all earlier
    partitions plus its position in its own. The position is written once, so a
    recomputed task cannot change it.
    """
    position = F.monotonically_increasing_id()
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pos", position), "ranged")
    piece, inside = F.shiftrightunsigned("_pos", 33), F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        ranged.withColumn("_piece", piece).join(F.broadcast(starts), "_piece")
        .withColumn(name, F.col("_start") + inside + 1)
        .drop("_piece", "_start", "_pos")
    )


def with_edge_ids(edges: DataFrame) -> DataFrame:
    """Stable ``edge_id`` = rank of ``(u, v, key)``."""
    return dense_ids(edges, ["u", "v", "key"])


def attach_edge_ids(flows: DataFrame, edges: DataFrame, strict: bool = True) -> DataFrame:
    """Left-join ``edge_id`` on ``(u, v, key)``; ``strict`` makes a missing edge an error."""
    joined = flows.join(edges.select("u", "v", "key", "edge_id"), ["u", "v", "key"], "left")
    if not strict:
        return joined
    missing = F.raise_error(F.lit("a flow row has no edge")).cast("bigint")
    return joined.withColumn("edge_id", F.when(F.col("edge_id").isNull(), missing).otherwise(F.col("edge_id")))


@dataclass(frozen=True)
class Adjacency:
    """Out-edges per node in rows of at most ``CHUNK`` edges (``node, chunk, outs``), broadcast or stored in buckets by node.

    Ordinary nodes fit one row. A hub takes several, and ``many_chunks`` then tells
    the graph operators to add up weights over a node's rows.
    """

    rows: DataFrame
    many_chunks: bool
    small: bool
    ord_digits: int

    def joinable(self) -> DataFrame:
        return F.broadcast(self.rows) if self.small else self.rows


def adjacency(edges: DataFrame, comfort_rules: tuple = ()) -> Adjacency:
    """Group out-edges by start node, in ``(v, key)`` order."""
    numbered = edges if "edge_id" in edges.columns else with_edge_ids(edges)
    first = numbered.groupBy("u").agg(F.min("edge_id").alias("_first"))
    order = F.col("edge_id") - F.col("_first")
    comfort = direction.comfort_weight(F.col("highway"), comfort_rules) if comfort_rules else F.lit(1.0)
    out = F.struct(order.alias("ord"), "v", "key", F.col("length"), F.col("bearing"), comfort.alias("comfort"))
    chunks = (
        numbered.join(first, "u")
        .select(F.col("u").alias("node"), F.floor(order / CHUNK).alias("chunk"), out.alias("out"))
        .groupBy("node", "chunk").agg(F.sort_array(F.collect_list("out")).alias("outs"))
    )
    rows, seen = cut_observed(
        chunks, "adjacency", chunks=F.max("chunk"), edges=F.sum(F.size("outs")), rows=row_count()
    )
    chunk_count = (seen["chunks"] or 0) + 1
    small = (seen["edges"] or 0) <= BROADCAST_EDGES
    return Adjacency(rows if small else _stored(rows), chunk_count > 1, small, len(f"{chunk_count * CHUNK:x}"))


def _stored(rows: DataFrame) -> DataFrame:
    """The rows in buckets by node: joins read them where they lie, and only the other side moves."""
    table = Buckets(rows.sparkSession, "adjacency", ["node"])
    table.append(table.placed(rows))
    return table.table()
