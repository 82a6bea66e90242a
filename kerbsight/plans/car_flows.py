"""Car counts to hourly flows on the road network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.functions import direction
from kerbsight.operators import propagate
from kerbsight.operators.nearest import nearest_edges
from kerbsight.operators.network import attach_edge_ids, dense_ids, with_edge_ids
from kerbsight.operators.profiles import car_seeds, clean_car_counts, typical_day_cars
from kerbsight.session import cut

SEED = ["msid", "richtung", "hour"]


def placed_seeds(raw_counts: DataFrame, edges: DataFrame) -> DataFrame:
    """Typical-day seeds with their nearest edge and the node the flow starts from."""
    seeds = cut(car_seeds(typical_day_cars(clean_car_counts(raw_counts))), "car-seeds")
    points = seeds.withColumnsRenamed({"ekoord": "px", "nkoord": "py"}).select(*SEED, "px", "py")
    found = nearest_edges(points, SEED, edges, ties=False)
    return start_nodes(seeds.join(found, SEED), edges)


def start_nodes(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Flow starts at the end of the edge when it heads against the edge's bearing."""
    bearings = edges.select("u", "v", "key", "bearing")
    against = direction.arc_between(F.col("bearing_seed"), F.coalesce("bearing", F.lit(180.0))) > 90.0
    return (
        seeds.join(bearings, ["u", "v", "key"])
        .withColumn("start_node", F.when(against, F.col("v")).otherwise(F.col("u"))).drop("bearing")
    )


def propagation_seeds(placed: DataFrame) -> DataFrame:
    """The columns the propagation needs, with a seed number; seeds without a mean flow
    cannot start one."""
    known = placed.filter(F.col("flow_value").isNotNull()).select(
        *SEED, F.col("bearing_seed").alias("bearing"), F.col("start_node").alias("node"), F.col("flow_value").alias("flow")
    )
    return dense_ids(known, SEED, "seed").select("seed", "hour", "bearing", "node", "flow")


def car_flows(raw_counts: DataFrame, edges: DataFrame, model: propagate.CarModel = propagate.CARS) -> tuple[DataFrame, DataFrame]:
    """Edge table with ``edge_id``, and flows balanced and normalized per hour."""
    numbered = with_edge_ids(edges)
    seeds = propagation_seeds(placed_seeds(raw_counts, edges))
    flows = cut(propagate.propagate_cars(seeds, numbered, model), "car-flows")
    balanced = attach_edge_ids(propagate.mass_balance(flows, seeds), numbered, strict=False)
    return numbered, propagate.normalize_per_hour(balanced)
