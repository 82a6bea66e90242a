"""Checks of gold tables, and descriptive numbers of intermediate ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.operators.profiles import exact_quantiles


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])


def orphans(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(*key), key, "left_anti")


def key_report(name: str, df: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """One row: table, rows, rows beyond unique keys, NULLs in required columns."""
    counted = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(required)],
    )
    nulls = sum((F.col(f"null_{i}") for i in range(len(required))), F.lit(0))
    return counted.agg(
        F.lit(name).alias("table_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls"),
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum of a column."""
    c = F.col(column)
    quartiles = exact_quantiles(
        df.withColumn("_all", F.lit(1)), ["_all"], [column], {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    ).groupBy("_all").agg(*[F.max(F.when(F.col("quantile") == n, F.col("value"))).alias(n) for n in ("q25", "q50", "q75")])
    basic = df.withColumn("_all", F.lit(1)).groupBy("_all").agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")
    )
    # one row on either side
    return basic.join(F.broadcast(quartiles), "_all").select("n", "mean", "std", "min", "q25", "q50", "q75", "max")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def clip_to_extent(points: DataFrame, nodes: DataFrame, edges: DataFrame, margin: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Network inside the points' bounding box plus ``margin`` (all in ``lon, lat``)."""
    box = points.agg(
        F.struct(
            (F.min("lon") - margin).alias("west"), (F.max("lon") + margin).alias("east"),
            (F.min("lat") - margin).alias("south"), (F.max("lat") + margin).alias("north"),
        )
    ).scalar()
    kept = nodes.withColumn("_box", box).filter(
        F.col("lon").between(F.col("_box.west"), F.col("_box.east"))
        & F.col("lat").between(F.col("_box.south"), F.col("_box.north"))
    ).drop("_box")
    ids = kept.select("node_id")
    inside = edges.join(ids.withColumnRenamed("node_id", "u"), "u", "left_semi").join(
        ids.withColumnRenamed("node_id", "v"), "v", "left_semi"
    )
    return kept, inside
