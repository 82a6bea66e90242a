"""Publishing the gold tables with their checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight import schemas
from kerbsight.operators import checks
from kerbsight.sources.publish import publish_gold


def gold_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Per gold table: rows, repeated keys, NULLs in required columns, rows without parent."""

    def report(name: str) -> DataFrame:
        spec = schemas.GOLD[name]
        required = [c for c in spec["required"] if c in tables[name].columns]
        counted = checks.key_report(name, tables[name], spec["key"], required)
        parent = spec.get("parent")
        if parent in tables:
            lost = checks.orphans(tables[name], tables[parent], ["edge_id"]).agg(F.count(F.lit(1))).scalar()
            return counted.withColumn("orphans", lost)
        return counted.withColumn("orphans", F.lit(0).cast("bigint"))

    return reduce(DataFrame.unionByName, [report(n) for n in schemas.GOLD if n in tables])


def publish_checked(tables: dict[str, DataFrame], folder: str) -> tuple[dict[str, int], DataFrame]:
    """Publish the tables, then report on what was written."""
    counts = publish_gold(tables, folder)
    spark = next(iter(tables.values())).sparkSession
    written = {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in tables if counts.get(n)}
    return counts, gold_checks(written)
