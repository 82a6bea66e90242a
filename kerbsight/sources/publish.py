"""Publishing gold tables to parquet folders or to a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kerbsight import schemas
from kerbsight.operators.conform import fit_target

BATCH_ROWS = 50_000
WRITERS = 4


def publish_parquet(df: DataFrame, folder: str, target: list[str]) -> int:
    """Replace a published table; an empty input leaves the old table as it is."""
    if df.isEmpty():
        return 0
    fitted, _, _ = fit_target(df, target)
    seen = Observation()
    fitted.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(folder)
    return seen.get["n"]


def publish_jdbc(df: DataFrame, url: str, table: str, target: list[str], properties: dict[str, str] | None = None) -> int:
    """Truncate and refill a database table in batches; an empty input is skipped."""
    if df.isEmpty():
        return 0
    fitted, _, _ = fit_target(df, target)
    seen = Observation()
    writer = (
        fitted.observe(seen, F.count(F.lit(1)).alias("n")).write.format("jdbc").mode("overwrite")
        .option("url", url).option("dbtable", table).option("truncate", "true").option("cascadeTruncate", "true")
        .option("batchsize", BATCH_ROWS).option("numPartitions", WRITERS)
    )
    writer.options(**(properties or {})).save()
    return seen.get["n"]


def publish_gold(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Publish every gold table that is given; returns rows per table and their total."""
    unknown = set(tables) - set(schemas.GOLD)
    if unknown:
        raise ValueError(f"not gold tables: {sorted(unknown)}")
    counts = {
        name: publish_parquet(tables[name], f"{folder.rstrip('/')}/{name}", schemas.GOLD[name]["schema"].names)
        for name in schemas.GOLD if name in tables
    }
    return {**counts, "total": sum(counts.values())}
