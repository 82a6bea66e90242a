"""All gold tables as one version: staged, checked, switched at once, and summarised from what is published.

A release folder holds ``versions/<version>/<table>``, ``reports`` (the checks of every version that was tried), ``manifest``
(one row for every switch) and ``summaries/<version>``. Readers take the newest version of the manifest, so a run that fails or
is refused, at whatever point, leaves them what they had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight import schemas
from kerbsight.operators.conform import fit_target
from kerbsight.plans import frontage_impressions
from kerbsight.plans.gold import gold_checks
from kerbsight.session import cut
from kerbsight.sources.landing import exists
from kerbsight.sources.wkb import from_wkb


def _within(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def switches(spark: SparkSession, folder: str) -> list[str]:
    """The versions that were published, oldest first; one short text for each release."""
    if not exists(spark, _within(folder, "manifest")):
        return []
    rows = spark.read.parquet(_within(folder, "manifest")).orderBy("number").collect()
    return [r["version"] for r in rows]


def released(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A gold table as last published."""
    versions = switches(spark, folder)
    if not versions:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(_within(folder, "versions", versions[-1], table))


def release(tables: dict[str, DataFrame], folder: str, version: str) -> list[str]:
    """Publish ``tables`` as ``version`` if every check passes; returns the names of the tables that fail one.

    All eight gold tables must be there with their key and required columns. A table fails when it is empty or has repeated
    keys, nulls in required columns or rows without parent. A version that was refused or interrupted can be tried again; a
    published one never changes.
    """
    if set(tables) != set(schemas.GOLD):
        raise ValueError(f"a release has the tables {sorted(schemas.GOLD)}")
    spark = next(iter(tables.values())).sparkSession
    before = switches(spark, folder)
    if version in before:
        raise ValueError(f"version {version} is published already")
    fitted = {}
    for name, spec in schemas.GOLD.items():
        fitted[name], missing, _ = fit_target(tables[name], spec["schema"].names)
        if lost := set(missing) & {*spec["key"], *spec["required"]}:
            raise ValueError(f"{name} has no {sorted(lost)}")
    staged = {}
    for name, df in fitted.items():
        path = _within(folder, "versions", version, name)
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        staged[name] = spark.read.schema(df.schema).parquet(path)
    passes = (F.col("n_rows") > 0) & (F.col("repeated") == 0) & (F.col("nulls") == 0) & (F.col("orphans") == 0)
    report = cut(gold_checks(staged).withColumns({"passed": passes, "version": F.lit(version)}), "release-report")
    report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(_within(folder, "reports"))
    failed = sorted(r["table_name"] for r in report.where("not passed").collect())
    if not failed:  # one row in one file: the switch is the commit of that file
        row = spark.range(1).select(F.lit(len(before)).alias("number"), F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
        row.coalesce(1).write.mode("append").parquet(_within(folder, "manifest"))
    return failed


def rebuild_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The impressions summary, from the published tables alone, written beside them under their version."""
    table = lambda name: released(spark, folder, name)
    sights = cut(from_wkb(table("frontage_visibility"), name="rings"), "sights")
    modes = [(from_wkb(table(f"{m}_edges")), table(f"{m}_flows")) for m in ("bike", "ped", "motorized_traffic")]
    items = frontage_impressions.mode_items(*modes, from_wkb(table("transit_flows_hourly")))
    path = _within(folder, "summaries", switches(spark, folder)[-1])
    frontage_impressions.impressions_summary(sights, items).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)
