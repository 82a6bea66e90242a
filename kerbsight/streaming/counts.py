"""Streaming ingest of counts from landed files.

No record is ever too late. A micro-batch writes what it contributes to every group into its own partition, and a group is
read by merging its parts; so the result does not depend on how many files a batch takes or in which order they landed, and
there is no state to keep in memory. Every ``MERGE_EVERY`` batches the parts so far are merged into one partition, and reading
starts at the newest of those. A batch that runs again after a failure writes its partition again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbsight.sources.landing import delete, exists, upsert_months

MERGE_EVERY = 10
#: the column that numbers kept micro-batches
BATCH = "batch_no"


def read_landed(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def _each_batch(counts: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> None:
    """Give every micro-batch to ``work``, then stop when all is read."""
    query = (
        counts.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def ingest_months(counts: DataFrame, folder: str, checkpoint: str, key: list[str] = ("id",),
                  time: str = "messung_dat_zeit") -> None:
    """Upsert micro-batches into month partitions; rows without a month go to the reject folder, by batch.

    Micro-batches are kept as they came; when all is read they are upserted together, a later batch over an earlier one. So a month is
    rewritten once, not with every batch. A batch that runs twice replaces its rows, and what a failed run has kept the next one
    upserts. Upserts are repeatable, so it does not matter if the kept batches of a finished upsert were not deleted.
    """
    spark, parts = counts.sparkSession, f"{folder.rstrip('/')}-batches"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn(BATCH, F.lit(number).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(parts)

    _each_batch(counts, checkpoint, keep)
    if exists(spark, parts):
        kept = spark.read.schema(T.StructType([*counts.schema.fields, T.StructField(BATCH, T.LongType())])).parquet(parts)
        upsert_months(kept, folder, list(key), time, F.concat(F.lit("batch-"), F.col(BATCH)), BATCH)
        delete(spark, parts)


def hour_parts(counts: DataFrame, time: str = "ts", station: str = "msid", value: str = "flow") -> DataFrame:
    """Sum and number of counts per station and clock hour; parts of a group add up."""
    hour = F.date_trunc("hour", time).alias("hour_start")
    return counts.groupBy(hour, station).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def added(parts: DataFrame) -> DataFrame:
    keys = [x for x in parts.columns if x not in ("total", "n")]
    return parts.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def hourly_means(parts: DataFrame) -> DataFrame:
    """Mean and number of counts of every group."""
    return added(parts).withColumn("mean_flow", F.try_divide("total", "n")).drop("total")


def first_copies(counts: DataFrame, ident: str = "id", time: str = "ts") -> DataFrame:
    """The earliest copy of every id, the smallest in content on a tie; however far apart the copies arrive."""
    rest = F.struct(time, *[x for x in counts.columns if x not in (ident, time)])
    return counts.groupBy(ident).agg(F.min(rest).alias("r")).select(ident, "r.*").select(counts.columns)


def collect_parts(counts: DataFrame, folder: str, checkpoint: str, part: Callable[[DataFrame], DataFrame],
                  merge: Callable[[DataFrame], DataFrame]) -> None:
    """Write ``part`` of every micro-batch below ``folder``; ``merge`` must give the same for parts merged in any order."""

    def save(batch: DataFrame, number: int) -> None:
        rows, whole = part(batch), number > 0 and number % MERGE_EVERY == 0
        if whole and exists(batch.sparkSession, folder):
            rows = merge(rows.unionByName(_current(batch.sparkSession, folder, number)))
        rows.withColumns({"whole": F.lit(int(whole)), "batch": F.lit(number)}).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("whole", "batch").parquet(folder)

    _each_batch(counts, checkpoint, save)


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts that together make the present state."""
    return _current(spark, folder, None)


def _current(spark: SparkSession, folder: str, before: int | None) -> DataFrame:
    """Parts from the newest merged batch on; ``before`` leaves out later ones, so that a repeated batch reads the same."""
    parts = spark.read.parquet(folder)
    if before is not None:
        parts = parts.where(F.col("batch") < before)
    newest = parts.where("whole = 1").agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
    return parts.where(F.col("batch") >= newest).drop("whole", "batch")
