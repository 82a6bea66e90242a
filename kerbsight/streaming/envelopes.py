"""Landing JSON envelopes: documents that wrap their records in an array, taken from a stream and stored by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.session import cut_observed
from kerbsight.streaming.counts import _each_batch


def read_documents(spark: SparkSession, folder: str, whole_files: bool = True, files_per_batch: int = 1000) -> DataFrame:
    """(value): a document for each file, or for each line."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder, wholetext=whole_files)


def unwrap(documents: DataFrame, record: str, field: str = "data") -> DataFrame:
    """(value, records): the array of every document; null where it is no JSON, lacks the array or breaks a type of ``record``."""
    parsed = F.from_json("value", f"`{field}` array<struct<{record}>>, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = documents.withColumn("_p", parsed)
    return rows.select("value", F.when(F.col("_p._corrupt").isNull(), F.col(f"_p.{field}")).alias("records"))


def land_envelopes(documents: DataFrame, folder: str, checkpoint: str, record: str, time: str, field: str = "data") -> None:
    """Land every micro-batch: records by day in ``days``, what cannot be used in ``aside``, and counts in ``audit``.

    ``aside`` has (kind, content): documents that do not parse, and records whose ``time`` does not begin with a date. The audit has
    one row a batch. Everything lies in a partition of its batch, so a batch that runs twice replaces what it wrote.
    """
    base = folder.rstrip("/")

    def put(rows: DataFrame, name: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", *by).parquet(f"{base}/{name}")

    def work(batch: DataFrame, number: int) -> None:
        read, seen = cut_observed(
            unwrap(batch, record, field), "envelopes", documents=F.count(F.lit(1)), broken=F.count_if(F.col("records").isNull()))
        day = F.substring(time, 1, 10)
        dated = F.coalesce(F.try_to_timestamp(day, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))
        rows = read.select(F.explode("records").alias("r")).select("r.*").withColumn("_dated", dated)
        rows, counted = cut_observed(rows, "envelope-records", records=F.count(F.lit(1)), undated=F.count_if(~F.col("_dated")))
        mark = F.lit(number).alias("batch")
        good = rows.where("_dated").drop("_dated").select("*", day.alias("day"), mark)
        put(good.hint("rebalance", F.col("day")), "days", "day")
        broken = read.where("records is null").select(F.lit("document").alias("kind"), F.col("value").alias("content"), mark)
        undated = rows.where("not _dated").drop("_dated")
        put(broken.unionByName(undated.select(F.lit("record").alias("kind"), F.to_json(F.struct(*undated.columns)).alias("content"), mark)), "aside")
        counts = {**seen, **counted}
        put(batch.sparkSession.range(1).select(mark, *[F.lit(n).cast("bigint").alias(k) for k, n in counts.items()]), "audit")

    _each_batch(documents, checkpoint, work)
