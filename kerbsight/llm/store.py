"""Written tables in the shared folder, and what is done with them once they are used up."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.session import cut_observed, dropped, scratch_root


BATCH_BYTES = 16 << 20


class Scratch:
    """The written tables of one operator run; each can be dropped as soon as nothing reads it any more.

    ``keep`` writes a table below the folder of ``spark.checkpoint.dir`` and goes on from the written files, so that a
    lost executor costs a re-read and no recomputation. ``drop`` deletes such a table. ``keep`` also lets Spark's own
    cleaner remove the shuffle files of plans that are over, which it does once the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        key = "spark.sql.execution.arrow.maxBytesPerBatch"
        spark.conf.set(key, str(BATCH_BYTES))  # a batch of very long texts stays small

    def keep(self, df: DataFrame, label: str, codec: str | None = None, **metrics: Column):
        if codec:
            path = f"{scratch_root(self.spark)}/kerbsight/{label}-{uuid.uuid4().hex}"
            df.write.option("compression", codec).parquet(path)
            out, seen = self.spark.read.schema(df.schema).parquet(path), {}
        else:
            out, seen = cut_observed(df, label, **metrics)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return (out, seen) if metrics else out

    def drop(self, *tables: DataFrame) -> None:
        dropped(*tables)


def is_small(rows: int, bytes_per_row: int, most: int = 16 << 20) -> bool:
    """Whether a side of ``rows`` rows is proven small enough to broadcast; above it a shuffled join is used."""
    return rows * bytes_per_row <= most


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, counted over the whole table; sizes blocks and shards."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0])
