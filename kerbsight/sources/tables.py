"""Table readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.operators.conform import texts_for_write


def read_counts(spark: SparkSession, folder: str, name_part: str = "") -> DataFrame:
    """All parquet files of a folder whose name contains ``name_part``, by column name."""
    reader = spark.read.option("mergeSchema", "true").option("pathGlobFilter", f"*{name_part}*.parquet")
    try:
        df = reader.parquet(folder)
    except Exception as error:  # no file: the schema cannot be inferred
        if "UNABLE_TO_INFER_SCHEMA" in str(error) or "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no parquet file with {name_part!r} in {folder}") from error
        raise
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: str | None = None) -> DataFrame:
    """Headed text table; columns are text unless a schema is given."""
    reader = spark.read.option("header", "true").option("sep", sep)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_envelopes(spark: SparkSession, path: str, field: str = "data", schema: str | None = None) -> DataFrame:
    """JSON documents that wrap their records in an array, e.g. ``data`` or ``result.records``."""
    reader = spark.read.option("multiLine", "true")
    docs = (reader.schema(schema) if schema else reader).json(path)
    return docs.select(F.explode(field).alias("r")).select("r.*")


def versioned(folder: str, stub: str, version: str = "") -> str:
    """Output path ``folder/<version>_<stub>``, without the prefix when there is no version."""
    return f"{folder.rstrip('/')}/{version}_{stub}" if version else f"{folder.rstrip('/')}/{stub}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = texts_for_write(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_normalized(edges: DataFrame, flows: DataFrame, folder: str, name: str, version: str = "",
                     partition_by: list[str] | None = None) -> None:
    """Geometry once in the edge table, flows without geometry, joined by ``edge_id``."""
    write_table(edges, versioned(folder, f"{name}_edges", version))
    write_table(flows.drop("geom", "geometry"), versioned(folder, f"{name}_flows", version), partition_by)
