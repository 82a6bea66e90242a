"""Session defaults and lineage cuts.

Iterative operators (propagation, shortest paths) cut their lineage by writing a
parquet table below the folder named in ``spark.checkpoint.dir``. That folder is
shared storage on a cluster, so a lost executor costs a task retry, not the run.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "kerbsight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on (UTC clock, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session whose tasks all run in this process may go without: it gets a
    temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kerbsight-"))
    return spark.conf.get("spark.checkpoint.dir")


def cut(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    return cut_observed(df, label)[0]


def cut_observed(df: DataFrame, label: str = "stage", **metrics: Column) -> tuple[DataFrame, dict]:
    """Like :func:`cut`, and return aggregate ``metrics`` of the same single job."""
    path = f"{scratch_root(df.sparkSession)}/kerbsight/{label}-{uuid.uuid4().hex}"
    values: dict = {}
    out = df
    if metrics:
        seen = Observation()
        out = df.observe(seen, *[m.alias(name) for name, m in metrics.items()])
    out.write.parquet(path)
    if metrics:
        values = seen.get
    return df.sparkSession.read.schema(df.schema).parquet(path), values


class Buckets:
    """A growing table whose rows lie in ``count`` buckets by the hash of ``keys``.

    Rounds are appended, and nothing is written again. Joins, windows and groups by the keys read the table without a shuffle, and
    only the ``folders`` (columns) that a filter leaves. It is registered under a name of its own until ``close``; its files lie
    beside the tables of :func:`cut`.
    """

    def __init__(self, spark: SparkSession, label: str, keys: list[str], count: int | None = None, folders: tuple[str, ...] = ()):
        self.spark, self.keys, self.folders = spark, keys, folders
        self.count = count or int(spark.conf.get("spark.sql.shuffle.partitions"))
        key = uuid.uuid4().hex
        self.path = f"{scratch_root(spark)}/kerbsight/{label}-{key}"
        self.name = f"kerbsight_{re.sub(r'[^a-z]', '_', label)}_{key}"
        self.schema = None

    def append(self, df: DataFrame, **metrics: Column) -> dict:
        """Write ``df`` and return aggregate ``metrics`` of the same job. Its rows should be partitioned like the buckets, so that a
        task writes one file."""
        self.schema = self.schema or df.schema
        seen = Observation()
        out = df.observe(seen, *[m.alias(name) for name, m in metrics.items()]) if metrics else df
        writer = out.write.format("parquet").mode("append").option("path", self.path).bucketBy(self.count, *self.keys)
        (writer.partitionBy(*self.folders) if self.folders else writer).saveAsTable(self.name)
        return seen.get if metrics else {}

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` partitioned like the buckets."""
        return df.repartition(self.count, *self.keys)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> DataFrame:
        """Forget the name; the rows stay readable."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return self.spark.read.schema(self.schema).parquet(self.path)


def row_count() -> Column:
    """Row-count metric for :func:`cut_observed`."""
    return F.count(F.lit(1))


def dropped(*tables: DataFrame) -> None:
    """Delete tables that :func:`cut` has written, once nothing reads them any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
