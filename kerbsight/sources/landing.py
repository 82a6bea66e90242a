"""Landing raw records and the incremental ingest of counts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kerbsight.functions.cleaning import whole_id
from kerbsight.operators.conform import snake_columns
from kerbsight.session import cut, cut_observed, row_count

#: shares of a month that is looked up in a large table
MONTH_SHARES = 512

# -------------------------------------------------------------------- daily landing
def month_slice(records: DataFrame, time: str, year: int, month: int) -> DataFrame:
    """Records of one month by their date text, from the first day to before the next month."""
    start = f"{year:04d}-{month:02d}-01"
    end = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    day = F.substring(time, 1, 10)
    return records.filter((day >= start) & (day < end))


def day_counts(records: DataFrame, time: str) -> DataFrame:
    return records.groupBy(F.substring(time, 1, 10).alias("date")).agg(F.count(F.lit(1)).alias("records_fetched"))


def land_by_day(records: DataFrame, time: str, folder: str) -> None:
    """One folder per day. Rebalancing keeps files large and splits a crowded day."""
    day = F.substring(time, 1, 10)
    parts = records.withColumns({
        "year": F.substring(day, 1, 4), "month": F.substring(day, 6, 2), "day": F.substring(day, 9, 2),
    })
    parts.hint("rebalance", F.col("year"), F.col("month"), F.col("day")).write.mode("append").partitionBy(
        "year", "month", "day"
    ).parquet(folder)


# --------------------------------------------------------------- incremental ingest
def new_records(records: DataFrame, year: int, last_time: str | None = None, last_id: int = -1,
                time: str = "messung_dat_zeit", ident: str = "id") -> DataFrame:
    """Records of ``year`` after the watermark ``(time text, id)``."""
    of_year = F.col(time).startswith(f"{year}-")
    if last_time is None:
        return records.filter(of_year)
    later = (F.col(time) > last_time) | ((F.col(time) == last_time) & (F.col(ident) > last_id))
    return records.filter(of_year & later)


def watermark(records: DataFrame, time: str = "messung_dat_zeit", ident: str = "id") -> DataFrame:
    """Largest ``(first 19 characters of the time, id or -1)``."""
    mark = F.struct(
        F.coalesce(F.substring(time, 1, 19), F.lit("")).alias("last_ts"),
        F.coalesce(whole_id(ident), F.lit(-1).cast("bigint")).alias("last_id"),
    )
    return records.agg(F.max(mark).alias("w")).select("w.*")


def keep_last(records: DataFrame, key: list[str] | None, order: Column) -> DataFrame:
    """Last record per key in arrival order, or distinct whole rows without a key.

    ``max_by`` combines on the map side, so a key with many copies is no crowded group.
    """
    if not key:
        return records.dropDuplicates()
    rest = [c for c in records.columns if c not in key]
    last = F.max_by(F.struct(*rest), order).alias("r")
    return records.groupBy(*key).agg(last).select(*key, "r.*").select(records.columns)


def merge_months(existing: DataFrame, arrived: DataFrame, key: list[str] | None = ("id",),
                 time: str = "messung_dat_zeit") -> DataFrame:
    """Existing rows of the touched months with the new rows; the newest copy of a key stays."""
    return _newest(_of_months(existing, arrived, time), arrived, key)


def _of_months(existing: DataFrame, arrived: DataFrame, time: str) -> DataFrame:
    """Existing rows of the months that ``arrived`` touches. A month is dealt into shares, so that it is no single task."""
    shares = F.explode(F.sequence(F.lit(0), F.lit(MONTH_SHARES - 1)))
    touched = arrived.select(F.substring(time, 1, 7).alias("_m")).distinct().withColumn("_share", shares)
    share = F.pmod(F.xxhash64(*existing.columns), F.lit(MONTH_SHARES)).cast("int")
    dealt = existing.withColumns({"_m": F.substring(time, 1, 7), "_share": share})
    return dealt.join(touched, ["_m", "_share"], "left_semi").drop("_m", "_share")


def _newest(old: DataFrame, arrived: DataFrame, key: list[str] | None, order: str | None = None) -> DataFrame:
    """Both tables, without the older copies of a key. ``order`` names a column that numbers the batches of ``arrived`` from 0."""
    batch = "_batch"
    number = F.col(order) + 1 if order else F.lit(1)
    fresh = arrived.withColumn(batch, number.cast("bigint")).drop(*([order] if order else []))
    both = old.withColumn(batch, F.lit(0).cast("bigint")).unionByName(fresh, allowMissingColumns=True)
    if not key:
        return both.drop(batch).dropDuplicates()
    rest = F.struct(*[c for c in both.columns if c not in (batch, *key)])
    # within a batch the copies of a key are ordered by their content
    return keep_last(both, list(key), F.struct(F.col(batch), F.to_json(rest))).drop(batch)


def upsert_months(arrived: DataFrame, folder: str, key: list[str] | None = ("id",),
                  time: str = "messung_dat_zeit", run: str | Column = "run", order: str | None = None) -> dict[str, int]:
    """Rewrite only the month partitions that got new rows; returns how many rows were written and rejected.

    ``arrived`` is read several times, mostly its times alone, so it should be a written table.

    ``order`` names a column with the number of a row's batch, where several arrive together; it is not stored. Rows whose time has no month land in ``rejects_folder``, below the name of the run; a repeated run replaces them.
    Rows merged with stored ones are staged first, because one job cannot read and overwrite a folder.
    """
    spark = arrived.sparkSession
    fresh = snake_columns(arrived)
    has_month = F.coalesce(F.col(time).rlike(r"^\d{4}-(0[1-9]|1[0-2])-"), F.lit(False))
    fresh = _with_month(fresh, time).withColumn("_ok", has_month)
    seen = fresh.agg(row_count().alias("arrived"), F.count_if("_ok").alias("written")).first()
    rejected = seen["arrived"] - seen["written"]
    if rejected:
        bad = fresh.filter(~F.col("_ok")).drop("_ok", "year", "month").withColumn("run", F.lit(run)).drop(*([order] if order else []))
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(rejects_folder(folder))
    fresh = fresh.filter("_ok").drop("_ok")
    if seen["written"]:
        old = fresh.drop("year", "month", *([order] if order else [])).limit(0)
        stores = exists(spark, folder)
        if stores:
            # the touched months, at most twelve a year, prune the stored partitions
            months = [r["m"] for r in fresh.select(F.concat_ws("-", "year", "month").alias("m")).distinct().collect()]
            stored = spark.read.parquet(folder)
            month = F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))
            old = stored.filter(month.isin(months)).drop("year", "month")
        merged = _with_month(_newest(old, fresh.drop("year", "month"), key, order), time)
        staged = cut(merged, "months") if stores else merged
        staged.hint("rebalance", F.col("year"), F.col("month")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("year", "month").parquet(folder)
    return {"written": seen["written"], "rejected": rejected}


def rejects_folder(folder: str) -> str:
    return f"{folder.rstrip('/')}-rejects"


def _with_month(records: DataFrame, time: str) -> DataFrame:
    return records.withColumns({"year": F.substring(time, 1, 4), "month": F.substring(time, 6, 2)})


def exists(spark: SparkSession, folder: str) -> bool:
    """Asks the folder's file system; trying to read it would log a failed query."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def land_raw(arrived: DataFrame, folder: str, year: int, load: str) -> tuple[DataFrame, int]:
    """Add new rows of a year, as they came, to the raw table, in a partition of their load; returns them as written, and their number.

    ``load`` names what was asked for (the watermark), so a load that is repeated after a failure replaces its own rows. Columns of
    the rows that are named like the two partitions give way to them in the raw table, but not in what is returned.
    """
    parts = {"year": F.lit(str(year)), "load": F.lit(load)}
    if {c.lower() for c in arrived.columns} & set(parts):
        arrived, rows = observed_rows(arrived, "arrived")
        if rows:
            _raw(arrived.withColumns(parts), folder)
        return arrived, rows
    seen = Observation()
    _raw(arrived.observe(seen, row_count().alias("n")).withColumns(parts), folder)
    written = f"{folder.rstrip('/')}/year={year}/load={load}"
    return arrived.sparkSession.read.schema(arrived.schema).parquet(written) if seen.get["n"] else arrived, seen.get["n"]


def _raw(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "load").parquet(folder)


# ------------------------------------------------------------------ state and audit
def read_state(spark: SparkSession, folder: str, year: int) -> tuple[str | None, int]:
    """Newest stored watermark of a year, ``(None, -1)`` when there is none."""
    if not exists(spark, folder):
        return None, -1
    newest = (
        spark.read.parquet(folder).filter(F.col("year") == year)
        .agg(F.max_by(F.struct("last_ts", "last_id"), "updated_at").alias("s")).first()["s"]
    )
    return (newest["last_ts"], newest["last_id"]) if newest else (None, -1)


def append_state(mark: DataFrame, folder: str, year: int) -> None:
    mark.withColumn("year", F.lit(year)).withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(folder)


def audit_row(spark: SparkSession, dataset: str, run_id: str, status: str, records: int, year: int,
              watermark: str = "", message: str = "") -> DataFrame:
    """One audit record; ``status`` is success, no_new_data, error or partial."""
    return spark.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"), F.lit(status).alias("status"),
        F.lit(records).cast("bigint").alias("records"), F.lit(year).cast("int").alias("year"),
        F.lit(watermark).alias("watermark"), F.lit(message).alias("message"),
        F.current_timestamp().alias("ingested_at"),
    )


def run_summary(audit: DataFrame) -> DataFrame:
    """Per run: units by outcome, records, and ``partial`` as soon as one unit failed."""
    status = F.col("status")
    return audit.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("units_total"),
        F.count_if(status == "success").alias("units_success"),
        F.count_if(status == "no_new_data").alias("units_no_new_data"),
        F.count_if(status == "error").alias("units_failed"),
        F.sum("records").alias("records"),
    ).withColumn("status", F.when(F.col("units_failed") == 0, "success").otherwise("partial"))


# ------------------------------------------------------------------ change detection
def fingerprint(df: DataFrame) -> DataFrame:
    """SHA-256 over a table's rows in any order: ``n_rows, sha256``.

    Every row gives a 256-bit digest; the digests are added up in eight 32-bit pieces,
    which needs no sorting and combines on the map side.
    """
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in df.columns]
    return _digests(df.select(F.sha2(F.concat_ws("\u001f", *marked), 256).alias("d")))


def part_fingerprints(df: DataFrame, by: str) -> DataFrame:
    """The same for every partition: ``by, n_rows, sha256``; one pass and one row for each partition and task are shuffled."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in df.columns]
    return _digests(df.select(by, F.sha2(F.concat_ws("\u001f", *marked), 256).alias("d")), by)


def _digests(rows: DataFrame, *by: str) -> DataFrame:
    pieces = rows.select(*by, *[
        F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)").alias(f"p{i}") for i in range(8)
    ])
    sums = pieces.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.coalesce(F.sum(f"p{i}"), F.lit(0)).cast("decimal(38,0)").cast("string").alias(f"s{i}") for i in range(8)
    ])
    text = F.concat_ws("-", F.col("n_rows").cast("string"), *[F.col(f"s{i}") for i in range(8)])
    return sums.select(*by, "n_rows", F.sha2(text, 256).alias("sha256"))


def refresh_if_changed(df: DataFrame, folder: str, state_folder: str, unit: str) -> str:
    """Overwrite ``folder`` only when the table's fingerprint differs from the stored one."""
    spark = df.sparkSession
    new = fingerprint(df).first()["sha256"]
    if exists(spark, state_folder):
        old = spark.read.parquet(state_folder).filter(F.col("unit") == unit).agg(
            F.max_by("sha256", "updated_at").alias("sha256")
        ).first()["sha256"]
        if old == new:
            return "no_new_data"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    spark.range(1).select(
        F.lit(unit).alias("unit"), F.lit(new).alias("sha256"), F.current_timestamp().alias("updated_at")
    ).write.mode("append").parquet(state_folder)
    return "success"


def refresh_partitions(df: DataFrame, folder: str, state_folder: str, by: str, unit: str, run_id: str,
                       audit_folder: str | None = None) -> DataFrame:
    """Rewrite only the partitions whose rows differ from those last stored, and delete those that are gone.

    ``by`` is a text column. Returns one row per partition, also of those gone: ``by, n_rows, action`` (new, changed, same,
    gone). Data are written before the state, so a run that fails is repeated in full and then finds the same actions. The
    audit gets one row a run. ``df`` must not be read from ``folder``. A missing value of ``by`` is a partition of its own.
    """
    spark = df.sparkSession
    now = part_fingerprints(df, by)
    if exists(spark, state_folder):
        stored = spark.read.parquet(state_folder).filter(F.col("unit") == unit)
        last = stored.groupBy(by).agg(F.max_by("sha256", "number").alias("old"), F.max("number").alias("number"))
        number = stored.agg(F.max("number")).first()[0] or 0
    else:
        last, number = now.select(by, F.col("sha256").alias("old")).limit(0), 0
    left, right = now.alias("now"), last.where("old is not null").alias("last")
    both = left.join(right, F.col(f"now.{by}").eqNullSafe(F.col(f"last.{by}")), "full")
    action = (
        F.when(F.col("old").isNull(), "new").when(F.col("sha256").isNull(), "gone")
        .when(F.col("old") == F.col("sha256"), "same").otherwise("changed")
    )
    key = F.when(F.col("sha256").isNull(), F.col(f"last.{by}")).otherwise(F.col(f"now.{by}")).alias(by)
    written = F.sum(F.when(F.col("action").isin("new", "changed"), F.col("n_rows")))
    report, seen = cut_observed(
        both.select(key, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "sha256", action.alias("action")), "partitions",
        written=F.coalesce(written, F.lit(0)), **{a: F.count_if(F.col("action") == a) for a in ("new", "changed", "same", "gone")})
    if seen["new"] + seen["changed"]:
        todo = report.where(F.col("action").isin("new", "changed")).select(F.col(by).alias("_part"))
        df.join(todo, F.col(by).eqNullSafe(F.col("_part")), "left_semi").hint("rebalance", F.col(by)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)
    if seen["gone"]:  # names of folders, as many as the file system lists
        gone = [r[by] for r in report.where(F.col("action") == "gone").select(by).collect()]
        _delete_partitions(spark, folder, by, gone)
    moved = report.where(F.col("action") != "same")
    if seen["new"] + seen["changed"] + seen["gone"]:
        moved.select(F.lit(unit).alias("unit"), by, "sha256", F.lit(number + 1).cast("bigint").alias("number")).write.mode("append").parquet(state_folder)
    if audit_folder:
        status = "success" if seen["new"] + seen["changed"] + seen["gone"] else "no_new_data"
        note = json.dumps({a: seen[a] for a in ("new", "changed", "same", "gone")})
        audit_row(spark, unit, run_id, status, seen["written"], 0, "", note).write.mode("append").parquet(audit_folder)
    return report.drop("sha256")


def _delete_partitions(spark: SparkSession, folder: str, by: str, values: list[str | None]) -> None:
    jvm = spark.sparkContext._jvm
    escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value in (None, "") else escaped(value)
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{escaped(by)}={name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def observed_rows(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """A written copy of the table and its number of rows, from one job."""
    staged, seen = cut_observed(df, label, n=row_count())
    return staged, seen["n"]
