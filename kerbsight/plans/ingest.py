"""One incremental ingest run of a counting dataset."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from kerbsight.operators.conform import snake_names
from kerbsight.sources import landing


@dataclass(frozen=True)
class Folders:
    raw: str
    months: str
    state: str
    audit: str


def ingest_year(source: DataFrame, year: int, dataset: str, run_id: str, folders: Folders,
                time: str = "MessungDatZeit", ident: str = "_id", before_state=None) -> str:
    """Take what is new since the watermark: raw append, month upsert, state, audit.

    The watermark is written after the data, so a failed run is repeated in full. Its raw
    rows and its rejects replace those of the failed run, and the upsert changes nothing the
    second time. The audit has arrived = written + rejected. Returns the run's status.
    """
    spark = source.sparkSession
    last_time = None
    try:
        last_time, last_id = landing.read_state(spark, folders.state, year)
        load = re.sub(r"\W", "_", f"{year}-after-{last_time}-{last_id}")
        arrived, rows = landing.land_raw(
            landing.new_records(source, year, last_time, last_id, time, ident), folders.raw, year, load
        )
        if not rows:
            _audit(spark, folders, dataset, run_id, "no_new_data", 0, year, last_time or "", "no new records")
            return "no_new_data"
        snake_time, snake_ident = snake_names([time]), snake_names([ident])
        written = landing.upsert_months(arrived, folders.months, snake_ident, snake_time[0], load)
        mark = landing.watermark(arrived, time, ident)
        if before_state:  # a last check of the caller's; if it raises, the run has failed
            before_state()
        landing.append_state(mark, folders.state, year)
        newest = mark.first()
        _audit(spark, folders, dataset, run_id, "success", rows, year, newest["last_ts"],
               json.dumps({"records_arrived": rows, **{f"records_{k}": n for k, n in written.items()}}))
        return "success"
    except Exception as error:
        _audit(spark, folders, dataset, run_id, "error", 0, year, last_time or "", str(error))
        raise


def _audit(spark, folders: Folders, dataset: str, run_id: str, status: str, records: int, year: int,
           watermark: str, message: str) -> None:
    row = landing.audit_row(spark, dataset, run_id, status, records, year, watermark, message)
    row.write.mode("append").parquet(folders.audit)
