"""Fitting tables to a schema: tolerant on input, reported on output."""

from __future__ import annotations

import re
from itertools import chain, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbsight.functions import cleaning

_RUN = re.compile(r"[^\W_]+")
_CAPITAL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Bookkeeping columns that a target table fills by itself.
TARGET_OWN_COLUMNS = ("flow_id", "facade_pk", "created_at", "updated_at")
# Columns loaded as whole numbers.
WHOLE_COLUMNS = ("u", "v", "key", "hour", "n_runs")


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, float] | None = None,
            required: tuple[str, ...] = ()) -> DataFrame:
    """Select, convert and complete columns of ``schema``; bad values become NULL.

    Columns with a default are created when absent and filled when NULL. Missing
    required columns are an error.
    """
    defaults = defaults or {}
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")

    def fitted(field: T.StructField) -> Column | None:
        name = field.name
        if name not in df.columns:
            return F.lit(defaults[name]).cast(field.dataType).alias(name) if name in defaults else None
        # whole numbers need no parsing
        if isinstance(field.dataType, T.LongType) and isinstance(df.schema[name].dataType, _WHOLE):
            return F.col(name).cast(field.dataType).alias(name)
        return _converted(name, field.dataType, defaults.get(name)).alias(name)

    columns = [fitted(f) for f in schema.fields]
    return df.select(*[c for c in columns if c is not None])


def _converted(name: str, kind: T.DataType, default: float | None) -> Column:
    if isinstance(kind, T.DoubleType):
        return cleaning.number(name, default)
    if isinstance(kind, T.LongType):
        return cleaning.whole_id(name)
    if isinstance(kind, T.IntegerType):
        return cleaning.whole_id(name).try_cast("int")
    if isinstance(kind, T.TimestampType):
        return cleaning.moment(name)
    return F.col(name).cast(kind)


def texts_for_write(df: DataFrame) -> DataFrame:
    """Arrays of text joined to one text, so that any reader can take the column."""

    def as_text(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            return F.concat_ws(",", field.name).alias(field.name)
        return F.col(field.name)

    return df.select(*[as_text(f) for f in df.schema.fields])


def snake_names(names: list[str]) -> list[str]:
    """Distinct snake-case names, in order.

    A name is the list of its words: runs of letters and digits, cut again before a capital that follows a small letter or a
    digit. No words make ``col``; a digit in front gets ``col_``; a name that is already there counts up from ``_2``."""
    out: list[str] = []
    for name in names:
        words = [w for run in _RUN.findall(name) for w in _CAPITAL.split(run)]
        wanted = "_".join(words).lower() or "col"
        if wanted[0].isdigit():
            wanted = f"col_{wanted}"
        numbered = (f"{wanted}_{n}" for n in count(2))
        out.append(next(x for x in chain([wanted], numbered) if x not in out))
    return out


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))


def fit_target(df: DataFrame, target: list[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Lower-case names, keep the target's columns, make key columns whole numbers.

    Returns the table, the target columns it lacks and its columns the target lacks.
    """
    lower = df.toDF(*[c.lower() for c in df.columns])
    target = [c for c in target if c not in TARGET_OWN_COLUMNS]
    shared = [c for c in target if c in lower.columns]
    if not shared:
        raise ValueError("no column in common with the target")
    whole = {c: F.col(c).cast("bigint") for c in WHOLE_COLUMNS if c in shared}
    missing = [c for c in target if c not in lower.columns]
    extra = [c for c in lower.columns if c not in target]
    return lower.withColumns(whole).select(*shared), missing, extra
