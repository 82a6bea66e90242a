"""Text-to-type conversions that turn bad values into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# plain decimal notation; a cast alone would also take "NaN", "Infinity" and "12d"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: Column | str, fill: float | None = None) -> Column:
    """Text to double; junk becomes NULL, or ``fill`` when one is given."""
    text = _col(c).cast("string")
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return value if fill is None else F.coalesce(value, F.lit(float(fill)))


def whole_id(c: Column | str) -> Column:
    """Identifier as bigint, also when it arrived as ``123.0``; junk and broken numbers become NULL.

    A zero fraction is cut off as text, so no digit is lost to a double."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(r"^[+-]?\d+(\.0*)?$"), F.regexp_replace(text, r"\..*$", "").try_cast("bigint"))


def moment(c: Column | str) -> Column:
    """Text that begins with a date to timestamp; junk, and a bare clock time, become NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(r"^\s*\d{4}-\d"), text.try_cast("timestamp"))


def hour_of(c: Column | str) -> Column:
    return F.hour(_col(c))


def clock_hour(c: Column | str) -> Column:
    """Hour of an ``HH:MM:SS`` text, -1 when it is not a time within one day."""
    return F.coalesce(F.hour(F.try_to_timestamp(_col(c), F.lit("HH:mm:ss"))), F.lit(-1))


def has_day_type(c: Column | str, wanted: str) -> Column:
    """Case-insensitive literal contains; NULL names never match."""
    return F.coalesce(F.lower(_col(c)).contains(wanted.lower()), F.lit(False))


def stop_name(c: Column | str) -> Column:
    """Comparable stop name: upper case, without the city suffix; NULL becomes empty."""
    name = F.upper(_col(c))
    for suffix in (" (STADT ZÜRICH)", " (ZÜRICH)"):
        name = F.replace(name, F.lit(suffix), F.lit(""))
    return F.coalesce(F.trim(name), F.lit(""))


def share(part: Column | str, total: Column | str) -> Column:
    """Part of a total, 0 where the total is 0."""
    return F.coalesce(F.try_divide(_col(part), _col(total)), F.lit(0.0))


def rounded(c: Column | str, places: int) -> Column:
    """Half-away-from-zero rounding on exact decimals."""
    return F.round(_col(c).cast("decimal(30,10)"), places)
