"""Date/time column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake.functions.text import col_

__all__ = [
    "valid_day", "ymd_num", "ts_num", "build_ts", "trunc", "minus_months", "year_month",
    "rfc3339", "lenient_ts", "lenient_double", "strict_ts", "kelvin_to_c", "ts_literal",
]


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime/date/ISO string."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def valid_day(d, m) -> Column:
    """Day/month validity with 30-day months and Feb <= 29 in any year.

    Deliberately not `make_date`: 29/02 must count as valid for format detection.
    """
    d, m = col_(d), col_(m)
    return (
        m.between(1, 12) & d.between(1, 31)
        & ~(m.isin(4, 6, 9, 11) & (d > 30))
        & ~((m == 2) & (d > 29))
    )


def ymd_num(y, m, d) -> Column:
    return col_(y).cast("long") * 10000 + col_(m) * 100 + col_(d)


def ts_num(y, m, d, hh, mi, ss) -> Column:
    """Sortable yyyymmddHHMMSS number."""
    return ymd_num(y, m, d) * 1000000 + col_(hh) * 10000 + col_(mi) * 100 + col_(ss)


def build_ts(y, m, d, hh, mi, ss=None) -> Column:
    """TIMESTAMP_NTZ from parts; NULL when the parts do not form a real instant."""
    sec = F.lit(0) if ss is None else F.coalesce(col_(ss), F.lit(0))
    return F.try_make_timestamp_ntz(col_(y), col_(m), col_(d), col_(hh), col_(mi), sec)


def trunc(c, grain: str) -> Column:
    """date_trunc that keeps TIMESTAMP_NTZ (Spark returns the zoned type)."""
    return F.date_trunc(grain, col_(c)).cast("timestamp_ntz")


def minus_months(c, n) -> Column:
    """Timestamp minus n calendar months (day clipped to month end)."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return (col_(c) - F.make_interval(F.lit(0), n.cast("int"))).cast("timestamp_ntz")


def year_month(c) -> Column:
    return F.date_format(col_(c), "yyyy-MM")


def rfc3339(c) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def lenient_ts(c) -> Column:
    """Text -> TIMESTAMP_NTZ or NULL (ISO forms, optional `T`); text with an offset is converted to UTC."""
    text = F.trim(col_(c).cast("string"))
    offset = r"(:\d\d[^+-]*)([+-]\d\d):?(\d\d)$"
    zoned = F.regexp_replace(text, offset, "$1$2:$3").try_cast("timestamp")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), zoned.cast("timestamp_ntz"))
    return F.when(text.rlike(offset), utc).otherwise(F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz"))


def lenient_double(c) -> Column:
    """Text -> DOUBLE or NULL; type suffixes (`1d`) are no numbers."""
    text = F.trim(col_(c).cast("string"))
    number = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)$"
    return F.when(text.rlike(number), text.try_cast("double"))


def strict_ts(c) -> Column:
    """Text -> TIMESTAMP_NTZ; raises on bad text (ANSI cast)."""
    return col_(c).cast("timestamp_ntz")


def kelvin_to_c(c) -> Column:
    return col_(c) - F.lit(273.15)
