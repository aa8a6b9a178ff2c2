"""String column expressions: trimming, null tokens, ids and location levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens a sensor export writes for "no reading"
# (compared after trimming spaces and upper-casing).
NULL_TOKENS = ["", "-", "NA", "N/A", "NULL"]
# Fixed value: a plain decimal number, optionally negative.
NUMERIC_PATTERN = r"^-?[0-9]+([.][0-9]+)?$"
# Fixed value: the sensor id is four upper-case hex digits between underscores.
SENSOR_ID_PATTERN = r"(?<=_)([0-9A-F]{4})(?=_)"

__all__ = [
    "NULL_TOKENS", "NUMERIC_PATTERN", "SENSOR_ID_PATTERN",
    "col_", "trim_spaces", "upper_trim", "strip_bom", "null_tokens", "is_numeric",
    "decimal_comma", "sensor_id", "basename", "date_parts", "level", "after", "after_prefix",
    "section", "floor_code", "floor_class", "levels",
]


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c) -> Column:
    """Remove leading/trailing spaces only (tabs and CR stay, as in the source)."""
    return F.regexp_replace(col_(c), r"^ +| +$", "")


def upper_trim(c) -> Column:
    return F.upper(trim_spaces(c))


def strip_bom(c) -> Column:
    return F.regexp_replace(col_(c), "^﻿", "")


def null_tokens(c) -> Column:
    """Trimmed text, or NULL when the cell holds a null token."""
    t = trim_spaces(c)
    return F.when(t.isNull() | F.upper(t).isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def is_numeric(c) -> Column:
    return col_(c).rlike(NUMERIC_PATTERN)


def decimal_comma(c, precision: int = 18, scale: int = 3) -> Column:
    """`21,5` -> 21.500 as decimal(18,3); unparseable text -> NULL."""
    return F.regexp_replace(trim_spaces(c), ",", ".").try_cast(f"decimal({precision},{scale})")


def basename(c) -> Column:
    return F.regexp_extract(col_(c), r"([^/\\]*)$", 1)


def sensor_id(c) -> Column:
    """First `_XXXX_` hex id in a file's base name; NULL when there is none."""
    sid = F.regexp_extract(basename(c), SENSOR_ID_PATTERN, 1)
    return F.when(sid != "", sid)


def date_parts(date_text, time_text) -> Column:
    """Split `NN/NN/NNNN` and `H:MM[:SS]` into ints p1, p2, year, hour, minute, second."""
    d = F.split(col_(date_text), "/")
    t = F.split(col_(time_text), ":")
    return F.struct(
        d.getItem(0).cast("int").alias("p1"),
        d.getItem(1).cast("int").alias("p2"),
        d.getItem(2).cast("int").alias("year"),
        t.getItem(0).cast("int").alias("hour"),
        t.getItem(1).cast("int").alias("minute"),
        F.coalesce(F.try_element_at(t, F.lit(3)).cast("int"), F.lit(0)).alias("second"),
    )


def level(c, method: str, n: int) -> Column:
    """`suffix` = last n characters, `prefix` = first n characters."""
    if method == "suffix":
        return F.right(col_(c), F.lit(n))
    if method == "prefix":
        return F.left(col_(c), F.lit(n))
    raise ValueError(f"unknown level method {method!r}")


def after(c, sep: str) -> Column:
    """Text after the first separator, or the whole text when it is absent."""
    return F.coalesce(F.try_element_at(F.split(col_(c), F.lit(sep), 2), F.lit(2)), col_(c))


def after_prefix(c, prefix: str) -> Column:
    return F.when(col_(c).startswith(prefix), F.substring(col_(c), F.lit(len(prefix) + 1), F.length(col_(c)))).otherwise(col_(c))


def section(c) -> Column:
    """Section number of a location: its last character as an int (NULL if not a digit)."""
    return F.right(col_(c), F.lit(1)).try_cast("int")


def floor_code(c) -> Column:
    return F.left(col_(c), F.lit(3))


def floor_class(c) -> Column:
    code = floor_code(c)
    return F.when(code.contains("NP"), F.lit("NP")).when(code.contains("PP"), F.lit("PP"))


def levels(c) -> Column:
    return F.struct(section(c).alias("section"), floor_code(c).alias("floor"), floor_class(c).alias("floor_class"))
