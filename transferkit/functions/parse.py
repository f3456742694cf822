"""Canonical text and load text back to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.types import BINARY, ColumnInfo


def _bool(c: Column) -> Column:
    return (
        F.when(c.isin("true", "1"), F.lit(True))
        .when(c.isin("false", "0"), F.lit(False))
        .when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a bool: "), c)).cast("boolean"))
    )


def _clock(c: Column) -> Column:
    return F.regexp_replace(c, r"^\d{4}-\d{2}-\d{2}T|Z$", "")


def _dashed(c: Column) -> Column:
    return F.regexp_replace(
        c, r"^([0-9A-Fa-f]{8})([0-9A-Fa-f]{4})([0-9A-Fa-f]{4})([0-9A-Fa-f]{4})([0-9A-Fa-f]{12})$",
        "$1-$2-$3-$4-$5",
    )


def typed_value(c: Column, info: ColumnInfo) -> Column:
    """Parse one column of canonical or load text.  Text that does not fit the type is an error
    (ANSI mode, Spark's default), never a silent NULL."""
    t = info.type
    target: T.DataType = info.spark_type()
    if t in BINARY:
        return F.unhex(F.regexp_replace(c, r"^\\x", ""))
    if t == "bool":
        return _bool(c)
    if t == "date":
        return F.substring(c, 1, 10).cast("date")
    if t == "datetimetz":
        # load text of zone-aware columns may lack the zone: it is UTC then
        zoned = c.rlike(r"(Z|[+-]\d{2}:\d{2})$")
        return F.when(zoned, c).otherwise(F.concat(c, F.lit("Z"))).cast("timestamp")
    if t == "time":
        return _clock(c)
    if t == "uuid":
        return _dashed(c)
    return c.cast(target)
