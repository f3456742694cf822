"""Typed values to the text each target's bulk loader reads.

The typed value goes straight to load text: there is no staged copy in between.  ``compat`` gives
the historical text; the default repairs the cases a loader would refuse or cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.functions.text import canonical_text, hex_text, time_text, utc_wall_clock
from transferkit.systems import profile
from transferkit.types import BINARY, TEXT, ColumnInfo

NUL = "\x00"


def load_text(
    c: Column, info: ColumnInfo, dtype: T.DataType, target: str, source: str | None = None, compat: bool = False
) -> Column:
    """Load text of one column for ``target``; NULL stays NULL."""
    rules, t = profile(target).load, info.type
    if t == "datetime" and not rules.rfc3339_timestamps:
        return utc_wall_clock(c, dtype).cast("string")
    if t == "datetimetz" and not rules.rfc3339_timestamps:
        wall = utc_wall_clock(c, dtype).cast("string")
        offset = rules.offset if compat else rules.exact_offset
        return F.concat(wall, F.lit(offset)) if offset else wall
    if t == "date":
        return c.cast("date").cast("string")
    if t == "time":
        return time_text(c, dtype)
    if t in BINARY and not isinstance(dtype, T.StringType):
        return F.concat(F.lit(rules.binary_prefix), hex_text(c)) if rules.binary_prefix else hex_text(c)
    if t == "uuid":
        text = canonical_text(c, info, dtype, source, compat)
        bare = rules.bare_uuid or (rules.bare_uuid_exact and not compat)
        return F.replace(text, F.lit("-")) if bare else text
    if t == "bool":
        digits = rules.bool_digits or (rules.bool_digits_exact and not compat)
        return c.cast("boolean").cast("int" if digits else "string").cast("string")
    if t in TEXT and rules.empty_as_nul:
        text = c.cast("string")
        return F.when(text == F.lit(""), F.lit(NUL)).otherwise(text)
    return canonical_text(c, info, dtype, source, compat)


def null_as_empty(text: Column) -> Column:
    """SQL Server's loader reads an empty field as NULL."""
    return F.coalesce(text, F.lit(""))


__all__ = ["NUL", "load_text", "null_as_empty"]
