"""Typed values to SQL literals of each target, for statements such as keyed deletes.

``compat`` gives the historical literals, some of which a database refuses (unquoted uuids, bytes
without quotes, an unclosed call); the default is the form the vendor documents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.functions.text import canonical_text, hex_text, time_text, utc_wall_clock
from transferkit.systems import profile
from transferkit.types import BINARY, TEXT, ColumnInfo


def _wrap(before: str, c: Column, after: str) -> Column:
    return F.concat(F.lit(before), c, F.lit(after))


def _text(c: Column, backslash_escapes: bool) -> Column:
    if backslash_escapes:
        c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return _wrap("'", F.replace(c, F.lit("'"), F.lit("''")), "'")


def sql_literal(
    c: Column, info: ColumnInfo, dtype: T.DataType, target: str, source: str | None = None, compat: bool = False
) -> Column:
    """SQL literal of one column for ``target``; NULL stays NULL."""
    lit, t = profile(target).literal, info.type
    if t in TEXT or t in ("json", "xml"):
        text = canonical_text(c, info, dtype, source, compat)
        return _text(text, lit.backslash_escapes and not compat)
    if t in ("datetime", "datetimetz"):
        wall = utc_wall_clock(c, dtype).cast("string")
        zoned = t == "datetimetz" and not compat and lit.zone
        if zoned:
            wall = F.concat(wall, F.lit(lit.zone))
        before, after = lit.zoned_timestamp if zoned else lit.timestamp
        return _wrap(before, wall, after)
    if t == "date":
        day = c.cast("date").cast("string")
        if compat and lit.long_dates:
            day = F.concat(day, F.lit(" 00:00:00"))
        return _wrap(*_around(lit.date, day))
    if t == "time":
        clock = time_text(c, dtype)
        if compat and lit.long_dates:
            clock = F.concat(F.lit("0000-01-01 "), clock)
        return _wrap("'", clock, "'")
    if t in BINARY:
        form = lit.binary_compat[t] if compat else lit.binary
        return _wrap(*_around(form, hex_text(c)))
    if t == "uuid":
        text = canonical_text(c, info, dtype, source, compat)
        if compat:
            return text
        if lit.uuid_bytes:
            return _wrap(*_around(lit.uuid_bytes, F.replace(text, F.lit("-"))))
        return _wrap("'", text, "'")
    if t == "bool":
        digits = lit.bool_digits or (lit.bool_digits_exact and not compat)
        return c.cast("boolean").cast("int" if digits else "string").cast("string")
    if t == "varbit" and not compat:
        return _wrap(*_around(lit.bits, canonical_text(c, info, dtype, source, compat)))
    return canonical_text(c, info, dtype, source, compat)


def _around(form: tuple[str, str], c: Column) -> tuple[str, Column, str]:
    return form[0], c, form[1]
