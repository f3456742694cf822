"""Typed values to canonical text.

Everything is a built-in expression inside whole-stage codegen.  Timestamps go through
``timestamp_ntz`` and a cast to string, which prints up to six fraction digits without trailing
zeros and never looks at the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.types import BINARY, CANONICAL_TYPES, FREE_TEXT, ColumnInfo

TIME_PATTERN = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,9})?$"


def utc_wall_clock(c: Column, dtype: T.DataType) -> Column:
    """An instant as its UTC wall-clock time; exact in any session zone, also around DST changes."""
    if isinstance(dtype, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch)
    return c.cast("timestamp_ntz")


def trim_fraction(t: Column) -> Column:
    """``10:11:12.500`` to ``10:11:12.5``, ``10:11:12.000`` to ``10:11:12``."""
    return F.when(F.contains(t, F.lit(".")), F.regexp_replace(t, r"[.]?0*$", "")).otherwise(t)


def time_text(t: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Time of day without trailing zeros; JDBC reads a time as a timestamp of some day."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.substr(t.cast("string"), F.lit(12))
    bad = F.raise_error(F.concat(F.lit("not a time of day: "), t))
    return F.when(t.isNull(), t).when(t.rlike(TIME_PATTERN), trim_fraction(t)).otherwise(bad)


def float_text(c: Column, compat: bool = False) -> Column:
    """Shortest text that reads back as the same number; with ``compat``, six decimals."""
    if not compat:
        return c.cast("string")
    d = c.cast("double")
    size, six = F.abs(d), F.lit("0.000000")
    # most values have few decimals: padding their digits is exact and much cheaper than formatting
    digits = d.cast("string")
    dot = F.instr(digits, ".")
    short = (size < F.lit(1e7)) & (F.length(digits) - dot <= 6) & ~F.contains(digits, F.lit("E"))
    # from 1e9 on, six decimals are more digits than the shortest text has: take the number apart
    whole = d.cast("long")
    exact = whole.cast("decimal(20,0)") + (d - whole).cast("decimal(18,17)")
    return (
        F.when(short, F.rpad(digits, dot + 6, F.lit("0")))
        .when(size < F.lit(1e9), F.call_function("format_number", d, six))
        .when(size < F.lit(2.0**63), F.call_function("format_number", exact, six))
        .when(size < F.lit(float("inf")), F.call_function("format_number", d, six))
        .otherwise(F.replace(F.replace(digits, F.lit("Infinity"), F.lit("+Inf")), F.lit("-+"), F.lit("-")))
    )


def decimal_text(c: Column, dtype: T.DataType) -> Column:
    """Plain digits; the cast alone may print an exponent for scales over 6 outside ANSI mode."""
    if isinstance(dtype, T.DecimalType) and dtype.scale > 6:
        return F.call_function("format_number", c, F.lit("0." + "0" * dtype.scale))
    return c.cast("string")


def hex_text(c: Column) -> Column:
    return F.lower(F.hex(c))


def guid_text(c: Column) -> Column:
    """A 16-byte SQL Server GUID: its first three groups are stored with reversed bytes."""
    h = F.hex(c)

    def byte(i: int) -> Column:
        return F.substring(h, 2 * i + 1, 2)

    return F.when(
        c.isNotNull(),
        F.concat_ws(
            "-",
            F.concat(*[byte(i) for i in (3, 2, 1, 0)]),
            F.concat(*[byte(i) for i in (5, 4)]),
            F.concat(*[byte(i) for i in (7, 6)]),
            F.substring(h, 17, 4),
            F.substring(h, 21, 12),
        ),
    )


def bit_text(c: Column, compat: bool = False) -> Column:
    """BIT bytes (at most 8) to binary digits without leading zeros.

    ``compat`` prints every byte on its own without padding, as ``0x0101`` to ``11``, and zero as
    an empty text.
    """
    if not compat:
        return F.conv(F.hex(c), 16, 2)
    h = F.hex(c)
    starts = F.sequence(F.lit(1), F.greatest(F.length(h) - 1, F.lit(1)), F.lit(2))
    per_byte = F.transform(starts, lambda i: F.conv(F.substr(h, i, F.lit(2)), 16, 2))
    return F.when(c.isNotNull(), F.regexp_replace(F.array_join(per_byte, ""), "^0+", ""))


def _rfc3339(ntz: Column) -> Column:
    return F.concat(F.replace(ntz.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def canonical_text(
    c: Column, info: ColumnInfo, dtype: T.DataType, source: str | None = None, compat: bool = False
) -> Column:
    """Canonical text of one column; NULL stays NULL."""
    t = info.type
    if t in ("float64", "float32"):
        # only the sources that print six decimals have a compat form
        return float_text(c, compat and source in (None, "postgresql", "mssql", "snowflake"))
    if t in ("decimal", "money"):
        return decimal_text(c, dtype)
    if t in ("datetime", "datetimetz"):
        return _rfc3339(utc_wall_clock(c, dtype))
    if t == "date":
        day = c.cast("date") if not isinstance(dtype, T.DateType) else c
        return F.concat(day.cast("string"), F.lit("T00:00:00Z"))
    if t == "time":
        if source == "oracle":
            return c
        return F.concat(F.lit("0000-01-01T"), time_text(c, dtype), F.lit("Z"))
    if t in BINARY:
        return hex_text(c)
    if t == "uuid" and isinstance(dtype, T.BinaryType):
        return guid_text(c)
    if t == "varbit" and isinstance(dtype, T.BinaryType):
        return bit_text(c, compat)
    if t == "varbit" and isinstance(dtype, T.IntegralType):
        return F.bin(c)
    if t == "varbit" and isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("string")
    if t == "json" and isinstance(dtype, T.VariantType):
        return F.to_json(c)
    if t in CANONICAL_TYPES:
        return c.cast("string")
    raise ValueError(f"unsupported canonical type for column {info.name}: {t}")


# Characters of the text of numbers, bools, timestamps and hex values.
_VALUE_CHARACTERS = set("-+0123456789.: \\xTZ" "abcdefABCDEF" "true false NaN Infinity")


def may_hold(info: ColumnInfo, token: str) -> bool:
    """Whether a column's text can have the token in it at all; if not, no row needs a check."""
    return info.type in FREE_TEXT or set(token) <= _VALUE_CHARACTERS


def refuse_token(text: Column, token: str, info: ColumnInfo, compat: bool = False) -> Column:
    """A real value equal to the null token would be read back as NULL, so it stops the job; ``compat``
    lets it through."""
    if compat or not may_hold(info, token):
        return text
    clash = F.raise_error(F.lit(f"column {info.name} holds the null token {token} as a value"))
    return F.when(text == F.lit(token), clash).otherwise(text)


def null_token(text: Column, token: str, info: ColumnInfo, compat: bool = False) -> Column:
    """NULL becomes the token."""
    return F.coalesce(refuse_token(text, token, info, compat), F.lit(token))
