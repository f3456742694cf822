"""Words as column expressions, and the names operators use inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# what stands between words: ASCII that is no letter or digit
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLANKS = r"[\x20\x09-\x0D]+"


def text_of(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and no other letter; pure ASCII goes by the quick way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def tokens(text: Column) -> Column:
    """Runs of characters that are no blanks."""
    return F.array_remove(F.split(text, BLANKS), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever the optimizer does with projections around it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def places(n: Column, width: int | Column) -> Column:
    """Starts, from 0, of the windows of ``width`` among ``n`` words."""
    return F.when(n >= width, F.sequence(F.lit(0), (n - width).cast("int"))).otherwise(F.expr("array()").cast("array<int>"))
