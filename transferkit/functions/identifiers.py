"""Identifier quoting as column expressions, for catalog-wide jobs, and for single names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from transferkit.systems import profile

# A name that needs no quotes: an ASCII letter, _, @ or # first, then letters, digits and _.
PLAIN_NAME = r"^[A-Za-z_@#][\p{L}\p{Nd}_]*$"


def is_reserved(name: Column, system: str, compat: bool = False) -> Column:
    """Whether a name is one of the system's key words.  ``compat`` matches the lower-case lists by
    exact case, so that ``SELECT`` would stay unquoted on PostgreSQL and Snowflake."""
    p = profile(system)
    words = p.reserved_words(compat)
    if not words or (compat and not p.keywords_compat):
        return name.isNull() & F.lit(False)
    if not compat:
        return F.lower(name).isin([w.lower() for w in words])
    return (F.upper(name) if p.keyword_case == "upper" else name).isin(words)


def needs_quotes(name: Column, system: str, compat: bool = False) -> Column:
    if profile(system).quote_all and not compat:
        return name != F.lit("")
    plain = name.rlike(PLAIN_NAME) & ~is_reserved(name, system, compat)
    return (name != F.lit("")) & ~plain


def quoted(name: Column, system: str, compat: bool = False) -> Column:
    """The name, in the system's quotes where needed; inner closing quotes are doubled."""
    before, after = profile(system).quotes
    inner = name if compat else F.replace(name, F.lit(after), F.lit(after * 2))
    wrapped = F.concat(F.lit(before), inner, F.lit(after))
    return F.when(needs_quotes(name, system, compat), wrapped).otherwise(name)


def qualified(schema: Column, table: Column, system: str, compat: bool = False) -> Column:
    """``schema.table``, or the table alone for systems without schemas."""
    t = quoted(table, system, compat)
    if not profile(system).schema_required:
        return t
    return F.concat_ws(".", quoted(schema, system, compat), t)


_PLAIN = re.compile(r"[A-Za-z_@#]\w*\Z")


def quote_name(name: str, system: str) -> str:
    """Quote one name given by the caller of a transfer."""
    p = profile(system)
    words = {w.lower() for w in p.reserved_words()}
    plain = _PLAIN.match(name) and name.lower() not in words and not p.quote_all
    if not name or plain:
        return name
    before, after = p.quotes
    return before + name.replace(after, after * 2) + after


def qualify_name(schema: str | None, table: str, system: str) -> str:
    t = quote_name(table, system)
    return f"{quote_name(schema, system)}.{t}" if schema and profile(system).schema_required else t


def string_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"
