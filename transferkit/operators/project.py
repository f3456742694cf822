"""Whole-table projections: to canonical text, to load text, to literals, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferkit.functions.literal import sql_literal
from transferkit.functions.load import load_text
from transferkit.functions.parse import typed_value
from transferkit.functions.text import canonical_text, null_token
from transferkit.types import META, ColumnInfo, column, column_infos


def _columns(df: DataFrame, encode, null: str | None, compat: bool) -> dict[str, Column]:
    out = {}
    for field, info in zip(df.schema.fields, column_infos(df)):
        text = encode(column(field.name), info, field.dataType)
        if null is not None:
            text = null_token(text, null, info, compat)
        out[field.name] = text.alias(field.name, metadata={META: info.metadata()})
    return out


def _project(df: DataFrame, encode, null: str | None, compat: bool) -> DataFrame:
    return df.select(*_columns(df, encode, null, compat).values())


def to_canonical(
    df: DataFrame, source: str | None = None, null: str | None = "{nll}", compat: bool = False
) -> DataFrame:
    """Every column as canonical text, NULL as the token (or kept as NULL with ``null=None``)."""
    return _project(df, lambda c, i, t: canonical_text(c, i, t, source, compat), null, compat)


def to_load(
    df: DataFrame,
    target: str,
    null: str | None = None,
    compat: bool = False,
    source: str | None = None,
) -> DataFrame:
    """Every column as the text ``target``'s bulk loader reads."""
    return df.select(*load_columns(df, target, null, compat, source).values())


def load_columns(
    df: DataFrame,
    target: str,
    null: str | None = None,
    compat: bool = False,
    source: str | None = None,
) -> dict[str, Column]:
    """The expressions of ``to_load`` by column name, to use several targets in one projection."""
    return _columns(df, lambda c, i, t: load_text(c, i, t, target, source, compat), null, compat)


def to_literals(df: DataFrame, target: str, null: str | None = "null", compat: bool = False) -> DataFrame:
    """Every column as an SQL literal of ``target``; NULL as a bare ``null``."""
    return _project(df, lambda c, i, t: sql_literal(c, i, t, target, None, compat), null, True)


def from_canonical(
    df: DataFrame, columns: list[ColumnInfo] | None = None, null: str | None = "{nll}"
) -> DataFrame:
    """Text columns back to typed ones: the inverse of ``to_canonical`` and ``to_load``.

    ``columns`` defaults to the descriptions in the text columns' metadata.
    """
    infos = columns or column_infos(df)
    out = []
    for name, info in zip(df.columns, infos):
        text = column(name)
        if null is not None:
            text = F.when(text != F.lit(null), text)
        out.append(typed_value(text, info).alias(info.name, metadata={META: info.metadata()}))
    return df.select(*out)


def key_columns(df: DataFrame) -> DataFrame:
    """The primary-key columns only, in table order."""
    keys = [i.name for i in column_infos(df) if i.primary_key]
    if not keys:
        raise ValueError("no column is tagged as primary key; use tag(df, keys=[...])")
    return df.select(*[column(k) for k in keys])

