"""Keyed deletes, upserts and high-water marks.

Skew: a key may own a large share of the target's rows.  The key side is made distinct before the
join, and it is grouped as a struct so that the join keeps exchanges of its own on both sides; AQE then
splits an oversized target partition over several tasks.  A key side below the broadcast threshold is
broadcast by Catalyst, from its measured size, and the target is not shuffled at all.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.functions.identifiers import qualify_name, quote_name
from transferkit.operators.numbering import numbered
from transferkit.operators.project import to_literals
from transferkit.types import column, tag

KEYS_PER_STATEMENT = 6
_NUMBER = "transferkit_number"


def _distinct_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    grouped = rows.select(F.struct(*[column(k) for k in keys]).alias("k")).distinct()
    return grouped.select(*[F.col("k").getField(k).alias(k) for k in keys])


def _no_nulls(keys: list[str]) -> Column:
    return reduce(and_, [column(k).isNotNull() for k in keys])


def delete_by_keys(target_df: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key tuple is not among ``keys_df``.

    As in SQL, a NULL in a key never matches: such target rows stay and such key rows delete nothing.
    """
    doomed = _distinct_keys(keys_df.where(_no_nulls(keys)), keys)
    left = target_df.join(doomed, keys, "left_anti")
    return left.select(*[column(c) for c in target_df.columns])


def upsert(target_df: DataFrame, rows_df: DataFrame, keys: list[str]) -> DataFrame:
    """Delete by the keys of the new rows, then append all of the new rows."""
    return delete_by_keys(target_df, rows_df, keys).unionByName(rows_df)


def _bucket(text: Column, buckets: int) -> Column:
    """A bucket that is the same on every engine: 28 bits of the text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % F.lit(buckets)


def _key_tuples(
    target: str, keys: list[str], table: str, schema: str | None, compat: bool
) -> tuple[Column, str, str, str]:
    """A key tuple from columns of literals, and what stands before, after and between tuples in a statement."""
    names = [quote_name(k, target) for k in keys]
    start = f"delete from {qualify_name(schema, table, target)} where "
    if target == "mssql" and not compat:  # no row values in T-SQL
        if len(keys) == 1:
            return column(keys[0]), f"{start}{names[0]} in (", ")", ","
        parts = [F.concat(F.lit(f"{n} = "), column(k)) for n, k in zip(names, keys)]
        return F.concat(F.lit("("), F.concat_ws(" and ", *parts), F.lit(")")), start, "", " or "
    text = F.concat(F.lit("("), F.concat_ws(",", *[column(k) for k in keys]), F.lit(")"))
    return text, f"{start}({','.join(names)}) in (", ")", ","


def delete_statements(
    keys_df: DataFrame,
    target: str,
    table: str,
    schema: str | None = None,
    keys: list[str] | None = None,
    batch: int = KEYS_PER_STATEMENT,
    buckets: int | None = None,
    compat: bool = False,
) -> DataFrame:
    """Delete statements of ``batch`` key tuples each: columns ``bucket``, ``batch``, ``statement``.

    By default the keys are numbered in their order, over all of them: every statement but the last is full and
    ``bucket`` is 0.  With ``buckets`` they are spread over so many hash buckets and numbered within, so that other keys
    change few statements; a window then runs over a bucket.  For large key sets ``write_table`` with ``keys``
    deletes by a staged table instead.
    """
    keys = keys or keys_df.columns
    if buckets is None:
        distinct = keys_df.select(*[column(k) for k in keys]).distinct()
        numbers = tag(numbered(distinct, keys, _NUMBER), {_NUMBER: "int64"})
        literals = to_literals(numbers, target, "null", compat)
        text, head, tail, sep = _key_tuples(target, keys, table, schema, compat)
        in_order = F.array_sort(F.collect_list(F.struct(column(_NUMBER).cast("long").alias("n"), text.alias("t"))))
        batches = literals.groupBy(F.floor(column(_NUMBER).cast("long") / F.lit(batch)).alias("batch"))
        tuples = F.array_join(F.transform(in_order, lambda x: x["t"]), sep)
        found = batches.agg(F.concat(F.lit(head), tuples, F.lit(tail)).alias("statement"))
        return found.select(F.lit(0).cast("long").alias("bucket"), "batch", "statement")
    literals = to_literals(keys_df.select(*[column(k) for k in keys]), target, "null", compat)
    tuple_text, start, tail, sep = _key_tuples(target, keys, table, schema, compat)
    text = literals.select(tuple_text.alias("t")).distinct()
    bucketed = text.withColumn("bucket", _bucket(F.col("t"), buckets))
    order = Window.partitionBy("bucket").orderBy("t")
    placed = bucketed.withColumn("batch", F.floor((F.row_number().over(order) - 1) / F.lit(batch)))
    tuples = F.array_join(F.array_sort(F.collect_list("t")), sep)
    return placed.groupBy("bucket", "batch").agg(
        F.concat(F.lit(start), tuples, F.lit(tail)).alias("statement")
    )


def high_water_mark(target_df: DataFrame, mark: str):
    """The largest value of the mark column in the target, or None; a single value."""
    return target_df.agg(F.max(column(mark))).first()[0]


def mark_literal(values: DataFrame, to: T.DataType) -> Column | None:
    """The largest value of a one-column table as a literal of type ``to``, or None.

    Times come to the driver as numbers or text, never as its own times: those would be moved by the zones of
    driver and session.  A time without zone beside one with a zone is UTC, as the transfers write it.
    """
    of = values.schema.fields[0].dataType
    newest = F.max(column(values.columns[0]))
    if isinstance(of, T.TimestampType):
        found = values.agg(F.unix_micros(newest)).first()[0]
        if found is None:
            return None
        if isinstance(to, T.TimestampNTZType):  # by counting: a wall clock has hours that come twice
            days, micros = divmod(found, 86_400_000_000)
            seconds = f"{micros // 1_000_000}.{micros % 1_000_000:06d}"
            return F.expr(f"timestamp_ntz '1970-01-01 00:00:00' + make_dt_interval({days}, 0, 0, {seconds})")
        return F.timestamp_micros(F.lit(found)).cast(to)
    if isinstance(of, T.TimestampNTZType):
        found = values.agg(newest.cast("string")).first()[0]
        if found is None:
            return None
        return F.lit(f"{found}Z" if isinstance(to, T.TimestampType) else found).cast(to)
    found = values.agg(newest).first()[0]
    return None if found is None else F.lit(found).cast(to)


def since(df: DataFrame, mark: str, target_df: DataFrame, inclusive: bool) -> DataFrame:
    """Source rows from the target's newest mark on; all rows when the target has none.

    Where rows are replaced by key, take ``inclusive=True``: the rows at the mark and those without one come
    again, and none is missed.  ``inclusive=False`` takes only what is strictly newer, for targets without
    keys: rows that reach the mark late are lost.  The mark is one aggregate over the target.
    """
    return after(df, mark, mark_literal(target_df.select(column(mark)), df.schema[mark].dataType), inclusive)


def after(df: DataFrame, mark: str, value, inclusive: bool = True) -> DataFrame:
    """Source rows at or after a known mark, and those without one; or only those after it.

    ``value`` is a literal (see ``mark_literal``) or a Python value.  It is pushed to the source.
    """
    if value is None:
        return df
    # a literal of the column's own type, so that no cast hides the column from the source
    of = df.schema[mark].dataType
    if not isinstance(value, Column):
        # a time without zone goes as text: as a Python time it would be an instant of the driver's zone
        value = F.lit(str(value) if isinstance(of, T.TimestampNTZType) else value)
    known = value.cast(of)
    return df.where((column(mark) >= known) | column(mark).isNull() if inclusive else column(mark) > known)


def latest_per_key(
    changes: DataFrame, keys: list[str], batch: str = "batch_id", oldest: int | None = None
) -> DataFrame:
    """What is left of a log of batches when each batch deletes by its keys and then appends its rows.

    A row is out of date when a later batch has its key.  Rows with a NULL in the key always stay.  The
    newest batch per key comes from a partially aggregated group, not a window, so a hot key never has to
    fit one task.  ``oldest``: the number of the first batch, whose keys can't replace anything; the group
    side then holds the later batches alone.
    """
    later = changes if oldest is None else changes.where(column(batch) > oldest)
    grouped = later.where(_no_nulls(keys)).groupBy(F.struct(*[column(k) for k in keys]).alias("k"))
    newest = grouped.agg(F.max(column(batch)).alias("_newest"))
    newest = newest.select(*[F.col("k").getField(k).alias(f"_key{n}") for n, k in enumerate(keys)], "_newest")
    on = [column(k) == F.col(f"_key{n}") for n, k in enumerate(keys)]
    on.append(column(batch) < F.col("_newest"))
    return changes.join(newest, reduce(and_, on), "left_anti")
