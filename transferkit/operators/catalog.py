"""Schema discovery and type translation as jobs over any number of tables at once.

Input is one row per column::

    table_schema, table_name, column_name, ordinal, data_type, precision, scale, length, is_primary

The lookup tables (fixed, under 50 rows per system) are broadcast, so the only shuffle is the one that
gathers a table's columns into its statement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.functions.identifiers import qualified, quoted
from transferkit.systems import SYSTEMS, profile
from transferkit.systems.profile import DecimalType, SizedType
from transferkit.types import ColumnInfo, column_infos

TABLE = ["table_schema", "table_name"]
# No system lets a table have more columns; a larger ordinal is a broken catalog.
MAX_COLUMNS = 30_000

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("precision", T.IntegerType()),
        T.StructField("scale", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("is_primary", T.BooleanType()),
    ]
)


def describe(df: DataFrame, schema: str = "", table: str = "") -> DataFrame:
    """One row per column of a DataFrame: name, canonical type, sizes, nullable, key flag."""
    return describe_all(df.sparkSession, {(schema, table): df})


def describe_all(spark: SparkSession, tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """``describe`` for many tables at once; only their schemas are looked at."""
    rows = [
        (schema, table, i.name, n, i.type, i.precision, i.scale, i.length, i.nullable, i.primary_key)
        for (schema, table), df in tables.items()
        for n, i in enumerate(column_infos(df), start=1)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA).withColumnRenamed("data_type", "canonical_type")


def with_sizes(columns: DataFrame) -> DataFrame:
    """Missing sizes become -1; adds ``has_decimal_size`` and ``has_length``."""
    for name in ("precision", "scale", "length"):
        columns = columns.withColumn(name, F.coalesce(F.col(name), F.lit(-1)))
    return columns.withColumns(
        {
            "has_decimal_size": (F.col("precision") > 0) | (F.col("scale") > 0),
            "has_length": F.col("length") > 0,
        }
    )


def with_keys(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Columns left-joined with the primary-key columns of their tables; adds ``is_primary``.

    Matches on schema, table and column, so equally named tables of two schemas do not mix.  The side
    to broadcast, if any, is Catalyst's choice by size.
    """
    on = [*TABLE, "column_name"]
    # a grouped struct keeps the key side free of duplicates and the join's own exchange in place
    marks = keys.select(F.struct(*on).alias("k")).distinct().select("k.*", F.lit(True).alias("_key"))
    joined = columns.drop("is_primary").join(marks, on, "left")
    return joined.withColumn("is_primary", F.col("_key").isNotNull()).drop("_key")


def primary_keys(columns: DataFrame) -> DataFrame:
    """Primary-key columns of every table, with their position."""
    return columns.where("is_primary").select(*TABLE, "column_name", "ordinal")


def require_columns(columns: DataFrame, schema: str | None, table: str) -> DataFrame:
    """A table without a single column does not exist: an error, not an empty transfer."""
    if columns.isEmpty():
        raise ValueError(f"no columns found for table {schema + '.' if schema else ''}{table}")
    return columns


def clean_type_name(data_type: Column, system: str) -> Column:
    """Oracle writes sizes into type names: ``TIMESTAMP(6) WITH TIME ZONE``, ``INTERVAL DAY(2) TO …``."""
    if system != "oracle":
        return data_type
    return (
        F.when(data_type.startswith("TIMESTAMP("), F.regexp_replace(data_type, r"\(\d+\)", ""))
        .when(data_type.startswith("INTERVAL"), F.lit("INTERVAL"))
        .otherwise(data_type)
    )


def type_map(spark: SparkSession, path: str = "table", compat: bool = False) -> DataFrame:
    """Rows (system, type name, canonical type) of all systems: a fixed table of some 140 rows."""
    rows = [(s, n, c) for s, p in SYSTEMS.items() for n, c in p.type_rows(path, compat)]
    return spark.createDataFrame(rows, "system string, type_name string, canonical_type string")


def with_canonical_types(
    columns: DataFrame, source: str | None = None, path: str = "table", compat: bool = False
) -> DataFrame:
    """Adds ``canonical_type``; an unknown type name stops the job.

    ``source`` is the system all rows come from, or None when a ``system`` column says so per row.
    """
    lookup = type_map(columns.sparkSession, path, compat)
    if source is not None:
        profile(source)
        name = clean_type_name(F.col("data_type"), source)
        lookup = lookup.where(F.col("system") == source).drop("system")
        keyed = columns.withColumn("type_name", F.lower(name))
        joined = keyed.join(F.broadcast(lookup), "type_name", "left")
        label = F.lit(source)
    else:
        name = F.when(F.col("system") == "oracle", clean_type_name(F.col("data_type"), "oracle"))
        keyed = columns.withColumn("type_name", F.lower(F.coalesce(name, F.col("data_type"))))
        joined = keyed.join(F.broadcast(lookup), ["system", "type_name"], "left")
        label = F.col("system")
    unknown = F.raise_error(
        F.concat(F.lit("unsupported database type for "), label, F.lit(": "), F.col("data_type"))
    )
    known = F.coalesce(F.col("canonical_type"), unknown.cast("string"))
    return joined.withColumn("canonical_type", known).drop("type_name")


def _sized(rule: SizedType, length: Column, compat: bool) -> Column:
    size = length * F.lit(rule.factor)
    sized = F.concat(F.lit(rule.name + "("), size.cast("string"), F.lit(")"))
    unknown = rule.unsized if compat else rule.overflow
    return (
        F.when(length <= 0, F.lit(unknown))
        .when(size <= rule.limit, sized)
        .otherwise(F.lit(rule.overflow))
    )


def _ps(rule: DecimalType, p: Column, s: Column) -> Column:
    return F.concat(
        F.lit(rule.name + "("), p.cast("string"), F.lit(rule.separator), s.cast("string"), F.lit(")")
    )


def _decimal(rule: DecimalType, p: Column, s: Column, compat: bool) -> Column:
    if not compat:
        fits = p.between(1, rule.max_precision) & s.between(0, rule.max_scale) & (s <= p)
    else:
        max_scale = rule.max_scale_compat or rule.max_scale
        wide = rule.scale_equal_compat
        fits = s.between(rule.min_scale_compat, max_scale) & p.between(
            0 if wide else 1, rule.max_precision
        )
        fits = fits & (((p > 0) | (s > 0)) if wide else (p > s))
    return F.when(fits, _ps(rule, p, s)).otherwise(F.lit(rule.fallback if compat else rule.exact or rule.fallback))


def _money(rule: DecimalType, p: Column, s: Column, compat: bool) -> Column:
    if not compat:
        return _decimal(rule, p, s, False)
    known = (p > 0) | (s > 0)
    too_big = F.raise_error(F.lit(f"money over precision {rule.max_precision} or scale {rule.max_scale}"))
    return (
        F.when(~known, F.lit(rule.fallback_compat or rule.fallback))
        .when((p > rule.max_precision) | (s > rule.max_scale), too_big.cast("string"))
        .otherwise(_ps(rule, p, s))
    )


def create_type(
    canonical: Column, precision: Column, scale: Column, length: Column, target: str, compat: bool = False
) -> Column:
    """Column type of ``target`` for a canonical type and its sizes (-1 where unknown)."""
    prof = profile(target)
    fixed = dict(prof.create_types)
    if not compat:
        fixed.update(prof.exact_create_types)
    rules: dict[str, Column] = {t: F.lit(name) for t, name in fixed.items()}
    for t, sized in prof.sized_types.items():
        rules[t] = _sized(sized, length, compat)
    if prof.decimal is not None and not (compat and "decimal" in prof.create_types):
        rules["decimal"] = _decimal(prof.decimal, precision, scale, compat)
    if prof.money is not None:
        rules["money"] = _money(prof.money, precision, scale, compat)
    chain = None
    for t, value in rules.items():
        chain = F.when(canonical == t, value) if chain is None else chain.when(canonical == t, value)
    bad = F.raise_error(F.concat(F.lit(f"unsupported canonical type for {target}: "), canonical))
    return chain.otherwise(bad.cast("string"))


def is_lossy(
    canonical: Column, precision: Column, scale: Column, target_type: Column, target: str, compat: bool
) -> Column:
    """Whether the chosen target type may cut values: floats standing in for decimals, numbers
    without scale, instants without zone."""
    inexact = F.lower(target_type).isin("float", "double", "binary_double", "real")
    if compat and target == "snowflake":
        inexact = inexact | (scale != 0)
    lossy = canonical.isin("decimal", "money") & inexact
    if compat and target != "snowflake":
        lossy = lossy | (canonical == "datetimetz")
    return lossy


def translate(
    columns: DataFrame,
    source: str | None = None,
    target: str = "postgresql",
    path: str = "table",
    compat: bool = False,
) -> DataFrame:
    """Source column rows to target column rows: adds ``canonical_type``, ``target_type``, ``lossy``.

    Rows that already carry ``canonical_type`` (from ``describe``) skip the source lookup.
    """
    rows = with_sizes(columns)
    if "canonical_type" not in rows.columns:
        rows = with_canonical_types(rows, source, path, compat)
    args = [F.col(c) for c in ("canonical_type", "precision", "scale", "length")]
    rows = rows.withColumn("target_type", create_type(*args, target, compat))
    return rows.withColumn("lossy", is_lossy(*args[:3], F.col("target_type"), target, compat))


def key_type(canonical: Column, length: Column, target_type: Column, target: str) -> Column:
    """The type of a column as a key of ``target``; NULL where none can be a key.

    A target's unbounded types are no keys there: a text or bytes of known length get a type of that length as far
    as an index entry goes, numbers without a size a text that holds them.
    """
    prof = profile(target)
    chain = F.when(F.lit(False), target_type)
    for t, rule in prof.key_types.items():
        this = canonical == t
        if t == "decimal":  # only where no sized type was found
            this = this & (target_type == F.lit(prof.decimal.exact))
        if isinstance(rule, SizedType):
            size = length * F.lit(rule.factor)
            sized = F.concat(F.lit(f"{rule.name}("), size.cast("string"), F.lit(")"))
            chain = chain.when(this, F.when((length > 0) & (size <= rule.limit), sized))
        else:
            chain = chain.when(this, F.lit(rule or None).cast("string"))
    return chain.otherwise(target_type)


def ddl(columns: DataFrame, target: str, incremental: bool = False, compat: bool = False) -> DataFrame:
    """One create-table statement per table, from translated column rows, and what speaks against one.

    With ``incremental`` the key columns get types that can be keys.  A table with a key column of which ``target`` can
    make no key has no statement; ``refused`` then names those columns.

    A table's columns are gathered by one grouped aggregation; its size is bounded by the number of
    columns a table can have, which is checked on every row before the shuffle.
    """
    too_many = F.raise_error(F.concat(F.lit("more columns than a table can have: "), F.col("table_name")))
    ordinal = F.when(F.col("ordinal") <= MAX_COLUMNS, F.col("ordinal")).otherwise(too_many.cast("int"))
    bare = compat and target == "oracle"
    name = F.col("column_name") if bare else quoted(F.col("column_name"), target, compat)
    column_type = F.col("target_type")
    if incremental and not compat:
        keyed = key_type(F.col("canonical_type"), F.col("length"), column_type, target)
        column_type = F.when(F.col("is_primary"), keyed).otherwise(column_type)
    rows = columns.select(
        *TABLE,
        F.struct(
            ordinal.alias("ordinal"),
            F.concat_ws(" ", name, column_type).alias("definition"),
            F.when(F.col("is_primary"), name).alias("key"),
            F.when(column_type.isNull(), F.col("column_name")).alias("refused"),
        ).alias("c"),
    )
    tables = rows.groupBy(*TABLE).agg(F.array_sort(F.collect_list("c")).alias("cols"))
    definitions = F.array_join(F.transform("cols", lambda c: c.definition), ", ")
    keys = F.array_join(F.filter(F.transform("cols", lambda c: c.key), lambda k: k.isNotNull()), ",")
    body = definitions
    if incremental and not bare:
        body = F.concat(
            definitions,
            F.when(keys != "", F.concat(F.lit(", primary key ("), keys, F.lit(")"))).otherwise(F.lit("")),
        )
    statement = create_statement(F.col("table_schema"), F.col("table_name"), body, target, compat)
    bad = F.array_join(F.filter(F.transform("cols", lambda c: c.refused), lambda k: k.isNotNull()), ", ")
    refused = F.when(bad != "", F.concat(F.lit(f"no key type of {target} for: "), bad))
    return tables.select(*TABLE, F.when(bad == "", statement).alias("statement"), refused.alias("refused"))


def create_statement(schema: Column, table: Column, body: Column, target: str, compat: bool = False) -> Column:
    """Create the table unless it is there, in the words of each system."""
    full = qualified(schema, table, target, compat)

    def inner(c: Column) -> Column:
        return F.replace(c, F.lit("'"), F.lit("''"))

    if target == "mssql":
        probe = F.concat(F.lit("if object_id('"), inner(full), F.lit("', 'U') is null "))
        return F.concat(probe, F.lit("create table "), full, F.lit(" ("), body, F.lit(")"))
    if target == "oracle":
        # ORA-00955: the name is taken
        create = F.concat(F.lit("create table "), full, F.lit(" ("), body, F.lit(")"))
        return F.concat(
            F.lit("begin execute immediate '"),
            inner(create),
            F.lit("'; exception when others then if sqlcode != -955 then raise; end if; end;"),
        )
    return F.concat(F.lit("create table if not exists "), full, F.lit(" ("), body, F.lit(")"))


def infos_from_rows(rows: DataFrame) -> list[ColumnInfo]:
    """Descriptions of ONE table's columns, for building its projection."""
    wanted = ["column_name", "canonical_type", "precision", "scale", "length", "is_primary"]
    found = rows.orderBy("ordinal").select(*wanted).take(MAX_COLUMNS + 1)
    if len(found) > MAX_COLUMNS:
        raise ValueError("more columns than a table can have")
    return [
        ColumnInfo(r.column_name, r.canonical_type, r.precision, r.scale, r.length, primary_key=r.is_primary)
        for r in found
    ]
