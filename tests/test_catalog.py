"""Schema discovery, type translation, identifiers and statements."""

import re

import pytest
from pyspark.sql import functions as F

from transferkit import SYSTEMS, ddl, primary_keys, translate
from transferkit.functions.identifiers import is_reserved, qualify_name, quote_name, quoted
from transferkit.operators import catalog
from transferkit.types import CANONICAL_TYPES

from conftest import random_text

COLUMNS = (
    "table_schema string, table_name string, column_name string, ordinal int, data_type string, precision int, "
    "scale int, length int, is_primary boolean"
)


def rows(spark, *columns, schema="s", table="t"):
    data = [
        (schema, table, name, n, kind, p, s, length, pk)
        for n, (name, kind, p, s, length, pk) in enumerate(columns, start=1)
    ]
    return spark.createDataFrame(data, COLUMNS)


def canonical(spark, system, path, compat, names):
    df = spark.createDataFrame([(n,) for n in names], "data_type string")
    out = catalog.with_canonical_types(df, system, path, compat)
    return {r.data_type: r.canonical_type for r in out.collect()}


# Where the table path and the query path of a system disagree, and one of each family.
SOURCE_CASES = [
    ("postgresql", "table", {"character varying": "nvarchar", "jsonb": "json", "bit varying": "varbit", "pg_lsn": "nvarchar"}),
    ("postgresql", "query", {"BPCHAR": "nvarchar", "142": "xml", "1266": "nvarchar", "FLOAT4": "float32"}),
    ("mssql", "table", {"varbinary": "varbinary", "timestamp": "varbinary", "image": "blob", "smallmoney": "money"}),
    ("mssql", "query", {"VARBINARY": "blob", "BINARY": "varbinary", "TINYINT": "int16", "UNIQUEIDENTIFIER": "uuid"}),
    ("mysql", "table", {"year": "varchar", "timestamp": "datetime", "enum": "nvarchar", "binary": "varbinary", "set": "nvarchar"}),
    ("mysql", "query", {"YEAR": "int16", "TIMESTAMP": "datetimetz", "BINARY": "blob", "UNSIGNED INT": "int64"}),
    ("oracle", "table", {"NUMBER": "decimal", "DATE": "date", "TIMESTAMP(6) WITH TIME ZONE": "datetimetz", "INTERVAL DAY(2) TO SECOND(6)": "nvarchar"}),
    ("oracle", "query", {"OCIClobLocator": "ntext", "TimeStampLTZ_DTY": "datetimetz", "LONG": "ntext", "IBFloat": "float32"}),
    ("snowflake", "table", {"OBJECT": "varbinary", "VARIANT": "nvarchar", "GEOGRAPHY": "varbinary", "NUMBER": "decimal"}),
    ("snowflake", "query", {"OBJECT": "nvarchar", "FIXED": "decimal", "REAL": "float64", "BOOLEAN": "bool"}),
]


@pytest.mark.parametrize("system, path, wanted", SOURCE_CASES)
def test_source_types(spark, system, path, wanted):
    assert canonical(spark, system, path, True, wanted) == wanted


def test_number_of_known_types():
    counts = {s: (len(p.type_rows("table", True)), len(p.type_rows("query", True))) for s, p in SYSTEMS.items()}
    assert counts == {
        "postgresql": (38, 39), "mssql": (29, 28), "mysql": (30, 26), "oracle": (17, 18), "snowflake": (15, 13),
    }


def test_one_mapping_for_both_paths_by_default(spark):
    for system, names in {
        "mssql": ["varbinary"], "mysql": ["binary", "timestamp", "year", "unsigned bigint"], "oracle": ["DATE"], "snowflake": ["OBJECT"],
    }.items():
        assert canonical(spark, system, "table", False, names) == canonical(spark, system, "query", False, names)
    assert canonical(spark, "mysql", "table", False, ["unsigned bigint"]) == {"unsigned bigint": "decimal"}


def test_unknown_type_stops_the_job(spark):
    with pytest.raises(Exception, match="unsupported database type for oracle: SDO_GEOMETRY"):
        canonical(spark, "oracle", "table", True, ["NUMBER", "SDO_GEOMETRY"])


CREATE = [
    # target, canonical, precision, scale, length, historical type, default type
    ("postgresql", "decimal", 10, 5, -1, "decimal(10,5)", "decimal(10,5)"),
    ("postgresql", "decimal", 10, 0, -1, "decimal", "decimal(10,0)"),
    ("postgresql", "datetimetz", -1, -1, -1, "timestamp", "timestamptz"),
    ("mssql", "nvarchar", -1, -1, 50, "nvarchar(100)", "nvarchar(100)"),
    ("mssql", "nvarchar", -1, -1, 2001, "nvarchar(max)", "nvarchar(max)"),
    ("mssql", "nvarchar", -1, -1, -1, "nvarchar(4000)", "nvarchar(max)"),
    ("mssql", "varbit", -1, -1, 4000, "varchar(8000)", "varchar(8000)"),
    ("mssql", "decimal", 10, 0, -1, "float", "decimal(10,0)"),
    ("mssql", "decimal", 38, 38, -1, "float", "decimal(38,38)"),
    ("mysql", "decimal", 65, 31, -1, "decimal(65,31)", "longtext"),
    ("mysql", "money", 19, 4, -1, "decimal(19,4)", "decimal(19,4)"),
    ("mysql", "money", -1, -1, -1, "float", "decimal(19,4)"),
    ("mysql", "blob", -1, -1, -1, "blob", "longblob"),
    ("oracle", "nvarchar", -1, -1, 1000, "varchar2(4000)", "varchar2(4000)"),
    ("oracle", "nvarchar", -1, -1, 1001, "clob", "clob"),
    ("oracle", "varbinary", -1, -1, 2000, "raw(2000)", "raw(2000)"),
    ("oracle", "varbinary", -1, -1, 2001, "blob", "blob"),
    ("oracle", "decimal", 38, 0, -1, "decimal(38, 0)", "decimal(38, 0)"),
    ("oracle", "decimal", -1, -1, -1, "BINARY_DOUBLE", "number"),
    ("oracle", "money", -1, -1, -1, "decimal(38, 4)", "decimal(38, 4)"),
    ("snowflake", "decimal", 10, 5, -1, "number", "number(10,5)"),
    ("snowflake", "money", 19, 4, -1, "number", "number(19,4)"),
]


def test_target_types(spark):
    data = [(n, *c) for n, c in enumerate(CREATE)]
    schema = "n int, target string, canonical_type string, precision int, scale int, length int, old string, new string"
    df = spark.createDataFrame(data, schema)
    for compat, wanted in ((True, "old"), (False, "new")):
        for target in SYSTEMS:
            out = translate(df.where(F.col("target") == target), None, target, compat=compat).collect()
            assert [(r.n, r.target_type) for r in out] == [(r.n, r[wanted]) for r in out]


def test_money_too_wide_for_mysql_is_an_error(spark):
    df = rows(spark, ("m", "money", 70, 2, None, False)).withColumnRenamed("data_type", "canonical_type")
    with pytest.raises(Exception, match="money over precision"):
        translate(df, None, "mysql", compat=True).collect()


def test_lossy_choices_are_marked(spark):
    df = rows(
        spark, ("a", "NUMBER", 10, 2, None, False), ("b", "NUMBER", None, None, None, False), ("c", "TIMESTAMP(6) WITH TIME ZONE", None, None, None, False)
    )
    for compat, wanted in ((False, [False, False, False]), (True, [False, True, True])):
        out = translate(df, "oracle", "mssql", compat=compat).orderBy("ordinal").collect()
        assert [r.lossy for r in out] == wanted


def test_keys_match_on_schema_and_table(spark):
    both = rows(spark, ("id", "int", None, None, None, None), ("x", "int", None, None, None, None)).unionAll(
        rows(spark, ("id", "int", None, None, None, None), schema="other")
    )
    keys = spark.createDataFrame([("s", "t", "id"), ("s", "t", "id")], "table_schema string, table_name string, column_name string")
    out = catalog.with_keys(both, keys).collect()
    assert sorted((r.table_schema, r.column_name, r.is_primary) for r in out) == [
        ("other", "id", False), ("s", "id", True), ("s", "x", False),
    ]
    assert [r.column_name for r in primary_keys(catalog.with_keys(both, keys)).collect()] == ["id"]


def test_a_table_without_columns_is_an_error(spark):
    with pytest.raises(ValueError, match="no columns found for table s.gone"):
        catalog.require_columns(rows(spark, ("id", "int", None, None, None, None)).where("false"), "s", "gone")


def test_catalog_rows_are_normalized(spark):
    from transferkit.sources.jdbc import catalog_rows

    raw = spark.createDataFrame(
        [("S", "T", "C", 1, "longtext", None, None, 4294967295)],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, COL_ORDINAL bigint, DATA_TYPE string, "
        "COL_PRECISION int, COL_SCALE int, COL_LENGTH bigint",
    )
    r = catalog.with_sizes(catalog_rows(raw)).first()
    assert (r.ordinal, r.precision, r.scale, r.length, r.has_length) == (1, -1, -1, 2**31 - 1, True)


PLAIN = re.compile(r"[A-Za-z_@#]\w*\Z")


@pytest.mark.parametrize("system", list(SYSTEMS))
def test_quoting_against_brute_force(spark, system):
    import random

    rng = random.Random(11)
    names = ["", "a", "9a", "a b", "select", "SELECT", "Order", "user", "x]y", 'x"y', "x`y", "été", "caféx", "_a", "@a", "#a", "a#", "within group"]
    names += [random_text(rng, 6) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(quoted(F.col("n"), system)).collect()]
    prof = SYSTEMS[system]
    reserved = {w.lower() for w in prof.reserved_words()}
    before, after = prof.quotes
    for name, text in zip(names, got):
        plain = not name or (PLAIN.match(name) and name.lower() not in reserved and not prof.quote_all)
        if name and plain and not name.isascii():
            continue  # \w also has marks and connectors; checked by the cases above
        assert text == (name if plain else before + name.replace(after, after * 2) + after)
        assert quote_name(name, system) == text


def test_reserved_words_by_case(spark):
    df = spark.createDataFrame([("select",), ("SELECT",), ("thing",)], "n string")

    def flags(system, compat):
        return [r[0] for r in df.select(is_reserved(F.col("n"), system, compat)).collect()]

    assert flags("postgresql", False) == [True, True, False]
    assert flags("postgresql", True) == [True, False, False]
    assert flags("mssql", True) == [True, True, False]
    assert flags("oracle", False) == [True, True, False]
    assert flags("oracle", True) == flags("mysql", False) == [False, False, False]


def test_qualified_names():
    assert qualify_name("s", "my table", "postgresql") == 's."my table"'
    assert qualify_name("s", "t", "mysql") == "`t`"
    assert qualify_name(None, "order", "mssql") == "[order]"


def test_statements(spark):
    df = rows(
        spark, ("id", "bigint", None, None, None, True), ("order", "character varying", None, None, 20, False),
        ("k2", "uuid", None, None, None, True), table="big t",
    )

    def text(target, incremental=True):
        return ddl(translate(df, "postgresql", target), target, incremental).first()["statement"]

    assert text("postgresql") == (
        'create table if not exists s."big t" (id bigint, "order" text, k2 uuid, primary key (id,k2))'
    )
    assert text("postgresql", False).endswith("k2 uuid)")
    named = translate(rows(spark, ("c", "character varying", None, None, 30, True)), "postgresql", "mysql")
    assert "(`c` varchar(30), primary key (`c`))" in ddl(named, "mysql", True).first()["statement"]
    assert "(`c` longtext)" in ddl(named, "mysql").first()["statement"]
    assert text("mysql") == (
        "create table if not exists `big t` (`id` bigint, `order` longtext, `k2` binary(16), primary key (`id`,`k2`))"
    )
    assert text("mssql") == (
        "if object_id('s.[big t]', 'U') is null create table s.[big t] "
        "(id bigint, [order] nvarchar(40), k2 uniqueidentifier, primary key (id,k2))"
    )
    assert text("oracle").startswith("begin execute immediate 'create table s.\"big t\" (id number(19), \"order\" varchar2(80)")


def test_quotes_inside_oracle_statements_are_doubled(spark):
    df = rows(spark, ("it's", "NUMBER", 5, 0, None, False), table="o'clock")
    text = ddl(translate(df, "oracle", "oracle"), "oracle").first()["statement"]
    assert "s.\"o''clock\" (\"it''s\" decimal(5, 0))" in text


def test_a_broken_ordinal_stops_before_the_shuffle(spark):
    df = translate(rows(spark, ("a", "text", None, None, None, False)), "postgresql", "mysql")
    with pytest.raises(Exception, match="more columns than a table can have"):
        ddl(df.withColumn("ordinal", F.lit(40_000)), "mysql").collect()


@pytest.mark.parametrize(
    "system, names, plain",
    [
        ("postgresql", "lateral fetch authorization binary cross ilike tablesample Select", "orders name value"),
        ("snowflake", "start rows row to unique any all qualify sample increment schema some of", "orders name value"),
        ("mssql", "RAISERROR within raiserror Table", "orders name value RAISEERROR"),
    ],
)
def test_words_of_the_vendors_are_quoted(spark, system, names, plain):
    from transferkit.functions.identifiers import quote_name, quoted

    for listed, wrapped in ((names.split(), True), (plain.split(), False)):
        rows = spark.createDataFrame([(n,) for n in listed], "n string").select("n", quoted(F.col("n"), system).alias("q"))
        assert all((r.n != r.q) == wrapped for r in rows.collect())
        assert all((quote_name(n, system) != n) == wrapped for n in listed)


def keyed(spark, target, canonical, precision=-1, scale=-1, length=-1):
    rows = [("s", "t", "k", 1, canonical, precision, scale, length, False, True), ("s", "t", "v", 2, "ntext", -1, -1, -1, True, False)]
    columns = spark.createDataFrame(rows, catalog.CATALOG_SCHEMA).withColumnRenamed("data_type", "canonical_type")
    return ddl(catalog.translate(columns, None, target), target, incremental=True).first()


def test_key_columns_have_types_that_can_be_keys(spark):
    number = keyed(spark, "mysql", "decimal", length=22)  # an unsized NUMBER says it is 22 bytes long
    assert "`k` varchar(255)" in number.statement and number.refused is None
    assert "k varchar(255)" in keyed(spark, "mssql", "decimal").statement
    assert "k number," in keyed(spark, "oracle", "decimal").statement
    assert "`k` decimal(38,2)" in keyed(spark, "mysql", "decimal", 38, 2).statement
    assert "`k` varchar(768)" in keyed(spark, "mysql", "ntext", length=768).statement
    assert "k nvarchar(450)" in keyed(spark, "mssql", "nvarchar", length=225).statement
    assert "k varchar2(40)" in keyed(spark, "oracle", "ntext", length=10).statement
    assert "k raw(16)" in keyed(spark, "oracle", "blob", length=16).statement
    assert "k timestamp with local time zone" in keyed(spark, "oracle", "datetimetz").statement
    assert "k text" in keyed(spark, "postgresql", "xml").statement


@pytest.mark.parametrize(
    "target, canonical, length",
    [("mysql", "ntext", -1), ("mysql", "nvarchar", 769), ("mysql", "json", 10), ("mssql", "nvarchar", 226), ("mssql", "xml", 5),
     ("mssql", "blob", -1), ("oracle", "text", -1), ("oracle", "varbinary", 2001)],
)
def test_a_key_that_cannot_be_one_is_refused(spark, target, canonical, length):
    row = keyed(spark, target, canonical, length=length)
    assert row.statement is None and row.refused == f"no key type of {target} for: k"


def test_no_key_has_an_unbounded_type(spark):
    sizes = [(-1, -1, -1), (10, 2, 30), (60, 40, 4000), (70, 5, 100_000)]
    for target in ("mysql", "mssql", "oracle"):
        for canonical in CANONICAL_TYPES:
            for p, s, length in sizes:
                text = keyed(spark, target, canonical, p, s, length).statement
                if text:
                    key = text.replace("`", "").split("(k ", 1)[1].split(", v ")[0].lower()
                    assert key not in ("longtext", "longblob", "clob", "blob", "json", "xml") and "max" not in key, (target, canonical)
