"""Whole transfers, over every pair of systems."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import random_text
from transferkit import (
    SYSTEMS, Endpoint, append_by_position, column_infos, columns, incremental_transfer, read_query, read_table, table_exists, tag, transfer, write_table,
)
from transferkit.types import CANONICAL_TYPES


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A folder with one table of every canonical type and a row of NULLs."""
    place = str(tmp_path_factory.mktemp("source"))
    rng = random.Random(77)
    df = spark.createDataFrame(
        [(n, random_text(rng, 30) or "x", rng.uniform(-1e6, 1e6), rng.randbytes(5)) for n in range(60)] + [(60, None, None, None)],
        "id bigint, s string, f double, b binary",
    )
    at = F.timestamp_add("MICROSECOND", F.col("id") * 7_777_777_123, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    some = F.col("s").isNotNull()
    h = F.md5(F.col("id").cast("string"))
    columns = {
        "id": ("int64", F.col("id")),
        "c1": ("nvarchar", F.col("s")),
        "c2": ("varchar", F.substring("s", 1, 4)),
        "c3": ("ntext", F.col("s")),
        "c4": ("text", F.concat("s", F.lit("\n"), "s")),
        "c5": ("int32", F.when(some, F.col("id").cast("int"))),
        "c6": ("int16", F.when(some, (-F.col("id")).cast("short"))),
        "c7": ("float64", F.col("f")),
        "c8": ("float32", F.col("f").cast("float")),
        "c9": ("decimal", F.col("f").cast("decimal(20,9)")),
        "c10": ("money", F.col("f").cast("decimal(19,4)")),
        "c11": ("datetime", F.when(some, at)),
        "c12": ("datetimetz", F.when(some, at.cast("timestamp"))),
        "c13": ("date", F.when(some, at.cast("date"))),
        "c14": ("time", F.when(some, F.substr(at.cast("string"), F.lit(12)))),
        "c15": ("varbinary", F.col("b")),
        "c16": ("blob", F.concat("b", "b")),
        "c17": ("uuid", F.when(some, F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)))),
        "c18": ("bool", F.when(some, F.col("id") % 2 == 0)),
        "c19": ("json", F.when(some, F.to_json(F.struct("id", "s")))),
        "c20": ("xml", F.when(some, F.concat(F.lit("<a>"), F.col("id").cast("string"), F.lit("</a>")))),
        "c21": ("varbit", F.when(some, F.bin("id"))),
    }
    assert sorted(t for t, _ in columns.values()) == sorted(CANONICAL_TYPES)
    made = df.select(*[e.alias(c) for c, (_, e) in columns.items()])
    tag(made, {c: t for c, (t, _) in columns.items()}, keys=["id"]).write.parquet(f"{place}/every")
    return place


def bag(df):
    def plain(v):
        return bytes(v) if isinstance(v, bytearray) else v

    return sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("source", list(SYSTEMS))
@pytest.mark.parametrize("target", list(SYSTEMS))
def test_every_route(spark, stored, folder, source, target):
    endpoint = Endpoint(source, path=stored)
    rows = read_table(spark, endpoint, "every")
    moved = transfer(
        spark, endpoint, Endpoint(target), "every", "s", table="every", null="{nll}", load_path=f"{folder}/load"
    )
    assert [i.type for i in moved.columns] == [i.type for i in column_infos(rows)]
    assert bag(moved.rows) == bag(rows)
    assert moved.commands


def test_file_metadata_keeps_canonical_types(spark, stored):
    infos = column_infos(read_table(spark, Endpoint("oracle", path=stored), "every"))
    assert infos[0].primary_key and infos[17].type == "uuid"


def test_query_transfer(spark, stored, folder):
    moved = transfer(
        spark, Endpoint("mysql", path=stored), Endpoint("postgresql"), "sums", "s",
        query="select c18, count(*) as n, max(c9) as top from every group by c18", query_tables=["every"],
        load_path=f"{folder}/load",
    )
    assert [i.type for i in moved.columns] == ["bool", "int64", "decimal"]
    assert moved.rows.count() == 3


def test_transfer_into_folder_and_catalog(spark, stored, folder):
    source = Endpoint("postgresql", path=stored)
    to_folder = Endpoint("mssql", path=folder)
    with pytest.raises(ValueError, match="create_table"):
        transfer(spark, source, to_folder, "copy", "s", table="every")
    for _ in range(2):
        moved = transfer(spark, source, to_folder, "copy", "s", table="every", create_table=True)
    assert moved.rows.count() == 122
    assert transfer(spark, source, to_folder, "copy", "s", table="every", drop_table=True).rows.count() == 61
    moved = transfer(
        spark, source, Endpoint("snowflake"), "copy", "made_here", table="every", create_schema=True, create_table=True
    )
    assert bag(moved.rows) == bag(read_table(spark, source, "every"))
    spark.sql("drop schema made_here cascade")


def test_append_is_by_position(spark):
    spark.sql("create table if not exists by_position (a int, b string) using parquet")
    append_by_position(spark.createDataFrame([(1, "x")], "b int, a string"), "by_position")
    assert tuple(spark.table("by_position").first()) == (1, "x")


def test_wrong_column_count_is_refused(spark, folder):
    target = Endpoint("oracle", path=folder)
    write_table(spark.range(2), target, "t", create_table=True)
    with pytest.raises(ValueError, match="2 columns for a table of 1"):
        write_table(spark.range(2).withColumn("x", F.lit(1)), target, "t")
    with pytest.raises(ValueError, match="JDBC target"):
        write_table(spark.range(2), target, "t", keys=["id"])


def test_table_exists(spark, folder):
    target = Endpoint("oracle", path=folder)
    assert not table_exists(spark, target, "t")
    write_table(spark.range(1), target, "t", create_table=True)
    assert table_exists(spark, target, "t")
    assert not table_exists(spark, Endpoint("oracle"), "no_such_table")


def test_query_runs_unchanged_in_the_session(spark):
    assert read_query(spark, Endpoint("mysql"), "select 1 as a union all select 2").count() == 2


@pytest.mark.parametrize(
    "kwargs, problem",
    [
        (dict(table="t", query="select 1"), "not both"),
        (dict(), "source table or a query"),
        (dict(query="select 1", schema="s"), "not both"),
        (dict(table="t", target_table=""), "target table"),
        (dict(table="t", target=Endpoint("oracle", url="jdbc:oracle:thin:@x"), target_schema=None), "needs a schema"),
        (dict(table="t", source=Endpoint("mssql", url="jdbc:sqlserver://x")), "mssql source table needs a schema"),
    ],
)
def test_argument_rules(spark, kwargs, problem):
    args = dict(source=Endpoint("mysql", path="/x"), target=Endpoint("mysql", path="/y"), target_table="t")
    with pytest.raises(ValueError, match=problem):
        transfer(spark, **{**args, **kwargs})


def test_columns_of_folder_tables(spark, stored, folder):
    write_table(spark.range(1), Endpoint("oracle", path=folder), "a", create_table=True)
    write_table(spark.range(1).withColumn("x", F.lit("y")), Endpoint("oracle", path=folder), "b", create_table=True)
    out = columns(spark, Endpoint("oracle", path=folder), tables=["a", "b"]).orderBy("table_name", "ordinal").collect()
    assert [(r.table_name, r.column_name, r.canonical_type) for r in out] == [
        ("a", "id", "int64"), ("b", "id", "int64"), ("b", "x", "ntext"),
    ]


def test_incremental_transfer(spark, folder):
    source, target = Endpoint("mysql", path=f"{folder}/in"), Endpoint("oracle", path=f"{folder}/out")
    schema = "k int, v string, m int"
    state = [(1, "a", 1), (2, "b", 2)]
    for changes in ([], [(2, "B", 3), (3, "c", 3)], [(4, "d", 3)], [(1, "A", 9)]):
        state = [r for r in state if r[0] not in {c[0] for c in changes}] + changes
        write_table(spark.createDataFrame(state, schema), source, "t", drop_table=True)
        out = incremental_transfer(spark, source, target, "t", ["k"], "m")
        assert bag(out) == sorted(state, key=repr)
    with pytest.raises(ValueError, match="JDBC or a folder"):
        incremental_transfer(spark, source, Endpoint("oracle"), "t", ["k"], "m")
