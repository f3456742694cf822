import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit import column_infos, describe, nested_as_json, tag, to_canonical
from transferkit.types import CANONICAL_TYPES, ColumnInfo, apply_infos


def test_twenty_two_canonical_types():
    assert len(CANONICAL_TYPES) == len(set(CANONICAL_TYPES)) == 22


def test_spark_types_get_canonical_types(spark):
    schema = (
        "a string, b bigint, c int, d smallint, e tinyint, f double, g float, h decimal(12,3), i timestamp_ntz, "
        "j timestamp, k date, l binary, m boolean"
    )
    infos = column_infos(spark.createDataFrame([], schema))
    assert [i.type for i in infos] == [
        "ntext", "int64", "int32", "int16", "int16", "float64", "float32", "decimal", "datetime", "datetimetz",
        "date", "blob", "bool",
    ]
    assert (infos[7].precision, infos[7].scale) == (12, 3)


def test_catalog_table_keeps_text_lengths(spark):
    spark.sql("create table if not exists sized_text (a varchar(17), b string, c char(4)) using parquet")
    infos = column_infos(spark.table("sized_text"))
    assert [(i.type, i.length) for i in infos] == [("nvarchar", 17), ("ntext", -1), ("nvarchar", 4)]


def test_tags_survive_filters_and_renames_by_position(spark):
    df = tag(spark.range(3).withColumn("u", F.lit("x")), {"u": "uuid"}, keys=["id"])
    kept = df.where("id > 0").select("u", "id")
    assert [(i.type, i.primary_key) for i in column_infos(kept)] == [("uuid", False), ("int64", True)]
    infos = [ColumnInfo("k", "int64", primary_key=True), ColumnInfo("v", "xml")]
    assert [i.type for i in column_infos(apply_infos(df, infos))] == ["int64", "xml"]


def test_bad_tags_are_refused(spark):
    with pytest.raises(ValueError, match="no such columns"):
        tag(spark.range(1), {"nope": "uuid"})
    with pytest.raises(ValueError, match="unsupported canonical type"):
        tag(spark.range(1), {"id": "geometry"})


def test_nested_columns_are_refused_or_sent_as_json(spark):
    df = spark.createDataFrame([(1, [1.5, 2.0])], "id int, v array<double>")
    with pytest.raises(TypeError, match="nested_as_json"):
        to_canonical(df)
    text = nested_as_json(df)
    assert column_infos(text)[1].type == "json"
    assert to_canonical(text).first()["v"] == "[1.5,2.0]"


def test_describe_lists_columns_in_order(spark):
    rows = describe(tag(spark.createDataFrame([], "b int, a string"), keys=["b"]), "s", "t").orderBy("ordinal")
    got = [(r.column_name, r.ordinal, r.canonical_type, r.is_primary) for r in rows.collect()]
    assert got == [("b", 1, "int32", True), ("a", 2, "ntext", False)]


def test_spark_type_of_wide_decimals_is_text():
    assert ColumnInfo("x", "decimal", 38, 4).spark_type() == T.DecimalType(38, 4)
    assert ColumnInfo("x", "decimal", 60, 4).spark_type() == T.StringType()
