"""Staged files and load files, read back by Spark and by Python's own CSV reader."""

import csv
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import random_text
from transferkit import (
    SYSTEMS, column_infos, control_text, load_commands, max_byte_length, read_keys, read_load, read_staged, tag,
    to_load, write_keys, write_load, write_staged,
)
from registry import scans, tables, targets
from transferkit.session import stored_bytes
from transferkit.sinks.files import data_files
from transferkit.types import ColumnInfo


def parts(path):
    return sorted(glob.glob(os.path.join(path, "part-*")))


def python_rows(path):
    out = []
    for name in parts(path):
        with open(name, newline="", encoding="utf-8") as f:
            out += [tuple(r) for r in csv.reader(f)]
    return out


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(5)
    data = [(n, random_text(rng, 40), None if n % 5 == 0 else random_text(rng, 8), rng.randbytes(n % 9)) for n in range(400)]
    data += [(400, "", None, b""), (401, " ", "", None), (402, "\\", '"', b"\x00"), (403, '""', ",", b"\xff")]
    return spark.createDataFrame(data, "id int, a string, b string, c binary").repartition(3)


def as_set(df):
    return {(r.id, r.a, r.b, None if r.c is None else bytes(r.c)) for r in df.collect()}


def test_staged_roundtrip(spark, awkward, folder):
    infos = write_staged(awkward, f"{folder}/s")
    assert as_set(read_staged(spark, f"{folder}/s", infos, typed=True)) == as_set(awkward)


def test_staged_files_are_plain_csv(awkward, folder):
    write_staged(awkward, f"{folder}/s")
    wanted = {
        (str(r.id), r.a, "{nll}" if r.b is None else r.b, "{nll}" if r.c is None else bytes(r.c).hex())
        for r in awkward.collect()
    }
    assert set(python_rows(f"{folder}/s")) == wanted


@pytest.mark.parametrize("target", list(SYSTEMS))
def test_load_files_roundtrip(spark, awkward, folder, target):
    # a carriage return at the end of a text would be the separator's; NUL marks an empty text
    rows = awkward
    infos = write_load(rows, f"{folder}/l", target, null="{nll}")
    back = read_load(spark, f"{folder}/l", target, infos)
    wanted = as_set(rows)
    if target == "mssql":  # an empty binary field is read as NULL there
        wanted = {(i, a, b, c or None) for i, a, b, c in wanted}
    assert as_set(back) == wanted


def test_one_column_of_empty_texts(spark, folder):
    df = spark.createDataFrame([("",), (None,), ("x",), ("",)], "a string")
    infos = write_staged(df, f"{folder}/s")
    back = read_staged(spark, f"{folder}/s", infos)
    assert sorted(map(str, (r.a for r in back.collect()))) == ["", "", "None", "x"]


def test_end_of_data_marker_is_quoted(spark, folder):
    """A bare backslash-dot line would end the input of PostgreSQL's copy."""
    df = spark.createDataFrame([("\\.",), ("x",)], "a string").coalesce(1)
    write_load(df, f"{folder}/l", "postgresql")
    assert open(parts(f"{folder}/l")[0]).read() == '"\\."\nx\n'


def test_a_value_equal_to_the_token_stops_the_write(spark, folder):
    df = spark.createDataFrame([("NULL",)], "a string")
    with pytest.raises(Exception, match="holds the null token"):
        write_load(df, f"{folder}/l", "mysql")
    write_load(df, f"{folder}/m", "mysql", null="{nll}")
    both = spark.createDataFrame([("NULL",), (None,)], "a string").coalesce(1)
    write_load(both, f"{folder}/q", "mysql", quote_clash=True)
    assert open(parts(f"{folder}/q")[0]).read() == '"NULL"\nNULL\n'
    with pytest.raises(ValueError, match="cannot tell"):
        write_load(both, f"{folder}/o", "oracle", quote_clash=True)
    with pytest.raises(ValueError, match="null token"):
        write_staged(df, f"{folder}/n", null="a,b")


def test_a_value_with_a_separator_stops_the_write(spark, folder):
    df = spark.createDataFrame([("a{dlm}b",)], "a string")
    with pytest.raises(Exception, match="holds the delimiter"):
        write_load(df, f"{folder}/l", "mssql")
    write_load(df, f"{folder}/m", "mssql", delimiter="<|>", newline="<nl>")
    numbers = spark.createDataFrame([(1.5, 2)], "a double, b int")
    with pytest.raises(Exception, match="holds the delimiter"):
        write_load(numbers, f"{folder}/n", "mssql", delimiter=".")


def test_file_roll(spark, folder):
    df = spark.range(0, 20_000, 1, 2).select("id", F.lpad(F.col("id").cast("string"), 40, "x").alias("t"))
    write_staged(df, f"{folder}/s", target_file_bytes=100_000)
    sizes = [os.path.getsize(f"{folder}/s/{p}") for p in data_files(spark, f"{folder}/s")]
    assert len(sizes) == 10 and max(sizes) <= 100_000
    assert read_staged(spark, f"{folder}/s", column_infos(df)).count() == 20_000


@pytest.mark.parametrize("huge", [0, 50_000, 300_000])
def test_one_long_row_does_not_shrink_the_files(spark, folder, huge):
    long = F.when(F.col("id") == 4321, F.repeat(F.lit("y"), huge)).otherwise(F.lpad(F.col("id").cast("string"), 40, "x"))
    df = spark.range(0, 20_000, 1, 1).select("id", long.alias("t"))
    write_staged(df, f"{folder}/s", target_file_bytes=100_000)
    sizes = sorted(os.path.getsize(f"{folder}/s/{p}") for p in data_files(spark, f"{folder}/s"))
    assert sum(s > 100_000 for s in sizes) == (huge > 100_000)
    small = [s for s in sizes if s <= 100_000]
    assert sum(small) / len(small) > 80_000
    assert sorted(map(tuple, read_staged(spark, f"{folder}/s", column_infos(df), typed=True).collect())) == sorted(map(tuple, df.collect()))


def test_files_of_one_name_have_places_of_their_own():
    files = ["/d/file_number=0/part-1.txt", "/d/file_number=1/part-1.txt"]
    found = load_commands("snowflake", "t", files, [ColumnInfo("id", "int64")], "s", load_id="x")
    assert "@s.transferkit_stage/x/file_number=0 " in found[1]
    assert "@s.transferkit_stage/x/file_number=1/part-1.txt " in found[4]


@pytest.mark.parametrize("split_bytes", [40, 1000, 1 << 20])
def test_a_file_read_by_many_tasks(spark, folder, split_bytes):
    rng = random.Random(split_bytes)
    values = [None, "", "{", '"', '""', "\n", "\r\n", '"\n"', ",", "a\n\n\nb", '\n"', "x" * 300, ("long\n" * 60) + '"']
    rows = [(i, rng.choice(values) if rng.random() < 0.6 else random_text(rng, 30), rng.choice(values)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, `a b` string, c string").coalesce(2)
    infos = write_staged(df, f"{folder}/s")
    small = {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        found = read_staged(spark, f"{folder}/s", infos, typed=True)
        again = read_staged(spark, f"{folder}/s", infos, typed=True, split=True)
        assert sorted(map(tuple, again.collect()), key=repr) == sorted(rows, key=repr)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("MapInArrow" in plan) == (split_bytes < 10_000) and plan.count("from_csv(") <= 1
        assert found.rdd.getNumPartitions() > (10 if split_bytes < 10_000 else 0)
        one = read_staged(spark, f"{folder}/s", infos[:1], split=True)
        with pytest.raises(Exception, match="(?i)malformed"):
            one.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_an_open_quote_stops_the_read(spark, folder):
    with open(f"{folder}/f.txt", "w") as f:
        f.write('1,"a\nb"\n2,"c\n')
    with pytest.raises(Exception, match="does not end in its file"):
        read_staged(spark, folder, [ColumnInfo("id", "int32"), ColumnInfo("t", "ntext")], split=True).collect()


def test_key_files(spark, folder):
    df = tag(spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "k int, l string, v string"), keys=["k", "l"])
    write_keys(df, f"{folder}/k")
    back = read_keys(spark, f"{folder}/k", column_infos(df))
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]


def test_max_byte_length(spark):
    df = spark.createDataFrame([("é", 12345, None), ("abc", 1, "x")], "a string, n int, b string")
    assert max_byte_length(df).first().asDict() == {"a": 8, "n": 10, "b": 10}
    assert max_byte_length(df.where("false")).first().asDict() == {"a": 5, "n": 5, "b": 5}


def test_control_text(spark):
    df = spark.createDataFrame([(1, "abc")], "id int, name string").withColumn("day", F.lit("2024-01-02").cast("date"))
    text = control_text(df, "my t", "s").first()[0]
    assert text == (
        'load data\ncharacterset al32utf8\nappend into table s."my t"\nfields csv with embedded\n(\n'
        "  id char(6) preserve blanks nullif id = '{nll}',\n  name char(8) preserve blanks nullif name = '{nll}',\n"
        "  day date 'YYYY-MM-DD' nullif day = '{nll}'\n)"
    )


def test_load_commands():
    cols = [ColumnInfo("id", "int64"), ColumnInfo("raw", "blob"), ColumnInfo("u", "uuid")]
    files = ["/d/a b.txt", "file:///d/c.txt"]
    found = load_commands("postgresql", "t", files, cols, "s")
    assert found[1] == "\\copy s.t from '/d/c.txt' with (format csv, null '{nll}', encoding 'UTF8')" and len(found) == 2
    mysql = load_commands("mysql", "t", files, cols)
    assert mysql[0].startswith("load data local infile '/d/a b.txt'") and len(mysql) == 2
    assert mysql[0].endswith("(`id`, @f1, @f2) set `raw` = unhex(@f1), `u` = unhex(@f2)")
    bcp = load_commands("mssql", "t", files, cols, "s", database="d")
    assert bcp == [f"bcp d.s.t in {f} -c -C 65001 -t '{{dlm}}' -r '{{nwln}}'" for f in ("'/d/a b.txt'", "/d/c.txt")]
    assert load_commands("oracle", "t", files, cols, "s", control="/d/x.ctl")[1] == "sqlldr control=/d/x.ctl data=/d/c.txt"
    snow = load_commands("snowflake", "t", files, cols, "s", load_id="x1")
    assert len(snow) == 5 and snow[3] == "put 'file:///d/c.txt' @s.transferkit_stage/x1 auto_compress = false"
    assert "@s.transferkit_stage/x1/c.txt file_format = (type = csv" in snow[4] and "null_if = ('{nll}')" in snow[4]
    for target, match in (("snowflake", "schema"), ("oracle", "control")):
        with pytest.raises(ValueError, match=match):
            load_commands(target, "t", files, cols)
    with pytest.raises(ValueError, match="cannot open"):
        load_commands("postgresql", "t", ["s3a://bucket/f"], cols, "s")


def test_encoding_stays_in_generated_code(spark, awkward):
    plan = to_load(awkward, "oracle")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Project" in plan


def test_listing_leaves_hidden_files_and_folders_out(spark, folder):
    for p in ("b=1/x.txt", "a/c/y z.txt", "top{1}.txt", "_SUCCESS", "_control/z.txt", "a/.hid.crc", ".h/q.txt"):
        os.makedirs(os.path.dirname(f"{folder}/{p}"), exist_ok=True)
        with open(f"{folder}/{p}", "w") as f:
            f.write("123")
    assert data_files(spark, folder) == data_files(spark, folder + "/") == ["a/c/y z.txt", "b=1/x.txt", "top{1}.txt"]
    assert data_files(spark, f"{folder}/none") == [] and stored_bytes(spark, f"{folder}/b=1") == 3


def _tables(spark, folder, rows):
    """Documents in files of 50 rows, and orders."""
    text = F.concat(F.lit('a "b"\n'), F.repeat(F.lit("word "), 40), F.col("id").cast("string"))
    line = F.concat(F.lit("a b "), F.repeat(F.lit("word "), 40), F.col("id").cast("string"))
    docs = spark.range(0, rows, 1, rows // 50).select(F.col("id").alias("doc_id"), text.alias("text"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.range(0, rows, 1, 2).select(F.col("id").alias("o_orderkey"), line.alias("o_comment")).write.parquet(f"{folder}/orders.parquet")


def test_large_tables_go_to_more_files_and_longer_splits(spark, folder, monkeypatch):
    _tables(spark, folder, 2000)
    small = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "1"}
    monkeypatch.setattr(tables, "TASK_BYTES", stored_bytes(spark, f"{folder}/documents.parquet") // 4 + 1)
    monkeypatch.setattr(scans, "SPLIT_BYTES", 1000)
    monkeypatch.setattr(scans, "SPLITS", 20)
    splits = []
    monkeypatch.setattr(scans, "read_staged", lambda *a, **k: splits.append(spark.conf.get("spark.sql.files.maxPartitionBytes")) or read_staged(*a, **k))
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        assert tables.in_few_tasks(spark, folder, "documents").rdd.getNumPartitions() == 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = scans.QUERIES["src8_split_file_documents"](spark, folder)
    expected = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert int(splits[0]) > 10 * 1000


@pytest.mark.parametrize("target", ["postgresql", "mssql", "mysql", "oracle", "snowflake"])
def test_commands_meet_their_files_by_equality(spark, folder, target):
    _tables(spark, folder, 1000)
    found = targets.QUERIES[f"snk5_load_commands_{target}"](spark, folder)
    each = 2 if target == "snowflake" else 1
    assert [tuple(r) for r in found.collect()] == [(1000, each, each, True, True)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
