"""Sizes and tokens taken from the values."""

import random

import pytest

from conftest import random_text
from transferkit import column_infos, free_tokens, sized_by_values, tag, value_profile
from transferkit.types import ColumnInfo, apply_infos


def table(spark, rows):
    df = spark.createDataFrame(rows, "n string, t string, b binary, i int, s string")
    infos = [ColumnInfo("n", "decimal"), ColumnInfo("t", "ntext"), ColumnInfo("b", "blob"), ColumnInfo("i", "int32"),
             ColumnInfo("s", "nvarchar", length=99)]
    return apply_infos(df, infos)


def test_profile(spark):
    rows = [("-0012.500", "né", b"abc", 1, "x"), ("7", None, None, None, "y"), (None, "", b"", 3, None), (".25", "x", b"x", 4, "z")]
    found = {r.column_name: tuple(r)[3:] for r in value_profile(table(spark, rows)).collect()}
    assert found == {"n": (1, 2, 2, None, None), "t": (1, None, None, 2, 3), "b": (1, None, None, None, 3),
                     "i": (1, None, None, None, None), "s": (1, None, None, 1, 1)}
    empty = {r.column_name: tuple(r)[3:] for r in value_profile(table(spark, rows).limit(0)).collect()}
    assert empty["n"] == (0, None, None, None, None)


def test_sizes(spark):
    rows = [("-0012.500", "né", b"abc", 1, "x"), ("7", None, None, None, "y")]
    df = sized_by_values(table(spark, rows))
    infos = {i.name: i for i in column_infos(df)}
    assert (infos["n"].precision, infos["n"].scale) == (3, 1) and df.schema["n"].dataType.simpleString() == "decimal(3,1)"
    assert infos["t"].length == 2 and infos["b"].length == 3 and infos["s"].length == 99
    assert [str(r.n) for r in df.orderBy("t").collect()] == ["7.0", "-12.5"]


@pytest.mark.parametrize("odd", ["1e5", "9" * 39, "0." + "1" * 39])
def test_numbers_that_stay_text(spark, odd):
    df = sized_by_values(table(spark, [(odd, "x", b"", 1, "s"), ("5", "y", b"", 1, "s")]))
    assert df.schema["n"].dataType.simpleString() == "string" and {r.n for r in df.collect()} == {odd, "5"}
    assert column_infos(sized_by_values(table(spark, []).limit(0)))[1].length == -1


def test_tokens_are_in_no_value(spark):
    rng = random.Random(2)
    values = [random_text(rng, 20) + rng.choice(["", f"{{k{rng.randrange(9):03x}}}", "{k", "{k00{k001}"]) for _ in range(300)]
    df = tag(spark.createDataFrame([(v, n) for n, v in enumerate(values)], "v string, n int"))
    found = free_tokens(df, 4)
    assert len(set(found)) == 4
    for a in found:
        assert not any(a in v for v in values)
        for b in found:  # between any value and a separator stands nothing else that reads as one
            assert all((v + a + w).count(b) == (a == b) for v in values[:60] for w in ("", "}", "k000}"))
    many = tag(spark.createDataFrame([("".join(f"{{k{i:03x}}}" for i in range(4095)),)], "v string"))
    assert free_tokens(many, 1) == ["{kfff}"] and free_tokens(many, 2) == ["{k0000}", "{k0001}"]
    assert free_tokens(spark.range(3), 1) == ["{k000}"]


def test_staged_folders_are_removed(spark):
    from transferkit.operators.numbering import numbered
    from transferkit.session import _workspaces, path_exists, remove_workspaces, staging, workspace

    before = len(_workspaces)
    kept = workspace(spark, "kept")
    spark.range(3).write.parquet(kept)
    with pytest.raises(KeyError), staging(spark):
        rows = numbered(spark.range(9).toDF("a"), ["a"], "n")
        files = rows.inputFiles()
        assert rows.count() == 9 and path_exists(spark, files[0])
        raise KeyError
    assert not path_exists(spark, files[0]) and path_exists(spark, kept)
    assert remove_workspaces(spark, before) == 1 and not path_exists(spark, kept) and remove_workspaces(spark, before) == 0
