"""Canonical text, load text and literals against values worked out in Python."""

import datetime as dt
import random
import struct
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit import SYSTEMS, from_canonical, key_columns, tag, to_canonical, to_literals, to_load
from transferkit.functions.text import bit_text, float_text, guid_text


def one(df):
    return tuple(df.first())


def stamp(df_spark, text, kind="timestamp_ntz"):
    return df_spark.range(1).select(F.lit(text).cast(kind).alias("v"))


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("2024-03-10 02:30:00", "2024-03-10T02:30:00Z"),  # does not exist on Los Angeles clocks
        ("2024-01-01 00:00:00.120", "2024-01-01T00:00:00.12Z"),
        ("2024-01-01 00:00:00.000001", "2024-01-01T00:00:00.000001Z"),
        ("0001-01-01 00:00:00", "0001-01-01T00:00:00Z"),
        ("9999-12-31 23:59:59.999999", "9999-12-31T23:59:59.999999Z"),
    ],
)
def test_datetime(spark, text, wanted):
    assert one(to_canonical(stamp(spark, text))) == (wanted,)


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("2024-11-03 01:30:00-07:00", "2024-11-03T08:30:00Z"),  # the same wall clock, twice
        ("2024-11-03 01:30:00-08:00", "2024-11-03T09:30:00Z"),
        ("1965-06-01 12:00:00.5+05:30", "1965-06-01T06:30:00.5Z"),
    ],
)
def test_instants_become_utc(spark, text, wanted):
    assert one(to_canonical(stamp(spark, text, "timestamp"))) == (wanted,)


def test_time_is_checked_and_trimmed(spark):
    df = tag(spark.createDataFrame([("10:11:12.500",), ("23:59:59",), ("00:00:00.000",), (None,)], "t string"), {"t": "time"})
    assert [r.t for r in to_canonical(df, null=None).collect()] == [
        "0000-01-01T10:11:12.5Z", "0000-01-01T23:59:59Z", "0000-01-01T00:00:00Z", None,
    ]
    bad = tag(spark.createDataFrame([("838:59:59",)], "t string"), {"t": "time"})
    with pytest.raises(Exception, match="not a time of day"):
        to_canonical(bad).collect()
    jdbc = tag(stamp(spark, "1970-01-01 07:08:09.250"), {"v": "time"})
    assert one(to_load(jdbc, "mssql")) == ("07:08:09.25",)


def test_six_decimal_floats_are_exact(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 5e-7, 2.5e-6, 0.5000005, 1.0000005, 1e7, 12345678.12345678, 2.0**53, 2.0**62, -1e-9, 1e15 + 0.5]
    values += [rng.uniform(-1e6, 1e6) for _ in range(2000)]
    values += [round(rng.uniform(-1e4, 1e4), rng.randint(0, 8)) for _ in range(2000)]
    values += [rng.uniform(0, 1) * 10 ** rng.randint(-12, 14) for _ in range(2000)]
    values += [k * 1e-7 * 5 for k in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(float_text(F.col("v"), True)).collect()]
    assert got == [f"{v:.6f}" for v in values]


def test_floats_read_back_exactly(spark):
    rng = random.Random(8)
    values = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [float(r.v) for r in to_canonical(df).collect()] == values
    assert [r.v for r in from_canonical(to_canonical(df)).collect()] == values


def test_special_floats_in_compat_text(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [r.v for r in to_canonical(df, compat=True).collect()] == ["NaN", "+Inf", "-Inf"]


def test_small_decimals_never_use_an_exponent(spark):
    df = spark.range(1).select(F.lit("0.0000001").cast("decimal(12,9)").alias("d"), F.lit("0").cast("decimal(20,8)").alias("z"))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert one(to_canonical(df)) == ("0.000000100", "0.00000000")
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_guid_bytes(spark):
    ids = [uuid.UUID(int=random.Random(n).getrandbits(128)) for n in range(200)]
    df = spark.createDataFrame([(i.bytes_le,) for i in ids] + [(None,)], "b binary")
    got = [r[0] for r in df.select(guid_text(F.col("b"))).collect()]
    assert got == [str(i).upper() for i in ids] + [None]


def test_bit_bytes(spark):
    rng = random.Random(3)
    values = [b"\x00", b"\x05", b"\x01\x01", b"\xff" * 8, b"\x00\x10", None] + [rng.randbytes(rng.randint(1, 8)) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "b binary")
    got = df.select(bit_text(F.col("b")), bit_text(F.col("b"), True)).collect()
    for value, (exact, compat) in zip(values, got):
        if value is None:
            assert (exact, compat) == (None, None)
        else:
            assert exact == f"{int.from_bytes(value, 'big'):b}"
            assert compat == "".join(f"{b:b}" for b in value).lstrip("0")


def test_null_token_and_its_clash(spark):
    df = spark.createDataFrame([("a", 1), (None, None)], "s string, n int")
    assert [tuple(r) for r in to_canonical(df).collect()] == [("a", "1"), ("{nll}", "{nll}")]
    clash = spark.createDataFrame([("{nll}",)], "s string")
    with pytest.raises(Exception, match="holds the null token"):
        to_canonical(clash).collect()
    assert one(to_canonical(clash, compat=True)) == ("{nll}",)
    with pytest.raises(Exception, match="holds the null token"):
        to_canonical(spark.range(3), null="2").collect()


def test_key_columns_keep_table_order(spark):
    df = tag(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), keys=["c", "a"])
    assert key_columns(df).columns == ["a", "c"]
    with pytest.raises(ValueError, match="primary key"):
        key_columns(spark.range(1))


VALUES = {
    "s": ("nvarchar", "it's \\ \"x\""),
    "e": ("text", ""),
    "n": ("int64", 7),
    "at": ("datetime", "2024-05-06 07:08:09.1"),
    "z": ("datetimetz", "2024-05-06 07:08:09.1-07:00"),
    "d": ("date", dt.date(2024, 5, 6)),
    "t": ("time", "07:08:09.250"),
    "b": ("blob", b"\xde\xad"),
    "u": ("uuid", "0f0e0d0c-0b0a-0908-0706-050403020100"),
    "ok": ("bool", True),
    "bits": ("varbit", "101"),
}


@pytest.fixture(scope="module")
def row(spark):
    schema = "s string, e string, n bigint, at string, z string, d date, t string, b binary, u string, ok boolean, bits string"
    df = spark.createDataFrame([tuple(v for _, v in VALUES.values())], schema)
    df = df.withColumn("at", F.col("at").cast("timestamp_ntz")).withColumn("z", F.col("z").cast("timestamp"))
    return tag(df, {k: t for k, (t, _) in VALUES.items()})


WALL = "2024-05-06 07:08:09.1"
UTC = "2024-05-06 14:08:09.1"
LOADS = {
    "postgresql": dict(e="", at="2024-05-06T07:08:09.1Z", z="2024-05-06T14:08:09.1Z", b="\\xdead", u=None, ok="true"),
    "mssql": dict(e="\x00", at=WALL, z=UTC, b="dead", u=None, ok="1"),
    "mysql": dict(e="", at=WALL, z=UTC, b="dead", u=None, ok="true"),
    "oracle": dict(e="", at=WALL, z=UTC + " +00:00", b="dead", u="bare", ok="1"),
    "snowflake": dict(e="", at="2024-05-06T07:08:09.1Z", z="2024-05-06T14:08:09.1Z", b="dead", u="bare", ok="true"),
}


@pytest.mark.parametrize("target", list(SYSTEMS))
def test_load_text(row, target):
    got = to_load(row, target, compat=True).first().asDict()
    wanted = dict(LOADS[target])
    wanted["u"] = VALUES["u"][1].replace("-", "") if wanted["u"] else VALUES["u"][1]
    wanted.update(s=VALUES["s"][1], n="7", d="2024-05-06", t="07:08:09.25", bits="101")
    assert got == wanted


def test_load_text_repairs(row):
    mysql = to_load(row, "mysql").first()
    assert (mysql.ok, mysql.u) == ("1", VALUES["u"][1].replace("-", ""))
    assert to_load(row, "mssql").first().z == UTC + " +00:00"


LITERALS = {
    "postgresql": dict(b="'\\xdead'", ok="true", bits="B'101'", z=f"'{UTC}+00'", u="'{}'"),
    "mssql": dict(b="0xdead", ok="1", bits="'101'", z=f"'{UTC} +00:00'", u="'{}'"),
    "mysql": dict(b="UNHEX('dead')", ok="true", bits="'101'", z=f"'{UTC}'", u="UNHEX('{}')"),
    "oracle": dict(
        b="HEXTORAW('dead')", ok="1", bits="'101'", u="HEXTORAW('{}')",
        z=f"TO_TIMESTAMP_TZ('{UTC} +00:00', 'YYYY-MM-DD HH24:MI:SS.FF6 TZH:TZM')",
    ),
    "snowflake": dict(b="X'dead'", ok="true", bits="'101'", z=f"'{UTC} +00:00'", u="X'{}'"),
}


@pytest.mark.parametrize("target", list(SYSTEMS))
def test_literals(row, target):
    got = to_literals(row, target).first().asDict()
    wanted = dict(LITERALS[target])
    bare = VALUES["u"][1].replace("-", "")
    wanted["u"] = wanted["u"].format(VALUES["u"][1] if target in ("postgresql", "mssql") else bare)
    text = "it''s \\\\ \"x\"" if target in ("mysql", "snowflake") else "it''s \\ \"x\""
    wanted.update(s=f"'{text}'", e="''", n="7", t="'07:08:09.25'", d="'2024-05-06'", at=f"'{WALL}'")
    if target == "oracle":
        wanted["d"] = "TO_DATE('2024-05-06', 'YYYY-MM-DD')"
        wanted["at"] = f"TO_TIMESTAMP('{WALL}', 'YYYY-MM-DD HH24:MI:SS.FF6')"
    assert got == wanted


def test_compat_literals(row):
    pg = to_literals(row, "postgresql", compat=True).first()
    assert (pg.b, pg.u, pg.d, pg.t) == ("\\xdead", VALUES["u"][1], "'2024-05-06 00:00:00'", "'0000-01-01 07:08:09.25'")
    assert to_literals(row, "mysql", compat=True).first().b == "UNHEX('dead'"
    assert to_literals(row, "mssql", compat=True).first().ok == "true"


def test_null_literals_are_bare(spark):
    df = spark.createDataFrame([(None, None)], "s string, n int")
    assert one(to_literals(df, "oracle")) == ("null", "null")


def test_parsing_refuses_text_that_does_not_fit(spark):
    from transferkit import ColumnInfo

    text = spark.createDataFrame([("maybe",)], "v string")
    for kind in ("bool", "int64", "datetime"):
        with pytest.raises(Exception):
            from_canonical(text, [ColumnInfo("v", kind)]).collect()


def test_unsupported_system():
    from transferkit.systems import profile

    with pytest.raises(ValueError, match="unsupported system"):
        profile("sqlite")


def test_decimal_canonical_type_of_text_values(spark):
    """Numbers too wide for Spark stay text end to end."""
    wide = "9" * 50 + ".25"
    df = tag(spark.createDataFrame([(wide,)], "n string"), {"n": "decimal"})
    back = from_canonical(to_canonical(df))
    assert isinstance(back.schema["n"].dataType, T.StringType) and back.first().n == wide
