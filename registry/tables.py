"""The given tables, and one table of every canonical type derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferkit import Endpoint, read_table, tag
from transferkit.session import stored_bytes
from transferkit.sources.tables import stored_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def folder(sf_dir: str, system: str = "postgresql") -> Endpoint:
    return Endpoint(system, path=sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, folder(sf_dir), name)


# Stored bytes of a table that one task reads where a query wants few files.
TASK_BYTES = 256 << 20


def in_few_tasks(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table read by as few tasks as its size allows: one up to ``TASK_BYTES``, so many times more beyond."""
    tasks = -(-stored_bytes(spark, stored_path(spark, folder(sf_dir), name)) // TASK_BYTES)
    return table(spark, sf_dir, name).coalesce(max(1, tasks))


TYPES = {
    "event_id": "int64",
    "i32": "int32",
    "i16": "int16",
    "code": "nvarchar",
    "kind": "varchar",
    "note": "ntext",
    "memo": "text",
    "f64": "float64",
    "f32": "float32",
    "num": "decimal",
    "cash": "money",
    "at": "datetime",
    "seen": "datetimetz",
    "day": "date",
    "clock": "time",
    "raw": "varbinary",
    "bytes": "blob",
    "uid": "uuid",
    "ok": "bool",
    "doc": "json",
    "tree": "xml",
    "bits": "varbit",
}


def every_type(spark: SparkSession, sf_dir: str, source: str | None = None) -> DataFrame:
    """One row per event and one column per canonical type, with NULLs, empty texts, quotes, fractions
    and an offset.  ``source`` shapes the columns that one system's driver hands over as bytes."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("string")
    digest = F.md5(F.col("event_id").cast("string"))
    dashed = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    pair = F.col("user_id") % 65536 * 257
    df = e.select(
        "event_id",
        (F.col("event_id") % 100000).cast("int").alias("i32"),
        (F.col("user_id") % 30000).cast("short").alias("i16"),
        F.when(
            F.col("event_type") != "error",
            F.concat("event_type", F.lit("'s \""), F.col("user_id").cast("string"), F.lit('"')),
        ).alias("code"),
        F.col("event_type").alias("kind"),
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.col("props")).alias("note"),
        F.concat(F.lit(" "), F.col("props"), F.lit("\\")).alias("memo"),
        F.col("value").alias("f64"),
        F.col("value").cast("float").alias("f32"),
        F.col("value").cast("decimal(12,3)").alias("num"),
        F.col("value").cast("decimal(19,4)").alias("cash"),
        F.col("ts").alias("at"),
        F.concat(ts, F.lit("-07:00")).cast("timestamp").alias("seen"),
        F.col("ts").cast("date").alias("day"),
        F.substr(ts, F.lit(12)).alias("clock"),
        F.encode("event_type", "utf-8").alias("raw"),
        F.encode("props", "utf-8").alias("bytes"),
        (F.unhex(digest) if source == "mssql" else dashed).alias("uid"),
        F.when(F.col("event_type") != "error", F.col("user_id") > 75).alias("ok"),
        F.col("props").alias("doc"),
        F.concat(F.lit("<e>"), F.col("event_type"), F.lit("</e>")).alias("tree"),
        (F.unhex(F.lpad(F.hex(pair), 8, "0")) if source == "mysql" else F.bin("user_id")).alias("bits"),
    )
    return tag(df, TYPES, {"code": 40, "kind": 20, "raw": 16}, keys=["event_id"])


def per_byte_sql(number: str) -> str:
    """Binary digits of a 64-bit number with every byte printed on its own, unpadded."""
    digits = "||".join(f"bin({number} // {256**n} % 256)" for n in range(7, -1, -1))
    return f"ltrim({digits}, '0')"


# The same table in SQL, with every value already as plain text where text is exact.
EVERY_TYPE_SQL = r"""
typed as (
  select event_id, (event_id % 100000)::int as i32, (user_id % 30000)::smallint as i16, user_id % 65536 * 257 as pair,
    case when event_type <> 'error' then event_type || '''s "' || user_id || '"' end as code,
    event_type as kind, case when event_type = 'click' then '' else props end as note,
    ' ' || props || '\' as memo, value as f64, value::float as f32,
    value::decimal(12,3) as num, value::decimal(19,4) as cash,
    strftime(ts, '%Y-%m-%d') as day,
    strftime(ts, '%H:%M:%S') || regexp_replace(strftime(ts, '.%f'), '[.]?0+$', '') as clock,
    strftime(ts + interval 7 hour, '%Y-%m-%d') as seen_day,
    strftime(ts + interval 7 hour, '%H:%M:%S')
      || regexp_replace(strftime(ts, '.%f'), '[.]?0+$', '') as seen_clock,
    lower(hex(encode(event_type))) as raw, lower(hex(encode(props))) as bytes,
    md5(event_id::varchar) as digest,
    case when event_type <> 'error' then user_id > 75 end as ok,
    props as doc, '<e>' || event_type || '</e>' as tree, bin(user_id) as bits
  from events)
"""
DASHED = (
    "substr(digest,1,8)||'-'||substr(digest,9,4)||'-'||substr(digest,13,4)||'-'"
    "||substr(digest,17,4)||'-'||substr(digest,21,12)"
)
ISO = {"at": "day||'T'||clock||'Z'", "seen": "seen_day||'T'||seen_clock||'Z'"}
WALL = {"at": "day||' '||clock", "seen": "seen_day||' '||seen_clock"}
TEXT_OF = {
    **{c: f"{c}::varchar" for c in ("event_id", "i32", "i16", "f64", "f32", "num", "cash", "ok")},
    **{c: c for c in ("code", "kind", "note", "memo", "raw", "bytes", "doc", "tree", "bits", "clock", "day")},
    **ISO,
    "uid": DASHED,
}


def select_sql(exprs: dict[str, str], extra: str = "") -> str:
    cols = ", ".join(f"{e} as {c}" for c, e in exprs.items())
    return f"with {EVERY_TYPE_SQL} select {cols}{extra} from typed"
