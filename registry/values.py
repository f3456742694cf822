"""PRJ-1, PRJ-4 to PRJ-12 and AGG-1: values to canonical text and back, and their sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.tables import DASHED, TEXT_OF, every_type, per_byte_sql, select_sql, table
from transferkit import from_canonical, key_columns, max_byte_length, tag, to_canonical, to_load
from transferkit.functions.load import null_as_empty
from transferkit.functions.text import bit_text, guid_text

QUERIES: dict = {}
SQL: dict[str, str] = {}

CANONICAL = {**TEXT_OF, "day": "day||'T00:00:00Z'", "clock": "'0000-01-01T'||clock||'Z'"}
SIX = {"f64": "printf('%.6f', f64)", "f32": "printf('%.6f', f32::double)"}
GUID = (
    "upper(substr(digest,7,2)||substr(digest,5,2)||substr(digest,3,2)||substr(digest,1,2)||'-'"
    "||substr(digest,11,2)||substr(digest,9,2)||'-'||substr(digest,15,2)||substr(digest,13,2)||'-'"
    "||substr(digest,17,4)||'-'||substr(digest,21,12))"
)
PER_SOURCE = {
    "postgresql": SIX,
    "mssql": {**SIX, "uid": GUID},
    "mysql": {"bits": per_byte_sql("pair")},
    "oracle": {"clock": "clock"},
    "snowflake": SIX,
}


def _canonical(source):
    return lambda spark, sf: to_canonical(every_type(spark, sf, source), source, compat=True)


for _source, _own in PER_SOURCE.items():
    _name = f"prj1_canonical_text_{_source}"
    QUERIES[_name] = _canonical(_source)
    _exprs = {c: f"coalesce({e}, '{{nll}}')" for c, e in {**CANONICAL, **_own}.items()}
    SQL[_name] = select_sql(_exprs)

QUERIES["prj1_canonical_text_exact"] = lambda spark, sf: to_canonical(every_type(spark, sf), null=None)
SQL["prj1_canonical_text_exact"] = select_sql(CANONICAL)


def prj1_float_compat(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    line = table(spark, sf, "lineitem")
    shares = (F.col("l_extendedprice") / F.col("l_quantity") / 7).alias("share")
    return to_canonical(line.select("l_orderkey", *cols, shares), compat=True)


QUERIES["prj1_float_compat"] = prj1_float_compat
SQL["prj1_float_compat"] = """
select l_orderkey::varchar as l_orderkey, printf('%.6f', l_quantity) as l_quantity,
  printf('%.6f', l_extendedprice) as l_extendedprice, printf('%.6f', l_discount) as l_discount,
  printf('%.6f', l_tax) as l_tax, printf('%.6f', l_extendedprice / l_quantity / 7) as share
from lineitem"""

QUERIES["prj1_datetime"] = lambda spark, sf: to_canonical(table(spark, sf, "events").select("event_id", "ts"))
SQL["prj1_datetime"] = r"""
select event_id::varchar as event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || regexp_replace(strftime(ts, '.%f'), '[.]?0+$', '') || 'Z' as ts
from events"""


def prj1_date(spark, sf):
    day = F.col("l_shipdate").cast("date").alias("ship_day")
    return to_canonical(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", day))


QUERIES["prj1_date"] = prj1_date
SQL["prj1_date"] = """
select l_orderkey::varchar as l_orderkey, l_linenumber::varchar as l_linenumber,
  strftime(l_shipdate, '%Y-%m-%dT00:00:00Z') as ship_day from lineitem"""


def prj1_bool(spark, sf):
    urgent = (F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    return to_canonical(table(spark, sf, "orders").select("o_orderkey", urgent))


QUERIES["prj1_bool"] = prj1_bool
SQL["prj1_bool"] = """
select o_orderkey::varchar as o_orderkey, (o_orderpriority = '1-URGENT')::varchar as urgent from orders"""


def prj1_decimal(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(14,2)").alias("price")
    tiny = (F.col("l_linenumber").cast("decimal(4,0)") * F.lit("0.00000001").cast("decimal(9,8)")).alias("tiny")
    return to_canonical(table(spark, sf, "lineitem").select("l_orderkey", price, tiny))


QUERIES["prj1_decimal"] = prj1_decimal
SQL["prj1_decimal"] = """
select l_orderkey::varchar as l_orderkey, l_extendedprice::decimal(14,2)::varchar as price,
  (l_linenumber::decimal(4,0) * 0.00000001::decimal(9,8))::varchar as tiny from lineitem"""


def prj4_null_token(spark, sf):
    o = table(spark, sf, "orders")
    status = F.nullif("o_orderstatus", F.lit("F")).alias("status")
    price = F.when(F.col("o_totalprice") >= 1000, F.col("o_totalprice").cast("decimal(12,2)")).alias("price")
    day = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("day")
    return to_canonical(o.select("o_orderkey", status, price, day))


QUERIES["prj4_null_token"] = prj4_null_token
SQL["prj4_null_token"] = """
select o_orderkey::varchar as o_orderkey, coalesce(nullif(o_orderstatus, 'F'), '{nll}') as status,
  coalesce(case when o_totalprice >= 1000 then o_totalprice::decimal(12,2) end::varchar, '{nll}') as price,
  coalesce(case when o_orderpriority <> '5-LOW' then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') end, '{nll}')
    as day
from orders"""


def prj5_null_as_empty(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"))
    text = to_load(o, "mssql")
    return text.select(*[null_as_empty(F.col(c)).alias(c) for c in text.columns])


QUERIES["prj5_null_as_empty"] = prj5_null_as_empty
SQL["prj5_null_as_empty"] = """
select o_orderkey::varchar as o_orderkey, coalesce(nullif(o_orderstatus, 'F'), '') as status from orders"""


def prj6_empty_as_nul(spark, sf):
    role = F.col("role")
    text = F.when(role == "assistant", F.lit("")).otherwise(F.col("text")).alias("text")
    c = table(spark, sf, "conversations").select("conv_id", "turn", text)
    return to_load(c, "mssql").withColumn("text", F.hex("text"))


QUERIES["prj6_empty_as_nul"] = prj6_empty_as_nul
SQL["prj6_empty_as_nul"] = """
select conv_id::varchar as conv_id, turn::varchar as turn,
  case when role = 'assistant' then '00' else hex(encode(text)) end as text from conversations"""


def prj7_zone(spark, sf):
    wall = F.col("ts").cast("string")
    e = table(spark, sf, "events").select(
        "event_id",
        F.concat(wall, F.lit("-07:00")).cast("timestamp").alias("pacific"),
        F.concat(wall, F.lit("+05:30")).cast("timestamp").alias("india"),
    )
    return to_canonical(e)


QUERIES["prj7_zone_normalization"] = prj7_zone
SQL["prj7_zone_normalization"] = r"""
with f as (select *, regexp_replace(strftime(ts, '.%f'), '[.]?0+$', '') || 'Z' as tail from events)
select event_id::varchar as event_id, strftime(ts + interval 7 hour, '%Y-%m-%dT%H:%M:%S') || tail as pacific,
  strftime(ts - interval 330 minute, '%Y-%m-%dT%H:%M:%S') || tail as india from f"""

QUERIES["prj8_guid"] = lambda spark, sf: table(spark, sf, "lineitem").select(
    "l_orderkey",
    "l_linenumber",
    guid_text(F.unhex(F.md5(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey")))).alias("guid"),
)
SQL["prj8_guid"] = f"""
with d as (select l_orderkey, l_linenumber,
  md5(l_orderkey || '/' || l_linenumber || '/' || l_partkey) as digest from lineitem)
select l_orderkey, l_linenumber, {GUID} as guid from d"""


def _bits(compat):
    def run(spark, sf):
        line = table(spark, sf, "lineitem")
        raw = F.unhex(F.lpad(F.hex("l_partkey"), 16, "0"))
        return line.select("l_orderkey", "l_partkey", bit_text(raw, compat).alias("bits"))

    return run


QUERIES["prj9_varbit"] = _bits(False)
SQL["prj9_varbit"] = "select l_orderkey, l_partkey, bin(l_partkey) as bits from lineitem"
QUERIES["prj9_varbit_compat"] = _bits(True)
SQL["prj9_varbit_compat"] = f"select l_orderkey, l_partkey, {per_byte_sql('l_partkey')} as bits from lineitem"


def prj10_blob_hex(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.encode("text", "utf-8").alias("body"))
    return to_canonical(d).withColumn("body", F.md5("body"))


QUERIES["prj10_blob_hex"] = prj10_blob_hex
SQL["prj10_blob_hex"] = """
select doc_id::varchar as doc_id, md5(lower(hex(encode(text)))) as body from documents"""


def prj11_keys(spark, sf):
    c = tag(table(spark, sf, "conversations"), keys=["conv_id", "turn"])
    return to_canonical(key_columns(c))


QUERIES["prj11_key_columns"] = prj11_keys
SQL["prj11_key_columns"] = (
    "select conv_id::varchar as conv_id, turn::varchar as turn from conversations"
)


def prj12_parse(spark, sf):
    back = from_canonical(to_canonical(every_type(spark, sf)))
    return back.select(
        "event_id", "i32", "i16", "code", "kind", "note", "memo", "f64", "f32", "at", "day", "clock", "uid",
        "ok", "doc", "tree", "bits", F.col("num").cast("string").alias("num"),
        F.col("cash").cast("string").alias("cash"), F.unix_micros("seen").alias("seen"),
        F.hex("raw").alias("raw"), F.hex("bytes").alias("bytes"),
    )


QUERIES["prj12_parse"] = prj12_parse
SQL["prj12_parse"] = (
    "with " + select_sql({"x": "1"}).split("with ", 1)[1].rsplit("select", 1)[0]
    + f"""select t.event_id, t.i32, t.i16, code, kind, note, memo, f64, f32, e.ts as at, e.ts::date as day, clock,
  {DASHED} as uid, ok, doc, tree, bits, num::varchar as num, cash::varchar as cash,
  epoch_us(e.ts + interval 7 hour) as seen, upper(raw) as raw, upper(bytes) as bytes
from typed t join events e on e.event_id = t.event_id"""
)


def agg1_documents(spark, sf):
    d = table(spark, sf, "documents")
    return max_byte_length(d.withColumn("lang", F.nullif("lang", F.lit("en"))))


QUERIES["agg1_max_byte_length"] = agg1_documents
SQL["agg1_max_byte_length"] = """
select (max(strlen(doc_id::varchar)) + 5)::int as doc_id, (max(strlen(text)) + 5)::int as text,
  (max(strlen(coalesce(nullif(lang, 'en'), '{nll}'))) + 5)::int as lang,
  (max(strlen(source)) + 5)::int as source, (max(strlen(n_chars::varchar)) + 5)::int as n_chars
from documents"""

_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
_LINE += ["l_tax", "l_returnflag", "l_linestatus"]
QUERIES["agg1_max_byte_length_lineitem"] = lambda spark, sf: max_byte_length(table(spark, sf, "lineitem"))
SQL["agg1_max_byte_length_lineitem"] = (
    "select "
    + ", ".join(f"(max(strlen({c}::varchar)) + 5)::int as {c}" for c in _LINE)
    + ", (max(strlen(strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ'))) + 5)::int as l_shipdate from lineitem"
)

