"""SNK-10 to SNK-13, REL, INC and TRF: tables written, merged, and moved from end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.tables import folder, table
from transferkit import (
    ChangeLog, Endpoint, PlacedTable, ddl, delete_by_keys, delete_statements, describe, incremental_transfer,
    latest_per_key, read_stream, read_table, since, sized_by_values, table_exists, tag, transfer, translate, upsert,
    value_profile, write_table,
)
from transferkit.session import workspace

QUERIES: dict = {}
SQL: dict[str, str] = {}

MARK = "timestamp '1998-01-01 00:00:00'"


def _mark():
    return F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")


def _place(spark, name):
    return Endpoint("postgresql", path=workspace(spark, name))


# --- SNK-10 to SNK-13 ----------------------------------------------------------------------------------


def snk10_append(spark, sf):
    """Two loads into one table, matched by position: the second one's names differ."""
    orders, target = table(spark, sf, "orders"), _place(spark, "append")
    write_table(orders.where(F.col("o_orderdate") < _mark()), target, "orders", create_table=True)
    later = orders.where(F.col("o_orderdate") >= _mark())
    write_table(later.toDF(*[f"c{n}" for n in range(len(later.columns))]), target, "orders")
    return read_table(spark, target, "orders")


QUERIES["snk10_append_by_position"] = snk10_append
SQL["snk10_append_by_position"] = "select * from orders"


def snk11_catalog(spark, sf):
    """Schema and table made in the session's catalog, rows inserted by position, schema kept."""
    schema, target = f"sales_{uuid.uuid4().hex[:8]}", Endpoint("postgresql")
    c = table(spark, sf, "customer")
    place = workspace(spark, schema)
    write_table(c, target, "customer", schema, create_schema=True, create_table=True, location=place)
    write_table(c.where("c_acctbal < 0"), target, "customer", schema)
    return read_table(spark, target, "customer", schema)


QUERIES["snk11_create_schema"] = snk11_catalog
SQL["snk11_create_schema"] = "select * from customer union all select * from customer where c_acctbal < 0"


def snk12_create_table(spark, sf):
    target = _place(spark, "create")
    write_table(table(spark, sf, "part"), target, "part", create_table=True)
    return read_table(spark, target, "part")


QUERIES["snk12_create_table"] = snk12_create_table
SQL["snk12_create_table"] = "select * from part"


def snk13_drop_table(spark, sf):
    """A load that drops the old table leaves only its own rows."""
    target, orders = _place(spark, "drop"), table(spark, sf, "orders")
    write_table(orders, target, "orders", create_table=True)
    write_table(orders.where("o_orderstatus = 'P'"), target, "orders", drop_table=True)
    return read_table(spark, target, "orders")


QUERIES["snk13_drop_table"] = snk13_drop_table
SQL["snk13_drop_table"] = "select * from orders where o_orderstatus = 'P'"



def _create_statements(target):
    """The statement ``write_table`` makes its table with, for tables whose texts have the length of their values."""

    def run(spark, sf):
        out = None
        for name, key in (("customer", "c_custkey"), ("part", "p_name"), ("supplier", "s_name")):
            rows = tag(sized_by_values(table(spark, sf, name)), keys=[key])
            columns = translate(describe(rows, "sales", name), None, target)
            made = ddl(columns, target, incremental=True).select("table_name", "statement", "refused")
            out = made if out is None else out.unionByName(made)
        return out

    return run


_SIZED = {
    "mssql": ("'nvarchar(' || 2 * n || ')'", "bigint", "integer", "float", "if object_id(''sales.{0}'', ''U'') is null create table sales.{0} ("),
    "mysql": ("'longtext'", "bigint", "integer", "double", "create table if not exists `{0}` ("),
    "postgresql": ("'text'", "bigint", "integer", "double precision", "create table if not exists sales.{0} ("),
}


_COLUMNS = {
    "customer": [
        ("c_custkey", "big"), ("c_name", "text"), ("c_nationkey", "whole"), ("c_acctbal", "real"), ("c_mktsegment", "text"),
    ],
    "part": [
        ("p_partkey", "big"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"), ("p_size", "whole"),
        ("p_retailprice", "real"),
    ],
    "supplier": [("s_suppkey", "big"), ("s_name", "text"), ("s_nationkey", "whole"), ("s_acctbal", "real")],
}


def _create_sql(target):
    text, big, whole, real, start = _SIZED[target]
    key_text = "'varchar(' || n || ')'" if target == "mysql" else text
    out = []
    for name, key in (("customer", "c_custkey"), ("part", "p_name"), ("supplier", "s_name")):
        parts = []
        for column, kind in _COLUMNS[name]:
            quoted = f"`{column}`" if target == "mysql" else column
            if kind == "text":
                value = key_text if column == key else text
                parts.append(f"'{quoted} ' || " + value.replace("n ||", f"(select max(length({column})) from {name}) ||"))
            else:
                parts.append(f"'{quoted} {dict(big=big, whole=whole, real=real)[kind]}'")
        last = f"', primary key ({f'`{key}`' if target == 'mysql' else key}))'"
        body = " || ', ' || ".join(parts)
        out.append(f"select '{name}' as table_name, '{start.format(name)}' || {body} || {last} as statement, null::varchar as refused")
    return " union all ".join(out)


for _target in _SIZED:
    QUERIES[f"snk12_create_statements_{_target}"] = _create_statements(_target)
    SQL[f"snk12_create_statements_{_target}"] = _create_sql(_target)

# --- REL -------------------------------------------------------------------------------------------------


def rel1_delete_by_keys(spark, sf):
    keys = table(spark, sf, "customer").where("c_acctbal < 2500").select(F.col("c_custkey").alias("o_custkey"))
    return delete_by_keys(table(spark, sf, "orders"), keys, ["o_custkey"])


QUERIES["rel1_delete_by_keys"] = rel1_delete_by_keys
SQL["rel1_delete_by_keys"] = """
select * from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 2500)"""


def rel1_delete_by_place(spark, sf):
    """Deletes noted by file and row, an upsert, and files that lost many rows replaced."""
    path, orders = workspace(spark, "placed_orders"), table(spark, sf, "orders")
    orders.repartitionByRange(6, "o_orderkey").write.parquet(path)
    placed = PlacedTable(path)
    customers = table(spark, sf, "customer").where("c_acctbal < 2500").select(F.col("c_custkey").alias("o_custkey"))
    placed.delete(spark, customers, ["o_custkey"])
    late = orders.where(F.col("o_orderdate") >= _mark()).withColumn("o_orderstatus", F.lit("X"))
    placed.upsert(spark, late, ["o_orderkey"])
    placed.delete(spark, orders.where("o_orderkey < 50").select("o_orderkey"), ["o_orderkey"])
    placed.rewrite(spark, 0.5)
    return placed.read(spark)


QUERIES["rel1_delete_by_place"] = rel1_delete_by_place
SQL["rel1_delete_by_place"] = f"""
select * from orders where o_orderdate < {MARK} and o_orderkey >= 50
  and o_custkey not in (select c_custkey from customer where c_acctbal < 2500)
union all select * replace ('X' as o_orderstatus) from orders where o_orderdate >= {MARK} and o_orderkey >= 50"""


def rel1_delete_null_keys(spark, sf):
    """Two-column keys with NULLs on both sides: a NULL deletes nothing and is never deleted."""
    e = table(spark, sf, "events").withColumn("event_type", F.nullif("event_type", F.lit("click")))
    keys = e.where("value > 400").select("user_id", "event_type")
    return delete_by_keys(e, keys, ["user_id", "event_type"])


QUERIES["rel1_delete_null_keys"] = rel1_delete_null_keys
SQL["rel1_delete_null_keys"] = """
with e as (select * replace (nullif(event_type, 'click') as event_type) from events)
select * from e where not exists (
  select 1 from e k where k.value > 400 and k.user_id = e.user_id and k.event_type = e.event_type)"""


def rel2_upsert(spark, sf):
    orders = table(spark, sf, "orders")
    late = orders.where(F.col("o_orderdate") >= _mark()).withColumn("o_orderstatus", F.lit("X"))
    return upsert(orders.where("o_orderpriority <> '5-LOW'"), late, ["o_orderkey"])


QUERIES["rel2_upsert"] = rel2_upsert
SQL["rel2_upsert"] = f"""
select * from orders where o_orderpriority <> '5-LOW' and o_orderdate < {MARK}
union all select * replace ('X' as o_orderstatus) from orders where o_orderdate >= {MARK}"""


def rel2_upsert_log(spark, sf):
    """The same by reading a log of batches: events of one user and type replace each other."""
    e = table(spark, sf, "events").withColumn("batch_id", F.dayofmonth("ts").cast("int"))
    return latest_per_key(e, ["user_id", "event_type"])


QUERIES["rel2_upsert_log"] = rel2_upsert_log
SQL["rel2_upsert_log"] = """
select *, day(ts)::int as batch_id from events
qualify day(ts) = max(day(ts)) over (partition by user_id, event_type)"""


# buckets of the key sets below
BUCKETS = 13


def _statements(target, compat=False):
    def run(spark, sf):
        keys = table(spark, sf, "orders").select("o_orderkey")
        return delete_statements(keys, target, "order", "sales", buckets=BUCKETS, compat=compat)

    return run


def _statements_sql(tuple_text: str, keys: str, start: str, end: str, sep: str = ",") -> str:
    return f"""
with k as ({keys}), t as (select distinct {tuple_text} as t from k),
b as (select t, ('0x' || substr(md5(t), 1, 7))::bigint % {BUCKETS} as bucket from t),
r as (select *, (row_number() over (partition by bucket order by t) - 1) // 6 as batch from b)
select bucket, batch, '{start}' || string_agg(t, '{sep}' order by t) || '{end}' as statement
from r group by bucket, batch"""


_KEYS = "select o_orderkey from orders"
_HEAD = {
    "postgresql": 'delete from sales."order" where (o_orderkey) in (',
    "mysql": "delete from `order` where (`o_orderkey`) in (",
    "oracle": 'delete from sales."order" where (o_orderkey) in (',
    "snowflake": 'delete from sales."order" where (o_orderkey) in (',
}
for _target, _start in _HEAD.items():
    QUERIES[f"rel3_delete_batches_{_target}"] = _statements(_target)
    SQL[f"rel3_delete_batches_{_target}"] = _statements_sql("'('||o_orderkey||')'", _KEYS, _start, ")")
QUERIES["rel3_delete_batches_mssql"] = _statements("mssql")
SQL["rel3_delete_batches_mssql"] = _statements_sql(
    "o_orderkey::varchar", _KEYS, "delete from sales.[order] where o_orderkey in (", ")"
)


def _pair_statements(target):
    def run(spark, sf):
        keys = table(spark, sf, "events").select("user_id", F.nullif("event_type", F.lit("click")).alias("type"))
        return delete_statements(keys, target, "events", "sales", buckets=BUCKETS)

    return run


_PAIR_KEYS = "select user_id, nullif(event_type, 'click') as type from events"
_PAIR_TYPE = "coalesce('''' || type || '''', 'null')"
QUERIES["rel3_delete_pairs_postgresql"] = _pair_statements("postgresql")
SQL["rel3_delete_pairs_postgresql"] = _statements_sql(
    f"'('||user_id||','||{_PAIR_TYPE}||')'", _PAIR_KEYS, "delete from sales.events where (user_id,type) in (", ")"
)
QUERIES["rel3_delete_pairs_mssql"] = _pair_statements("mssql")
SQL["rel3_delete_pairs_mssql"] = _statements_sql(
    f"'(user_id = '||user_id||' and type = '||{_PAIR_TYPE}||')'", _PAIR_KEYS, "delete from sales.events where ", "",
    " or ",
)



def _ordered_statements(target):
    def run(spark, sf):
        return delete_statements(table(spark, sf, "lineitem").select("l_orderkey"), target, "order lines", "sales")

    return run


def _ordered_pairs(target):
    def run(spark, sf):
        keys = table(spark, sf, "events").select("user_id", F.nullif("event_type", F.lit("click")).alias("type"))
        return delete_statements(keys, target, "events", "sales")

    return run


def _ordered_sql(keys: str, tuple_text: str, order: str, start: str, end: str, sep: str = ",") -> str:
    return f"""
with k as (select distinct * from ({keys})),
r as (select {tuple_text} as t, row_number() over (order by {order}) - 1 as n from k)
select 0::bigint as bucket, n // 6 as batch, '{start}' || string_agg(t, '{sep}' order by n) || '{end}' as statement
from r group by n // 6"""


for _target, _full, _column in (
    ("postgresql", 'sales."order lines"', "l_orderkey"), ("mysql", "`order lines`", "`l_orderkey`"),
    ("oracle", 'sales."order lines"', "l_orderkey"), ("snowflake", 'sales."order lines"', "l_orderkey"),
):
    QUERIES[f"rel3_delete_in_order_{_target}"] = _ordered_statements(_target)
    SQL[f"rel3_delete_in_order_{_target}"] = _ordered_sql(
        "select l_orderkey from lineitem", "'('||l_orderkey||')'", "l_orderkey",
        f"delete from {_full} where ({_column}) in (", ")",
    )
QUERIES["rel3_delete_in_order_mssql"] = _ordered_statements("mssql")
SQL["rel3_delete_in_order_mssql"] = _ordered_sql(
    "select l_orderkey from lineitem", "l_orderkey::varchar", "l_orderkey",
    "delete from sales.[order lines] where l_orderkey in (", ")",
)
QUERIES["rel3_pairs_in_order_mssql"] = _ordered_pairs("mssql")
SQL["rel3_pairs_in_order_mssql"] = _ordered_sql(
    _PAIR_KEYS, f"'(user_id = '||user_id||' and type = '||{_PAIR_TYPE}||')'", "user_id, type nulls first",
    "delete from sales.events where ", "", " or ",
)

# --- INC -------------------------------------------------------------------------------------------------


def inc1_since(spark, sf):
    orders = table(spark, sf, "orders")
    return since(orders, "o_orderdate", orders.where(F.col("o_orderdate") < _mark()), inclusive=False)


QUERIES["inc1_high_water_mark"] = inc1_since
SQL["inc1_high_water_mark"] = f"""
select * from orders where o_orderdate > (select max(o_orderdate) from orders where o_orderdate < {MARK})"""


def inc1_incremental_load(spark, sf):
    """A first load, a load of what is newer than the mark, and a load of changed rows."""
    orders = table(spark, sf, "orders")
    log = ChangeLog(workspace(spark, "orders_log"), ("o_orderkey",))
    log.load(spark, orders.where(F.col("o_orderdate") < _mark()), "o_orderdate")
    log.load(spark, orders, "o_orderdate", inclusive=False)
    changed = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("U"))
    log.load(spark, changed)
    return log.current(spark)


QUERIES["inc1_incremental_load"] = inc1_incremental_load
SQL["inc1_incremental_load"] = """
select * replace (case when o_orderpriority = '1-URGENT' then 'U' else o_orderstatus end as o_orderstatus)
from orders"""


def inc1_log_without_success(spark, sf):
    """Loads of a committer that leaves no ``_SUCCESS`` file count like others."""
    orders, name = table(spark, sf, "orders"), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    log = ChangeLog(workspace(spark, "orders_quiet"), ("o_orderkey",))
    spark.conf.set(name, "false")
    try:
        for rest in range(3):
            log.load(spark, orders.where(F.col("o_custkey") % 3 == rest))
        log.load(spark, orders.where("o_orderstatus = 'P'").withColumn("o_orderpriority", F.lit("late")))
    finally:
        spark.conf.unset(name)
    return log.current(spark)


QUERIES["inc1_log_without_success"] = inc1_log_without_success
SQL["inc1_log_without_success"] = """
select * replace (case when o_orderstatus = 'P' then 'late' else o_orderpriority end as o_orderpriority) from orders"""


def inc1_new_column(spark, sf):
    """A batch brings a column that the log did not have."""
    orders = table(spark, sf, "orders")
    log = ChangeLog(workspace(spark, "orders_wider"), ("o_orderkey",))
    log.load(spark, orders)
    log.load(spark, orders.where("o_orderstatus <> 'F'").withColumn("note", F.concat("o_orderstatus", F.lit("!"))))
    return log.current(spark)


QUERIES["inc1_new_column"] = inc1_new_column
SQL["inc1_new_column"] = """
select *, case when o_orderstatus <> 'F' then o_orderstatus || '!' end as note from orders"""


def inc1_null_and_tied_marks(spark, sf):
    """Rows that get the newest mark late, or have none, are in the next load."""
    orders = table(spark, sf, "orders").withColumn(
        "o_orderdate", F.when(F.col("o_custkey") % 7 != 0, F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"))
    )
    log = ChangeLog(workspace(spark, "orders_late"), ("o_orderkey",))
    first = F.coalesce(F.col("o_orderdate") <= F.date_trunc("month", _mark()), F.col("o_custkey") % 14 == 0)
    log.load(spark, orders.where(first & (F.col("o_orderkey") % 2 == 0)), "o_orderdate")
    log.load(spark, orders, "o_orderdate")
    return log.current(spark)


QUERIES["inc1_null_and_tied_marks"] = inc1_null_and_tied_marks
SQL["inc1_null_and_tied_marks"] = f"""
with o as (select * replace (
  case when o_custkey % 7 <> 0 then date_trunc('month', o_orderdate)::timestamp end as o_orderdate) from orders),
f as (select * from o where o_orderkey % 2 = 0
  and coalesce(o_orderdate <= date_trunc('month', {MARK}::timestamp), o_custkey % 14 = 0))
select * from f where o_orderdate < (select max(o_orderdate) from f)
union all select * from o where o_orderdate is null or o_orderdate >= (select max(o_orderdate) from f)"""


def inc1_stream(spark, sf):
    """The same with the changes arriving as a file stream."""
    orders = table(spark, sf, "orders")
    log = ChangeLog(workspace(spark, "orders_stream"), ("o_orderkey",))
    log.load(spark, orders.where(F.col("o_orderdate") < _mark()))
    stream = read_stream(spark, folder(sf), "orders")
    changes = stream.where("o_orderstatus <> 'F'").withColumn("o_orderpriority", F.lit("streamed"))
    log.follow(changes, workspace(spark, "orders_stream_checkpoint"))
    return log.current(spark)


QUERIES["inc1_stream_upsert"] = inc1_stream
SQL["inc1_stream_upsert"] = f"""
select * from orders where o_orderstatus = 'F' and o_orderdate < {MARK}
union all select * replace ('streamed' as o_orderpriority) from orders where o_orderstatus <> 'F'"""


def inc2_first_load(spark, sf):
    """Run the same load twice: the first finds no table and takes all, the second what is newer."""
    orders, target = table(spark, sf, "orders"), _place(spark, "first_load")
    for source in (orders.where(F.col("o_orderdate") < _mark()), orders):
        first = not table_exists(spark, target, "orders")
        rows = source if first else since(source, "o_orderdate", read_table(spark, target, "orders"), inclusive=False)
        write_table(rows, target, "orders", create_table=first)
    return read_table(spark, target, "orders")


QUERIES["inc2_first_load"] = inc2_first_load
SQL["inc2_first_load"] = "select * from orders"


def inc1_incremental_transfer(spark, sf):
    """Events moved up to a day, then the rest; rows at the mark are taken again and replaced."""
    events, source, target = table(spark, sf, "events"), _place(spark, "growing"), _place(spark, "grown")
    cut = F.lit("2024-01-12 00:00:00").cast("timestamp_ntz")
    write_table(events.where(F.col("ts") < cut), source, "events", create_table=True)
    incremental_transfer(spark, source, target, "events", ["event_id"], "ts")
    write_table(events.where(F.col("ts") >= cut), source, "events")
    return incremental_transfer(spark, source, target, "events", ["event_id"], "ts")


QUERIES["inc1_incremental_transfer"] = inc1_incremental_transfer
SQL["inc1_incremental_transfer"] = "select * from events"

# --- TRF -------------------------------------------------------------------------------------------------


def _table_transfer(target):
    def run(spark, sf):
        moved = transfer(
            spark, folder(sf), Endpoint(target), "orders", "sales", table="orders",
            load_path=workspace(spark, f"transfer_{target}"), client_folder="/load",
        )
        return moved.rows

    return run


for _target in ("postgresql", "mssql", "mysql", "oracle", "snowflake"):
    QUERIES[f"trf1_table_transfer_{_target}"] = _table_transfer(_target)
    SQL[f"trf1_table_transfer_{_target}"] = "select * from orders"


def trf1_to_table(spark, sf):
    """Source table to target table, without files in between."""
    target = _place(spark, "transfer_table")
    return transfer(
        spark, folder(sf), target, "lineitem", "sales", table="lineitem", create_table=True
    ).rows


QUERIES["trf1_table_to_table"] = trf1_to_table
SQL["trf1_table_to_table"] = "select * from lineitem"

REVENUE = (
    "select l_suppkey, count(*) as n, min(l_shipdate) as first_day, "
    "cast(sum(cast(l_extendedprice as decimal(14,2))) as decimal(38,2)) as revenue "
    "from lineitem where l_returnflag <> 'R' group by l_suppkey"
)


def trf2_query_transfer(spark, sf):
    moved = transfer(
        spark, folder(sf, "mysql"), Endpoint("mssql"), "revenue", "sales", query=REVENUE,
        query_tables=["lineitem"], load_path=workspace(spark, "transfer_query"), client_folder="/load",
    )
    return moved.rows.withColumn("revenue", F.col("revenue").cast("string"))


QUERIES["trf2_query_transfer"] = trf2_query_transfer
SQL["trf2_query_transfer"] = REVENUE.replace("as decimal(38,2))", "as decimal(38,2))::varchar")


EQUAL_NAMES = (
    "select o.o_orderkey, c.c_custkey as o_orderkey, o.o_orderstatus as status, c.c_mktsegment as Status, "
    "c.c_acctbal as status_2 from orders o join customer c on c.c_custkey = o.o_custkey"
)


def trf2_equal_names(spark, sf):
    """A query whose columns share names: they are moved by position, the later ones under a number."""
    return transfer(
        spark, folder(sf), Endpoint("mysql"), "pairs", "sales", query=EQUAL_NAMES, query_tables=["orders", "customer"],
        load_path=workspace(spark, "transfer_equal_names"), client_folder="/load",
    ).rows


QUERIES["trf2_equal_names"] = trf2_equal_names
SQL["trf2_equal_names"] = """
select o_orderkey, c_custkey as o_orderkey_2, o_orderstatus as status, c_mktsegment as "Status_3", c_acctbal as status_2
from orders join customer on c_custkey = o_custkey"""


# Every default token, alone and inside a text, and one of those looked for.
TOKENS = ("{nll}", "NULL", "{dlm}", "{nwln}", "{k000}", "a{k001}{k002}")


def _tokens_in_values(target):
    """Rows that hold every default token arrive whole: others are found."""

    def run(spark, sf):
        source, o = _place(spark, "tokens"), table(spark, sf, "orders")
        tokens = F.array(*[F.lit(t) for t in TOKENS])
        token = F.element_at(tokens, (F.col("o_custkey") % len(TOKENS) + 1).cast("int"))
        rows = o.select(
            "o_orderkey",
            F.when(F.col("o_orderstatus") != "P", token).alias("token"),
            F.concat("o_orderpriority", token, F.lit(",\"")).alias("note"),
        )
        write_table(rows, source, "tokens", create_table=True)
        return transfer(
            spark, source, Endpoint(target), "tokens", "sales", table="tokens", find_tokens=True,
            load_path=workspace(spark, f"tokens_{target}"), client_folder="/load",
        ).rows

    return run


for _target in ("postgresql", "mssql", "mysql", "oracle", "snowflake"):
    QUERIES[f"snk5_tokens_in_values_{_target}"] = _tokens_in_values(_target)
    SQL[f"snk5_tokens_in_values_{_target}"] = f"""
with o as (select *, {list(TOKENS)}[o_custkey % {len(TOKENS)} + 1] as t from orders)
select o_orderkey, case when o_orderstatus <> 'P' then t end as token, o_orderpriority || t || ',"' as note from o"""


def trf1_measured(spark, sf):
    """Numbers without a size and texts without a length get those of their values, and with them can be keys."""
    o = table(spark, sf, "orders").select(
        F.col("o_totalprice").cast("decimal(20,4)").cast("string").alias("price"), "o_orderpriority",
        F.col("o_orderkey").cast("string").alias("no"),
    )
    rows = sized_by_values(tag(o, {"price": "decimal", "no": "decimal"}, keys=["no", "o_orderpriority"]))
    made = [
        ddl(translate(describe(rows, "sales", "o"), None, t), t, incremental=True).select(F.lit(t).alias("target"), "statement", "refused")
        for t in ("postgresql", "mssql", "mysql", "oracle", "snowflake")
    ]
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out


QUERIES["trf1_measured_types"] = trf1_measured
SQL["trf1_measured_types"] = """
with m as (
  select max(length(floor(o_totalprice::decimal(20,4))::bigint::varchar)) as whole,
    max(length(rtrim(split_part(o_totalprice::decimal(20,4)::varchar, '.', 2), '0'))) as part,
    max(length(o_orderkey::varchar)) as digits, max(length(o_orderpriority)) as chars from orders),
t as (select *, '(' || (whole + part) || ',' || part || ')' as ps, '(' || digits || ',0)' as no from m),
s as (
  select 'postgresql' as target, 'create table if not exists sales.o (price decimal' || ps || ', o_orderpriority text, no decimal'
    || no || ', primary key (o_orderpriority,no))' as statement from t
  union all select 'snowflake', 'create table if not exists sales.o (price number' || ps || ', o_orderpriority text, no number'
    || no || ', primary key (o_orderpriority,no))' from t
  union all select 'mysql', 'create table if not exists `o` (`price` decimal' || ps || ', `o_orderpriority` varchar(' || chars
    || '), `no` decimal' || no || ', primary key (`o_orderpriority`,`no`))' from t
  union all select 'mssql', 'if object_id(''sales.o'', ''U'') is null create table sales.o (price decimal' || ps
    || ', o_orderpriority nvarchar(' || 2 * chars || '), no decimal' || no || ', primary key (o_orderpriority,no))' from t
  union all select 'oracle', 'begin execute immediate ''create table sales.o (price decimal' || replace(ps, ',', ', ')
    || ', o_orderpriority varchar2(' || 4 * chars || '), no decimal' || replace(no, ',', ', ')
    || ', primary key (o_orderpriority,no))''; exception when others then if sqlcode != -955 then raise; end if; end;' from t)
select target, statement, null::varchar as refused from s"""


def agg1_value_profile(spark, sf):
    events = table(spark, sf, "events")
    rows = tag(events.withColumn("value", F.col("value").cast("decimal(18,6)").cast("string")), {"value": "decimal"})
    return value_profile(rows)


QUERIES["agg1_value_profile"] = agg1_value_profile
SQL["agg1_value_profile"] = r"""
with e as (select *, value::decimal(18,6)::varchar as v from events)
select 'event_id' as column_name, 1 as ordinal, 'int64' as canonical_type, count(*) filter (where event_id is null) as nulls,
  null::int as integer_digits, null::int as fraction_digits, null::int as characters, null::int as bytes from e
union all select 'ts', 2, 'datetime', count(*) filter (where ts is null), null, null, null, null from e
union all select 'user_id', 3, 'int64', count(*) filter (where user_id is null), null, null, null, null from e
union all select 'event_type', 4, 'ntext', count(*) filter (where event_type is null), null, null,
  max(length(event_type))::int, max(strlen(event_type))::int from e
union all select 'value', 5, 'decimal', count(*) filter (where v is null),
  max(length(regexp_extract(v, '^[+-]?0*([0-9]*)', 1)))::int, max(length(rtrim(split_part(v, '.', 2), '0')))::int, null, null from e
union all select 'props', 6, 'ntext', count(*) filter (where props is null), null, null,
  max(length(props))::int, max(strlen(props))::int from e"""
