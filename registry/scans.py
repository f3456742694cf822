"""SRC-1, SRC-2, SRC-8, SRC-9: table scans, query scans, staged files read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.tables import folder, in_few_tasks, table
from transferkit import (
    column_infos, read_keys, read_query, read_staged, tag, write_keys, write_staged,
)
from transferkit.session import stored_bytes, workspace

QUERIES: dict = {}
SQL: dict[str, str] = {}

QUERIES["src1_table_scan"] = lambda spark, sf: table(spark, sf, "orders")
SQL["src1_table_scan"] = "select * from orders"


def src1_pruned_scan(spark, sf):
    """Columns and filters chosen on a table scan reach the files."""
    line = table(spark, sf, "lineitem")
    return line.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_extendedprice"
    )


QUERIES["src1_pruned_scan"] = src1_pruned_scan
SQL["src1_pruned_scan"] = (
    "select l_orderkey, l_extendedprice from lineitem where l_shipdate >= timestamp '1998-01-01'"
)

# The caller's SQL goes to the source unchanged, so the same text is the expected result.
USER_SQL = {
    "filter": (
        ["orders"],
        "select o_orderkey, o_totalprice from orders "
        "where o_orderstatus = 'P' and o_totalprice between 50000 and 250000",
    ),
    "join": (
        ["orders", "customer", "nation"],
        "select n.n_name, c.c_custkey, o.n_orders, o.biggest from "
        "(select o_custkey, count(*) as n_orders, max(o_totalprice) as biggest from orders group by o_custkey) o "
        "join customer c on c.c_custkey = o.o_custkey join nation n on n.n_nationkey = c.c_nationkey",
    ),
    "agg": (
        ["lineitem"],
        "select l_returnflag, l_linestatus, count(*) as n, "
        "cast(sum(cast(l_quantity as bigint)) as bigint) as quantity, "
        "min(l_discount) as low, max(l_extendedprice) as high, count(distinct l_suppkey) as suppliers "
        "from lineitem where l_shipdate <= timestamp '2000-09-02 00:00:00' group by l_returnflag, l_linestatus",
    ),
    "window": (
        ["orders"],
        "select o_custkey, o_orderkey, o_totalprice, cast(place as bigint) as place from (select o_custkey, o_orderkey, o_totalprice, "
        "row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as place "
        "from orders) t where place <= 3",
    ),
    "setop": (
        ["customer", "orders"],
        "select c_custkey as custkey from customer except select o_custkey from orders group by o_custkey "
        "union all select o_custkey from (select o_custkey from orders where o_orderpriority = '1-URGENT' "
        "group by o_custkey intersect select c_custkey from customer where c_acctbal < 0) t",
    ),
    "topk": (
        ["lineitem"],
        "select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem "
        "order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey limit 100",
    ),
    "subquery": (
        ["orders", "lineitem"],
        "select o_orderkey, o_orderdate from orders where o_orderstatus = 'F' and o_orderkey in "
        "(select l_orderkey from lineitem group by l_orderkey having sum(cast(l_quantity as bigint)) > 150)",
    ),
}


def _user_query(names, text):
    return lambda spark, sf: read_query(spark, folder(sf), text, names)


for _case, (_names, _text) in USER_SQL.items():
    QUERIES[f"src2_query_scan_{_case}"] = _user_query(_names, _text)
    SQL[f"src2_query_scan_{_case}"] = _text


def _roundtrip(name):
    def run(spark, sf):
        rows = table(spark, sf, name)
        path = workspace(spark, f"staged_{name}")
        infos = write_staged(rows, path)
        return read_staged(spark, path, infos, typed=True)

    return run


for _t in ("documents", "pages", "conversations", "orders"):
    QUERIES[f"src8_staged_roundtrip_{_t}"] = _roundtrip(_t)
    SQL[f"src8_staged_roundtrip_{_t}"] = f"select * from {_t}"


SPLIT_BYTES, SPLITS = 20_000, 256


def _split_roundtrip(name):
    """One file, or few of a large table, read by many tasks: records go over line ends and over the ends of splits.

    Splits have ``SPLIT_BYTES``, and grow with the files beyond ``SPLITS`` of them, up to what the session gives a task.
    """

    def run(spark, sf):
        path, read = workspace(spark, f"one_file_{name}"), workspace(spark, f"one_file_{name}_rows")
        infos = write_staged(in_few_tasks(spark, sf, name), path)
        most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        split = max(SPLIT_BYTES, min(most, stored_bytes(spark, path) // SPLITS))
        small = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}
        before = {k: spark.conf.get(k) for k in small}
        for k, v in small.items():
            spark.conf.set(k, v)
        try:
            rows = read_staged(spark, path, infos, typed=True, split=True)
            rows.write.parquet(read)
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        return spark.read.schema(rows.schema).parquet(read)

    return run


for _t in ("documents", "pages"):
    QUERIES[f"src8_split_file_{_t}"] = _split_roundtrip(_t)
    SQL[f"src8_split_file_{_t}"] = f"select * from {_t}"


def src8_empty_and_null(spark, sf):
    """Empty text and NULL stay different through a staged file, also in a one-column table."""
    note = F.when(F.col("o_orderstatus") == "F", F.lit("")).when(
        F.col("o_orderstatus") == "O", F.col("o_orderpriority")
    )
    rows = table(spark, sf, "orders").select(note.alias("note"))
    path = workspace(spark, "staged_one_column")
    infos = write_staged(rows, path)
    back = read_staged(spark, path, infos, typed=True)
    return back.groupBy("note").agg(F.count("*").alias("n"))


QUERIES["src8_empty_and_null"] = src8_empty_and_null
SQL["src8_empty_and_null"] = """
select case o_orderstatus when 'F' then '' when 'O' then o_orderpriority end as note, count(*) as n
from orders group by 1"""


def src9_key_file(spark, sf):
    rows = tag(table(spark, sf, "conversations"), keys=["conv_id", "turn"])
    path = workspace(spark, "keys")
    write_keys(rows, path)
    return read_keys(spark, path, column_infos(rows))


QUERIES["src9_key_file"] = src9_key_file
SQL["src9_key_file"] = "select conv_id, turn from conversations"
