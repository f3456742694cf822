"""PRJ-2, PRJ-3, SNK-1 to SNK-9 and TRF-3: load text, literals and load files of the five targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.tables import DASHED, TEXT_OF, TYPES, WALL, every_type, in_few_tasks, select_sql, table
from registry.vendors import NULL_TOKENS, VENDORS
from transferkit import (
    Endpoint, column_infos, control_text, read_load, read_staged, tag, to_literals, to_load, transfer,
    write_keys, write_load, write_staged,
)
from transferkit.operators.project import load_columns
from transferkit.session import few_listing_tasks, workspace
from transferkit.sinks.files import NEWLINE, data_files

QUERIES: dict = {}
SQL: dict[str, str] = {}

SIX = {"f64": "printf('%.6f', f64)", "f32": "printf('%.6f', f32::double)"}
BARE = {"uid": "digest"}
DIGIT = {"ok": "ok::int::varchar"}
NUL = {c: f"case when {c} = '' then chr(0) else {c} end" for c in ("code", "kind", "note", "memo")}
LOAD = {
    "postgresql": {"raw": r"'\x'||raw", "bytes": r"'\x'||bytes"},
    "mssql": {**WALL, **DIGIT, **NUL},
    "mysql": WALL,
    "oracle": {**WALL, "seen": WALL["seen"] + "||' +00:00'", **BARE, **DIGIT},
    "snowflake": BARE,
}
LOAD_EXACT = {
    "postgresql": {},
    "mssql": {"seen": WALL["seen"] + "||' +00:00'"},
    "mysql": {**BARE, **DIGIT},
    "oracle": {},
    "snowflake": {},
}


def load_exprs(target: str, compat: bool) -> dict[str, str]:
    exprs = {**TEXT_OF, **LOAD[target]}
    return {**exprs, **SIX} if compat else {**exprs, **LOAD_EXACT[target]}


def _load(target, compat):
    return lambda spark, sf: to_load(every_type(spark, sf), target, compat=compat)


def quote(e: str, backslash: bool = False) -> str:
    if backslash:
        e = f"replace({e}, '\\', '\\\\')"
    return f"''''||replace({e}, '''', '''''')||''''"


def call(before: str, e: str, after: str) -> str:
    return f"'{before}'||{e}||'{after}'"


TEXTS = ("code", "kind", "note", "memo", "doc", "tree")
Q = "''"


def literal_exprs(target: str, compat: bool) -> dict[str, str]:
    slash = target in ("mysql", "snowflake") and not compat
    out = {**TEXT_OF, **{c: quote(c, slash) for c in TEXTS}}
    at, seen = WALL["at"], WALL["seen"]
    out.update(at=call(Q, at, Q), seen=call(Q, seen, Q), day=call(Q, "day", Q), clock=call(Q, "clock", Q))
    if compat:
        out.update(SIX)
    if target == "oracle":
        stamp = "'', ''YYYY-MM-DD HH24:MI:SS.FF6''"
        out.update(
            at=call("TO_TIMESTAMP(''", at, stamp + ")"),
            seen=call("TO_TIMESTAMP(''", seen, stamp + ")")
            if compat
            else call("TO_TIMESTAMP_TZ(''", seen + "||' +00:00'", stamp[:-2] + " TZH:TZM'')"),
            day=call("TO_DATE(''", "day", "'', ''YYYY-MM-DD'')"),
            ok="ok::int::varchar",
        )
    elif not compat:
        zone = {"postgresql": "||'+00'", "mssql": "||' +00:00'", "snowflake": "||' +00:00'"}.get(target, "")
        out["seen"] = call(Q, seen + zone, Q)
    if compat and target == "postgresql":
        out["day"] = call(Q, "day||' 00:00:00'", Q)
        out["clock"] = call(Q, "'0000-01-01 '||clock", Q)
    if target == "mssql" and not compat:
        out["ok"] = "ok::int::varchar"
    forms = {
        "postgresql": (r"\x", "") if compat else (r"''\x", Q),
        "mssql": ("0x", ""),
        "mysql": ("UNHEX(''", "'')"),
        "oracle": ("HEXTORAW(''", "'')"),
        "snowflake": ("0x", "") if compat else ("X''", Q),
    }
    before, after = forms[target]
    out["raw"] = call(before, "raw", after)
    out["bytes"] = call(before, "bytes", Q if compat and target == "mysql" else after)
    if not compat:
        by_bytes = target in ("mysql", "oracle", "snowflake")
        out["uid"] = call(before, "digest", after) if by_bytes else call(Q, DASHED, Q)
        out["bits"] = call("B''" if target == "postgresql" else Q, "bits", Q)
    return out


def _literal(target, compat):
    return lambda spark, sf: to_literals(every_type(spark, sf), target, compat=compat)


for _target in VENDORS:
    for _compat, _suffix in ((True, ""), (False, "_exact")):
        QUERIES[f"prj2_load_text_{_target}{_suffix}"] = _load(_target, _compat)
        SQL[f"prj2_load_text_{_target}{_suffix}"] = select_sql(load_exprs(_target, _compat))
        QUERIES[f"prj3_literal_{_target}{_suffix}"] = _literal(_target, _compat)
        _lits = {c: f"coalesce({e}, 'null')" for c, e in literal_exprs(_target, _compat).items()}
        SQL[f"prj3_literal_{_target}{_suffix}"] = select_sql(_lits)


# --- files -------------------------------------------------------------------------------------------


def _customer_rows(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        F.concat(F.lit('the "'), F.col("c_name"), F.lit('", ltd')).alias("c_name"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
    )


CUSTOMER_LINE = (
    "c_custkey||',\"the \"\"'||c_name||'\"\", ltd\",'||coalesce(nullif(c_mktsegment, 'BUILDING'), '{null}')"
    "||','||c_acctbal::decimal(12,2)"
)


def snk1_staged_csv(spark, sf):
    path = workspace(spark, "staged_customer")
    write_staged(_customer_rows(spark, sf), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


QUERIES["snk1_staged_csv"] = snk1_staged_csv
SQL["snk1_staged_csv"] = "select " + CUSTOMER_LINE.replace("{null}", "{nll}") + " as line from customer"

FILE_BYTES = 200_000


def snk2_file_roll(spark, sf):
    """No staged file is longer than asked for, there are many, and no row is lost."""
    path = workspace(spark, "rolled_documents")
    rows = table(spark, sf, "documents").select("doc_id", "text")
    infos = write_staged(rows, path, target_file_bytes=FILE_BYTES)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    rolled = files.agg(
        F.sum("length").cast("long").alias("bytes"),
        (F.max("length") <= FILE_BYTES).alias("bounded"),
        (F.count("*") >= F.sum("length") / FILE_BYTES).alias("rolled"),
    )
    return rolled.crossJoin(read_staged(spark, path, infos).agg(F.count("*").alias("n")))


QUERIES["snk2_file_roll"] = snk2_file_roll
SQL["snk2_file_roll"] = r"""
select count(*) as n, sum(strlen(doc_id::varchar) + 2 + strlen(
  case when text is null then '{nll}' when regexp_matches(text, '[",\r\n]|^[ \t]|[ \t]$|^$|^\\\.$')
  then '"' || replace(text, '"', '""') || '"' else text end))::bigint as bytes, true as bounded, true as rolled
from documents"""


def snk2_filled_files(spark, sf):
    """Files are filled to four fifths on average, though a row of a third of a file stands among short ones."""
    path = workspace(spark, "filled_documents")
    text = F.when(F.col("doc_id") % 200 == 7, F.repeat(F.lit("long "), FILE_BYTES // 15)).otherwise(F.col("text"))
    rows = in_few_tasks(spark, sf, "documents").select("doc_id", text.alias("text"))
    write_staged(rows, path, target_file_bytes=FILE_BYTES)
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    return files.agg(
        F.sum("length").cast("long").alias("bytes"),
        (F.max("length") <= FILE_BYTES).alias("bounded"),
        (F.avg("length") >= 0.8 * FILE_BYTES).alias("filled"),
    )


QUERIES["snk2_filled_files"] = snk2_filled_files
SQL["snk2_filled_files"] = rf"""
with d as (
  select doc_id, case when doc_id % 200 = 7 then repeat('long ', {FILE_BYTES // 15}) else text end as text from documents)
select sum(strlen(doc_id::varchar) + 2 + strlen(
  case when text is null then '{{nll}}' when regexp_matches(text, '[",\r\n]|^[ \t]|[ \t]$|^$|^\\\.$')
  then '"' || replace(text, '"', '""') || '"' else text end))::bigint as bytes, true as bounded, true as filled
from d"""


def snk3_key_file(spark, sf):
    path = workspace(spark, "key_file")
    write_keys(tag(table(spark, sf, "orders"), keys=["o_orderkey", "o_orderdate"]), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


QUERIES["snk3_key_file"] = snk3_key_file
SQL["snk3_key_file"] = (
    "select o_orderkey||','||strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as line from orders"
)


def _load_lines(target):
    def run(spark, sf):
        path = workspace(spark, f"load_{target}")
        write_load(_customer_rows(spark, sf), path, target)
        return spark.read.text(path).withColumnRenamed("value", "line")

    return run


for _id, _target in (("snk5", "postgresql"), ("snk6", "mysql"), ("snk8", "oracle"), ("snk9", "snowflake")):
    _name = f"{_id}_load_csv_{_target}"
    QUERIES[_name] = _load_lines(_target)
    SQL[_name] = f"select {CUSTOMER_LINE.replace('{null}', NULL_TOKENS[_target])} as line from customer"


def snk7_multichar_text(spark, sf):
    path = workspace(spark, "load_mssql")
    write_load(_customer_rows(spark, sf), path, "mssql")
    lines = spark.read.option("lineSep", "{nwln}").text(path)
    return lines.withColumnRenamed("value", "line")


QUERIES["snk7_multichar_text_mssql"] = snk7_multichar_text
SQL["snk7_multichar_text_mssql"] = """
select c_custkey||'{dlm}the "'||c_name||'", ltd{dlm}'||coalesce(nullif(c_mktsegment, 'BUILDING'), '')
  ||'{dlm}'||c_acctbal::decimal(12,2) as line
from customer"""


def snk8_control_text(spark, sf):
    o = table(spark, sf, "orders").withColumn("order", F.nullif("o_orderstatus", F.lit("P")))
    return control_text(o, "my orders", "sales")


_CONTROL_SIZES = {
    "o_orderkey": "o_orderkey::varchar", "o_custkey": "o_custkey::varchar", "o_orderstatus": "o_orderstatus",
    "o_totalprice": "o_totalprice::varchar", "o_orderpriority": "o_orderpriority",
    '"order"': "coalesce(nullif(o_orderstatus, 'P'), '{nll}')",
}


_TOKEN = "''{nll}''"  # inside a literal


def _control_sql() -> str:
    fields = [
        f"'{c} char(' || (max(strlen({value})) + 5) || ') preserve blanks nullif {c} = {_TOKEN}'"
        for c, value in _CONTROL_SIZES.items()
    ]
    fields.insert(4, "'o_orderdate timestamp ''YYYY-MM-DD HH24:MI:SS.FF'' nullif o_orderdate = " + _TOKEN + "'")
    head = ["load data", "characterset al32utf8", 'append into table sales."my orders"', "fields csv with embedded", "("]
    lines = ", ".join(f"'{line}', chr(10)" for line in head)
    return f"select concat({lines}, '  ', concat_ws(',' || chr(10) || '  ', {', '.join(fields)}), chr(10), ')') as control from orders"


QUERIES["snk8_control_text_oracle"] = snk8_control_text
SQL["snk8_control_text_oracle"] = _control_sql()

COMMAND_FILE_BYTES = 20_000
# Behind each slash a folder and a name in it, as Spark writes them: without blanks, quotes and slashes.
COMMAND_PLACE = r"/(?=([^/\s']+/[^/\s']+))"


def _load_commands(target):
    """A transfer into several files: rows of all files, and how many commands name each."""

    def run(spark, sf):
        path = workspace(spark, f"commands_{target}")
        moved = transfer(
            spark, Endpoint("postgresql", path=sf), Endpoint(target), "orders", "sales", table="orders",
            load_path=path, target_file_bytes=COMMAND_FILE_BYTES, client_folder="/load",
        )
        with few_listing_tasks(spark):
            lines = spark.read.option("lineSep", NEWLINE if target == "mssql" else "\n").text(path)
        rows = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
        rows = rows.select(F.substring_index("path", "/", -2).alias("file"), "n")
        named = spark.createDataFrame([(f,) for f in data_files(spark, path)], "file string")
        commands = spark.createDataFrame([(c,) for c in moved.commands], "command string")
        # every folder and name in a command once, so that files and commands meet by equality
        places = F.array_distinct(F.regexp_extract_all("command", F.lit(COMMAND_PLACE), F.lit(1)))
        commands = commands.select("command", F.explode(places).alias("file"))
        found = named.join(rows, "file", "left").join(commands, "file", "left")
        found = found.groupBy("file").agg(F.first("n").alias("n"), F.count("command").alias("commands"))
        return found.agg(
            F.sum("n").alias("n"), F.min("commands").alias("least"), F.max("commands").alias("most"),
            (F.count("*") > 1).alias("several"), (F.min("n") > 0).alias("all_hold_rows"),
        )

    return run


for _target in VENDORS:
    QUERIES[f"snk5_load_commands_{_target}"] = _load_commands(_target)
    _each = 2 if _target == "snowflake" else 1
    SQL[f"snk5_load_commands_{_target}"] = (
        f"select count(*) as n, {_each} as least, {_each} as most, true as several, true as all_hold_rows from orders"
    )


def _load_roundtrip(target):
    def run(spark, sf):
        rows = every_type(spark, sf)
        path = workspace(spark, f"load_every_type_{target}")
        token = NULL_TOKENS[target]
        write_load(rows, path, target)
        back = read_load(spark, path, target, column_infos(rows), token)
        return to_load(back, target)

    return run


for _target in VENDORS:
    QUERIES[f"snk4_load_file_roundtrip_{_target}"] = _load_roundtrip(_target)
    SQL[f"snk4_load_file_roundtrip_{_target}"] = select_sql(load_exprs(_target, False))


# --- every route -------------------------------------------------------------------------------------


def _routes(source):
    """Rows of one source as load text of every target, joined to a line."""

    def run(spark, sf):
        rows = every_type(spark, sf, source if source in ("mssql", "mysql") else None)
        out = []
        for target in VENDORS:
            # one projection per target keeps each compiled method small enough for the JIT
            text = load_columns(rows, target, "{nll}", source=source)
            line = F.md5(F.concat_ws("|", *text.values()))
            out.append(rows.select(text["event_id"], F.lit(target).alias("target"), line.alias("line")))
        return reduce(DataFrame.unionAll, out)

    return run


def _routes_sql(source):
    from registry.values import GUID

    parts = []
    for target in VENDORS:
        exprs = load_exprs(target, False)
        if source == "mssql":
            exprs["uid"] = f"replace({GUID}, '-', '')" if exprs["uid"] == "digest" else GUID
        if source == "mysql":
            exprs["bits"] = "bin(pair)"
        line = "||'|'||".join(f"coalesce({exprs[c]}, '{{nll}}')" for c in TYPES)
        parts.append(f"select event_id::varchar as event_id, '{target}' as target, md5({line}) as line from typed")
    return select_sql({"x": "1"}).rsplit("select", 1)[0] + " union all ".join(parts)


for _source in VENDORS:
    QUERIES[f"trf3_routes_from_{_source}"] = _routes(_source)
    SQL[f"trf3_routes_from_{_source}"] = _routes_sql(_source)
