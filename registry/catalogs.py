"""CAT-2 to CAT-13: schema discovery and type translation over a large catalog.

The catalog is derived from ``orders``: every order is a column, every 24 orders are a table, and the
order's other values choose the column's type, sizes and name.  It grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.tables import table
from registry.vendors import QUOTES, VENDORS, reserved_words, type_pairs
from transferkit import ddl, describe, max_byte_length, primary_keys, translate
from transferkit.functions.identifiers import is_reserved, qualified, quoted
from transferkit.operators import catalog

QUERIES: dict = {}
SQL: dict[str, str] = {}


def type_names(system: str, path: str, compat: bool) -> list[str]:
    return [name for name, _ in type_pairs(system, path, compat)]


def _pick(names: list[str], index):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index % len(names) + 1).cast("int"))


def _column_rows(spark, sf, data_type):
    k, slot = F.col("o_orderkey"), F.col("o_orderkey") % 24
    name = (
        F.when(F.col("o_orderstatus") == "F", F.lit("Order"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("Col_"), slot.cast("string")))
        .otherwise(F.concat("o_orderpriority", F.lit("]\""), slot.cast("string")))
    )
    return table(spark, sf, "orders").select(
        F.lit("sales").alias("table_schema"),
        F.concat(F.lit("big table "), F.expr("o_orderkey div 24").cast("string")).alias("table_name"),
        name.alias("column_name"),
        (slot + 1).cast("int").alias("ordinal"),
        data_type.alias("data_type"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 45).cast("int").alias("precision"),
        F.when(F.col("o_orderstatus") != "P", k % 12).cast("int").alias("scale"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") * 7 % 5000 + 1).cast("int").alias("length"),
        (slot < 2).alias("is_primary"),
    )


def column_rows(spark, sf, system, path="table", compat=False):
    return _column_rows(spark, sf, _pick(type_names(system, path, compat), F.col("o_custkey")))


def _list(names: list[str]) -> str:
    return "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + "]"


def rows_sql(data_type: str) -> str:
    return f"""rows as (
  select 'sales' as table_schema, 'big table ' || (o_orderkey // 24) as table_name,
    case o_orderstatus when 'F' then 'Order' when 'O' then 'Col_' || (o_orderkey % 24)
      else o_orderpriority || ']"' || (o_orderkey % 24) end as column_name,
    (o_orderkey % 24 + 1)::int as ordinal, {data_type} as data_type,
    coalesce(case when o_orderstatus <> 'P' then o_custkey % 45 end, -1)::int as precision,
    coalesce(case when o_orderstatus <> 'P' then o_orderkey % 12 end, -1)::int as scale,
    coalesce(case when o_orderpriority <> '5-LOW' then o_custkey * 7 % 5000 + 1 end, -1)::int as length,
    o_orderkey % 24 < 2 as is_primary
  from orders)"""


def names_sql(names: list[str]) -> str:
    return f"{_list(names)}[o_custkey % {len(names)} + 1]"


# --- CAT-2, CAT-3, CAT-9: keys and sizes --------------------------------------------------------------

_PG = type_names("postgresql", "table", True)


def cat2_columns_and_keys(spark, sf):
    rows = column_rows(spark, sf, "postgresql", compat=True)
    found = rows.where("is_primary").select("table_schema", "table_name", "column_name")
    other = found.withColumn("table_schema", F.lit("archive"))  # same names in another schema
    out = catalog.with_keys(rows.drop("is_primary"), found.unionAll(other))
    return out.select("table_name", "column_name", "ordinal", "data_type", "is_primary")


QUERIES["cat2_columns_and_keys"] = cat2_columns_and_keys
SQL["cat2_columns_and_keys"] = f"""
with {rows_sql(names_sql(_PG))}, keys as (select distinct table_name, column_name from rows where is_primary)
select r.table_name, r.column_name, r.ordinal, r.data_type, k.table_name is not null as is_primary
from rows r left join keys k on k.table_name = r.table_name and k.column_name = r.column_name"""


def cat3_sizes(spark, sf):
    return catalog.with_sizes(column_rows(spark, sf, "mysql")).select(
        "table_name", "ordinal", "precision", "scale", "length", "has_decimal_size", "has_length"
    )


QUERIES["cat3_missing_sizes"] = cat3_sizes
SQL["cat3_missing_sizes"] = f"""
with {rows_sql("''")}
select table_name, ordinal, precision, scale, length, precision > 0 or scale > 0 as has_decimal_size,
  length > 0 as has_length
from rows"""

_ORACLE_RAW = [
    "TIMESTAMP(6)", "TIMESTAMP(9) WITH TIME ZONE", "TIMESTAMP(3) WITH LOCAL TIME ZONE",
    "INTERVAL DAY(2) TO SECOND(6)", "INTERVAL YEAR(4) TO MONTH", "NUMBER", "VARCHAR2", "DATE",
]
_ORACLE_CLEAN = [
    "TIMESTAMP", "TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITH LOCAL TIME ZONE", "INTERVAL", "INTERVAL",
    "NUMBER", "VARCHAR2", "DATE",
]
QUERIES["cat4_oracle_type_names"] = lambda spark, sf: _column_rows(
    spark, sf, _pick(_ORACLE_RAW, F.col("o_custkey"))
).select("table_name", "ordinal", "data_type", catalog.clean_type_name(F.col("data_type"), "oracle").alias("clean"))
SQL["cat4_oracle_type_names"] = f"""
select 'big table ' || (o_orderkey // 24) as table_name, (o_orderkey % 24 + 1)::int as ordinal,
  {names_sql(_ORACLE_RAW)} as data_type, {names_sql(_ORACLE_CLEAN)} as clean
from orders"""

# --- CAT-5, CAT-6: type names to canonical types --------------------------------------------------------


def _canonical_types(path, compat):
    def run(spark, sf):
        names = list(VENDORS)
        system = _pick(names, F.col("o_orderkey"))
        typed = F.lit(None).cast("string")
        for s in names:
            typed = F.when(system == s, _pick(type_names(s, path, compat), F.col("o_custkey"))).otherwise(typed)
        orders = table(spark, sf, "orders")
        rows = orders.select("o_orderkey", system.alias("system"), typed.alias("data_type"))
        out = catalog.with_canonical_types(rows, None, path, compat)
        return out.select("o_orderkey", "system", "data_type", "canonical_type")

    return run


def _canonical_sql(path, compat):
    names = list(VENDORS)
    pick = " ".join(
        f"when '{s}' then {names_sql(type_names(s, path, compat))}" for s in names
    )
    pairs = [(s, n, c) for s in names for n, c in type_pairs(s, path, compat)]
    values = ", ".join(f"('{s}', '{n}', '{c}')" for s, n, c in pairs)
    return f"""
with o as (select o_orderkey, o_custkey, {_list(names)}[o_orderkey % {len(names)} + 1] as system from orders),
t as (select o_orderkey, system, case system {pick} end as data_type from o),
m(system, data_type, canonical_type) as (values {values})
select t.o_orderkey, t.system, t.data_type, m.canonical_type
from t join m on m.system = t.system and m.data_type = t.data_type"""


for _id, _path in (("cat5_catalog", "table"), ("cat6_result", "query")):
    for _compat, _suffix in ((True, ""), (False, "_exact")):
        QUERIES[f"{_id}_types{_suffix}"] = _canonical_types(_path, _compat)
        SQL[f"{_id}_types{_suffix}"] = _canonical_sql(_path, _compat)

# --- CAT-7: canonical types to column types -------------------------------------------------------------

CANONICAL = (
    "nvarchar varchar ntext text int64 int32 int16 float64 float32 decimal money datetime datetimetz date "
    "time varbinary blob uuid bool json xml varbit"
).split()


def _sized_sql(name, factor, limit, overflow, unsized):
    size = f"length * {factor}"
    return (
        f"case when length <= 0 then '{unsized}' when {size} <= {limit} then '{name}(' || {size} || ')' "
        f"else '{overflow}' end"
    )


def _ps_sql(sep, name="decimal"):
    return f"'{name}(' || precision || '{sep}' || scale || ')'"


def _types_postgresql(compat):
    decimal = "scale between 1 and 1000 and precision between 1 and 1000 and precision > scale"
    if not compat:
        decimal = "precision between 1 and 1000 and scale between 0 and precision"
    return {
        **dict.fromkeys(("nvarchar", "varchar", "ntext", "text"), "'text'"),
        "int64": "'bigint'", "int32": "'integer'", "int16": "'smallint'",
        "float64": "'double precision'", "float32": "'float'",
        "decimal": f"case when {decimal} then {_ps_sql(',')} else 'decimal' end",
        "money": "'money'" if compat else "'decimal(19,4)'",
        "datetime": "'timestamp'", "datetimetz": "'timestamp'" if compat else "'timestamptz'",
        "date": "'date'", "time": "'time'", "varbinary": "'bytea'", "blob": "'bytea'", "uuid": "'uuid'",
        "bool": "'boolean'", "json": "'jsonb'", "xml": "'xml'", "varbit": "'varbit'",
    }


def _types_mssql(compat):
    decimal = "scale between 1 and 38 and precision between 1 and 38 and precision > scale"
    if not compat:
        decimal = "precision between 1 and 38 and scale between 0 and precision"

    def sized(name, limit, none):
        return _sized_sql(name, 2, limit, f"{name}(max)", f"{name}({none if compat else 'max'})")

    return {
        "nvarchar": sized("nvarchar", 4000, 4000), "varchar": sized("varchar", 8000, 8000),
        "ntext": "'nvarchar(max)'", "text": "'varchar(max)'",
        "int64": "'bigint'", "int32": "'integer'", "int16": "'smallint'",
        "float64": "'float'", "float32": "'real'",
        "decimal": f"case when {decimal} then {_ps_sql(',')} else '{'float' if compat else 'varchar(max)'}' end",
        "money": "'money'",
        "datetime": "'datetime2'", "datetimetz": "'datetime2'" if compat else "'datetimeoffset'",
        "date": "'date'", "time": "'time'", "varbinary": sized("varbinary", 8000, 8000),
        "blob": "'varbinary(max)'", "uuid": "'uniqueidentifier'", "bool": "'bit'",
        "json": sized("nvarchar", 4000, 4000), "xml": "'xml'", "varbit": sized("varchar", 8000, 8000),
    }


def _types_mysql(compat):
    decimal = "scale between 1 and 65 and precision between 1 and 65 and precision > scale"
    known = "precision > 0 or scale > 0"
    if not compat:
        decimal = "precision between 1 and 65 and scale between 0 and least(precision, 30)"
        known = decimal
    blob = "'blob'" if compat else "'longblob'"
    return {
        **dict.fromkeys(("nvarchar", "varchar", "ntext", "text", "xml", "varbit"), "'longtext'"),
        "int64": "'bigint'", "int32": "'integer'", "int16": "'smallint'",
        "float64": "'double'", "float32": "'float'",
        "decimal": f"case when {decimal} then {_ps_sql(',')} else '{'double' if compat else 'longtext'}' end",
        "money": f"case when {known} then {_ps_sql(',')} else '{'float' if compat else 'decimal(19,4)'}' end",
        "datetime": "'datetime'" if compat else "'datetime(6)'",
        "datetimetz": "'datetime'" if compat else "'datetime(6)'",
        "date": "'date'", "time": "'time'" if compat else "'time(6)'", "varbinary": blob, "blob": blob,
        "uuid": "'binary(16)'", "bool": "'tinyint(1)'", "json": "'json'",
    }


def _types_oracle(compat):
    decimal = "precision between 0 and 38 and scale between 0 and 38 and (precision > 0 or scale > 0)"
    known = "precision > 0 or scale > 0"
    if not compat:
        decimal = known = "precision between 1 and 38 and scale between 0 and precision"
    text = _sized_sql("varchar2", 4, 4000, "clob", "varchar2(4000)" if compat else "clob")
    money = f"case when {known} then {_ps_sql(', ')} else 'decimal(38, 4)' end"
    if compat:  # a precision over 38 stops the job; the query leaves such rows out on both sides
        money = f"case when not ({known}) then 'decimal(38, 4)' else {_ps_sql(', ')} end"
    return {
        **dict.fromkeys(("nvarchar", "varchar", "xml", "varbit"), text),
        **dict.fromkeys(("ntext", "text", "json"), "'clob'"),
        "int64": "'number(19)'", "int32": "'number(10)'", "int16": "'number(5)'",
        "float64": "'BINARY_DOUBLE'", "float32": "'BINARY_FLOAT'",
        "decimal": f"case when {decimal} then {_ps_sql(', ')} else '{'BINARY_DOUBLE' if compat else 'number'}' end",
        "money": money,
        "datetime": "'timestamp'", "datetimetz": "'timestamp'" if compat else "'timestamp with time zone'",
        "date": "'date'", "time": "'varchar2(256)'",
        "varbinary": _sized_sql("raw", 1, 2000, "blob", "raw(2000)" if compat else "blob"), "blob": "'blob'",
        "uuid": "'raw(16)'", "bool": "'number(1)'",
    }


def _types_snowflake(compat):
    decimal = "precision between 1 and 38 and scale between 0 and least(precision, 37)"
    return {
        **dict.fromkeys(("nvarchar", "varchar", "ntext", "text", "xml", "varbit"), "'text'"),
        **dict.fromkeys(("int64", "int32", "int16"), "'number'"),
        "float64": "'real'", "float32": "'real'",
        "decimal": "'number'" if compat else f"case when {decimal} then {_ps_sql(',', 'number')} else 'text' end",
        "money": "'number'" if compat else "'number(19,4)'",
        "datetime": "'datetime'", "datetimetz": "'timestamp_tz'", "date": "'date'", "time": "'time'",
        **dict.fromkeys(("varbinary", "blob", "uuid"), "'varbinary'"), "bool": "'boolean'", "json": "'variant'",
    }


TYPES_SQL = {
    "postgresql": _types_postgresql,
    "mssql": _types_mssql,
    "mysql": _types_mysql,
    "oracle": _types_oracle,
    "snowflake": _types_snowflake,
}


def type_case(target: str, compat: bool) -> str:
    cases = " ".join(f"when '{t}' then {e}" for t, e in TYPES_SQL[target](compat).items())
    return f"case data_type {cases} end"


def translated(spark, sf, target, compat):
    rows = _column_rows(spark, sf, _pick(CANONICAL, F.col("o_custkey")))
    rows = rows.withColumn("canonical_type", F.col("data_type"))
    if compat and target == "oracle":  # historically an error there
        rows = rows.withColumn("precision", F.when(F.col("precision").isNotNull(), F.least("precision", F.lit(38))))
    return translate(rows, None, target, compat=compat)


def _create_types(target, compat):
    columns = ["table_name", "ordinal", "canonical_type", "target_type"]
    return lambda spark, sf: translated(spark, sf, target, compat).select(*columns, *([] if compat else ["lossy"]))


def _typed_rows_sql(target, compat):
    rows = rows_sql(names_sql(CANONICAL))
    if compat and target == "oracle":
        rows = rows.replace("o_custkey % 45 end, -1)", "least(o_custkey % 45, 38) end, -1)")
    return rows


for _target in VENDORS:
    for _compat, _suffix in ((True, ""), (False, "_exact")):
        _name = f"cat7_create_types_{_target}{_suffix}"
        QUERIES[_name] = _create_types(_target, _compat)
        SQL[_name] = (
            f"with {_typed_rows_sql(_target, _compat)} select table_name, ordinal, data_type as canonical_type, "
            f"{type_case(_target, _compat)} as target_type{'' if _compat else ', false as lossy'} from rows"
        )


def cat7_money_error(spark, sf):
    """Historically Oracle money of too large a precision stops the job: which orders' sizes would, and
    the types of the others."""
    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 45).cast("int").alias("precision"))
    wide = F.col("precision") > 38
    narrow = F.when(~wide, F.col("precision"))
    known = catalog.create_type(F.lit("money"), narrow, F.lit(2), F.lit(-1), "oracle", True)
    return orders.select("o_orderkey", wide.alias("refused"), F.when(~wide, known).alias("target_type"))


QUERIES["cat7_money_error_oracle"] = cat7_money_error
SQL["cat7_money_error_oracle"] = """
select o_orderkey, o_custkey % 45 > 38 as refused,
  case when o_custkey % 45 <= 38 then 'decimal(' || o_custkey % 45 || ', 2)' end as target_type from orders"""

# --- CAT-8, CAT-9 -----------------------------------------------------------------------------------------


def cat8_describe(spark, sf):
    """Every column of a table: its canonical type and the longest text it holds."""
    line = table(spark, sf, "lineitem")
    sizes = max_byte_length(line, null="")
    measured = sizes.unpivot([], sizes.columns, "column_name", "bytes")
    return (
        describe(line, "sales", "lineitem")
        .join(measured, "column_name")
        .select("column_name", "ordinal", "canonical_type", "nullable", "bytes")
    )


_LINEITEM = {
    "l_orderkey": "int64", "l_partkey": "int64", "l_suppkey": "int64", "l_linenumber": "int32",
    "l_quantity": "float64", "l_extendedprice": "float64", "l_discount": "float64", "l_tax": "float64",
    "l_returnflag": "ntext", "l_linestatus": "ntext", "l_shipdate": "datetime",
}
QUERIES["cat8_describe_query"] = cat8_describe
SQL["cat8_describe_query"] = " union all ".join(
    f"select '{c}' as column_name, {n}::int as ordinal, '{t}' as canonical_type, true as nullable, "
    + (
        "max(strlen(strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')))::int as bytes from lineitem"
        if t == "datetime"
        else f"max(strlen({c}::varchar))::int as bytes from lineitem"
    )
    for n, (c, t) in enumerate(_LINEITEM.items(), start=1)
)

QUERIES["cat9_primary_keys"] = lambda spark, sf: primary_keys(column_rows(spark, sf, "oracle"))
SQL["cat9_primary_keys"] = f"""
with {rows_sql("''")}
select table_schema, table_name, column_name, ordinal from rows where is_primary"""

# --- CAT-10 to CAT-12: identifiers -------------------------------------------------------------------------


def names(spark, sf):
    """Every distinct word of the documents, every address of the pages and every customer name."""
    words = table(spark, sf, "documents").select(F.explode(F.split("text", r"[ \t\n\r\f]+")).alias("name"))
    urls = table(spark, sf, "pages").select(F.col("url").alias("name"))
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return words.unionAll(urls).unionAll(customers).groupBy("name").agg(F.count("*").alias("n"))


NAMES_SQL = r"""names as (
  select name, count(*) as n from (
    select unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) as name from documents
    union all select url from pages union all select c_name from customer) group by name)"""


def _quoted(system, compat):
    return lambda spark, sf: names(spark, sf).select("name", quoted(F.col("name"), system, compat).alias("quoted"))


def reserved_sql(name: str, system: str, compat: bool) -> str:
    words = reserved_words(system, compat)
    if not words or (compat and system == "oracle"):
        return "false"
    listed = ", ".join(f"'{w}'" for w in words)
    folded = f"lower({name})" if not compat or system == "mssql" else name
    return f"{folded} in ({listed})"


def quoted_sql(name: str, system: str, compat: bool) -> str:
    before, after = QUOTES[system]
    inner = name if compat else f"replace({name}, '{after}', '{after}{after}')"
    if system == "mysql" and not compat:
        return f"case when {name} <> '' then '`' || {inner} || '`' else {name} end"
    plain = rf"regexp_matches({name}, '^[A-Za-z_@#][\p{{L}}\p{{Nd}}_]*$')"
    return (
        f"case when {name} <> '' and (not {plain} or {reserved_sql(name, system, compat)}) "
        f"then '{before}' || {inner} || '{after}' else {name} end"
    )


for _system in VENDORS:
    for _compat, _suffix in ((True, ""), (False, "_exact")):
        QUERIES[f"cat10_quote_{_system}{_suffix}"] = _quoted(_system, _compat)
        _name = quoted_sql("name", _system, _compat)
        SQL[f"cat10_quote_{_system}{_suffix}"] = f"with {NAMES_SQL} select name, {_name} as quoted from names"


def cat11_reserved(spark, sf):
    name = F.col("name")
    flags = [is_reserved(name, s).alias(s) for s in ("postgresql", "mssql", "oracle", "snowflake")]
    exact = [is_reserved(name, s, True).alias(f"{s}_compat") for s in ("postgresql", "snowflake")]
    return names(spark, sf).select("name", "n", *flags, *exact)


QUERIES["cat11_reserved_words"] = cat11_reserved
SQL["cat11_reserved_words"] = (
    f"with {NAMES_SQL} select name, n, "
    + ", ".join(f"{reserved_sql('name', s, False)} as {s}" for s in ("postgresql", "mssql", "oracle", "snowflake"))
    + ", "
    + ", ".join(f"{reserved_sql('name', s, True)} as {s}_compat" for s in ("postgresql", "snowflake"))
    + " from names"
)


def cat12_qualified(spark, sf):
    s = table(spark, sf, "supplier")
    schema, name = F.col("s_name"), F.concat(F.lit("stock "), F.col("s_nationkey").cast("string"))
    return s.select("s_suppkey", *[qualified(schema, name, t).alias(t) for t in VENDORS])


QUERIES["cat12_qualified_names"] = cat12_qualified
SQL["cat12_qualified_names"] = (
    "with s as (select s_suppkey, s_name as a, 'stock ' || s_nationkey as b from supplier) select s_suppkey, "
    + ", ".join(
        (f"{quoted_sql('b', t, False)} as {t}")
        if t == "mysql"
        else f"({quoted_sql('a', t, False)}) || '.' || ({quoted_sql('b', t, False)}) as {t}"
        for t in VENDORS
    )
    + " from s"
)

# --- CAT-13: statements ------------------------------------------------------------------------------------


def _ddl(target):
    return lambda spark, sf: ddl(translated(spark, sf, target, False), target, incremental=True)


def _ddl_sql(target):
    name = quoted_sql("column_name", target, False)
    full = quoted_sql("table_name", target, False)
    if target != "mysql":
        full = f"'sales.' || ({full})"
    body = "string_agg(name || ' ' || target_type, ', ' order by ordinal) || ', primary key (' || " \
        "string_agg(name, ',' order by ordinal) filter (where is_primary) || ')'"
    inner = "replace({}, '''', '''''')".format
    if target == "mssql":
        statement = f"'if object_id(''' || {inner('t')} || ''', ''U'') is null create table ' || t || ' (' || b || ')'"
    elif target == "oracle":
        create = "'create table ' || t || ' (' || b || ')'"
        statement = (
            f"'begin execute immediate ''' || {inner(create)} || '''; "
            "exception when others then if sqlcode != -955 then raise; end if; end;'"
        )
    else:
        statement = "'create table if not exists ' || t || ' (' || b || ')'"
    plain = type_case(target, False)
    column_type = f"case when is_primary then {KEYS_SQL[target].format(plain=plain)} else {plain} end"
    return f"""
with {rows_sql(names_sql(CANONICAL))},
c as (select *, {name} as name, {column_type} as target_type from rows),
g as (
  select table_schema, table_name, {body} as b,
    string_agg(column_name, ', ' order by ordinal) filter (where target_type is null) as bad
  from c group by table_schema, table_name),
q as (select *, {full} as t from g)
select table_schema, table_name, case when bad is null then {statement} end as statement,
  'no key type of {target} for: ' || bad as refused
from q"""


# The vendors' rules for columns of a primary key.  MySQL: an index entry of 3,072 bytes, 4 to a character of utf8mb4,
# and a length for every text and blob.  SQL Server: 900 bytes, no (max) types.  Oracle: no large objects, no
# TIMESTAMP WITH TIME ZONE.  Numbers without a size travel as text of at most 255 characters.
KEYS_SQL = {
    "postgresql": "case when data_type = 'xml' then 'text' else {plain} end",
    "snowflake": "{plain}",
    "mysql": """case
      when data_type in ('nvarchar', 'varchar', 'ntext', 'text', 'xml', 'varbit')
        then case when length > 0 and 4 * length <= 3072 then 'varchar(' || length || ')' end
      when data_type in ('varbinary', 'blob')
        then case when length > 0 and length <= 3072 then 'varbinary(' || length || ')' end
      when data_type = 'json' then null
      when data_type = 'decimal' and not (precision between 1 and 65 and scale between 0 and least(precision, 30))
        then 'varchar(255)'
      else {plain} end""",
    "mssql": """case
      when data_type in ('nvarchar', 'ntext', 'json')
        then case when length > 0 and 2 * (2 * length) <= 900 then 'nvarchar(' || 2 * length || ')' end
      when data_type in ('varchar', 'text', 'varbit')
        then case when length > 0 and 2 * length <= 900 then 'varchar(' || 2 * length || ')' end
      when data_type in ('varbinary', 'blob')
        then case when length > 0 and 2 * length <= 900 then 'varbinary(' || 2 * length || ')' end
      when data_type = 'xml' then null
      when data_type = 'decimal' and not (precision between 1 and 38 and scale between 0 and precision)
        then 'varchar(255)'
      else {plain} end""",
    "oracle": """case
      when data_type in ('nvarchar', 'varchar', 'ntext', 'text', 'json', 'xml', 'varbit')
        then case when length > 0 and 4 * length <= 4000 then 'varchar2(' || 4 * length || ')' end
      when data_type in ('varbinary', 'blob')
        then case when length > 0 and length <= 2000 then 'raw(' || length || ')' end
      when data_type = 'datetimetz' then 'timestamp with local time zone'
      else {plain} end""",
}


for _target in VENDORS:
    QUERIES[f"cat13_ddl_{_target}"] = _ddl(_target)
    SQL[f"cat13_ddl_{_target}"] = _ddl_sql(_target)
