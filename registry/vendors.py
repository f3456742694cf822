"""What the vendors' manuals and drivers say, typed out for the expected results; nothing here comes from the package.

Type names stand under the canonical type they become.  The catalog calls types by one name, the metadata of a result
by another; numbers are PostgreSQL's ids of types without a name there.
"""

# Type names by canonical type.
CATALOG_TYPES = {
    "postgresql": {
        "nvarchar": "character varying, character, interval, box, circle, line, path, point, polygon, lseg, inet, macaddr, "
        "cidr, time with time zone, pg_lsn, pg_snapshot, tsquery, tsvector, txid_snapshot",
        "ntext": "text", "int64": "bigint", "int32": "integer", "int16": "smallint", "float64": "double precision",
        "float32": "real", "decimal": "numeric", "datetime": "timestamp without time zone",
        "datetimetz": "timestamp with time zone", "date": "date", "time": "time without time zone", "blob": "bytea",
        "uuid": "uuid", "bool": "boolean", "json": "json, jsonb", "xml": "xml", "varbit": "bit, bit varying",
    },
    "mssql": {
        "nvarchar": "nvarchar, nchar", "varchar": "varchar, char", "ntext": "ntext", "text": "text", "int64": "bigint",
        "int32": "int", "int16": "smallint, tinyint", "float64": "float", "float32": "real", "decimal": "decimal, numeric",
        "money": "money, smallmoney", "datetime": "datetime2, datetime, smalldatetime", "datetimetz": "datetimeoffset",
        "date": "date", "time": "time", "varbinary": "binary, varbinary, timestamp", "blob": "image",
        "uuid": "uniqueidentifier", "bool": "bit", "xml": "xml",
    },
    "mysql": {
        "nvarchar": "varchar, char, enum, set", "varchar": "year", "ntext": "longtext, mediumtext, text, tinytext",
        "int64": "bigint", "int32": "int, mediumint", "int16": "smallint, tinyint", "float64": "double",
        "float32": "float", "decimal": "decimal", "datetime": "datetime, timestamp", "date": "date", "time": "time",
        "varbinary": "binary, varbinary", "blob": "longblob, mediumblob, blob, tinyblob, geometry", "json": "json",
        "varbit": "bit",
    },
    "oracle": {
        "nvarchar": "nchar, char, varchar2, urowid, interval", "ntext": "clob, nclob", "float64": "float, binary_double",
        "float32": "binary_float", "decimal": "number", "datetime": "timestamp",
        "datetimetz": "timestamp with time zone, timestamp with local time zone", "date": "date", "varbinary": "raw",
        "blob": "blob",
    },
    "snowflake": {
        "nvarchar": "text, variant, array", "float64": "float", "decimal": "number", "datetime": "timestamp_ntz",
        "datetimetz": "timestamp_ltz, timestamp_tz", "date": "date", "time": "time",
        "varbinary": "binary, object, geography, geometry", "bool": "boolean",
    },
}
RESULT_TYPES = {
    "postgresql": {
        "nvarchar": "varchar, bpchar, interval, box, circle, line, path, point, polygon, lseg, inet, macaddr, cidr, 1266, "
        "774, 3220, 5038, 3615, 3614, 2970",
        "ntext": "text", "int64": "int8", "int32": "int4", "int16": "int2", "float64": "float8", "float32": "float4",
        "decimal": "numeric", "datetime": "timestamp", "datetimetz": "timestamptz", "date": "date", "time": "time",
        "blob": "bytea", "uuid": "uuid", "bool": "bool", "json": "json, jsonb", "xml": "142", "varbit": "bit, varbit",
    },
    "mssql": {
        "nvarchar": "nvarchar, nchar", "varchar": "varchar, char", "ntext": "ntext", "text": "text", "int64": "bigint",
        "int32": "int", "int16": "smallint, tinyint", "float64": "float", "float32": "real", "decimal": "decimal, numeric",
        "money": "money, smallmoney", "datetime": "datetime2, datetime, smalldatetime", "datetimetz": "datetimeoffset",
        "date": "date", "time": "time", "varbinary": "binary", "blob": "image, varbinary", "uuid": "uniqueidentifier",
        "bool": "bit", "xml": "xml",
    },
    "mysql": {
        "nvarchar": "varchar, char", "ntext": "text", "int64": "unsigned bigint, bigint, unsigned int",
        "int32": "int, mediumint, unsigned smallint", "int16": "year, smallint, unsigned tinyint, tinyint",
        "float64": "double", "float32": "float", "decimal": "decimal", "datetime": "datetime", "datetimetz": "timestamp",
        "date": "date", "time": "time", "blob": "binary, varbinary, blob, geometry", "json": "json", "varbit": "bit",
    },
    "oracle": {
        "nvarchar": "nchar, char, rowid, urowid, intervalym_dty, intervalds_dty", "ntext": "ocicloblocator, long",
        "float64": "ibdouble", "float32": "ibfloat", "decimal": "number", "datetime": "timestampdty",
        "datetimetz": "timestamptz_dty, timestampltz_dty", "date": "date", "varbinary": "raw",
        "blob": "ocibloblocator, ocifilelocator",
    },
    "snowflake": {
        "nvarchar": "text, variant, array, object", "float64": "real", "decimal": "fixed", "datetime": "timestamp_ntz",
        "datetimetz": "timestamp_ltz, timestamp_tz", "date": "date", "time": "time", "varbinary": "binary",
        "bool": "boolean",
    },
}
# Where the two disagree, or a value would not fit, the wider type holds for both.
WIDER = {
    "postgresql": {},
    "mssql": {"varbinary": "blob"},
    "mysql": {
        "binary": "blob", "varbinary": "blob", "year": "int16", "timestamp": "datetimetz", "unsigned tinyint": "int16",
        "unsigned smallint": "int32", "unsigned mediumint": "int32", "unsigned int": "int64", "unsigned bigint": "decimal",
    },
    "oracle": {"date": "datetime"},
    "snowflake": {"object": "nvarchar"},
}
VENDORS = tuple(CATALOG_TYPES)
QUOTES = {
    "postgresql": ('"', '"'), "mssql": ("[", "]"), "mysql": ("`", "`"), "oracle": ('"', '"'), "snowflake": ('"', '"'),
}
NULL_TOKENS = {"postgresql": "{nll}", "mssql": "{nll}", "mysql": "NULL", "oracle": "{nll}", "snowflake": "{nll}"}

# The words each manual reserves.  MySQL's names are always quoted.
RESERVED = {
    "postgresql": """
all, analyse, analyze, and, any, array, as, asc, asymmetric, authorization, binary, both, case, cast, check,
collate, collation, column, concurrently, constraint, create, cross, current_catalog, current_date,
current_role, current_schema, current_time, current_timestamp, current_user, default, deferrable, desc,
distinct, do, else, end, except, false, fetch, for, foreign, freeze, from, full, grant, group, having, ilike,
in, initially, inner, intersect, into, is, isnull, join, lateral, leading, left, like, limit, localtime,
localtimestamp, natural, not, notnull, null, offset, on, only, or, order, outer, overlaps, placing, primary,
references, returning, right, select, session_user, similar, some, symmetric, system_user, table, tablesample,
then, to, trailing, true, union, unique, user, using, variadic, verbose, when, where, window, with
""",
    "mssql": """
add, all, alter, and, any, as, asc, authorization, backup, begin, between, break, browse, bulk, by, cascade,
case, check, checkpoint, close, clustered, coalesce, collate, column, commit, compute, constraint, contains,
containstable, continue, convert, create, cross, current, current_date, current_time, current_timestamp,
current_user, cursor, database, dbcc, deallocate, declare, default, delete, deny, desc, disk, distinct,
distributed, double, drop, dump, else, end, errlvl, escape, except, exec, execute, exists, exit, external,
fetch, file, fillfactor, for, foreign, freetext, freetexttable, from, full, function, goto, grant, group,
having, holdlock, identity, identity_insert, identitycol, if, in, index, inner, insert, intersect, into, is,
join, key, kill, left, like, lineno, load, merge, national, nocheck, nonclustered, not, null, nullif, of, off,
offsets, on, open, opendatasource, openquery, openrowset, openxml, option, or, order, outer, over, percent,
pivot, plan, precision, primary, print, proc, procedure, public, raiserror, read, readtext, reconfigure,
references, replication, restore, restrict, return, revert, revoke, right, rollback, rowcount, rowguidcol, rule,
save, schema, securityaudit, select, semantickeyphrasetable, semanticsimilaritydetailstable,
semanticsimilaritytable, session_user, set, setuser, shutdown, some, statistics, system_user, table,
tablesample, textsize, then, to, top, tran, transaction, trigger, truncate, try_convert, tsequal, union, unique,
unpivot, update, updatetext, use, user, values, varying, view, waitfor, when, where, while, with, within,
writetext
""",
    "oracle": """
access, add, all, alter, and, any, as, asc, audit, between, by, char, check, cluster, column, column_value,
comment, compress, connect, create, current, date, decimal, default, delete, desc, distinct, drop, else,
exclusive, exists, file, float, for, from, grant, group, having, identified, immediate, in, increment, index,
initial, insert, integer, intersect, into, is, level, like, lock, long, maxextents, minus, mlslabel, mode,
modify, nested_table_id, noaudit, nocompress, not, nowait, null, number, of, offline, on, online, option, or,
order, pctfree, prior, public, raw, rename, resource, revoke, row, rowid, rownum, rows, select, session, set,
share, size, smallint, start, successful, synonym, sysdate, table, then, to, trigger, uid, union, unique,
update, user, validate, values, varchar, varchar2, view, whenever, where, with
""",
    "snowflake": """
account, all, alter, and, any, as, between, by, case, cast, check, column, connect, connection, constraint,
create, cross, current, current_date, current_time, current_timestamp, current_user, database, delete, distinct,
drop, else, exists, false, following, for, from, full, grant, group, gscluster, having, ilike, in, increment,
inner, insert, intersect, into, is, issue, join, lateral, left, like, localtime, localtimestamp, minus, natural,
not, null, of, on, or, order, organization, qualify, regexp, revoke, right, rlike, row, rows, sample, schema,
select, set, some, start, table, tablesample, then, to, trigger, true, try_cast, union, unique, update, using,
values, view, when, whenever, where, with
""",
    "mysql": "",
}
# How the historical quoting differed: words it did not know, and words it knew besides.
UNKNOWN_THEN = {
    "postgresql": "authorization, binary, collation, concurrently, cross, current_schema, deferrable, fetch, freeze, ilike, "
    "isnull, lateral, notnull, system_user, tablesample",
    "mssql": "raiserror, within",
    "snowflake": "account, all, any, connect, connection, constraint, cross, current, current_user, database, following, "
    "gscluster, ilike, increment, issue, lateral, localtime, localtimestamp, minus, natural, of, organization, qualify, "
    "regexp, rlike, row, rows, sample, schema, some, start, tablesample, to, trigger, try_cast, unique, view, whenever",
}
KNOWN_THEN = {"mssql": "raiseerror, range, within group", "snowflake": "collate, desc, outer"}


def _words(text: str) -> list[str]:
    return [w.strip() for w in text.replace("\n", " ").split(",") if w.strip()]


def reserved_words(system: str, then: bool) -> list[str]:
    """Lower-case words that are no plain names, today or as the historical quoting had them."""
    found = _words(RESERVED[system])
    if then:
        gone = _words(UNKNOWN_THEN.get(system, ""))
        found = [w for w in found if w not in gone] + _words(KNOWN_THEN.get(system, ""))
    return sorted(found)


def type_pairs(system: str, path: str, then: bool) -> list[tuple[str, str]]:
    """(type name, canonical type), by name."""
    given = (CATALOG_TYPES if path == "table" else RESULT_TYPES)[system]
    rows = {n.lower(): canonical for canonical, names in given.items() for n in _words(names)}
    return sorted((rows if then else rows | WIDER[system]).items())
