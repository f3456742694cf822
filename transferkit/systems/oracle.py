from transferkit.systems.profile import DecimalType, LiteralRules, LoadRules, SizedType, SystemProfile

# Oracle type names.
CATALOG_TYPES = {
    "nvarchar": "NCHAR, CHAR, VARCHAR2, INTERVAL, UROWID",
    "ntext": "CLOB, NCLOB",
    "float64": "FLOAT, BINARY_DOUBLE",
    "float32": "BINARY_FLOAT",
    "decimal": "NUMBER",
    "datetime": "TIMESTAMP",
    "datetimetz": "TIMESTAMP WITH TIME ZONE, TIMESTAMP WITH LOCAL TIME ZONE",
    "date": "DATE",
    "varbinary": "RAW",
    "blob": "BLOB",
}
RESULT_TYPES = {
    "nvarchar": "NCHAR, CHAR, ROWID, UROWID, IntervalYM_DTY, IntervalDS_DTY",
    "ntext": "OCIClobLocator, LONG",
    "float64": "IBDouble",
    "float32": "IBFloat",
    "decimal": "NUMBER",
    "datetime": "TimeStampDTY",
    "datetimetz": "TimeStampTZ_DTY, TimeStampLTZ_DTY",
    "date": "DATE",
    "varbinary": "RAW",
    "blob": "OCIBlobLocator, OCIFileLocator",
}
# Further names of the JDBC driver.
STATEMENT_TYPES = {
    "nvarchar": "nvarchar2, intervalym, intervalds",
    "ntext": "nclob",
    "blob": "bfile, long raw",
    "decimal": "integer, smallint",
}
# Reserved words of Oracle's SQL language reference.
KEYWORDS = """
access, add, all, alter, and, any, as, asc, audit, between, by, char, check, cluster, column, column_value,
comment, compress, connect, create, current, date, decimal, default, delete, desc, distinct, drop, else,
exclusive, exists, file, float, for, from, grant, group, having, identified, immediate, in, increment, index,
initial, insert, integer, intersect, into, is, level, like, lock, long, maxextents, minus, mlslabel, mode,
modify, nested_table_id, noaudit, nocompress, not, nowait, null, number, of, offline, on, online, option, or,
order, pctfree, prior, public, raw, rename, resource, revoke, row, rowid, rownum, rows, select, session, set,
share, size, smallint, start, successful, synonym, sysdate, table, then, to, trigger, uid, union, unique,
update, user, validate, values, varchar, varchar2, view, whenever, where, with
"""

_VARCHAR2 = SizedType("varchar2", 4, 4000, "clob", "varchar2(4000)")
_VARCHAR2_KEY = SizedType("varchar2", 4, 4000, "", "")

ORACLE = SystemProfile(
    name="oracle",
    driver="oracle.jdbc.OracleDriver",
    catalog_types=CATALOG_TYPES,
    result_types=RESULT_TYPES,
    statement_types=STATEMENT_TYPES,
    # an Oracle DATE has a time of day, which the date type would drop
    corrections={"date": "datetime"},
    create_types={
        "ntext": "clob",
        "text": "clob",
        "int64": "number(19)",
        "int32": "number(10)",
        "int16": "number(5)",
        "float64": "BINARY_DOUBLE",
        "float32": "BINARY_FLOAT",
        "datetime": "timestamp",
        "datetimetz": "timestamp",
        "date": "date",
        "time": "varchar2(256)",
        "blob": "blob",
        "uuid": "raw(16)",
        "bool": "number(1)",
        "json": "clob",
    },
    exact_create_types={"datetimetz": "timestamp with time zone"},
    sized_types={
        "nvarchar": _VARCHAR2,
        "varchar": _VARCHAR2,
        "xml": _VARCHAR2,
        "varbit": _VARCHAR2,
        "varbinary": SizedType("raw", 1, 2000, "blob", "raw(2000)"),
    },
    decimal=DecimalType(
        38, 38, "BINARY_DOUBLE", separator=", ", min_scale_compat=0, scale_equal_compat=True, exact="number"
    ),
    money=DecimalType(38, 38, "decimal(38, 4)", separator=", "),
    # neither large objects nor instants with a zone of their own can be keys
    key_types={
        **dict.fromkeys(("nvarchar", "varchar", "xml", "varbit", "ntext", "text", "json"), _VARCHAR2_KEY),
        **dict.fromkeys(("varbinary", "blob"), SizedType("raw", 1, 2000, "", "")),
        "datetimetz": "timestamp with local time zone",
    },
    load=LoadRules(offset=" +00:00", exact_offset=" +00:00", bare_uuid=True, bool_digits=True),
    literal=LiteralRules(
        binary=("HEXTORAW('", "')"),
        binary_compat={"varbinary": ("HEXTORAW('", "')"), "blob": ("HEXTORAW('", "')")},
        timestamp=("TO_TIMESTAMP('", "', 'YYYY-MM-DD HH24:MI:SS.FF6')"),
        zoned_timestamp=("TO_TIMESTAMP_TZ('", "', 'YYYY-MM-DD HH24:MI:SS.FF6 TZH:TZM')"),
        zone=" +00:00",
        date=("TO_DATE('", "', 'YYYY-MM-DD')"),
        uuid_bytes=("HEXTORAW('", "')"),
        bool_digits=True,
    ),
    keywords=KEYWORDS,
    keywords_compat=False,
    upper_names=True,
    loads_by_name=True,
    read_options={
        "preferTimestampNTZ": "true",
        "fetchsize": "10000",
        "oracle.jdbc.mapDateToTimestamp": "true",
    },
)
