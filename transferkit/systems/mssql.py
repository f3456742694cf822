from transferkit.systems.profile import UNSIZED_NUMBER_KEY, DecimalType, LiteralRules, LoadRules, SizedType, SystemProfile

# SQL Server type names and key words.
CATALOG_TYPES = {
    "nvarchar": "nvarchar, nchar",
    "varchar": "varchar, char",
    "ntext": "ntext",
    "text": "text",
    "int64": "bigint",
    "int32": "int",
    "int16": "smallint, tinyint",
    "float64": "float",
    "float32": "real",
    "decimal": "decimal, numeric",
    "money": "money, smallmoney",
    "datetime": "datetime2, datetime, smalldatetime",
    "datetimetz": "datetimeoffset",
    "date": "date",
    "time": "time",
    "varbinary": "binary, varbinary, timestamp",
    "blob": "image",
    "uuid": "uniqueidentifier",
    "bool": "bit",
    "xml": "xml",
}
RESULT_TYPES = {
    "nvarchar": "NVARCHAR, NCHAR",
    "varchar": "VARCHAR, CHAR",
    "ntext": "NTEXT",
    "text": "TEXT",
    "int64": "BIGINT",
    "int32": "INT",
    "int16": "SMALLINT, TINYINT",
    "float64": "FLOAT",
    "float32": "REAL",
    "decimal": "DECIMAL, NUMERIC",
    "money": "MONEY, SMALLMONEY",
    "datetime": "DATETIME2, DATETIME, SMALLDATETIME",
    "datetimetz": "DATETIMEOFFSET",
    "date": "DATE",
    "time": "TIME",
    "varbinary": "BINARY",
    "blob": "IMAGE, VARBINARY",
    "uuid": "UNIQUEIDENTIFIER",
    "bool": "BIT",
    "xml": "XML",
}
# Further names of the JDBC driver.
STATEMENT_TYPES = {"nvarchar": "sysname", "varbinary": "timestamp"}
# The words SQL Server's manual reserves.
RESERVED = (
    "add", "all", "alter", "and", "any", "as", "asc", "authorization", "backup", "begin", "between",
    "break", "browse", "bulk", "by", "cascade", "case", "check", "checkpoint", "close", "clustered",
    "coalesce", "collate", "column", "commit", "compute", "constraint", "contains", "containstable",
    "continue", "convert", "create", "cross", "current", "current_date", "current_time",
    "current_timestamp", "current_user", "cursor", "database", "dbcc", "deallocate", "declare", "default",
    "delete", "deny", "desc", "disk", "distinct", "distributed", "double", "drop", "dump", "else", "end",
    "errlvl", "escape", "except", "exec", "execute", "exists", "exit", "external", "fetch", "file",
    "fillfactor", "for", "foreign", "freetext", "freetexttable", "from", "full", "function", "goto",
    "grant", "group", "having", "holdlock", "identity", "identity_insert", "identitycol", "if", "in",
    "index", "inner", "insert", "intersect", "into", "is", "join", "key", "kill", "left", "like", "lineno",
    "load", "merge", "national", "nocheck", "nonclustered", "not", "null", "nullif", "of", "off", "offsets",
    "on", "open", "opendatasource", "openquery", "openrowset", "openxml", "option", "or", "order", "outer",
    "over", "percent", "pivot", "plan", "precision", "primary", "print", "proc", "procedure", "public",
    "raiserror", "read", "readtext", "reconfigure", "references", "replication", "restore", "restrict",
    "return", "revert", "revoke", "right", "rollback", "rowcount", "rowguidcol", "rule", "save", "schema",
    "securityaudit", "select", "semantickeyphrasetable", "semanticsimilaritydetailstable",
    "semanticsimilaritytable", "session_user", "set", "setuser", "shutdown", "some", "statistics",
    "system_user", "table", "tablesample", "textsize", "then", "to", "top", "tran", "transaction",
    "trigger", "truncate", "try_convert", "tsequal", "union", "unique", "unpivot", "update", "updatetext",
    "use", "user", "values", "varying", "view", "waitfor", "when", "where", "while", "with", "within",
    "writetext",
)
# The words the historical quoting knew.
KEYWORDS = """
ADD, ALL, ALTER, AND, ANY, AS, ASC, AUTHORIZATION, BACKUP, BEGIN, BETWEEN, BREAK, BROWSE, BULK, BY, CASCADE,
CASE, CHECK, CHECKPOINT, CLOSE, CLUSTERED, COALESCE, COLLATE, COLUMN, COMMIT, COMPUTE, CONSTRAINT, CONTAINS,
CONTAINSTABLE, CONTINUE, CONVERT, CREATE, CROSS, CURRENT, CURRENT_DATE, CURRENT_TIME, CURRENT_TIMESTAMP,
CURRENT_USER, CURSOR, DATABASE, DBCC, DEALLOCATE, DECLARE, DEFAULT, DELETE, DENY, DESC, DISK, DISTINCT,
DISTRIBUTED, DOUBLE, DROP, DUMP, ELSE, END, ERRLVL, ESCAPE, EXCEPT, EXEC, EXECUTE, EXISTS, EXIT, EXTERNAL,
FETCH, FILE, FILLFACTOR, FOR, FOREIGN, FREETEXT, FREETEXTTABLE, FROM, FULL, FUNCTION, GOTO, GRANT, GROUP,
HAVING, HOLDLOCK, IDENTITY, IDENTITY_INSERT, IDENTITYCOL, IF, IN, INDEX, INNER, INSERT, INTERSECT, INTO, IS,
JOIN, KEY, KILL, LEFT, LIKE, LINENO, LOAD, MERGE, NATIONAL, NOCHECK, NONCLUSTERED, NOT, NULL, NULLIF, OF,
OFF, OFFSETS, ON, OPEN, OPENDATASOURCE, OPENQUERY, OPENROWSET, OPENXML, OPTION, OR, ORDER, OUTER, OVER,
PERCENT, PIVOT, PLAN, PRECISION, PRIMARY, PRINT, PROC, PROCEDURE, PUBLIC, RAISEERROR, RANGE, READ, READTEXT,
RECONFIGURE, REFERENCES, REPLICATION, RESTORE, RESTRICT, RETURN, REVERT, REVOKE, RIGHT, ROLLBACK, ROWCOUNT,
ROWGUIDCOL, RULE, SAVE, SCHEMA, SECURITYAUDIT, SELECT, SEMANTICKEYPHRASETABLE,
SEMANTICSIMILARITYDETAILSTABLE, SEMANTICSIMILARITYTABLE, SESSION_USER, SET, SETUSER, SHUTDOWN, SOME,
STATISTICS, SYSTEM_USER, TABLE, TABLESAMPLE, TEXTSIZE, THEN, TO, TOP, TRAN, TRANSACTION, TRIGGER, TRUNCATE,
TRY_CONVERT, TSEQUAL, UNION, UNIQUE, UNPIVOT, UPDATE, UPDATETEXT, USE, USER, VALUES, VARYING, VIEW, WAITFOR,
WHEN, WHERE, WHILE, WITH, WITHIN GROUP, WRITETEXT
"""

_NVARCHAR = SizedType("nvarchar", 2, 4000, "nvarchar(max)", "nvarchar(4000)")
_VARCHAR = SizedType("varchar", 2, 8000, "varchar(max)", "varchar(8000)")

MSSQL = SystemProfile(
    name="mssql",
    driver="com.microsoft.sqlserver.jdbc.SQLServerDriver",
    catalog_types=CATALOG_TYPES,
    result_types=RESULT_TYPES,
    statement_types=STATEMENT_TYPES,
    corrections={"varbinary": "blob"},
    create_types={
        "ntext": "nvarchar(max)",
        "text": "varchar(max)",
        "int64": "bigint",
        "int32": "integer",
        "int16": "smallint",
        "float64": "float",
        "float32": "real",
        "money": "money",
        "datetime": "datetime2",
        "datetimetz": "datetime2",
        "date": "date",
        "time": "time",
        "blob": "varbinary(max)",
        "uuid": "uniqueidentifier",
        "bool": "bit",
        "xml": "xml",
    },
    exact_create_types={"datetimetz": "datetimeoffset"},
    sized_types={
        "nvarchar": _NVARCHAR,
        "varchar": _VARCHAR,
        "varbinary": SizedType("varbinary", 2, 8000, "varbinary(max)", "varbinary(8000)"),
        "json": _NVARCHAR,
        "varbit": _VARCHAR,
    },
    decimal=DecimalType(38, 38, "float", exact="varchar(max)"),
    money=None,
    # the key of a clustered index has at most 900 bytes
    key_types={
        **dict.fromkeys(("nvarchar", "ntext", "json"), SizedType("nvarchar", 2, 450, "", "")),
        **dict.fromkeys(("varchar", "text", "varbit"), SizedType("varchar", 2, 900, "", "")),
        **dict.fromkeys(("varbinary", "blob"), SizedType("varbinary", 2, 900, "", "")),
        "xml": "",
        "decimal": UNSIZED_NUMBER_KEY,
    },
    load=LoadRules(exact_offset=" +00:00", bool_digits=True, empty_as_nul=True),
    literal=LiteralRules(
        binary=("0x", ""),
        binary_compat={"varbinary": ("0x", ""), "blob": ("0x", "")},
        zone=" +00:00",
        bool_digits_exact=True,
    ),
    quotes=("[", "]"),
    keywords=KEYWORDS,
    reserved=RESERVED,
    keyword_case="upper",
    not_found="Invalid object name",
    read_options={"preferTimestampNTZ": "true", "fetchsize": "10000"},
    write_options={"useBulkCopyForBatchInsert": "true"},
)
