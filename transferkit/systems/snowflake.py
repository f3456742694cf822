from transferkit.systems.profile import DecimalType, LiteralRules, LoadRules, SystemProfile

# Snowflake type names and key words.
CATALOG_TYPES = {
    "nvarchar": "TEXT, VARIANT, ARRAY",
    "float64": "FLOAT",
    "decimal": "NUMBER",
    "datetime": "TIMESTAMP_NTZ",
    "datetimetz": "TIMESTAMP_LTZ, TIMESTAMP_TZ",
    "date": "DATE",
    "time": "TIME",
    "varbinary": "BINARY, OBJECT, GEOGRAPHY, GEOMETRY",
    "bool": "BOOLEAN",
}
RESULT_TYPES = {
    "nvarchar": "TEXT, VARIANT, OBJECT, ARRAY",
    "float64": "REAL",
    "decimal": "FIXED",
    "datetime": "TIMESTAMP_NTZ",
    "datetimetz": "TIMESTAMP_LTZ, TIMESTAMP_TZ",
    "date": "DATE",
    "time": "TIME",
    "varbinary": "BINARY",
    "bool": "BOOLEAN",
}
# Further names of the JDBC driver.
STATEMENT_TYPES = {
    "nvarchar": "varchar, char",
    "float64": "double",
    "datetime": "timestampntz",
    "datetimetz": "timestampltz, timestamptz",
    "varbinary": "geography, geometry",
}
# The words Snowflake's manual reserves.
RESERVED = (
    "account", "all", "alter", "and", "any", "as", "between", "by", "case", "cast", "check", "column",
    "connect", "connection", "constraint", "create", "cross", "current", "current_date", "current_time",
    "current_timestamp", "current_user", "database", "delete", "distinct", "drop", "else", "exists",
    "false", "following", "for", "from", "full", "grant", "group", "gscluster", "having", "ilike", "in",
    "increment", "inner", "insert", "intersect", "into", "is", "issue", "join", "lateral", "left", "like",
    "localtime", "localtimestamp", "minus", "natural", "not", "null", "of", "on", "or", "order",
    "organization", "qualify", "regexp", "revoke", "right", "rlike", "row", "rows", "sample", "schema",
    "select", "set", "some", "start", "table", "tablesample", "then", "to", "trigger", "true", "try_cast",
    "union", "unique", "update", "using", "values", "view", "when", "whenever", "where", "with",
)
# The words the historical quoting knew.
KEYWORDS = """
alter, and, as, between, by, case, cast, check, collate, column, create, current_date, current_time,
current_timestamp, delete, desc, distinct, drop, else, exists, false, for, from, full, grant, group, having,
in, inner, insert, intersect, into, is, join, left, like, not, null, on, or, order, outer, revoke, right,
select, set, table, then, true, union, update, using, values, when, where, with
"""

SNOWFLAKE = SystemProfile(
    name="snowflake",
    driver="net.snowflake.client.jdbc.SnowflakeDriver",
    catalog_types=CATALOG_TYPES,
    result_types=RESULT_TYPES,
    statement_types=STATEMENT_TYPES,
    corrections={"object": "nvarchar"},
    create_types={
        "nvarchar": "text",
        "varchar": "text",
        "ntext": "text",
        "text": "text",
        "int64": "number",
        "int32": "number",
        "int16": "number",
        "float64": "real",
        "float32": "real",
        "decimal": "number",
        "money": "number",
        "datetime": "datetime",
        "datetimetz": "timestamp_tz",
        "date": "date",
        "time": "time",
        "varbinary": "varbinary",
        "blob": "varbinary",
        "uuid": "varbinary",
        "bool": "boolean",
        "json": "variant",
        "xml": "text",
        "varbit": "text",
    },
    # a bare number has scale 0 and would round fractions away
    exact_create_types={"money": "number(19,4)"},
    sized_types={},
    decimal=DecimalType(38, 37, "real", name="number", exact="text"),
    money=None,
    load=LoadRules(rfc3339_timestamps=True, bare_uuid=True),
    literal=LiteralRules(
        binary=("X'", "'"),
        binary_compat={"varbinary": ("0x", ""), "blob": ("0x", "")},
        zone=" +00:00",
        uuid_bytes=("X'", "'"),
        backslash_escapes=True,
    ),
    keywords=KEYWORDS,
    reserved=RESERVED,
    upper_names=True,
    lists_keys=False,
    json_from_text="parse_json({})",
    read_options={"preferTimestampNTZ": "true", "fetchsize": "10000"},
)
