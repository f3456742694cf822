from transferkit.systems.profile import UNSIZED_NUMBER_KEY, DecimalType, LiteralRules, LoadRules, SizedType, SystemProfile

# MySQL type names.
CATALOG_TYPES = {
    "nvarchar": "char, varchar, enum, set",
    "varchar": "year",
    "ntext": "longtext, mediumtext, text, tinytext",
    "int64": "bigint",
    "int32": "int, mediumint",
    "int16": "smallint, tinyint",
    "float64": "double",
    "float32": "float",
    "decimal": "decimal",
    "datetime": "datetime, timestamp",
    "date": "date",
    "time": "time",
    "varbinary": "binary, varbinary",
    "blob": "longblob, mediumblob, blob, tinyblob, geometry",
    "json": "json",
    "varbit": "bit",
}
RESULT_TYPES = {
    "nvarchar": "CHAR, VARCHAR",
    "ntext": "TEXT",
    "int64": "BIGINT, UNSIGNED BIGINT, UNSIGNED INT",
    "int32": "INT, MEDIUMINT, UNSIGNED SMALLINT",
    "int16": "SMALLINT, TINYINT, UNSIGNED TINYINT, YEAR",
    "float64": "DOUBLE",
    "float32": "FLOAT",
    "decimal": "DECIMAL",
    "datetime": "DATETIME",
    "datetimetz": "TIMESTAMP",
    "date": "DATE",
    "time": "TIME",
    "blob": "BINARY, VARBINARY, BLOB, GEOMETRY",
    "json": "JSON",
    "varbit": "BIT",
}
# Further names of the JDBC driver.
STATEMENT_TYPES = {
    "nvarchar": "enum, set",
    "ntext": "tinytext, mediumtext, longtext",
    "blob": "tinyblob, mediumblob, longblob",
    "int32": "unsigned mediumint",
}

MYSQL = SystemProfile(
    name="mysql",
    driver="com.mysql.cj.jdbc.Driver",
    catalog_types=CATALOG_TYPES,
    result_types=RESULT_TYPES,
    statement_types=STATEMENT_TYPES,
    # one mapping for both paths: the wider canonical type; unsigned 64-bit does not fit int64
    corrections={
        "binary": "blob",
        "varbinary": "blob",
        "timestamp": "datetimetz",
        "year": "int16",
        "unsigned bigint": "decimal",
        "unsigned int": "int64",
        "unsigned mediumint": "int32",
        "unsigned smallint": "int32",
        "unsigned tinyint": "int16",
    },
    create_types={
        "nvarchar": "longtext",
        "varchar": "longtext",
        "ntext": "longtext",
        "text": "longtext",
        "int64": "bigint",
        "int32": "integer",
        "int16": "smallint",
        "float64": "double",
        "float32": "float",
        "datetime": "datetime",
        "datetimetz": "datetime",
        "date": "date",
        "time": "time",
        "varbinary": "blob",
        "blob": "blob",
        "uuid": "binary(16)",
        "bool": "tinyint(1)",
        "json": "json",
        "xml": "longtext",
        "varbit": "longtext",
    },
    # datetime and time without (6) round to whole seconds; blob ends at 65,535 bytes.  A zone-aware
    # MySQL timestamp ends in 2038, so instants stay UTC datetimes.
    exact_create_types={
        "datetime": "datetime(6)",
        "datetimetz": "datetime(6)",
        "time": "time(6)",
        "varbinary": "longblob",
        "blob": "longblob",
    },
    sized_types={},
    decimal=DecimalType(65, 30, "double", max_scale_compat=65, exact="longtext"),
    money=DecimalType(65, 30, "decimal(19,4)", fallback_compat="float"),
    # an index entry has at most 3,072 bytes, four to a character; texts and blobs need a length, JSON has no order
    key_types={
        **dict.fromkeys(("nvarchar", "varchar", "ntext", "text", "xml", "varbit"), SizedType("varchar", 1, 768, "", "")),
        **dict.fromkeys(("varbinary", "blob"), SizedType("varbinary", 1, 3072, "", "")),
        "json": "",
        "decimal": UNSIZED_NUMBER_KEY,
    },
    load=LoadRules(bare_uuid_exact=True, bool_digits_exact=True),
    literal=LiteralRules(
        binary=("UNHEX('", "')"),
        binary_compat={"varbinary": ("UNHEX('", "')"), "blob": ("UNHEX('", "'")},
        uuid_bytes=("UNHEX('", "')"),
        backslash_escapes=True,
    ),
    quotes=("`", "`"),
    quote_all=True,
    schema_required=False,
    null_token="NULL",
    not_found="doesn't exist",
    # without a cursor the client buffers a partition's whole result
    read_options={
        "preferTimestampNTZ": "true",
        "fetchsize": "10000",
        "useCursorFetch": "true",
        "connectionTimeZone": "UTC",
        "yearIsDateType": "false",
    },
    write_options={"rewriteBatchedStatements": "true", "connectionTimeZone": "UTC"},
)
