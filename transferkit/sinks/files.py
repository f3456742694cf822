"""Staged files, load files per target, and the statements that load them.

Rows are encoded and written in the same stage as they are read: no shuffle, no second pass.  The
job commit makes a folder of files all-or-nothing, also when executors are lost.
"""

from __future__ import annotations

import uuid
from shlex import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transferkit.functions.identifiers import qualify_name, quote_name, string_literal
from transferkit.functions.load import null_as_empty
from transferkit.functions.text import may_hold, refuse_token
from transferkit.operators.project import key_columns, to_canonical, to_load
from transferkit.operators.sizing import file_number, max_byte_length
from transferkit.session import file_paths
from transferkit.systems import profile
from transferkit.types import BINARY, FREE_TEXT, ColumnInfo, column, column_infos

DELIMITER = "{dlm}"
NEWLINE = "{nwln}"
FILE_NUMBER = "file_number"

# What must be quoted: separators, quotes, line ends, outer blanks, the empty text (an unquoted one is a
# NULL to some loaders), and \. which ends the input of PostgreSQL's copy.
NEEDS_QUOTES = r"""[",\r\n]|^[ \t]|[ \t]$|^$|^\\\.$"""


def _check_token(token: str) -> None:
    if not token or any(ch in token for ch in ',"\r\n'):
        raise ValueError("a null token must not be empty or hold commas, quotes or line ends")


def csv_lines(text: DataFrame, null: str, compat: bool = False, quote_clash: bool = False) -> DataFrame:
    """RFC 4180 records of text columns, NULL as the bare token.

    Only free text and empty bytes can need quotes; the other columns are joined as they are.
    """
    _check_token(null)

    def field(info: ColumnInfo) -> Column:
        c = column(info.name)
        if info.type in FREE_TEXT:
            doubled = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
            needs = c.rlike(NEEDS_QUOTES)
            if quote_clash:
                return F.coalesce(F.when(needs | (c == F.lit(null)), doubled).otherwise(c), F.lit(null))
            safe = refuse_token(c, null, info, compat)
            return F.coalesce(F.when(needs, doubled).otherwise(safe), F.lit(null))
        safe = refuse_token(c, null, info, compat)
        if info.type in BINARY:  # the hex text of no bytes is empty
            safe = F.when(c == F.lit(""), F.lit('""')).otherwise(safe)
        return F.coalesce(safe, F.lit(null))

    return text.select(F.concat_ws(",", *[field(i) for i in column_infos(text)]).alias("value"))


def _write_lines(lines: DataFrame, path: str, newline: str, mode: str, target_file_bytes: int | None) -> None:
    if target_file_bytes:
        size = F.octet_length("value") + F.lit(len(newline.encode()))
        numbered = lines.withColumn(FILE_NUMBER, file_number(size, target_file_bytes))
        writer = numbered.write.partitionBy(FILE_NUMBER)
    else:
        writer = lines.write
    writer.mode(mode).option("lineSep", newline).text(path)


def write_staged(
    df: DataFrame,
    path: str,
    source: str | None = None,
    null: str = "{nll}",
    target_file_bytes: int | None = None,
    mode: str = "error",
    compat: bool = False,
) -> list[ColumnInfo]:
    """Canonical text as RFC 4180 files; returns the column descriptions to read them with.

    With ``target_file_bytes`` no file holds more bytes than that, unless a single row does: every task fills its files
    one after the other, all but its last to within a row.  Files of one number, of all tasks, are in one folder.
    Without it a file is what one task writes, which ``spark.sql.files.maxPartitionBytes`` bounds.
    """
    text = to_canonical(df, source, None, compat)
    _write_lines(csv_lines(text, null, compat), path, "\n", mode, target_file_bytes)
    return column_infos(df)


def write_keys(
    df: DataFrame, path: str, source: str | None = None, null: str = "{nll}", mode: str = "error"
) -> list[ColumnInfo]:
    """The primary-key columns only, beside the staged rows."""
    return write_staged(key_columns(df), path, source, null, mode=mode)


def multichar_lines(text: DataFrame, delimiter: str = DELIMITER, newline: str = NEWLINE) -> DataFrame:
    """Unquoted lines with a delimiter of several characters; NULL is an empty field.

    There is no escape in this format, so a value holding a separator stops the job.
    """

    if not delimiter or not newline:
        raise ValueError("the delimiter and the newline text must not be empty")

    def safe(info: ColumnInfo) -> Column:
        c = column(info.name)
        if not (may_hold(info, delimiter) or may_hold(info, newline)):
            return null_as_empty(c)
        bad = F.raise_error(F.lit(f"column {info.name} holds the delimiter or the newline text"))
        clash = F.contains(c, F.lit(delimiter)) | F.contains(c, F.lit(newline))
        return null_as_empty(F.when(clash, bad.cast("string")).otherwise(c))

    return text.select(F.concat_ws(delimiter, *[safe(i) for i in column_infos(text)]).alias("value"))


def write_load(
    df: DataFrame,
    path: str,
    target: str,
    source: str | None = None,
    null: str | None = None,
    delimiter: str = DELIMITER,
    newline: str = NEWLINE,
    target_file_bytes: int | None = None,
    mode: str = "error",
    compat: bool = False,
    quote_clash: bool = False,
    lengths: Observation | None = None,
) -> list[ColumnInfo]:
    """Files ready for ``target``'s bulk loader; returns the column descriptions.

    ``lengths`` gets the longest text of every column, in bytes, from the job that writes the files.

    A text equal to the NULL token stops the job.  PostgreSQL and MySQL tell a quoted token from a bare one,
    so ``quote_clash`` lets such values through there, in quotes; ``read_load`` cannot tell the two.
    """
    if quote_clash and target not in ("postgresql", "mysql"):
        raise ValueError(f"the loader of {target} cannot tell a quoted null token from NULL")
    text = to_load(df, target, None, compat, source)
    if lengths is not None:
        text = text.observe(lengths, *[F.max(F.octet_length(column(c))).alias(c) for c in text.columns])
    if target == "mssql":
        lines = multichar_lines(text, delimiter, newline)
    else:
        lines, newline = csv_lines(text, null or profile(target).null_token, compat, quote_clash), "\n"
    _write_lines(lines, path, newline, mode, target_file_bytes)
    return column_infos(df)


# Field formats of Oracle's loader.
CONTROL_FORMATS = {
    "date": "date 'YYYY-MM-DD'",
    "datetime": "timestamp 'YYYY-MM-DD HH24:MI:SS.FF'",
    "datetimetz": "timestamp with time zone 'YYYY-MM-DD HH24:MI:SS.FF TZH:TZM'",
}


def _control(infos: list[ColumnInfo], sizes: dict[str, Column], table: str, schema: str | None, null: str, compat: bool) -> Column:
    fields: list[Column] = []
    for i in infos:
        name = i.name if compat else quote_name(i.name, "oracle")
        nullif = f" nullif {name} = {string_literal(null)}"
        if i.type in CONTROL_FORMATS:
            fields.append(F.lit(f"{name} {CONTROL_FORMATS[i.type]}{nullif}"))
        else:
            fields.append(F.concat(F.lit(f"{name} char("), sizes[i.name].cast("string"), F.lit(f") preserve blanks{nullif}")))
    head = f"load data\ncharacterset al32utf8\nappend into table {qualify_name(schema, table, 'oracle')}\nfields csv with embedded\n(\n  "
    return F.concat(F.lit(head), F.concat_ws(",\n  ", *fields), F.lit("\n)"))


def control_text(
    df: DataFrame, table: str, schema: str | None = None, null: str = "{nll}", compat: bool = False
) -> DataFrame:
    """One row: the control text of Oracle's loader for the load files of ``df``, whichever they are.

    Field lengths are the longest values of the data, measured in one aggregation.
    """
    infos = column_infos(df)
    text = to_load(df, "oracle", None, compat)
    sized = [i.name for i in infos if i.type not in CONTROL_FORMATS]
    lengths = (
        max_byte_length(text.select(*[column(c) for c in sized]), null, encoded=True)
        if sized
        else df.sparkSession.range(1)
    )
    sizes = {c: column(c) for c in sized}
    return lengths.select(_control(infos, sizes, table, schema, null, compat).alias("control"))


def write_control(
    spark: SparkSession,
    path: str,
    infos: list[ColumnInfo],
    lengths: dict[str, int | None],
    table: str,
    schema: str | None = None,
    null: str = "{nll}",
    compat: bool = False,
) -> str:
    """Write the control text for files whose longest values are known; returns the file's path."""
    margin = len(null.encode())
    sizes = {i.name: F.lit(max(lengths.get(i.name) or 0, margin) + margin) for i in infos}
    text = spark.range(1).select(_control(infos, sizes, table, schema, null, compat).alias("value"))
    text.coalesce(1).write.text(path)
    return f"{path}/{data_files(spark, path)[0]}"


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files with rows, as paths from a folder on, without markers and hidden files."""
    return file_paths(spark, path)


def client_path(path: str) -> str:
    """A path as a loader on this machine takes it; loaders can't open what only Hadoop can."""
    scheme, sep, rest = path.partition(":")
    if not sep or len(scheme) == 1:
        return path
    if scheme != "file":
        raise ValueError(f"loaders cannot open {path}; say where their machine sees it")
    return "/" + rest.lstrip("/")


def load_commands(
    target: str,
    table: str,
    files: list[str],
    columns: list[ColumnInfo],
    schema: str | None = None,
    null: str | None = None,
    delimiter: str = DELIMITER,
    newline: str = NEWLINE,
    database: str = "",
    load_id: str | None = None,
    control: str | None = None,
) -> list[str]:
    """What to run in the target's own client to load files of ``write_load``, file by file.

    Columns are loaded by position on every system but Oracle, whose ``control`` file names them.
    ``load_id`` names the load's folder in a Snowflake stage; a new name by default.
    """
    files = [client_path(f) for f in files]
    token = null or profile(target).null_token
    full = qualify_name(schema, table, target)
    if target == "postgresql":
        options = f"format csv, null {string_literal(token)}, encoding 'UTF8'"
        return [f"\\copy {full} from {string_literal(f)} with ({options})" for f in files]
    if target == "mysql":
        binary = {c.name for c in columns if c.type in ("varbinary", "blob", "uuid")}
        fields, sets = [], []
        for n, c in enumerate(columns):
            name = quote_name(c.name, target)
            fields.append(f"@f{n}" if c.name in binary else name)
            if c.name in binary:  # hex text becomes bytes on the way in
                sets.append(f"{name} = unhex(@f{n})")
        tail = f" ({', '.join(fields)}) set {', '.join(sets)}" if sets else ""
        return [
            f"load data local infile {string_literal(f)} into table {full} character set utf8mb4 "
            f"fields terminated by ',' optionally enclosed by '\"' escaped by '' lines terminated by '\\n'{tail}"
            for f in files
        ]
    if target == "mssql":
        owner = f"{quote_name(database, target)}." if database else ""
        return [
            " ".join(["bcp", quote(owner + full), "in", quote(f), "-c -C 65001 -t", quote(delimiter), "-r", quote(newline)])
            for f in files
        ]
    if target == "oracle":
        if not control:
            raise ValueError("oracle loads need a control file")
        return [f"sqlldr control={quote(client_path(control))} data={quote(f)}" for f in files]
    if not schema:
        raise ValueError("snowflake needs a schema for its stage")
    stage = f"{quote_name(schema, target)}.transferkit_stage"
    place = f"{stage}/{load_id or uuid.uuid4().hex}"
    # options in the statement itself: a named format could be one of an earlier load with another token
    csv = (
        "type = csv field_optionally_enclosed_by = '\"' escape_unenclosed_field = none "
        f"empty_field_as_null = false null_if = ({string_literal(token)})"
    )
    out = [f"create stage if not exists {stage}"]
    for f in files:
        # files of one task have one name, so each folder of files has a place of its own
        folder, name = f.rsplit("/", 1) if "/" in f else ("", f)
        own = folder.rsplit("/", 1)[-1]
        at = f"{place}/{own}" if own.startswith(f"{FILE_NUMBER}=") else place
        out.append(f"put {string_literal('file://' + f)} @{at} auto_compress = false")
        out.append(f"copy into {full} from @{at}/{name} file_format = ({csv})")
    return out
