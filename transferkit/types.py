"""The canonical column types every transfer passes through, and how they sit on Spark types.

A column's canonical type travels in its field metadata, so a DataFrame keeps it through
``select``/``filter``/``join`` without a side table.  A column without metadata gets the canonical
type of its Spark type.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The canonical type names, by family.
SIZED_TEXT = ("nvarchar", "varchar")
UNSIZED_TEXT = ("ntext", "text")
TEXT = SIZED_TEXT + UNSIZED_TEXT
INTEGERS = ("int64", "int32", "int16")
FLOATS = ("float64", "float32")
DECIMALS = ("decimal", "money")
TIMESTAMPS = ("datetime", "datetimetz")
BINARY = ("varbinary", "blob")
OTHERS = ("date", "time", "uuid", "bool", "json", "xml", "varbit")
# Types whose text is whatever the source holds.
FREE_TEXT = TEXT + ("json", "xml", "uuid", "varbit", "time")
CANONICAL_TYPES = TEXT + INTEGERS + FLOATS + DECIMALS + TIMESTAMPS + BINARY + OTHERS

META = "canonical"
_CHAR_TYPE = "__CHAR_VARCHAR_TYPE_STRING"


@dataclass(frozen=True)
class ColumnInfo:
    """What a transfer knows about one column; sizes of -1 mean unknown."""

    name: str
    type: str
    precision: int = -1
    scale: int = -1
    length: int = -1
    nullable: bool = True
    primary_key: bool = False

    @property
    def has_decimal_size(self) -> bool:
        return self.precision > 0 or self.scale > 0

    @property
    def has_length(self) -> bool:
        return self.length > 0

    def metadata(self) -> dict:
        return {
            "type": self.type,
            "precision": self.precision,
            "scale": self.scale,
            "length": self.length,
            "primary_key": self.primary_key,
        }

    def spark_type(self) -> T.DataType:
        """The Spark type that holds this column's values without loss."""
        if self.type == "decimal":
            if 0 < self.precision <= 38 and 0 <= self.scale <= self.precision:
                return T.DecimalType(self.precision, self.scale)
            return T.StringType()
        if self.type == "money":
            return T.DecimalType(19, 4)
        return {
            "int64": T.LongType(),
            "int32": T.IntegerType(),
            "int16": T.ShortType(),
            "float64": T.DoubleType(),
            "float32": T.FloatType(),
            "datetime": T.TimestampNTZType(),
            "datetimetz": T.TimestampType(),
            "date": T.DateType(),
            "varbinary": T.BinaryType(),
            "blob": T.BinaryType(),
            "bool": T.BooleanType(),
        }.get(self.type, T.StringType())


def _from_spark_type(field: T.StructField) -> ColumnInfo:
    dt, name, nullable = field.dataType, field.name, field.nullable
    declared = (field.metadata or {}).get(_CHAR_TYPE, "")
    sized = re.match(r"(?:var)?char\((\d+)\)", declared)
    if sized or isinstance(dt, (T.CharType, T.VarcharType)):
        length = int(sized.group(1)) if sized else dt.length
        return ColumnInfo(name, "nvarchar", length=length, nullable=nullable)
    if isinstance(dt, T.DecimalType):
        return ColumnInfo(name, "decimal", dt.precision, dt.scale, nullable=nullable)
    simple = {
        T.StringType: "ntext",
        T.LongType: "int64",
        T.IntegerType: "int32",
        T.ShortType: "int16",
        T.ByteType: "int16",
        T.DoubleType: "float64",
        T.FloatType: "float32",
        T.TimestampNTZType: "datetime",
        T.TimestampType: "datetimetz",
        T.DateType: "date",
        T.BinaryType: "blob",
        T.BooleanType: "bool",
        T.DayTimeIntervalType: "nvarchar",
        T.YearMonthIntervalType: "nvarchar",
        T.VariantType: "json",
    }
    for spark_type, canonical in simple.items():
        if isinstance(dt, spark_type):
            return ColumnInfo(name, canonical, nullable=nullable)
    raise TypeError(
        f"column {name} of type {dt.simpleString()} has no canonical type; "
        "turn it into JSON text first with nested_as_json(df)"
    )


def column_info(field: T.StructField) -> ColumnInfo:
    meta = (field.metadata or {}).get(META)
    if meta is None:
        return _from_spark_type(field)
    return ColumnInfo(
        field.name,
        meta["type"],
        meta.get("precision", -1),
        meta.get("scale", -1),
        meta.get("length", -1),
        field.nullable,
        meta.get("primary_key", False),
    )


def column_infos(df_or_schema) -> list[ColumnInfo]:
    """Canonical description of every column of a DataFrame or schema, in order."""
    schema = getattr(df_or_schema, "schema", df_or_schema)
    return [column_info(f) for f in schema.fields]


def tag(
    df: DataFrame,
    types: dict[str, str] | None = None,
    lengths: dict[str, int] | None = None,
    keys: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Write canonical types, text lengths and key flags into the columns' metadata."""
    types, lengths = types or {}, lengths or {}
    unknown = (set(types) | set(lengths) | set(keys)) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    out = []
    for f in df.schema.fields:
        if f.name in types:
            bad = types[f.name] not in CANONICAL_TYPES
            if bad:
                raise ValueError(f"unsupported canonical type for {f.name}: {types[f.name]}")
            info = ColumnInfo(f.name, types[f.name], nullable=f.nullable)
            if isinstance(f.dataType, T.DecimalType):
                info = replace(info, precision=f.dataType.precision, scale=f.dataType.scale)
        else:
            info = column_info(f)
        info = replace(
            info,
            length=lengths.get(f.name, info.length),
            primary_key=f.name in keys or info.primary_key,
        )
        out.append(F.col(_q(f.name)).alias(f.name, metadata={META: info.metadata()}))
    return df.select(*out)


def apply_infos(df: DataFrame, infos: list[ColumnInfo]) -> DataFrame:
    """Attach known column descriptions (say, from a source's catalog) to a DataFrame by position."""
    if len(infos) != len(df.columns):
        raise ValueError(f"{len(infos)} column descriptions for {len(df.columns)} columns")
    return df.select(
        *[
            F.col(_q(c)).alias(i.name, metadata={META: i.metadata()})
            for c, i in zip(df.columns, infos)
        ]
    )


def nested_as_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs have no canonical type; send them as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(_q(f.name)).alias(f.name, metadata={META: ColumnInfo(f.name, "json").metadata()})
            if isinstance(f.dataType, nested)
            else F.col(_q(f.name))
            for f in df.schema.fields
        ]
    )


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str):
    """A column by its exact name, also when the name has dots, blanks or backticks."""
    return F.col(_q(name))
