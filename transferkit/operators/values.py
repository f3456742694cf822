"""What the values themselves say: sizes that no catalog gave, and tokens that no value holds.

Both are one pass of aggregates that merge map-side, over all rows; what comes to the driver is a few numbers for each
column, or the numbers of the tokens found.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferkit.types import BINARY, FREE_TEXT, META, TEXT, ColumnInfo, column, column_infos

BOUNDED = {"ntext": "nvarchar", "text": "varchar"}
WIDEST = 38  # digits of Spark's decimals
PLAIN_NUMBER = r"^[+-]?[0-9]*\.?[0-9]*$"
# Tokens are {k000}, {k001}, ...: an opening brace stands only first in them, so one cannot begin inside another.
TOKEN_DIGITS = 3


def _measures(c: Column, info: ColumnInfo) -> dict[str, Column]:
    nothing = F.lit(None).cast("int")
    out = dict.fromkeys(("integer_digits", "fraction_digits", "characters", "bytes"), nothing)
    if info.type in ("decimal", "money"):
        text = c.cast("string")
        whole = F.length(F.regexp_extract(text, r"^[+-]?0*([0-9]*)", 1))
        part = F.length(F.regexp_extract(text, r"\.([0-9]*?)0*$", 1))
        # a number in another form has no known digits, nor has its column
        odd = F.max((~text.rlike(PLAIN_NUMBER)).cast("int")) == 1
        out["integer_digits"] = F.when(~odd, F.max(whole))
        out["fraction_digits"] = F.when(~odd, F.max(part))
    elif info.type in FREE_TEXT or info.type in BINARY:
        out["bytes"] = F.max(F.octet_length(c))
        if info.type not in BINARY:
            out["characters"] = F.max(F.length(c))
    return out


def value_profile(df: DataFrame) -> DataFrame:
    """One row per column: NULLs, most digits before and after the point, most characters and bytes; NULL where a
    measure does not apply, the table is empty, or numbers are in exponent form."""
    infos = column_infos(df)
    if not infos:
        raise ValueError("a table without columns has no column to measure")
    found = [
        F.struct(
            F.lit(i.name).alias("column_name"),
            F.lit(n).alias("ordinal"),
            F.lit(i.type).alias("canonical_type"),
            F.count_if(column(i.name).isNull()).alias("nulls"),
            *[m.cast("int").alias(k) for k, m in _measures(column(i.name), i).items()],
        )
        for n, i in enumerate(infos, start=1)
    ]
    return df.agg(F.array(*found).alias("columns")).select(F.inline("columns"))


def sized_by_values(df: DataFrame) -> DataFrame:
    """The table with the smallest sizes that hold its values, where its columns have none.

    Numbers without a size that travel as text become decimals of up to 38 digits; wider ones, and those in exponent
    form, stay text.  Texts and bytes without a length get that of the longest value, and unbounded text becomes bounded:
    keys need that on most systems.  Sizes that are known stay; an empty column gets none.  Later loads may bring longer
    values than these.
    """
    unsized = [
        i
        for i in column_infos(df)
        if (i.type == "decimal" and i.spark_type() == T.StringType()) or (i.type in TEXT + BINARY and not i.has_length)
    ]
    if not unsized:
        return df
    measured = value_profile(df.select(*[column(i.name) for i in unsized])).collect()  # a row per column
    known = {r.column_name: r for r in measured}
    out = []
    for info in column_infos(df):
        c, row = column(info.name), known.get(info.name)
        if row is None:
            out.append(c)
            continue
        if info.type == "decimal":
            digits = (row.integer_digits, row.fraction_digits)
            precision = None if None in digits else max(1, sum(digits))
            if precision and precision <= WIDEST:
                info = replace(info, precision=precision, scale=row.fraction_digits)
                c = c.cast(T.DecimalType(precision, row.fraction_digits))
        elif size := (row.bytes if info.type in BINARY else row.characters):
            info = replace(info, type=BOUNDED.get(info.type, info.type), length=size)
        out.append(c.alias(info.name, metadata={META: info.metadata()}))
    return df.select(*out)


def free_tokens(text: DataFrame, n: int = 3) -> list[str]:
    """``n`` tokens that no value of the text columns holds, for NULLs and separators.

    The numbers of the tokens that values do hold are collected as a set, of some thousands at most.
    """
    columns = [column(i.name) for i in column_infos(text) if i.type in FREE_TEXT]
    digits = TOKEN_DIGITS
    while True:
        taken: set[int] = set()
        if columns:
            pattern = rf"\{{k([0-9a-f]{{{digits}}})\}}"
            nothing = F.expr("array()").cast("array<string>")
            held = [F.when(F.contains(c, F.lit("{k")), F.regexp_extract_all(c, F.lit(pattern), F.lit(1))) for c in columns]
            held = F.flatten(F.array(*[F.coalesce(h, nothing) for h in held]))
            taken = {int(r[0], 16) for r in text.select(F.explode(held)).distinct().collect()}
        free = [i for i in range(len(taken) + n) if i not in taken and i < 16**digits][:n]
        if len(free) == n:
            return [f"{{k{i:0{digits}x}}}" for i in free]
        digits += 1
