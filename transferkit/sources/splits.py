"""Equal-depth splits of a JDBC table: cuts at quantiles of a sample of its keys, over one column or several.

Ranges between the smallest and the largest key are as uneven as the keys are, and text, uuids and pairs have no
strides.  Here the database orders a sample of its keys and returns the keys at the quantiles, as many as there are
parts; between two of them lies a range in lexicographic order.  The database also compares, so its own order of
text decides on both sides, and no row can fall between two ranges or into both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from transferkit.operators.project import to_literals
from transferkit.types import ColumnInfo, column

# Sampled keys for each part: the parts then differ by some tenths.
SAMPLED_PER_PART = 200
# Canonical types whose values a database orders and a literal can name.
ORDERED = ("int64", "int32", "int16", "decimal", "money", "date", "datetime", "nvarchar", "varchar", "ntext", "text", "uuid")
TEXT = ("nvarchar", "varchar", "ntext", "text")


def split_keys(infos: list[ColumnInfo]) -> list[ColumnInfo]:
    """The primary-key columns a table can be cut along: all, or those before the first without an order."""
    found = []
    for i in infos:
        if i.primary_key:
            if i.type not in ORDERED:
                break
            found.append(i)
    return found


def sample_clause(system: str, fraction: float) -> tuple[str, str]:
    """What follows the table's name, and a condition, to read about so much of it."""
    if fraction >= 0.5:
        return "", ""
    percent = f"{100 * fraction:.6f}"
    return {
        "postgresql": (f" tablesample system ({percent})", ""),
        "mssql": (f" tablesample ({percent} percent)", ""),
        "mysql": ("", f"rand() < {fraction:.8f}"),
        "oracle": (f" sample ({percent})", ""),
        "snowflake": (f" sample ({percent})", ""),
    }[system]


def ordering(system: str, name: str, info: ColumnInfo) -> str:
    """Oracle orders text by the language of the client but compares its bytes."""
    return f"nlssort({name}, 'nls_sort=binary')" if system == "oracle" and info.type in TEXT else name


def cuts_query(system: str, table: str, names: list[str], infos: list[ColumnInfo], parts: int, fraction: float) -> str:
    """The first key of every part but the first, in order: ``parts`` rows at most."""
    sample, condition = sample_clause(system, fraction)
    known = " and ".join([f"{n} is not null" for n in names] + ([condition] if condition else []))
    order = ", ".join(ordering(system, n, i) for n, i in zip(names, infos))
    keys = ", ".join(names)
    place = f"(tk_row * {parts}) % tk_rows" if system == "mssql" else f"mod(tk_row * {parts}, tk_rows)"
    ranked = (
        f"select {keys}, row_number() over (order by {order}) - 1 as tk_row, count(*) over () as tk_rows "
        f"from {table}{sample} where {known}"
    )
    # the rows at which the number of the part grows
    return f"select {keys}, tk_row from ({ranked}) q where tk_row > 0 and {place} < {parts}"


def cut_literals(cuts: DataFrame, system: str, names: list[str]) -> list[list[str]]:
    """The cuts as literals of the system, in their order; the frame has one row per part at most."""
    ordered = cuts.orderBy(cuts.columns[-1]).select(*[column(c) for c in cuts.columns[:-1]])
    return [list(r) for r in to_literals(ordered, system, "null").select(*[column(c) for c in ordered.columns]).collect()]


def _compared(names: list[str], cut: list[str], sign: str, last: str) -> str:
    """A lexicographic comparison, led by one of the first column alone, which any index on it can serve."""
    condition = f"{names[-1]} {last} {cut[-1]}"
    if len(names) == 1:
        return condition
    for name, value in zip(names[-2::-1], cut[-2::-1]):
        condition = f"{name} {sign} {value} or ({name} = {value} and ({condition}))"
    return f"{names[0]} {sign}= {cut[0]} and ({condition})"


def at_or_after(names: list[str], cut: list[str]) -> str:
    return _compared(names, cut, ">", ">=")


def before(names: list[str], cut: list[str]) -> str:
    return _compared(names, cut, "<", "<")


def beyond(names: list[str], cut: list[str]) -> str:
    return _compared(names, cut, ">", ">")


def up_to(names: list[str], cut: list[str]) -> str:
    return _compared(names, cut, "<", "<=")


def range_predicates(names: list[str], cuts: list[list[str]], nullable: bool = False) -> list[str]:
    """Disjoint conditions that together hold for every row; rows with a NULL in the key have one of their own."""
    cuts = [c for n, c in enumerate(cuts) if n == 0 or c != cuts[n - 1]]
    known = " and ".join(f"{n} is not null" for n in names) if nullable else ""
    ranges = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        both = [at_or_after(names, low)] if low else []
        both += [before(names, high)] if high else []
        both += [known] if known else []
        ranges.append(" and ".join(both) or "1 = 1")
    return [*ranges, " or ".join(f"{n} is null" for n in names)] if nullable else ranges
