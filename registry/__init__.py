"""The runnable queries, each next to the SQL that says what it must return."""

from registry import catalogs, loads, scans, targets, values

MODULES = (scans, values, targets, catalogs, loads)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
