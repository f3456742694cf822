"""All registered queries of the subpackage, and the SQL of those that SQL can express."""

from transferkit.llm import queries_copies, queries_filters, queries_models, queries_search

MODULES = (queries_filters, queries_models, queries_copies, queries_search)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
