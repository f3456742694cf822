"""Profiles of the five database systems, keyed by name."""

from transferkit.systems.mssql import MSSQL
from transferkit.systems.mysql import MYSQL
from transferkit.systems.oracle import ORACLE
from transferkit.systems.postgresql import POSTGRESQL
from transferkit.systems.profile import SystemProfile
from transferkit.systems.snowflake import SNOWFLAKE

SYSTEMS: dict[str, SystemProfile] = {p.name: p for p in (POSTGRESQL, MSSQL, MYSQL, ORACLE, SNOWFLAKE)}


def profile(system: str) -> SystemProfile:
    try:
        return SYSTEMS[system]
    except KeyError:
        raise ValueError(f"unsupported system {system!r}; use one of {sorted(SYSTEMS)}") from None


__all__ = ["SYSTEMS", "SystemProfile", "profile"]
