"""A place to read from or write to, and the settings JDBC needs for it."""

from __future__ import annotations

from dataclasses import dataclass, field

from transferkit.systems import SystemProfile, profile


@dataclass(frozen=True)
class Endpoint:
    """A database system, and where its tables are.

    ``url``   a JDBC database: tables are read and written over JDBC.
    ``path``  a folder: tables are Spark files under it, one folder or file per table.
    neither   the Spark catalog of the session.

    ``system`` sets the type, text and identifier rules in every case.
    """

    system: str
    url: str | None = None
    path: str | None = None
    file_format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        profile(self.system)
        if self.url and self.path:
            raise ValueError("an endpoint has a url or a path, not both")
        if self.url and not self.url.startswith("jdbc:"):
            raise ValueError("url must be a JDBC url")

    @property
    def profile(self) -> SystemProfile:
        return profile(self.system)

    @property
    def is_jdbc(self) -> bool:
        return self.url is not None

    def read_options(self) -> dict[str, str]:
        p = self.profile
        return {"url": self.url, "driver": p.driver, **p.read_options, **self.options}

    def write_options(self) -> dict[str, str]:
        p = self.profile
        return {"url": self.url, "driver": p.driver, **p.write_options, **self.options}


@dataclass(frozen=True)
class Partitioning:
    """Parallel JDBC read: ``partitions`` range queries over a numeric, date or timestamp column.

    Bounds only set the strides; rows outside them, and NULLs, go to the outer partitions.
    """

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def hash_predicates(column: str, partitions: int, system: str) -> list[str]:
    """Disjoint predicates that split a table evenly whatever the distribution of an integer key, for
    keys too skewed for range strides.  NULL keys get a predicate of their own."""
    mod = f"mod({column}, {partitions})"
    if system == "mssql":
        mod = f"({column} % {partitions})"
    return [f"abs({mod}) = {i}" for i in range(partitions)] + [f"{column} is null"]
