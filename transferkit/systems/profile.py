"""What differs between database systems, as data.  There is no class per system or per pair."""

from __future__ import annotations

from dataclasses import dataclass, field


# Holds the text of every number a source can send: 38 digits and an exponent of three, or 255 digits written out.
UNSIZED_NUMBER_KEY = "varchar(255)"


@dataclass(frozen=True)
class SizedType:
    """A type with a length: ``name(factor * length)`` up to ``limit``, else ``overflow``."""

    name: str
    factor: int
    limit: int
    overflow: str
    unsized: str  # historical type where the length is unknown


@dataclass(frozen=True)
class DecimalType:
    """``decimal(p,s)`` where the target can hold it, else ``fallback``."""

    max_precision: int
    max_scale: int
    fallback: str
    fallback_compat: str = ""
    max_scale_compat: int = 0
    name: str = "decimal"
    separator: str = ","
    min_scale_compat: int = 1  # historical rule: a scale of zero is not accepted
    scale_equal_compat: bool = False  # historical rule: precision must exceed scale
    exact: str = ""  # for sizes that are unknown or do not fit, where ``fallback`` would cut values


@dataclass(frozen=True)
class LoadRules:
    rfc3339_timestamps: bool = False
    offset: str = ""  # zone suffix of datetimetz text
    exact_offset: str = ""
    binary_prefix: str = ""
    bare_uuid: bool = False
    bare_uuid_exact: bool = False
    bool_digits: bool = False
    bool_digits_exact: bool = False
    empty_as_nul: bool = False


@dataclass(frozen=True)
class LiteralRules:
    binary: tuple[str, str]
    binary_compat: dict[str, tuple[str, str]]
    timestamp: tuple[str, str] = ("'", "'")
    zoned_timestamp: tuple[str, str] = ("'", "'")
    zone: str = ""
    date: tuple[str, str] = ("'", "'")
    long_dates: bool = False
    uuid_bytes: tuple[str, str] | None = None
    bool_digits: bool = False
    bool_digits_exact: bool = False
    bits: tuple[str, str] = ("'", "'")
    backslash_escapes: bool = False


@dataclass(frozen=True)
class SystemProfile:
    name: str
    driver: str
    catalog_types: dict[str, str]  # canonical type -> names in the system's catalog
    result_types: dict[str, str]  # canonical type -> names in result-set metadata
    corrections: dict[str, str]  # lower-case type names mapped to a wider canonical type by default
    create_types: dict[str, str]
    exact_create_types: dict[str, str]
    sized_types: dict[str, SizedType]
    decimal: DecimalType | None
    money: DecimalType | None
    load: LoadRules
    literal: LiteralRules
    # canonical type -> further names that the JDBC driver gives in the metadata of a statement
    statement_types: dict[str, str] = field(default_factory=dict)
    # canonical types whose column type cannot be a key: what a key column gets instead, '' for nothing
    key_types: dict[str, SizedType | str] = field(default_factory=dict)
    quotes: tuple[str, str] = ('"', '"')
    schema_required: bool = True
    keywords: str = ""
    reserved: tuple[str, ...] = ()  # lower-case words of the vendor's manual; without: ``keywords``
    keyword_case: str = "lower"  # case the word list is written in
    keywords_compat: bool = True  # whether the historical quoting knew the words
    quote_all: bool = False  # quote every name: quotes change nothing there but the words allowed
    null_token: str = "{nll}"
    not_found: str = "does not exist"  # text of the system's missing-table error
    upper_names: bool = False
    lists_keys: bool = True
    loads_by_name: bool = False  # otherwise first column to first column
    json_from_text: str = ""  # call that turns text into the system's JSON type, where a cast is needed
    read_options: dict[str, str] = field(default_factory=dict)
    write_options: dict[str, str] = field(default_factory=dict)

    def type_rows(self, path: str, compat: bool) -> list[tuple[str, str]]:
        """(lower-case type name, canonical type) of the table path (the system's catalog), the query path (result-set
        metadata), or of JDBC statements, whose drivers use names of both and some of their own."""
        sources = {
            "table": [self.catalog_types],
            "query": [self.result_types],
            "statement": [self.catalog_types, self.result_types, self.statement_types],
        }
        if path not in sources:
            raise ValueError(f"path must be 'table', 'query' or 'statement', not {path!r}")
        rows = {
            n.strip().lower(): canonical
            for source in sources[path]
            for canonical, names in source.items()
            for n in names.split(",")
        }
        if not compat:
            rows.update(self.corrections)
        return sorted(rows.items())

    def reserved_words(self, compat: bool = False) -> list[str]:
        """Lower-case words that are no plain names; ``compat``: as the historical quoting had them."""
        if self.reserved and not compat:
            return list(self.reserved)
        return [w.strip() for w in self.keywords.replace("\n", " ").split(",") if w.strip()]
