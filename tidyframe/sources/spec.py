"""Source spec: validated when built, before any Spark job runs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from tidyframe.errors import SpecError

FILE_FORMATS = ("csv", "json", "parquet", "xml")
# Database kinds that share the one JDBC reader (the driver jar is the user's).
JDBC_KINDS = ("jdbc", "sqlite", "postgresql", "mysql", "sqlserver")

HEADERS = ("match", "by_name", "position")
UNKNOWN_COLUMNS = ("raise", "keep", "drop")

_JDBC_PARTITION_KEYS = ("partition_column", "lower_bound", "upper_bound", "num_partitions")


def schema_from_files_ok(spec: "SourceSpec") -> bool:
    """Can the schema be taken from existing files without scanning data?

    CSV without ``inferSchema`` needs only the header line (all columns are
    strings); Parquet needs only file footers.  JSON / XML inference reads
    every record, a full extra pass at scale.
    """
    if spec.format == "parquet":
        return True
    return spec.format == "csv" and spec.options.get("inferSchema", "false").lower() != "true"


def _opt_str(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def normalize_options(options: Mapping | None) -> dict[str, str]:
    return {str(k): _opt_str(v) for k, v in (options or {}).items()}


@dataclass(frozen=True)
class SourceSpec:
    """Where and how to read.

    Files: ``format`` in FILE_FORMATS, ``path`` (a glob such as
    ``raw/vitals_*.csv`` unions every match), reader ``options`` and an optional
    ``schema`` (DDL string or StructType; without it CSV columns are strings).
    ``file_path_col`` adds each row's source file (lineage).

    CSV files with a header: ``headers="match"`` fails on a file whose header is not
    the schema's, ``"by_name"`` reads each file by its own header (columns that a file lacks are
    NULL, ``unknown_columns`` raise, are kept as text or are dropped), and ``"position"`` ignores
    the names, as Spark does by itself.

    JDBC: ``format`` in JDBC_KINDS with ``url``, ``driver`` and ``table`` or
    ``query``.  Give ``partition_column/lower_bound/upper_bound/num_partitions``
    (all four) or ``predicates`` to read in parallel; otherwise one task reads
    the whole table.
    """

    format: str
    path: str | tuple[str, ...] | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | StructType | None = None
    file_path_col: str | None = None
    url: str | None = None
    driver: str | None = None
    table: str | None = None
    query: str | None = None
    partition_column: str | None = None
    lower_bound: int | str | None = None
    upper_bound: int | str | None = None
    num_partitions: int | None = None
    predicates: tuple[str, ...] | None = None
    fetchsize: int | None = None
    headers: str = "match"
    unknown_columns: str = "raise"

    def __post_init__(self):
        fmt = (self.format or "").lower()
        object.__setattr__(self, "format", fmt)
        object.__setattr__(self, "options", normalize_options(self.options))
        if isinstance(self.path, list):
            object.__setattr__(self, "path", tuple(self.path))
        if isinstance(self.predicates, list):
            object.__setattr__(self, "predicates", tuple(self.predicates))
        self.validate()

    @property
    def is_jdbc(self) -> bool:
        return self.format in JDBC_KINDS

    @property
    def has_header(self) -> bool:
        return self.format == "csv" and self.options.get("header", "false").lower() == "true"

    def validate(self) -> None:
        if self.format in FILE_FORMATS:
            if not self.path:
                raise SpecError(f"{self.format} source needs a path")
            if self.format == "xml" and "rowTag" not in self.options:
                raise SpecError("xml source needs options.rowTag")
            if self.headers not in HEADERS:
                raise SpecError(f"source headers must be one of {HEADERS}")
            if self.unknown_columns not in UNKNOWN_COLUMNS:
                raise SpecError(f"source unknown_columns must be one of {UNKNOWN_COLUMNS}")
            if self.headers == "by_name" and not self.has_header:
                raise SpecError("headers='by_name' needs a csv source with options.header")
            if self.headers == "by_name" and self.options.get("inferSchema", "false").lower() == "true":
                raise SpecError("headers='by_name' takes types from the schema, not from inferSchema")
            return
        if self.format not in JDBC_KINDS:
            raise SpecError(
                f"unsupported source format {self.format!r}; "
                f"use one of {FILE_FORMATS + JDBC_KINDS}"
            )
        missing = [k for k in ("url", "driver") if not getattr(self, k)]
        if missing:
            raise SpecError(f"jdbc source needs {missing}")
        if bool(self.table) == bool(self.query):
            raise SpecError("jdbc source needs exactly one of table / query")
        given = [k for k in _JDBC_PARTITION_KEYS if getattr(self, k) is not None]
        if given and len(given) != len(_JDBC_PARTITION_KEYS):
            raise SpecError(
                f"jdbc partitioning needs all of {_JDBC_PARTITION_KEYS}, got {given}"
            )
        if given and self.predicates:
            raise SpecError("use either a partition column or predicates, not both")
        if given and self.query:
            raise SpecError("jdbc partition_column works with table, not query")
        if self.predicates and self.query:
            raise SpecError("jdbc predicates work with table, not query")
        if self.num_partitions is not None and int(self.num_partitions) < 1:
            raise SpecError("num_partitions must be >= 1")

    @classmethod
    def from_dict(cls, d: Mapping) -> SourceSpec:
        allowed = set(cls.__dataclass_fields__)
        aliases = {"file_type": "format", "file_path": "path"}
        out = {}
        for k, v in d.items():
            k = aliases.get(k, k)
            if k not in allowed:
                raise SpecError(f"unknown source key {k!r}; allowed: {sorted(allowed)}")
            out[k] = v
        if "format" not in out:
            raise SpecError("source needs a format")
        return cls(**out)
