"""File sinks with an explicit save mode and output layout.

Layout rules (``num_files``):

* ``None`` / ``0`` / negative: keep the plan's partitioning.  With
  ``partition_by`` and AQE on, a ``rebalance`` hint on the partition columns
  lets AQE coalesce small tasks *and split skewed ones*, so a partition value
  holding a third of the rows (a single run date holds all of them) is still
  written by many tasks instead of one.
* ``1``: one file, via ``repartition(1)``: upstream work stays parallel and
  only the final write is one task (``coalesce(1)`` would pull the whole
  upstream plan into that one task).  One writer task by definition: meant
  for bounded outputs (reports, small dimensions), not for growing tables.
* ``n > 1``: ``repartition(n)`` (round robin, even files).
* ``target_file_bytes``: as many files per partition value as its bytes need, see ``sizing``.

Save modes: ``append``, ``overwrite``, ``error``/``errorifexists``,
``ignore``.  ``overwrite`` replaces the whole sink, so no partition of an earlier
write stays behind.  With ``dynamic_overwrite=True`` only the partitions present
in the new data are replaced.  That is the default of a job whose sink is
partitioned by a run stamp: rerunning a day never erases other days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import col
from tidyframe.sinks.sizing import sized
from tidyframe.sources.spec import normalize_options

SINK_FORMATS = ("parquet", "csv", "json", "xml")
# Spark's CSV writer trims values by default; a prep job must not alter text
# silently, so keep whitespace unless the user sets these options.
CSV_WRITE_DEFAULTS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
SAVE_MODES = ("append", "overwrite", "error", "errorifexists", "ignore")


@dataclass(frozen=True)
class SinkSpec:
    path: str
    format: str = "parquet"
    mode: str = "overwrite"
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    num_files: int | None = None
    dynamic_overwrite: bool | None = None  # None: dynamic for run-stamp partitions only
    max_records_per_file: int | None = None
    target_file_bytes: int | None = None  # files of about this many bytes of plain values (``sinks.sizing``)
    cluster_by: str | None = None         # with it: each file a range of this column
    idempotent: bool = False  # an append in run folders with a manifest (``sinks.runs``)

    def __post_init__(self):
        object.__setattr__(self, "format", (self.format or "").lower())
        object.__setattr__(self, "mode", (self.mode or "").lower())
        object.__setattr__(self, "options", normalize_options(self.options))
        pb = self.partition_by
        if isinstance(pb, str):
            pb = (pb,)
        object.__setattr__(self, "partition_by", tuple(pb or ()))
        self.validate()

    def validate(self) -> None:
        if not self.path:
            raise SpecError("sink needs a path")
        if self.format not in SINK_FORMATS:
            raise SpecError(f"unsupported sink format {self.format!r}; use one of {SINK_FORMATS}")
        if self.mode not in SAVE_MODES:
            raise SpecError(f"unsupported save mode {self.mode!r}; use one of {SAVE_MODES}")
        if self.idempotent and self.mode != "append":
            raise SpecError("idempotent is for sinks that append; other modes do not add up")
        if "mode" in self.options:
            raise SpecError("save mode is the sink's `mode` field, not a writer option")
        if self.format == "xml" and "rowTag" not in self.options:
            raise SpecError("xml sink needs options.rowTag")
        for k in ("sep", "delimiter"):
            if self.format == "csv" and self.options.get(k) == "":
                raise SpecError(f"csv sink: empty {k!r}")
        if self.num_files is not None and not isinstance(self.num_files, int):
            raise SpecError("num_files must be an integer or null")
        if self.target_file_bytes is not None and (
                not isinstance(self.target_file_bytes, int) or self.target_file_bytes < 1 or self.num_files):
            raise SpecError("target_file_bytes must be a positive integer, without num_files")
        if self.cluster_by and self.target_file_bytes is None:
            raise SpecError("cluster_by goes with target_file_bytes")
        m = self.max_records_per_file
        if m is not None and (not isinstance(m, int) or m < 1):
            raise SpecError("max_records_per_file must be a positive integer")

    @classmethod
    def from_dict(cls, d: Mapping) -> SinkSpec:
        allowed = set(cls.__dataclass_fields__)
        aliases = {"file_type": "format", "file_path": "path"}
        out = {}
        for k, v in d.items():
            k = aliases.get(k, k)
            if k not in allowed:
                raise SpecError(f"unknown sink key {k!r}; allowed: {sorted(allowed)}")
            out[k] = v
        return cls(**out)


def _aqe_on(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def prepare_layout(df: DataFrame, spec: SinkSpec, constant_partitions: bool = False) -> DataFrame:
    """Apply the file-count / partition layout rules (see module doc).

    ``constant_partitions``: every partition column holds one value for the
    whole write (a run-date stamp).  Each task then writes one file into the
    one folder anyway, so no rebalance shuffle is added.
    """
    if spec.target_file_bytes:
        return sized(df, spec.partition_by, spec.target_file_bytes, spec.cluster_by)
    n = spec.num_files
    if n == 1:
        return df.repartition(1)
    if n and n > 1:
        return df.repartition(n)
    if spec.partition_by and not constant_partitions and _aqe_on(df):
        return df.hint("rebalance", *[col(c) for c in spec.partition_by])
    return df


def writer_options(spec: SinkSpec) -> dict[str, str]:
    """Options that batch and streaming writers share: a sink alters no text unless told."""
    opts = dict(spec.options)
    if spec.format == "csv":
        opts = {**CSV_WRITE_DEFAULTS, **opts}
    if spec.max_records_per_file:
        opts["maxRecordsPerFile"] = str(spec.max_records_per_file)
    return opts


def write_sink(
    df: DataFrame, spec: SinkSpec, layout: bool = True, stamps: Sequence[str] = ()
) -> None:
    """Write ``df``; ``layout=False`` when the caller already applied it.
    ``stamps``: columns that hold this run's date or time."""
    if spec.partition_by:
        require_columns(df, spec.partition_by)
    out = prepare_layout(df, spec) if layout else df
    w = out.write.format(spec.format).mode(spec.mode).options(**writer_options(spec))
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
        if spec.mode == "overwrite":
            # explicit both ways, so a session default cannot flip it
            dynamic = spec.dynamic_overwrite
            if dynamic is None:
                dynamic = not set(stamps).isdisjoint(spec.partition_by)
            w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    w.save(spec.path)
