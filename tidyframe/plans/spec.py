"""Declarative job spec: a frozen, validated description of one prep job.

Built from a plain dict (``JobSpec.from_dict``); unknown keys raise, so a typo
never silently disables a step.  ``from_legacy_attributes`` accepts the older
Portuguese-keyed config layout (see that function for the key map).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tidyframe.errors import SpecError
from tidyframe.functions.casting import ON_ERROR
from tidyframe.functions.dates import AGE_METHODS, check_date_pattern
from tidyframe.operators.dedupe import STRATEGIES, SortKey
from tidyframe.operators.quality import RangeRule
from tidyframe.plans.quarantine import QuarantineSpec, quarantined_source
from tidyframe.sinks.write import SinkSpec
from tidyframe.sources.spec import SourceSpec, schema_from_files_ok


def _strict(d: Mapping, allowed: set[str], where: str) -> None:
    unknown = set(d) - allowed
    if unknown:
        raise SpecError(f"unknown key(s) {sorted(unknown)} in {where}; allowed: {sorted(allowed)}")


def _names(v, where: str) -> tuple[str, ...]:
    if v is None:
        return ()
    if isinstance(v, str):
        return (v,)
    if not all(isinstance(x, str) for x in v):
        raise SpecError(f"{where} must be a list of column names")
    return tuple(v)


def _policy(v: str, where: str) -> str:
    if v not in ON_ERROR:
        raise SpecError(f"{where}.on_error must be one of {ON_ERROR}")
    return v


@dataclass(frozen=True)
class DateReformat:
    column: str
    from_pattern: str
    to_pattern: str = "yyyy-MM-dd"
    on_error: str = "null"

    @classmethod
    def from_dict(cls, d: Mapping) -> DateReformat:
        _strict(d, {"column", "from", "to", "on_error"}, "reformat_date")
        return cls(
            d["column"],
            check_date_pattern(d["from"]),
            check_date_pattern(d.get("to", "yyyy-MM-dd")),
            _policy(d.get("on_error", "null"), "reformat_date"),
        )


@dataclass(frozen=True)
class SplitStep:
    column: str
    into: tuple[str, ...]
    pattern: str = "/"
    regex: bool = False
    keep_source: bool = False
    cast: str | None = None
    on_error: str = "null"

    @classmethod
    def from_dict(cls, d: Mapping) -> SplitStep:
        _strict(d, {"column", "into", "pattern", "regex", "keep_source", "cast", "on_error"}, "split")
        into = _names(d.get("into"), "split.into")
        if not into:
            raise SpecError("split needs `into` column names")
        return cls(
            d["column"], into, d.get("pattern", "/"), bool(d.get("regex", False)),
            bool(d.get("keep_source", False)), d.get("cast"),
            _policy(d.get("on_error", "null"), "split"),
        )


@dataclass(frozen=True)
class CastStep:
    columns: tuple[str, ...]
    to: str = "double"
    on_error: str = "null"
    missing: str = "skip"

    @classmethod
    def from_dict(cls, d: Mapping) -> CastStep:
        _strict(d, {"columns", "to", "on_error", "missing"}, "cast")
        return cls(
            _names(d.get("columns"), "cast.columns"), d.get("to", "double"),
            _policy(d.get("on_error", "null"), "cast"), d.get("missing", "skip"),
        )


@dataclass(frozen=True)
class YearsStep:
    """``column`` = whole years from ``start`` to ``end`` (default: run date)."""

    column: str
    start: str
    end: str | None = None
    pattern: str | None = None
    method: str = "calendar"
    on_error: str = "null"

    @classmethod
    def from_dict(cls, d: Mapping) -> YearsStep:
        _strict(d, set(cls.__dataclass_fields__), "years_between")
        if d.get("method", "calendar") not in AGE_METHODS:
            raise SpecError(f"years_between.method must be one of {AGE_METHODS}")
        pat = d.get("pattern")
        return cls(
            d["column"], d["start"], d.get("end"),
            check_date_pattern(pat) if pat else None, d.get("method", "calendar"),
            _policy(d.get("on_error", "null"), "years_between"),
        )


@dataclass(frozen=True)
class CleanSpec:
    normalize_text: tuple[str, ...] = ()
    title_case: tuple[str, ...] = ()
    title_case_plain: tuple[str, ...] = ()
    strip_accents: tuple[str, ...] = ()
    reformat_date: tuple[DateReformat, ...] = ()
    split: tuple[SplitStep, ...] = ()
    unicode_whitespace: bool = True

    @classmethod
    def from_dict(cls, d: Mapping | None) -> CleanSpec:
        d = d or {}
        _strict(d, set(cls.__dataclass_fields__), "clean")
        return cls(
            _names(d.get("normalize_text"), "clean.normalize_text"),
            _names(d.get("title_case"), "clean.title_case"),
            _names(d.get("title_case_plain"), "clean.title_case_plain"),
            _names(d.get("strip_accents"), "clean.strip_accents"),
            tuple(DateReformat.from_dict(x) for x in d.get("reformat_date", ())),
            tuple(SplitStep.from_dict(x) for x in d.get("split", ())),
            bool(d.get("unicode_whitespace", True)),
        )


@dataclass(frozen=True)
class DedupeSpec:
    keys: tuple[str, ...]
    order_by: tuple[SortKey, ...] = ()
    strategy: str = "auto"

    @classmethod
    def from_dict(cls, d: Mapping | None) -> DedupeSpec | None:
        if not d:
            return None
        _strict(d, {"keys", "order_by", "strategy"}, "dedupe")
        keys = _names(d.get("keys"), "dedupe.keys")
        if not keys:
            raise SpecError("dedupe needs keys")
        if d.get("strategy", "auto") not in STRATEGIES:
            raise SpecError(f"dedupe.strategy must be one of {STRATEGIES}")
        order = tuple(SortKey.parse(o) for o in d.get("order_by", ()) or ())
        return cls(keys, order, d.get("strategy", "auto"))


@dataclass(frozen=True)
class QualitySpec:
    keys: tuple[str, ...] = ()
    ranges: tuple[RangeRule, ...] = ()
    columns: tuple[str, ...] | None = None
    describe: bool = True
    warn_pct: float = 10.0
    legacy_null_valid: bool = False
    approx_duplicates: bool = False
    # where to keep the report (with run_date / run_ts columns); None = not kept
    report_sink: SinkSpec | None = None
    # where to keep metric states, which merge over runs (``report_from_state``); Parquet
    state_sink: SinkSpec | None = None

    @classmethod
    def from_dict(cls, d: Mapping | None) -> QualitySpec | None:
        if d is None:
            return None
        _strict(d, set(cls.__dataclass_fields__), "quality")
        if not 0.0 <= float(d.get("warn_pct", 10.0)) <= 100.0:
            raise SpecError("quality.warn_pct must be between 0 and 100")
        cols = d.get("columns")
        state = SinkSpec.from_dict(d["state_sink"]) if d.get("state_sink") else None
        if state is not None and state.format != "parquet":
            raise SpecError("quality.state_sink holds sketches: its format must be parquet")
        return cls(
            _names(d.get("keys"), "quality.keys"),
            tuple(RangeRule.from_dict(r) for r in d.get("ranges", ()) or ()),
            _names(cols, "quality.columns") if cols is not None else None,
            bool(d.get("describe", True)),
            float(d.get("warn_pct", 10.0)),
            bool(d.get("legacy_null_valid", False)),
            bool(d.get("approx_duplicates", False)),
            SinkSpec.from_dict(d["report_sink"]) if d.get("report_sink") else None,
            state,
        )


@dataclass(frozen=True)
class StampSpec:
    date_column: str | None = "processing_date"
    ts_column: str | None = "processing_ts"
    ts_type: str = "timestamp"

    @classmethod
    def from_dict(cls, d: Mapping | None) -> StampSpec | None:
        if d is None:
            return None
        _strict(d, set(cls.__dataclass_fields__), "stamps")
        spec = cls(**d)
        if spec.ts_type not in ("timestamp", "timestamp_ntz"):
            raise SpecError("stamps.ts_type must be 'timestamp' or 'timestamp_ntz'")
        return spec


@dataclass(frozen=True)
class IngestSpec:
    """Incremental mode: only files not seen by ``checkpoint`` are read; files of
    committed batches are moved under ``archive_dir`` (must not match the
    source glob) at the end of the run."""

    checkpoint: str
    archive_dir: str | None = None
    max_files_per_batch: int | None = None
    # event-time column + delay ("2 hours"): dedupe state is then bounded
    watermark_column: str | None = None
    watermark_delay: str | None = None
    # folder of an index of the keys written so far: rows are then unique across runs
    unique_index: str | None = None
    unique_buckets: int = 256
    unique_bits: int = 1 << 16
    # folder of a ledger of file contents: files read before under another name are skipped
    content_ledger: str | None = None

    @classmethod
    def from_dict(cls, d: Mapping | None) -> IngestSpec | None:
        if not d:
            return None
        _strict(d, set(cls.__dataclass_fields__), "ingest")
        if not d.get("checkpoint"):
            raise SpecError("ingest needs a checkpoint path")
        if bool(d.get("watermark_column")) != bool(d.get("watermark_delay")):
            raise SpecError("ingest watermark needs both watermark_column and watermark_delay")
        n = d.get("max_files_per_batch")
        if n is not None and (not isinstance(n, int) or n < 1):
            raise SpecError("ingest.max_files_per_batch must be a positive integer")
        if d.get("unique_index") and d.get("watermark_column"):
            raise SpecError("use either ingest.unique_index or a watermark")
        if d.get("content_ledger") and d.get("watermark_column"):
            raise SpecError("a watermark job reads its files as one stream; it takes no content ledger")
        return cls(**d)


@dataclass(frozen=True)
class JobSpec:
    source: SourceSpec
    sink: SinkSpec
    dedupe: DedupeSpec | None = None
    clean: CleanSpec = field(default_factory=CleanSpec)
    cast: tuple[CastStep, ...] = ()
    years_between: tuple[YearsStep, ...] = ()
    stamps: StampSpec | None = field(default_factory=StampSpec)
    quality: QualitySpec | None = None
    ingest: IngestSpec | None = None
    quarantine: QuarantineSpec | None = None

    @classmethod
    def from_dict(cls, d: Mapping) -> JobSpec:
        _strict(d, set(cls.__dataclass_fields__), "job")
        if "source" not in d or "sink" not in d:
            raise SpecError("job needs a source and a sink")
        stamps = d["stamps"] if "stamps" in d else {}
        spec = cls(
            source=SourceSpec.from_dict(d["source"]),
            sink=SinkSpec.from_dict(d["sink"]),
            dedupe=DedupeSpec.from_dict(d.get("dedupe")),
            clean=CleanSpec.from_dict(d.get("clean")),
            cast=tuple(CastStep.from_dict(c) for c in d.get("cast", ()) or ()),
            years_between=tuple(YearsStep.from_dict(y) for y in d.get("years_between", ()) or ()),
            stamps=StampSpec.from_dict(stamps),
            quality=QualitySpec.from_dict(d.get("quality")),
            ingest=IngestSpec.from_dict(d.get("ingest")),
            quarantine=QuarantineSpec.from_dict(d.get("quarantine")),
        )
        quarantined_source(spec.source, spec.quarantine)  # raises what it cannot do
        if spec.quarantine and spec.ingest and spec.ingest.watermark_column:
            raise SpecError("a watermark job is one stream into one sink; it takes no quarantine")
        if spec.ingest and spec.source.is_jdbc:
            raise SpecError("incremental ingest needs a file source")
        if spec.ingest and spec.source.schema is None and not schema_from_files_ok(spec.source):
            raise SpecError(
                "incremental ingest needs an explicit source schema (only CSV without "
                "inferSchema and Parquet can take it from the files cheaply)"
            )
        if spec.ingest and spec.ingest.unique_index and spec.dedupe is None:
            raise SpecError("ingest.unique_index needs dedupe keys")
        if spec.ingest and spec.sink.idempotent:
            raise SpecError("incremental batches are idempotent by their own folders; leave sink.idempotent out")
        if spec.ingest and spec.sink.mode != "append":
            raise SpecError("incremental ingest appends: set sink mode to 'append'")
        return spec


# ----------------------------------------------------------- legacy config layout

# Key names of the older config layout, and the column names its
# job stamped.  They must be spelled exactly like this to read such configs.
LEGACY_STAMP_DATE = "DATA_PROCESSAMENTO"
LEGACY_DATE_PATTERN = "dd/MM/yyyy"
LEGACY_STAMP_TS = "TIMESTAMP_PROCESSAMENTO"
LEGACY_KEYS = (
    "source", "destiny", "transformations", "type_conversion", "enrichment",
    "quality", "partitioning", "processing",
)
LEGACY_JDBC = {"tabela": "table", "conexao": "url", "driver": "driver"}


def from_legacy_attributes(attrs: Mapping, checkpoint: str | None = None) -> JobSpec:
    """Map the older config layout (root ``attributes``) onto ``JobSpec``.

    * ``source`` / ``destiny``: ``file_type``, ``file_path``, ``options``; a
      ``mode`` inside the writer options becomes the save mode, empty-string
      options are dropped.  A database ``file_type`` takes ``tabela``, ``conexao``
      and ``driver``, given beside ``source`` or in it.
    * ``processing.remove_duplicates`` / ``duplicate_key`` -> dedupe;
      ``move_processed_files`` / ``processed_folder`` -> incremental ingest with
      archive (needs ``checkpoint`` and a source schema).
    * ``transformations.normalize_text`` / ``normalize_date`` /
      ``split_columns``; ``type_conversion.double_columns``;
      ``enrichment.date_diff_years``.
    * ``quality.coluna_chave`` and ``validacoes_faixa`` (``coluna/min/max``).
    * ``partitioning.num_particoes`` / ``particionar_por``.
    """
    _strict(attrs, {*LEGACY_KEYS, *LEGACY_JDBC}, "attributes")
    try:
        return _from_legacy(attrs, checkpoint)
    except KeyError as ex:
        raise SpecError(f"older config layout: missing key {ex}") from ex
    except (TypeError, AttributeError) as ex:
        raise SpecError(f"older config layout: malformed section ({ex})") from ex


def _from_legacy(attrs: Mapping, checkpoint: str | None) -> JobSpec:
    src = dict(attrs["source"])
    jdbc = {new: v for old, new in LEGACY_JDBC.items() if (v := attrs.get(old, src.get(old)))}
    dst = dict(attrs["destiny"])
    dst_opts = {k: v for k, v in (dst.pop("options", {}) or {}).items() if v != ""}
    mode = dst_opts.pop("mode", "overwrite")
    part = attrs.get("partitioning", {}) or {}
    sink = {
        "format": dst.get("file_type", "parquet"),
        "path": dst["file_path"],
        "mode": mode,
        "options": dst_opts,
        "partition_by": _names(part.get("particionar_por"), "particionar_por"),
        "num_files": part.get("num_particoes"),
    }
    tr = attrs.get("transformations", {}) or {}
    clean = {
        "normalize_text": tr.get("normalize_text", []),
        "reformat_date": [
            {"column": x["column"], "from": x["fmt"], "to": "yyyy-MM-dd"}
            for x in tr.get("normalize_date", []) or []
        ],
        "split": [
            {"column": x["column"], "into": x["new_columns"], "pattern": x.get("pattern", "/")}
            for x in tr.get("split_columns", []) or []
        ],
    }
    dbl = (attrs.get("type_conversion", {}) or {}).get("double_columns", []) or []
    reformatted = {r["column"] for r in clean["reformat_date"]}
    years = [
        {"column": x["column"], "start": x["start_date"], "end": x.get("end_date"),
         # a re-formatted column is parsed with its new pattern; others with
         # the older layout's default day-first pattern
         "pattern": None if x["start_date"] in reformatted else LEGACY_DATE_PATTERN}
        for x in (attrs.get("enrichment", {}) or {}).get("date_diff_years", []) or []
    ]
    q = attrs.get("quality", {}) or {}
    quality = {
        "keys": [q["coluna_chave"]] if q.get("coluna_chave") else [],
        "ranges": [
            {"column": r["coluna"], "min": r["min"], "max": r["max"]}
            for r in q.get("validacoes_faixa", []) or []
        ],
    }
    proc = attrs.get("processing", {}) or {}
    dedupe = None
    if proc.get("remove_duplicates"):
        dedupe = {"keys": _names(proc.get("duplicate_key") or q.get("coluna_chave"), "duplicate_key")}
    ingest = None
    if proc.get("move_processed_files"):
        if not checkpoint:
            raise SpecError("move_processed_files needs a checkpoint path for the ingest")
        ingest = {"checkpoint": checkpoint, "archive_dir": proc.get("processed_folder")}
        sink["mode"] = "append"  # the stream appends each new file exactly once
    return JobSpec.from_dict(
        {
            "source": {"format": src.get("file_type"), "path": src.get("file_path"),
                       "options": src.get("options", {}) or {}, **jdbc,
                       **({"schema": src["schema"]} if "schema" in src else {})},
            "sink": sink,
            "dedupe": dedupe,
            "clean": clean,
            "cast": [{"columns": dbl, "to": "double"}] if dbl else [],
            "years_between": years,
            "stamps": {"date_column": LEGACY_STAMP_DATE, "ts_column": LEGACY_STAMP_TS},
            "quality": quality,
            "ingest": ingest,
        }
    )


def load_spec(source, checkpoint: str | None = None) -> JobSpec:
    """A ``JobSpec`` from a dict or a YAML file (read on the driver: it is a
    small config).  A file whose root is ``attributes`` uses the older layout
    (``from_legacy_attributes``).  Any problem raises at once."""
    if isinstance(source, Mapping):
        data = source
    else:
        try:
            import yaml
        except ImportError as ex:  # pragma: no cover - PyYAML is optional
            raise SpecError("reading a spec file needs PyYAML") from ex
        try:
            with open(source, encoding="utf-8") as fh:
                data = yaml.safe_load(fh)
        except (OSError, yaml.YAMLError) as ex:
            raise SpecError(f"cannot read spec {source!r}: {ex}") from ex
    if not isinstance(data, Mapping):
        raise SpecError("a spec must be a mapping")
    if set(data) == {"attributes"}:
        return from_legacy_attributes(data["attributes"], checkpoint)
    return JobSpec.from_dict(data)


__all__ = [
    "CastStep", "CleanSpec", "DateReformat", "DedupeSpec", "IngestSpec", "JobSpec",
    "QualitySpec", "SplitStep", "StampSpec", "YearsStep", "from_legacy_attributes",
    "load_spec",
]
