"""Rows that a job cannot use, kept apart with the reason instead of turned into NULLs.

A row is rejected when its record is malformed (the reader could not parse it) or when a
conversion step (cast, date re-format, cast split part, year difference) turned one of its
values into NULL.  The source is read and judged once, into a disk-persisted frame that both
writes share: accepted rows go through the rest of the job, rejected ones go to the
quarantine sink with the raw record, the file it came from and the reasons.

The record is the malformed line as it was read, else the source row as JSON; it is built for
rejected rows only, and never crosses a shuffle.  The counts of what was read, accepted and
rejected come from the frame and from the two writes, and must add up.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidyframe.errors import SpecError
from tidyframe.functions._util import col
from tidyframe.sinks.write import SinkSpec
from tidyframe.sources.spec import FILE_FORMATS, SourceSpec

MALFORMED = "malformed record"
CORRUPT, FILE, SOURCE = "__malformed", "__source_file", "__source_row"
REASONS, RECORD = "__reasons", "__record"
INTERNAL = (CORRUPT, FILE, SOURCE, REASONS, RECORD)
TEXT_FORMATS = ("csv", "json", "xml")


@dataclass(frozen=True)
class QuarantineSpec:
    sink: SinkSpec
    malformed: bool = True
    conversions: bool = True

    @classmethod
    def from_dict(cls, d: Mapping | None) -> QuarantineSpec | None:
        if not d:
            return None
        unknown = set(d) - {"sink", "malformed", "conversions"}
        if unknown or "sink" not in d:
            raise SpecError(f"quarantine needs a sink, and knows malformed / conversions; got {sorted(d)}")
        spec = cls(SinkSpec.from_dict(d["sink"]), bool(d.get("malformed", True)), bool(d.get("conversions", True)))
        if not (spec.malformed or spec.conversions):
            raise SpecError("quarantine would reject nothing")
        return spec


def quarantined_source(source: SourceSpec, spec: QuarantineSpec | None) -> SourceSpec:
    """The source with the reader's malformed-record column and each row's file."""
    if spec is None or source.format not in FILE_FORMATS:
        return source
    source = replace(source, file_path_col=source.file_path_col or FILE)
    if not spec.malformed or source.format not in TEXT_FORMATS:
        return source
    if source.schema is None:
        raise SpecError("malformed records can be told by an explicit source schema only; give "
                        "source.schema or set quarantine.malformed to false")
    schema = StructType.fromDDL(source.schema) if isinstance(source.schema, str) else source.schema
    options = {**source.options, "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    return replace(source, schema=StructType([*schema.fields]).add(CORRUPT, StringType()), options=options)


def keep_source(rows: DataFrame, source: SourceSpec) -> DataFrame:
    """Add the source row as one struct, from which a rejected row's record is made."""
    hidden = [c for c in (CORRUPT, FILE, source.file_path_col) if c in rows.columns]
    return rows.withColumn(SOURCE, F.struct(*[col(c) for c in rows.columns if c not in hidden]))


def judge(rows: DataFrame, source: SourceSpec, nulled: Sequence[tuple[str, object]]) -> DataFrame:
    """Add the reasons and the record.  ``nulled`` holds (column, condition) of conversions."""
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    reasons = F.array_compact(F.array(
        F.when(bad, F.lit(MALFORMED)),
        *[F.when(~bad & cond, F.lit(f"conversion of {name}")) for name, cond in nulled]))
    as_json = F.to_json(F.col(SOURCE), {"ignoreNullFields": "false"})
    raw = F.coalesce(F.col(CORRUPT), as_json) if CORRUPT in rows.columns else as_json
    path = F.col(source.file_path_col) if source.file_path_col in rows.columns else F.lit(None).cast("string")
    return (rows.withColumn(REASONS, reasons).withColumn(RECORD, F.when(F.size(REASONS) > 0, raw))
            .withColumn(FILE, path).drop(CORRUPT, SOURCE))


class Quarantine:
    """The two sides of one judged frame."""

    def __init__(self, judged: DataFrame, columns: Sequence[str]):
        self.judged = judged.persist(StorageLevel.DISK_ONLY)
        self.reasons = [MALFORMED, *(f"conversion of {c}" for c in columns)]
        self.observation = Observation(f"tidyframe_quarantine_{uuid.uuid4().hex}")
        names = {f"r{i}": F.count_if(F.array_contains("reasons", r)) for i, r in enumerate(self.reasons)}
        self.rejected = (
            self.judged.filter(F.size(REASONS) > 0)
            .select(F.col(RECORD).alias("record"), F.col(FILE).alias("file"), F.col(REASONS).alias("reasons"))
            .observe(self.observation, F.count(F.lit(1)).alias("n"), *[e.alias(n) for n, e in names.items()]))

    @property
    def accepted(self) -> DataFrame:
        return self.judged.filter(F.size(REASONS) == 0).drop(*INTERNAL)

    def release(self) -> None:
        self.judged.unpersist()

    def counts(self) -> dict[str, int]:
        """Rows read, accepted, rejected, and rejected by reason; call after both writes."""
        seen = self.judged.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size(REASONS) == 0).alias("ok")).first()
        values = self.observation.get
        if seen["n"] != seen["ok"] + values["n"]:
            raise RuntimeError(f"{seen['n']} rows were read, but {seen['ok']} accepted and {values['n']} rejected")
        return {"n_read": seen["n"], "n_accepted": seen["ok"], "n_rejected": values["n"],
                **{r: values[f"r{i}"] for i, r in enumerate(self.reasons)}}

    @staticmethod
    def report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
        rows = [("quarantine", "rows", m, float(counts[m])) for m in ("n_read", "n_accepted", "n_rejected")]
        rows += [("quarantine", r, "n_rejected", float(n)) for r, n in counts.items() if not r.startswith("n_")]
        return spark.createDataFrame(rows, "check string, subject string, metric string, value double")
