"""CSV files whose headers differ: every file is read by its own column names.

Spark takes one schema for all files of a scan and applies it by position, so a file with its
columns in another order would fill the wrong ones.  Here

1. each file's first line is read in the cluster, a task per file that stops after it;
2. files with the same header make one scan with that header's columns, typed by name;
3. the scans are united by name: a column that a file lacks is NULL, one that the schema does
   not know raises, is kept as text or is dropped.

The driver sees one line and one path per file, as Spark's own file listing does.
"""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidyframe.errors import SpecError
from tidyframe.functions._util import col
from tidyframe.sources.spec import SourceSpec

MAX_HEADERS = 500  # distinct headers, each a scan of the plan


def _first_line(comment: str):
    """Of each task's only file: (path, header), with no further line read."""

    def run(batches):
        for batch in batches:
            for k, line in enumerate(batch.column("value").to_pylist()):
                line = line.lstrip("﻿")
                if line.strip() and not (comment and line.startswith(comment)):
                    yield batch.slice(k, 1)
                    return

    return run


def file_headers(spark: SparkSession, spec: SourceSpec) -> list[tuple[str, str]]:
    """(path, header line) of every file that has one, by path."""
    own = spark.newSession()  # the caller's settings stay as they are
    whole = str(1 << 50)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, whole)  # a file is a task, whatever its size
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    paths = list(spec.path) if isinstance(spec.path, tuple) else [spec.path]
    options = {k: v for k, v in spec.options.items()
               if k in ("lineSep", "pathGlobFilter", "recursiveFileLookup", "ignoreMissingFiles", "ignoreCorruptFiles")}
    lines = own.read.options(**options).text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    found = lines.mapInArrow(_first_line(spec.options.get("comment", "")), "path string, value string").toArrow()
    return sorted(zip(found.column("path").to_pylist(), found.column("value").to_pylist(), strict=True))


def header_names(line: str, options: dict[str, str]) -> list[str]:
    """Column names of a header line, as the CSV reader with ``options`` names them."""
    line = line.lstrip("﻿").rstrip("\r\n")
    sep = options.get("sep", options.get("delimiter", ","))
    quote, escape = options.get("quote", '"'), options.get("escape", "\\")
    names = next(csv.reader([line], delimiter=sep.replace("\\t", "\t"), quotechar=quote or None,
                            quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE,
                            escapechar=None if escape == quote else escape or None), [])
    if options.get("ignoreLeadingWhiteSpace", "false").lower() == "true":
        names = [n.lstrip() for n in names]
    if options.get("ignoreTrailingWhiteSpace", "false").lower() == "true":
        names = [n.rstrip() for n in names]
    return [n or f"_c{i}" for i, n in enumerate(names)]


def _literal_path(uri: str) -> str:
    """A listed file as a path that is no glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def read_by_header(spark: SparkSession, spec: SourceSpec, options: dict[str, str]) -> DataFrame:
    """The rows of all files, columns matched by name (under the session's case rule)."""
    if options.get("encoding", options.get("charset", "utf-8")).lower() not in ("utf-8", "utf8", "us-ascii"):
        raise SpecError("headers='by_name' reads UTF-8 files")
    exact = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    same = (lambda n: n) if exact else str.lower
    groups: dict[str, list[str]] = {}
    for path, line in file_headers(spark, spec):
        groups.setdefault(line, []).append(_literal_path(path))
    if len(groups) > MAX_HEADERS:
        raise SpecError(f"{len(groups)} distinct headers at {spec.path!r}; at most {MAX_HEADERS} can be united")

    schema = spec.schema
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    corrupt = options.get("columnNameOfCorruptRecord", "_corrupt_record")
    fields = {same(f.name): f for f in schema.fields} if schema is not None else {}
    kept = dict(fields)  # the result's columns in their order
    parsed = {}
    for line in groups:
        names = parsed[line] = header_names(line, options)
        if len({same(n) for n in names}) < len(names):
            raise SpecError(f"a header names a column twice: {line!r}")
        unknown = [n for n in names if same(n) not in fields]
        if schema is not None and unknown and spec.unknown_columns == "raise":
            raise SpecError(f"column(s) {unknown} of {groups[line][0]!r} are not in the schema; set "
                            "unknown_columns to 'keep' or 'drop'")
        if schema is None or spec.unknown_columns == "keep":
            kept.update({same(n): StructField(n, StringType()) for n in unknown if same(n) not in kept})

    scans = []
    for line, paths in groups.items():
        own = [fields.get(same(n)) or StructField(n, StringType()) for n in parsed[line]]
        if same(corrupt) in fields and same(corrupt) not in {same(n) for n in parsed[line]}:
            own.append(fields[same(corrupt)])
        reader = spark.read.format("csv").options(**options).schema(StructType(own))
        if isinstance(spec.path, str) and not re.search(r"[\[{*?]", spec.path) and not spec.path.endswith(".csv"):
            reader = reader.option("basePath", spec.path)  # keeps partition columns of the folder
        rows = reader.load(paths)
        have = {same(f.name): f.name for f in own}
        parts = [c for c in rows.columns if same(c) not in have and same(c) not in kept]
        cells = [col(have[k]).alias(f.name) if k in have else F.lit(None).cast(f.dataType).alias(f.name)
                 for k, f in kept.items()]
        if spec.file_path_col:
            cells.append(F.col("_metadata.file_path").alias(spec.file_path_col))
        scans.append(rows.select(*cells, *[col(c) for c in parts]))
    if not scans:
        extra = [StructField(spec.file_path_col, StringType())] if spec.file_path_col else []
        return spark.createDataFrame([], StructType([*kept.values(), *extra]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
