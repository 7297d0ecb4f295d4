"""Build the (lazy) DataFrame for a ``SourceSpec``.

File scans keep Catalyst's pushdown and pruning: filters and projections added
later reach the Parquet reader (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyframe.sources.headers import read_by_header
from tidyframe.sources.spec import SourceSpec

# Spark's XML reader trims values by default; a prep job must not alter text
# silently, so keep whitespace unless the user sets the option.
READ_DEFAULTS = {"xml": {"ignoreSurroundingSpaces": "false"}}


def reader_options(spec: SourceSpec) -> dict[str, str]:
    """Options that batch and streaming readers share."""
    opts = {**READ_DEFAULTS.get(spec.format, {}), **spec.options}
    if spec.has_header and spec.headers == "match":
        # a file with other columns, or in another order, fails instead of filling the wrong ones
        opts = {"enforceSchema": "false", **opts}
    return opts


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.is_jdbc:
        return _read_jdbc(spark, spec)
    if spec.headers == "by_name":
        return read_by_header(spark, spec, reader_options(spec))
    if spec.schema is None and (
        spec.format in ("json", "xml")
        or spec.options.get("inferSchema", "false").lower() == "true"
    ):
        warnings.warn(
            f"{spec.format} source without a schema: Spark scans the whole input once "
            "to infer it; give source.schema for large inputs",
            stacklevel=2,
        )
    reader = spark.read.format(spec.format).options(**reader_options(spec))
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    paths = list(spec.path) if isinstance(spec.path, tuple) else [spec.path]
    df = reader.load(paths if len(paths) > 1 else paths[0])
    if spec.file_path_col:
        df = df.withColumn(spec.file_path_col, F.col("_metadata.file_path"))
    return df


def jdbc_options(spec: SourceSpec) -> dict[str, str]:
    """The JDBC reader options for a spec (user options first, spec wins)."""
    opts = dict(spec.options)
    opts["url"] = spec.url
    opts["driver"] = spec.driver
    if spec.table:
        opts["dbtable"] = spec.table
    else:
        opts["query"] = spec.query
    if spec.partition_column is not None:
        opts["partitionColumn"] = spec.partition_column
        opts["lowerBound"] = str(spec.lower_bound)
        opts["upperBound"] = str(spec.upper_bound)
        opts["numPartitions"] = str(spec.num_partitions)
    if spec.fetchsize is not None:
        opts["fetchsize"] = str(spec.fetchsize)
    return opts


def _read_jdbc(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    opts = jdbc_options(spec)
    if spec.schema is not None:
        ddl = spec.schema
        if not isinstance(ddl, str):
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ddl.fields)
        opts["customSchema"] = ddl  # a reader option and a connection property alike
    if spec.predicates:
        # one task per predicate; each predicate is a WHERE clause on the table
        url, table = opts.pop("url"), opts.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=list(spec.predicates), properties=opts)
    if spec.partition_column is None:
        warnings.warn(
            "a jdbc source without partition_column or predicates is read by one task; "
            "give one of them for large tables",
            stacklevel=3,
        )
    return spark.read.format("jdbc").options(**opts).load()
