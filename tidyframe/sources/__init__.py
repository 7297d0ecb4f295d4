"""Readers: files (CSV, JSON, Parquet, XML, globs) and JDBC tables."""

from tidyframe.sources.spec import FILE_FORMATS, JDBC_KINDS, SourceSpec
from tidyframe.sources.read import read_source

__all__ = ["FILE_FORMATS", "JDBC_KINDS", "SourceSpec", "read_source"]
