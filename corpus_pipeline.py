"""From raw documents to a training mixture: toxicity, line dedup, near copies,
benchmark passages, mixing.  Each stage is written as Parquet in the shared folder
and reread, so a lost executor costs the stage it was in at most."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyframe.llm import decontamination, line_runs, mixture, ngram_join, toxicity
from tidyframe.llm.common import materialize, table

#: weights of the sources in code point order, repeating
WEIGHTS = (5.0, 2.0, 1.0)


def _as_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` true to the text."""
    return rows.select(*(
        F.char_length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars"
        else F.col(f"`{c}`") for c in docs.columns))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: names that operators give to columns of their own
TAKEN = ("n_lines", "n_removed", "n_runs")


def _keeping_names(stage: Stage) -> Stage:
    """The user's columns may be named like an operator's own ones: under other names
    meanwhile, they come out as they went in."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        other = {c: f"user_column_{i}" for i, c in enumerate(docs.columns)
                 if c.startswith("__") or c.lower() in TAKEN}
        if not other:
            return stage(spark, docs, sf_dir)
        out = stage(spark, docs.withColumnsRenamed(other), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in other.items()})

    return run


@_keeping_names
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@_keeping_names
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; so do documents of nothing else."""
    rows = line_runs.dedup_lines(docs)
    return _as_documents(rows.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))),
                         docs)


@_keeping_names
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    return ngram_join.drop_near_copies(docs, width=5, percent=80)


@_keeping_names
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_keeping_names
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mixture takes."""
    return mixture.mix_sources(docs, WEIGHTS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
]

#: training a network and following components are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
