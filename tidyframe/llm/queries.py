"""Registered queries of the corpus operators: each runs its operator with
production parameters over its whole table.  ORACLES holds DuckDB SQL where SQL
can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyframe.llm import (
    chat_format,
    collocations,
    decontamination,
    line_runs,
    mixture,
    ngram_join,
    pii,
    quality_ledger,
    sql,
    substring_dedup,
    token_counts,
    toxicity,
    url_templates,
    whitening,
)
from tidyframe.llm.common import table

URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS = 2048


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    score = F.col(toxicity.SCORE)
    return toxicity.score_toxicity(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", F.coalesce(toxicity.is_held_out(), F.lit(False)).alias("held_out"),
        score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path(TOKENIZER))
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ledger.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_ledger.passes("base")).alias("base_failed"),
        quality_ledger.passes("v1").alias("kept"), "fail_bits")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.judge_documents(table(spark, sf_dir, "documents"),
                                           table(spark, sf_dir, "benchmark"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, sf_dir, "documents"), width=4, percent=85) \
        .select("doc_id", "n_shingles", "component_id")


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", "n_runs",
                       F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_sources(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substring_dedup.dedup_substrings(docs, with_text=False).drop("kept_text")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    back = chat_format.read_back(chat_format.format_chats(turns.unionByName(planted)))
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        digest(F.concat_ws("", F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))))).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        digest(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))



def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find_personal_data(table(spark, sf_dir, "documents"), with_text=False)
    count = lambda kind: F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return rows.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(F.encode(pii.listed(base_only=True), "UTF-8"), 256).alias("base_sha256"),
        pii.listed().alias("spans"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_url_filter, op3_token_counts, op4_quality_rules, op5_decontamination,
    op6_ngram_join, op7_line_runs, op8_source_mixture, op9_substring_dedup, op10_chat_format,
    op11_collocations, op12_pii, op13_whitening)}

ORACLES: dict[str, str] = {
    "op4_quality_rules": sql.QUALITY,
    "op6_ngram_join": sql.NEAR_COPIES,
    "op7_line_runs": sql.LINE_RUNS,
    "op9_substring_dedup": sql.SUBSTRINGS,
    "op10_chat_format": sql.CHATS,
    "op11_collocations": sql.COLLOCATIONS,
}
