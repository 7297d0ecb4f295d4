"""Quality rules as a bitmask ledger.

``measure`` reads every whole text once; ``ledger`` evaluates every rule on the
measurements and stores one failure bit per rule beside them.  Policies are
versioned sets of rules applied to the stored bits, and ``ablation`` tells, from
the bits alone, what each rule of a policy decides.

Defined results: a null or empty text has no words and no lines and fails
``few_words``; rates over nothing are 0; repeated rows are measured alike; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import slices, split_words

MEASURES = ("n_chars_text", "n_words", "word_chars", "n_symbols", "n_upper", "n_lines",
            "n_dup_lines", "n_repeat_words")
_SPACE, _SYMBOLS, WINDOW = " \t\n\v\f\r", "#*$%&|<>", 5

#: rule -> failure condition; a rule's bit is its place in this list
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "n_lines > 1 AND 10 * n_dup_lines > 3 * n_lines"),
    ("capitals", "2 * n_upper > word_chars"),
)
#: version -> rules that reject
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(name for name, _ in RULES),
}


def _repeat_words(ids: np.ndarray) -> int:
    """Words in windows of WINDOW words found twice or more, first ones included.
    Windows are compared exactly: ids are paired and renumbered step by step."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    name, width = ids, 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        m = len(ids) - (width + step) + 1
        pair = name[:m] * np.int64(int(name.max()) + 1) + name[step:step + m]
        name = np.unique(pair, return_inverse=True)[1]
        width += step
    again = np.bincount(name)[name] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _line_counts(text: str) -> tuple[int, int]:
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return len(lines), len(lines) - len(set(lines))


def measure(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id and the MEASURES (long)."""

    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids, starts, _ = split_words(texts)
            out = {k: [] for k in MEASURES}
            for k, t in enumerate(texts):
                own = ids[starts[k]:starts[k + 1]]
                lines, dup = _line_counts(t)
                upper = sum(map(str.isupper, t)) if not t.islower() else 0
                for name, v in zip(MEASURES, (
                        len(t), len(own), len(t) - sum(map(t.count, _SPACE)),
                        sum(map(t.count, _SYMBOLS)), upper, lines, dup,
                        _repeat_words(np.unique(own, return_inverse=True)[1])), strict=True):
                    out[name].append(v)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(out[k], pa.int64()) for k in MEASURES)],
                names=["doc_id", *MEASURES])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{k} long" for k in MEASURES)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fail_bits() -> Column:
    bits = F.lit(0).cast("long")
    for k, (_, failed) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return bits


def policy_mask(version: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(name) for name in POLICIES[version])


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``fail_bits`` of every document."""
    return measure(docs).withColumn("fail_bits", fail_bits())


def passes(version: str, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0


def ablation(rows: DataFrame, version: str) -> DataFrame:
    """(rule, failed, rejected_alone, rejected): documents that fail the rule, those
    that no other rule of the policy rejects, and the policy's rejections.  One
    pass over the bits; the result has a row per rule."""
    mask = policy_mask(version)
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    bits = [(name, 1 << k) for k, (name, _) in enumerate(RULES) if mask >> k & 1]
    sums = [F.count(F.when(hit != 0, 1)).alias("_all")]
    for name, bit in bits:
        sums.append(F.count(F.when(hit.bitwiseAND(F.lit(bit).cast("long")) != 0, 1)).alias(f"f_{name}"))
        sums.append(F.count(F.when(hit == bit, 1)).alias(f"a_{name}"))
    one = rows.agg(*sums)
    each = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"f_{name}").alias("failed"),
                              F.col(f"a_{name}").alias("rejected_alone"), F.col("_all").alias("rejected"))
                     for name, _ in bits])
    return one.select(F.inline(each))
