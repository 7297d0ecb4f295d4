"""Collocations against a plain count of all phrases, with small thresholds."""

from __future__ import annotations

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from tidyframe.llm import collocations
from tidyframe.llm.queries import op11_collocations

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, least=100, top=2000, absorb=100, depth=5):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, depth + 1):
                for i in range(len(w) - m + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, count in f.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        cands = {p: c for p, c in count.items() if len(p) > 1 and c >= least}
        inside = collections.defaultdict(int)
        for p, c in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], c)
        found = []
        for p, a in cands.items():
            if p in inside and 100 * inside[p] >= absorb * a:
                continue
            cuts = [(1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def got(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(r) for r in frame.collect())


SCHEMA = "doc_id long, lang string, text string, n int, phrase string, f int"


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(1, a, b, 1, "p", 2) for a, b in rows], SCHEMA).repartition(parts)


ODD = [("en", "A b c D. a b c d, e"), ("en", "a b c d"), ("en", "a b c d"), (None, "x y! x y\nx\ty"), ("und", "x y"),
       ("en", None), ("en", ""), ("en", " \t\n.,;"), ("en", "a\x01 b a\x01 b a\x01 b a"), ("fr", "é à é à É à"),
       ("en", "b c " * 40), ("en", "w" * 50_000 + " z"), ("", "q q q q q q q q"), ("en", ".a.b.c d:a b"),
       ("de", "1 2\r3 4\x0b5 6\x0c1 2"), ("en", " ".join(f"r{k}" for k in range(3000)))]


@pytest.mark.parametrize("budget", [1, 3, 1000])
@pytest.mark.parametrize("absorb", [100, 60])
def test_odd_rows_and_every_budget(spark, budget, absorb):
    frame = collocations.collocations(docs_of(spark, ODD), min_count=2, top=7, absorb=absorb, budget=budget)
    assert got(frame) == brute(ODD, least=2, top=7, absorb=absorb)


def test_random_texts(spark):
    rng = np.random.default_rng(4)
    rows = [(["en", None, "de"][rng.integers(3)], "".join(rng.choice(["a", "b", "c ", "D", " ", ".", " e"], 60)))
            for _ in range(300)]
    for depth, least in ((5, 3), (3, 20), (2, 5)):
        frame = collocations.collocations(docs_of(spark, rows), depth=depth, min_count=least, budget=50)
        assert got(frame) == brute(rows, least=least, depth=depth)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 7)
    frame = collocations.collocations(docs_of(spark, ODD), min_count=2, budget=10)
    assert got(frame) == brute(ODD, least=2)


def test_groups_keep_to_the_budget(spark):
    rows = [(f"{a} {b} {c}", "en") for a in "ab" for b in range(30) for c in range(30)]
    leaves = spark.createDataFrame([(t, lang, 1) for t, lang in rows], "suffix string, lang string, f long")
    parts = collocations.partition_leaves(leaves, 5, 40).collect()
    assert len(parts) == len(rows)
    for key in (("lang", "prefix"), ("grp",)):
        sizes = collections.Counter(tuple(r[c] for c in key) for r in parts)
        assert max(sizes.values()) <= (40 if len(key) > 1 else 80)
    assert all(r["prefix"] == " ".join(r["suffix"].split()[:r["words"]]) for r in parts)


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts of a huge corpus: the score is exact where its factors pass 64 bits."""
    big = 30_000_000_000_000_007
    freq = spark.createDataFrame([("en", "a", big), ("en", "b", big - 2), ("en", "a b", 1_234_567_890_123_457)],
                                 "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 2 * big + 5)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: (freq, totals))
    row, = collocations.collocations(docs_of(spark, [])).collect()
    assert row["score"] == 1000 * 1_234_567_890_123_457 * (2 * big + 5) // (big * (big - 2))


def test_empty_table(spark):
    assert got(collocations.collocations(docs_of(spark, []))) == []


def test_query(spark):
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows)
    assert want and got(op11_collocations(spark, SF)) == want


def told(texts, most, depth=5):
    """Rows of a task that reads each text as a batch of its own; all words may be frequent."""
    full = [np.full(1 << collocations.BITS >> 6, ~np.uint64(0))] * 3
    batches = (pa.RecordBatch.from_pydict({"lang": ["en"], "text": [t]}) for t in texts)
    return [r for b in collocations._count_leaves(full, depth, most)(batches) for r in b.to_pylist()]


def test_a_task_tells_a_leaf_once():
    text = "a b c d e f g, x y. a b c d e"
    want = {"a b c d e": 2, "b c d e f": 1, "c d e f g": 1, "d e f g": 1, "e f g": 1, "f g": 1, "x y": 1,
            "b c d e": 1, "c d e": 1, "d e": 1}
    rows = told([text] * 7, most=1000)
    assert sorted((r["lang"], r["suffix"], r["f"]) for r in rows) == sorted(("en", s, 7 * n) for s, n in want.items())
    rows = told([text] * 7, most=1)  # told after each chunk: the same sums
    assert len(rows) == 7 * len(want)
    assert sum((collections.Counter({r["suffix"]: r["f"]}) for r in rows), collections.Counter()) == \
        {s: 7 * n for s, n in want.items()}
    assert told(["", "a", ". . ."], most=1000) == []


@pytest.mark.parametrize("pruned", [1, 2, 4, 5])
def test_how_far_rare_windows_are_left_out_changes_nothing(spark, monkeypatch, pruned):
    monkeypatch.setattr(collocations, "PRUNED", pruned)
    monkeypatch.setattr(collocations, "TASK_LEAVES", 3)
    frame = collocations.collocations(docs_of(spark, ODD), min_count=2, budget=10)
    assert got(frame) == brute(ODD, least=2)
