"""Personal data: base patterns against plain regular expressions, the field against
exhaustive sums and searches, and its labels on texts it was not trained on."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tidyframe.llm import pii
from tidyframe.llm.queries import op12_pii

SF = "/root/testdata/sf0.001"


def luhn(digits):
    ds = [int(c) for c in digits][::-1]
    return (sum(ds[::2]) + sum(sum(divmod(2 * d, 10)) for d in ds[1::2])) % 10 == 0


def brute(text):
    """The four patterns as they are written down."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    find = lambda p: re.finditer(p, text)
    out = [("email", *m.span()) for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    out += [("ip", *m.span()) for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
            if max(map(int, m.group().split("."))) <= 255]
    out += [("card", *m.span()) for m in find(r"[0-9]([\x20-]?[0-9])+")
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 8 <= len(digits(m)) <= 15]


def test_base_patterns():
    rng = random.Random(3)
    pieces = ["@", ".", "+", "-", " ", "a", "b.c", "%", "_", "1", "25", "255", "256", "007", "(", ")", "é", "\n",
              "4111111111111111", "4111 1111 1111 1111", "12345678", "x@y.z", "1.2.3.4", "+1 (743) 555-3824", "\t"]
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 9)))
        assert pii.base_spans(text) == brute(text), text


def test_base_patterns_take_linear_time():
    for one in ("a", "1", "1.", "a@", "+1", "1 ", "@a.", "a.", "+1 ", "4111111111111111 "):
        pii.find_spans([one * (400_000 // len(one))], pii.train())


def tiny(rng, k=len(pii.LABELS)):
    return rng.normal(size=(k, k)) * 2


def test_marginals_and_gradient():
    rng = np.random.default_rng(1)
    k = 3
    e, moves = rng.normal(size=(4, k)), rng.normal(size=(k, k))

    def score(path):
        full = [0, *path, 0]
        return sum(e[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(full))

    paths = list(itertools.product(range(k), repeat=4))
    weight = np.exp([score(p) for p in paths])
    whole, p, _ = pii._marginals(e, moves)
    assert whole == pytest.approx(np.log(weight.sum()))
    for t in range(4):
        for y in range(k):
            assert p[t, y] == pytest.approx(sum(w for q, w in zip(paths, weight, strict=True) if q[t] == y)
                                            / weight.sum())
    rows = [(rng.integers(0, 2, (5, 6)).astype(float), np.array([0, 1, 2, 0, 1])),
            (rng.integers(0, 2, (1, 6)).astype(float), np.array([2]))]
    w = rng.normal(size=(6, k))
    _, dw, dm = pii.loss_and_gradient(rows, w, moves)
    for at, grad in ((w, dw), (moves, dm)):
        for i, j in ((0, 0), (1, 2), (2, 1)):
            old = at[i, j]
            at[i, j] = old + 1e-5
            up = pii.loss_and_gradient(rows, w, moves)[0]
            at[i, j] = old - 1e-5
            down = pii.loss_and_gradient(rows, w, moves)[0]
            at[i, j] = old
            assert grad[i, j] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-6)


def plain_viterbi(e, moves):
    best, back = moves[0] + e[0], []
    for row in e[1:]:
        way = best[:, None] + moves
        back.append(way.argmax(axis=0))
        best = way.max(axis=0) + row
    y = [int((best + moves[:, 0]).argmax())]
    for b in reversed(back):
        y.append(int(b[y[-1]]))
    return y[::-1]


def test_batched_viterbi_equals_one_text_at_a_time(monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(pii, "VITERBI_WORDS", 40)
    for scale in (0.3, 3.0):
        field = pii.Field({}, tiny(rng))
        table = rng.normal(size=(12, 3, len(pii.LABELS))) * scale
        table[:6, :, 0] += 6  # shapes that are O almost surely
        sizes = [0, 1, 7, 0, 30, 2, 90, 1, 0]
        ids = rng.integers(0, 12, sum(sizes))
        cuts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        got = pii.label_words(field, ids, cuts, table)
        for a, n in zip(cuts, sizes, strict=True):
            part = ids[a:a + n]
            if n:
                e = table[part, 0].copy()
                e[1:] += table[part[:-1], 1]
                e[:-1] += table[part[1:], 2]
                assert got[a:a + n].tolist() == plain_viterbi(e, field.moves)


def values(text):
    return [(k, text[a:b], base) for k, a, b, base in pii.find_spans([text], pii.train())[0]]


def test_field_adds_what_the_patterns_miss():
    """None of these texts is in the labelled table."""
    for text, want in [
            ("Write to anna[at]web[dot]de, please", ("email", "anna[at]web[dot]de")),
            ("then érica@mañana.example wrote back", ("email", "érica@mañana.example")),
            ("or ring (415) 555-2671 in the morning", ("phone", "(415) 555-2671")),
            ("You get him under 628-555-0143.", ("phone", "628-555-0143")),
            ("we saw 10[.]1[.]2[.]3 in a log", ("ip", "10[.]1[.]2[.]3")),
            ("the host 2001:db8:1:2:3:4:5:6 is new", ("ip", "2001:db8:1:2:3:4:5:6")),
            ("they took 5555.5555.5555.4444 as well", ("card", "5555.5555.5555.4444")),
            ("both 7536784127813050 4845168114407329 were used", ("card", "4845168114407329"))]:
        assert (*want, False) in values(text), text


def test_field_leaves_clean_texts_alone():
    for text in ["On 3.10.1990 and 2021-11-30 it rained", "It cost $5,420.50 in 1987, not 3.5", "v2.11.4 of 17 files",
                 'secret = "bc0d31ba76f17e56642e8751295a3fd50cd8e61f" was kept', "ISBN 978-1-86197-876-9, page 303",
                 "A plain text. With two sentences, (and brackets)!", "see https://www.example.net/x/123?y=4#5",
                 "| 1 | 2 | 3 |", "", "   \n\t ", "!!! ### 17%%% 4&&&", "rows 10 200 3000 40000"]:
        assert values(text) == [], text
    for r in pii.parse_labelled(pii.LABELLED):
        assert len(r[0]) == len(r[1])


def test_odd_rows(spark):
    schema = "doc_id string, text string, found int, masked string, kind string"
    mail = "mail a@b.cd or b[at]web[dot]de"
    table = [("1", None, 1, "m", "k"), ("2", "", 1, "m", "k"), (None, mail, 1, "m", "k"), (None, mail, 1, "m", "k"),
             ("3", "word " * 200_000 + "call +1 (743) 555-3824 now", 1, "m", "k"), ("4", "é" * 300_000, 1, "m", "k")]
    got = pii.find_personal_data(spark.createDataFrame(table, schema)).collect()
    assert sorted((r["doc_id"] or "", len(r["found"])) for r in got) == \
        [("", 2), ("", 2), ("1", 0), ("2", 0), ("3", 1), ("4", 0)]
    by = {r["doc_id"]: r["masked"] for r in got}
    assert by["1"] is None and by["2"] == "" and by[None] == "mail <EMAIL> or <EMAIL>"
    assert by["3"].endswith("call <PHONE> now")
    assert pii.find_personal_data(spark.createDataFrame([], schema)).count() == 0


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op12_pii(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == w[0] for w in want) for k in pii.KINDS]
        said = [":".join(map(str, w)) for w in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r["spans"].split(","))
