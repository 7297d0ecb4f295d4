"""Corpus operators against brute force, on odd rows and on whole small tables."""

from __future__ import annotations

import collections
import hashlib
import os
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from tidyframe.llm import (  # noqa: E402
    chat_format,
    components,
    decontamination,
    line_runs,
    mixture,
    ngram_join,
    quality_ledger,
    substring_dedup,
    token_counts,
    toxicity,
    url_templates,
)

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
PASSAGE = " ".join(f"p{k}" for k in range(70))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score int, n_lines int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a long text, ties, repeated rows, extra and clashing columns."""
    texts = [(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (2, None), (3, ""), (None, None),
             (None, "a b c d e f g h i j k"), (4, LONG), (5, LONG + " end"), (6, f"x {PASSAGE}"),
             (7, f"{PASSAGE} y\nz"), (8, "one\u00a0word Ünïcode ÀB"), (8, "other text of one id"),
             (9, "\n\n \t\n"), (10, "l1\nl2\nl3\nl4\nl5"), (11, "l0\nl1\nl2\nl3\nl4\nl6")]
    return spark.createDataFrame([(i, t, None, "s" if i else None, None, "k", 1, 2) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORDS.findall(text or "")


def rows(df):
    return [r.asDict() for r in df.collect()]


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_line_runs_are_counted_without_blank_lines(spark):
    eight = [f"line {k}" for k in range(8)]
    docs = spark.createDataFrame([(1, "\n".join(eight)), (2, "\n\n \n".join(eight)),
                                  (3, "\n".join([*eight[:4], "new", *eight[4:]]))], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_runs"]) for r in line_runs.dedup_lines(docs).collect()}
    assert got == {1: (0, 0), 2: (8, 1), 3: (8, 2)}


# ------------------------------------------------------------ token counts, quality


def test_token_counts(spark, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    more = spark.createDataFrame([(20, "x<|endoftext|>y it's we'll 12 É\u0301"), (21, "\u0301a \x1c\x85b \u3000c")],
                                 "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more).unionByName(docs_of(spark).select("doc_id", "text"))
    want = collections.Counter(
        (r["doc_id"], len((r["text"] or "").encode()), len(t.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in rows(docs))
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_tokens"])
                              for r in rows(token_counts.count_tokens(docs, path)))
    assert got == want
    assert token_counts.count_tokens(empty, path).count() == 0


def quality_brute(text):
    w, seen, dup, at = words(text), set(), 0, collections.defaultdict(list)
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    for k in range(len(w) - 4):
        at[tuple(w[k:k + 5])].append(k)
    cover = {j for ks in at.values() if len(ks) > 1 for k in ks for j in range(k, k + 5)}
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(cover))


def test_quality_ledger(spark, odd, empty):
    extra = spark.createDataFrame([(30, "a b " * 40), (31, "a a a a a a"), (32, "x\n\nx\n x\n#$ <>")],
                                  "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(extra).unionByName(docs_of(spark).select("doc_id", "text"))
    led = quality_ledger.ledger(docs).cache()
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert collections.Counter((r["doc_id"], *(r[c] for c in cols)) for r in rows(led)) == \
        collections.Counter((r["doc_id"], *quality_brute(r["text"])) for r in rows(docs))
    bits = [r["fail_bits"] for r in rows(led)]
    mask = quality_ledger.policy_mask("v1")
    for r in rows(quality_ledger.ablation(led, "v1")):
        bit = 1 << [n for n, _ in quality_ledger.RULES].index(r["rule"])
        assert r["failed"] == sum(b & bit > 0 for b in bits)
        assert r["rejected_alone"] == sum(b & mask == bit for b in bits)
        assert r["rejected"] == sum(b & mask > 0 for b in bits)
    assert quality_ledger.ledger(empty).count() == 0


# ------------------------------------------------------------------------ join


def join_brute(docs, width, percent):
    sets = []
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()))
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(sets):
        least[find(k)].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    return collections.Counter((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_ngram_join_near_copies(spark, odd, width, percent):
    rng = np.random.default_rng(5)
    base = [f"b{k}" for k in range(120)]
    near = []
    for k in range(80):
        w = list(base)
        for at in rng.choice(120, rng.integers(0, 5), replace=False):
            w[at] = f"e{rng.integers(9)}"
        near.append((100 + k, " ".join(w)))
    docs = odd.select("doc_id", "text").unionByName(
        spark.createDataFrame(near, "doc_id long, text string"))
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"])
                              for r in rows(ngram_join.similarity_components(docs, width, percent)))
    assert got == join_brute([(r["doc_id"], r["text"]) for r in rows(docs)], width, percent)


def test_groups_are_compared_in_compact_code(spark):
    from conftest import plan_text

    rng = np.random.default_rng(11)
    sim, longs = ngram_join.Similarity(4, 85), ngram_join.SKETCH
    base = rng.integers(-1 << 63, 1 << 63, longs)
    groups = []
    for k in range(40):  # a few bits from one sketch; loose bits: none known, some, all of a long
        flips = np.bitwise_or.reduce(np.int64(1) << rng.integers(0, 63, (int(rng.integers(1, 4)), longs)), axis=0)
        vary = None if k % 3 == 0 else [int(x) for x in rng.integers(-1 << 63, 1 << 63, longs) * (k % 3 - 1)]
        groups.append((k, int(rng.integers(80, 300)), [int(x) for x in base ^ flips], vary))
    table = spark.createDataFrame(groups, "k long, n long, sketch array<long>, vary array<long>").select(
        "k", "n", *ngram_join._spread_sketch())
    side = lambda s: table.select(*(F.col(c).alias(f"{c}_{s}") for c in table.columns))
    got = {(r[0], r[1]) for r in side("a").crossJoin(side("b")).filter(
        ngram_join._groups_close(sim)).select("k_a", "k_b").collect()}
    differ = lambda x, y: sum(((a ^ b) & ~v & ~w & (1 << 64) - 1).bit_count() for a, b, v, w in zip(
        x[2], y[2], x[3] or [0] * longs, y[3] or [0] * longs, strict=True))
    want = {(x[0], y[0]) for x in groups for y in groups if 185 * differ(x, y) <= 15 * (x[1] + y[1])}
    assert got == want and 40 < len(got) < 1600

    slim = table.limit(3).select(F.col("k").alias("id"), "n", F.array(*["bits0"] * longs).alias("sketch"),
                                 F.array(F.lit(7).cast("long")).alias("prefix"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = ngram_join._group_pairs(slim, slim.select("id", F.col("id").alias("comp")), sim)
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", plan_text(pairs, "codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(map(int, sizes)) < 6000  # bytes; 7854 on arrays


def test_ngram_join_table(spark, empty):
    docs = docs_of(spark)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"])
                              for r in rows(E.queries()["op6_ngram_join"](spark, SF)))
    assert got == join_brute([(r["doc_id"], r["text"]) for r in rows(docs)], 4, 85)
    assert ngram_join.similarity_components(empty).count() == 0


def test_drop_near_copies_keeps_one(odd):
    left = ngram_join.drop_near_copies(odd)
    assert left.columns == odd.columns
    ids = sorted((r["doc_id"] or -1) for r in rows(left) if words(r["text"]))
    assert ids == [1, 4, 6, 8, 8, 10, 11] or ids == [1, 4, 6, 7, 8, 8, 10, 11]
    assert left.filter("text IS NULL OR text = ''").count() == 3


def test_components_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(50, 51)], "a long, b long")
    got = {r["node"]: r["component"] for r in rows(components.connected_components(edges))}
    assert got == {**{k: 1 for k in range(1, 41)}, 50: 50, 51: 50}


# ------------------------------------------------------- lines, substrings, leaks


def lines_brute(docs, min_lines=4, min_words=10):
    order = sorted({(i is None, i or 0, t) for i, t in docs if t is not None})
    seen, out = set(), {}
    for null, i, t in order:
        lines = t.split("\n")
        place = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\f\r")]
        own = [lines[k].strip(" \t\n\x0b\f\r") for k in place]
        gone = set()
        for k in range(len(own)):
            if own[k] in seen and len(words(own[k])) >= min_words:
                gone.add(place[k])
            seen.add(own[k])
            run = tuple(own[k:k + min_lines])
            if len(run) == min_lines:
                if run in seen:
                    gone.update(place[k:k + min_lines])
                seen.add(run)
        out[(None if null else i, t)] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def test_line_runs(spark, odd, empty):
    docs = odd.filter("doc_id IS NULL OR doc_id <> 8").select("doc_id", "text").unionByName(
        docs_of(spark).select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    want = lines_brute([(r["doc_id"], r["text"]) for r in rows(docs)])
    src = collections.Counter((r["doc_id"], *want.get((r["doc_id"], r["text"]), (None, 0))) for r in rows(docs))
    got = collections.Counter((r["doc_id"], r["text"], r["n_removed"]) for r in rows(line_runs.dedup_lines(docs)))
    assert got == src
    assert line_runs.dedup_lines(odd).select(*[c for c in odd.columns if c != "n_lines"]).count() == 15
    assert line_runs.dedup_lines(empty).count() == 0


def substring_brute(docs, window=50):
    first, out = {}, collections.Counter()
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                s = tuple(w[k:k + window])
                first[s] = min(first.get(s, i), i)
    for i, t in docs:
        w = words(t)
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                keep[k:k + window] = [False] * window
        left = " ".join(x for x, y in zip(w, keep, strict=True) if y)
        out[i, len(w), len(w) - sum(keep), hashlib.sha256(left.encode()).hexdigest()] += 1
    return out


def test_substring_dedup(spark, odd, empty):
    docs = odd.withColumn("text", F.substring("text", 1, 6000)).select("doc_id", "text").unionByName(
        docs_of(spark).select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                              for r in rows(substring_dedup.dedup_substrings(docs)))
    assert got == substring_brute([(r["doc_id"], r["text"]) for r in rows(docs)])
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_substring_dedup_splits_a_hot_minimiser(spark, monkeypatch):
    stock = " ".join(f"s{k}" for k in range(40))
    docs = [(i, " ".join(f"a{i}x{k}" for k in range(45)) + f" {stock} " + " ".join(f"b{i}x{k}" for k in range(45)))
            for i in range(60)]
    docs += [(100 + i, f"c{i} {docs[i][1]}") for i in (3, 7, 7)]  # repeats longer than a window
    limit, least_ids = 300, substring_dedup._least_ids

    def bounded(packed, doc_ids, window):  # runs in the tasks
        n = sum(p.count(b" ") + 2 - window for p in packed)
        assert n < 2 * limit, f"{n} windows at a time"
        return least_ids(packed, doc_ids, window)

    monkeypatch.setattr(substring_dedup, "BUCKET_WINDOWS", limit)
    monkeypatch.setattr(substring_dedup, "_least_ids", bounded)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                              for r in rows(substring_dedup.dedup_substrings(table)))
    assert got == substring_brute(docs)
    assert sum(r[2] * n for r, n in got.items()) == 390


def test_substring_dedup_repeated_windows_of_a_text_are_one_row(spark, monkeypatch):
    import pyarrow as pa

    docs = [(i, f"a{i} b{i} " + "go on " * (150 + i) + f"c{i}") for i in range(20)]
    docs += [(40 + i, docs[i][1] + " " + docs[i][1]) for i in range(3)]
    strings, places = substring_dedup._strings, []
    for doc_id, text in docs:
        hot = sorted({m for *_, (least, _, _) in substring_dedup._each_text(
            pa.record_batch({"text": [text]}), 50) for m in least.tolist()})
        part = pa.record_batch({"doc_id": [doc_id], "row_no": [doc_id], "text": [text], "shared": [hot], "hot": [hot]})
        for found in strings(50, False)([part]):
            first = [x for xs in found.column("firsts").to_pylist() for x in xs]
            assert sorted(first) == list(range(len(words(text)) - 49))  # every window, once
            places.append(found.num_rows)
    assert max(places) < 200  # 254 windows and more, the two of the pair over and over

    monkeypatch.setattr(substring_dedup, "BUCKET_WINDOWS", 300)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                              for r in rows(substring_dedup.dedup_substrings(table)))
    assert got == substring_brute(docs)


def test_decontamination(spark, odd, empty):
    bench = spark.createDataFrame([
        (1, "Tom has 12 apples and gives 5 of them to his friend Anna who then eats 3 right away."),
        (2, "short item"), (3, None)], "item_id long, text string")
    item = bench.first()["text"]
    cases = {40: ("so " + item + " more words here", True),
             41: (item.replace("12", "77").replace("Anna", "Berta"), True),       # other values
             42: (item.replace("12", "5").replace("5 of", "9 of").replace("3", "12"), True),
             43: ("Tom has bread and gives nothing of it to anyone at all today", False),
             44: (None, False)}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(decontamination.judge_documents(docs, bench))}
    assert {i: r["contaminated"] for i, r in got.items()} == {i: y for i, (_, y) in cases.items()}
    assert got[40]["item_ids"] == [1] and got[40]["verbatim"] and not got[41]["verbatim"]
    left = decontamination.drop_contaminated(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert decontamination.judge_documents(empty, bench).count() == 0
    none = bench.limit(0)
    assert decontamination.judge_documents(docs, none).filter("contaminated").count() == 0


def test_decontamination_slots_must_agree(spark):
    bench = spark.createDataFrame(
        [(1, "add 3 to the left and then add 3 to the right and then add 3 more")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "add 7 to the left and then add 7 to the right and then add 7 more"),
         (2, "add 7 to the left and then add 8 to the right and then add 9 more")], "doc_id long, text string")
    got = {r["doc_id"]: r["contaminated"] for r in rows(decontamination.judge_documents(docs, bench))}
    assert got == {1: True, 2: False}


def test_decontamination_conflict_drops_its_windows_only(spark):
    tail = " ".join(f"plain{chr(97 + k)}" for k in range(20))
    bench = spark.createDataFrame(
        [(1, f"take 3 of the red ones {tail} and add 3 of the blue"),
         (2, "so we saw Anna and Carl go home there and later on we met Anna again by the old mill pond")],
        "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"take 3 of the red ones {tail} and add 4 of the blue"),    # one of two equal numbers
         (2, f"take 5 of the red ones {tail} and add 4 of the blue"),    # stands for two others
         # one of two equal names, and another name put in throughout: windows with both stay
         (3, "so we saw Anna and Dora go home there and later on we met Berta again by the old mill pond"),
         (4, "take 5 of the red ones and add 4 of the blue")], "doc_id long, text string")
    got = {r["doc_id"]: (r["item_ids"], r["verbatim"])
           for r in rows(decontamination.judge_documents(docs, bench))}
    assert got == {1: ([1], True), 2: ([1], True), 3: ([2], False), 4: ([], None)}


def test_decontamination_plain_words(spark):
    items = {1: "Alice Brown met Carl Davis near Elm Street while Frank Green called Helen Irving",
             2: "the water in the old harbour froze over twice during that long winter of the war and nobody sailed",
             3: "we then saw Peter standing near the gate", 4: "Which river is longest?", 5: "Ärger ÜBER Öl",
             6: "", 7: "on the hill that evening the mayor of our town met Gustav who had come by boat"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    cases = [(1, "x " + items[1] + " y", [1]), (2, items[2].upper(), [2]),
             (3, "and so " + items[3].capitalize() + " at noon", [3]),
             (4, "he asked WHICH RIVER is longest, twice: which river is longest", [4]),
             (5, "viel ärger über öl hier", [5]), (6, items[7].lower(), [7]), (7, "", []), (8, None, []),
             (9, "Alice Brown met Carl Smith near Oak Street and which river is long", [])]
    docs = spark.createDataFrame([(i, t) for i, t, _ in cases], "doc_id long, text string")
    got = {r["doc_id"]: (r["item_ids"], r["verbatim"])
           for r in rows(decontamination.judge_documents(docs, bench))}
    assert got == {i: (k, True if k else None) for i, _, k in cases}


def test_decontamination_table(spark):
    items = {r["item_id"]: " ".join(words(r["text"]))
             for r in rows(spark.read.parquet(f"{SF}/benchmark.parquet"))}
    want = {r["doc_id"]: sorted(k for k, t in items.items() if t in " ".join(words(r["text"])))
            for r in rows(docs_of(spark))}
    got = {r["doc_id"]: r["item_ids"] for r in rows(E.queries()["op5_decontamination"](spark, SF))}
    assert got == want


# --------------------------------------------------------- urls, mixture, chats


def test_urls(spark):
    urls = ["https://WWW.Example.com/en/1?x", "http://a.example.com/en/2#t", "http://b.com", "ftp://b.com/", None,
            "no scheme", "http://m.x.net/es/3", "http://x.net/de/3", "http://y.org/a/b://c/d", "http://com/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    from tidyframe.llm.queries import URL_RULES

    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in rows(url_templates.filter_urls(pages, URL_RULES))}
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        1: ("a.example.com", "/en/2", "example.com/en/", "block"), 2: ("b.com", "", None, "allow"),
        3: ("b.com", "/", "com/", "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
        6: ("m.x.net", "/es/3", "net/es/", "block"), 7: ("x.net", "/de/3", None, "allow"),
        8: ("y.org", "/a/b://c/d", None, "allow"), 9: ("com", "/q", "com/", "allow")}
    assert url_templates.filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_url_template_tree_blocks_by_purity(spark):
    bad = [f"http://h.org/spam/{k}" for k in range(40)]
    rules = [(f"h.org/spam/{k}", "block") for k in range(20)]
    good = [f"http://h.org/news/{k}" for k in range(40)]
    pages = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    got = {r["page_id"]: r for r in rows(url_templates.filter_urls(pages, rules))}
    assert {got[k]["template"] for k in range(40)} == {"/spam/*"}
    assert all(got[k]["verdict"] == "block" and got[k + 40]["verdict"] == "allow" for k in range(40))


def test_url_templates_do_not_depend_on_row_counts(spark):
    rules = [(f"h.org/spam/{k}", "block") for k in range(20)]
    urls = [f"http://h.org/{s}/{k}" for s in ("spam", "news") for k in range(40)]

    def judged(pages, rules):
        table = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
        return {pages[r["page_id"]]: (r["template"], r["verdict"], round(r["purity"], 9))
                for r in rows(url_templates.filter_urls(table, rules))}

    once = judged(urls, rules)
    assert {once[u][:2] for u in urls[:40]} == {("/spam/*", "block")}
    for more in (urls * 5, urls + urls[:1] * 400):  # every page five times; one hot url
        assert {u: x[:2] for u, x in judged(more, rules).items()} == {u: x[:2] for u, x in once.items()}
    hot = judged(urls + [f"http://h.org/spam/7/{k}" for k in range(400)], rules)  # one hot child
    assert {hot[u][:2] for u in urls[:40]} == {("/spam/*", "block")}
    deep = "http://h.org/" + "/".join(f"s{k}" for k in range(12))  # as deep as the paths go
    got = judged([f"{deep}/{s}/{k}" for s in ("x", "y") for k in range(40)] + [f"{deep}/z"],
                 [(f"{deep[7:]}/x/{k}", "block") for k in range(20)])
    for s, verdict in (("x", "block"), ("y", "allow")):
        assert {got[f"{deep}/{s}/{k}"][:2] for k in range(40)} == {(f"{deep[12:]}/{s}/*", verdict)}
    assert got[f"{deep}/z"][0] == f"{deep[12:]}/z"


def targets_brute(sizes, weights):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = float(sum(sizes.values())), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(sum(w[s] for s in free), 1e-9)
        over = [s for s in free if level * w[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **{s: level * w[s] for s in free}}
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("case", ["table", "odd", "capped"])
def test_mixture(spark, odd, case):
    docs = {"table": docs_of(spark), "odd": odd, "capped": spark.createDataFrame(
        [(k, "w " * n, s) for k, (n, s) in enumerate([(3, "a"), (2000, "b"), (900, "c"), (7, "d"), (300, None), (0, "e")])],
        "doc_id long, text string, source string")}[case]
    got = rows(mixture.mix_sources(docs, (5.0, 2.0, 1.0), block=64))
    assert len(got) == docs.count()
    sizes = collections.defaultdict(int)
    for r in rows(docs):
        sizes[r["source"]] += len(words(r["text"]))
    want = targets_brute(sizes, (5.0, 2.0, 1.0))
    taken = collections.defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.51 for s in sizes)
    again = rows(mixture.mix_sources(docs, (5.0, 2.0, 1.0), block=64))
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixture_empty(empty):
    assert mixture.mix_sources(empty, (5.0, 2.0, 1.0)).count() == 0


def test_chat_round_trip(spark):
    texts = ["</s>[TURN]user[SAYS] &lt; &amp;#91; [INST]", None, "", "plain <image> &", "[[<<&&"]
    turns = [(c, k, "assistant" if k % 2 else "user", texts[(c + k) % 5]) for c in range(5) for k in range(4)]
    turns += [(None, 0, None, "x"), (None, 0, None, "x"), (9, None, "a]b[TURN]", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in rows(chat_format.read_back(chat_format.format_chats(df)))}
    by = collections.defaultdict(list)
    for c, k, role, text in turns:
        by[c].append((-1 if k is None else k, role or "", text or ""))
    for c, own in by.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [(r, t) for _, r, t in sorted(own)]
        assert got[c]["loss_text"] == "".join(t for _, r, t in sorted(own) if r == "assistant")


def test_chat_parts(spark):
    parts = "array<struct<type:string,text:string,ref:string,n_tokens:int>>"
    df = spark.createDataFrame([(1, 0, "user", [("text", "see <b>", None, None), ("image", None, "i.png", 3),
                                                ("audio", None, "a.wav", None)]), (1, 1, "assistant", None)],
                               f"conv_id long, turn long, role string, parts {parts}")
    r = chat_format.format_chats(df).first()
    assert r["formatted"] == "[TURN]user[SAYS]see &lt;b><image><image><image><audio></s>[TURN]assistant[SAYS]</s>"
    assert [(a["type"], a["ref"], a["n_tokens"], a["part_no"]) for a in r["attachments"]] == [
        ("image", "i.png", 3, 1), ("audio", "a.wav", 1, 2)]
    assert r["n_placeholder_tokens"] == 4


# --------------------------------------------------------------------- toxicity


def test_gradients():
    rng = np.random.default_rng(1)
    model = {k: v.astype(np.float64) for k, v in toxicity.new_model(1).items()}
    x = rng.standard_normal((6, 2 * toxicity.DIM))
    index = rng.integers(0, 6, (5, 4))
    index[3:, 1] = -1
    doc_of, labels = np.array([0, 0, 1, 1]), np.array([1, 0])
    _, g, d_x = toxicity._gradients(model, x, index, doc_of, labels)
    loss = lambda: toxicity._gradients(model, x, index, doc_of, labels)[0]
    for name in ("o", "A", "v", "Uf", "Ub", "Wf", "cb"):
        flat, k = model[name].reshape(-1), 1
        old, flat[k] = flat[k], flat[k] + 1e-3
        up = loss()
        flat[k] = old - 1e-3
        down = loss()
        flat[k] = old
        assert (up - down) / 2e-3 == pytest.approx(g[name].reshape(-1)[k], rel=0.05, abs=1e-4), name


def test_toxicity_learns_held_out(spark, odd, empty):
    rng = np.random.default_rng(2)
    vocabulary = [f"word{k}" for k in range(300)]
    texts, labels = [], []
    for k in range(400):
        w = list(rng.choice(vocabulary, rng.integers(30, 200)))
        if k % 4 == 0:
            for at in rng.choice(len(w), 4):
                w[at] = rng.choice(["vilething", "vileness", "vilely"])
        texts.append((k, " ".join(w)))
        labels.append((k, int(k % 4 == 0)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs.unionByName(odd.select("doc_id", "text").filter("text IS NULL OR text = ''")),
                                     lab).withColumn("held", toxicity.is_held_out())
    got = rows(scored.join(lab, "doc_id", "left"))
    held = [(r["toxic"], r["__score"] >= 0.5) for r in got if r["held"] and r["doc_id"] > 11]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r["__score"] <= 1 for r in got)
    assert toxicity.score_toxicity(empty, lab.limit(0)).count() == 0
    assert toxicity.drop_toxic(odd, lab.limit(0)).count() == odd.count()


def test_toxicity_sample_takes_one_row_of_an_id(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    once = [(i, f"text {i} of the table") for i in range(40)]
    docs = spark.createDataFrame(
        once + [(i, f"other row {k} of a hot id") for i in range(40) for k in range(25)] + once * 3,
        "doc_id long, text string")
    alone = toxicity.sample_windows(docs.dropDuplicates(["doc_id"]), labels)
    got = toxicity.sample_windows(docs, labels)
    assert collections.Counter(y for y, _ in got) == collections.Counter(y for y, _ in alone)
    assert got == toxicity.sample_windows(docs.unionByName(docs), labels)


# --------------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    docs = docs_of(spark)
    out = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, out = out, stage(spark, out, SF)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns, name
            out = corpus_pipeline.materialize(out, "test")
            assert 0 < out.count() <= before.count(), name
    assert {"doc_id", "size", "taken", "target"} <= set(out.columns)


def test_stages_take_empty_and_odd_tables(spark, odd, empty):
    # columns named like the operators' own come out as they went in
    clash = {"__score": F.lit(5), "__dockey": F.lit("d"), "n_removed": F.lit("r"), "N_Runs": F.lit(7)}
    for docs in (empty, odd.withColumns(clash)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count(), name
            if k + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == docs.columns, name
                kept = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
                assert {tuple(r) for r in out.select(kept).collect()} <= {tuple(r) for r in docs.select(kept).collect()}
