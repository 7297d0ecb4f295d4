"""Whitening against a plain numpy decomposition of the whole table."""

from __future__ import annotations

import numpy as np
import pytest

from tidyframe.llm import whitening
from tidyframe.llm.queries import op13_whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, component string, x int, n int"


def brute(vectors, k=32):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    dev = [sum(int(n * a - b) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    y = (n * x - s) / n
    _, s, v = np.linalg.svd(y)
    return n, dev, y, np.append(s, [0.0] * (len(v) - len(s))) ** 2 / n, v.T


def check(spark, vectors, extra=()):
    """Compare every row with brute force, up to the sign of a component."""
    table = [(k, [float(c) for c in v], "c", 1, 2) for k, v in enumerate(vectors)]
    got = whitening.whiten(spark.createDataFrame([*table, *extra], SCHEMA).repartition(4)).toPandas()
    n, dev, y, e, v = brute(vectors)
    rank = int((e > e[0] * 1e-24).sum())
    k = min(32, rank)
    assert len(got) == n * k and (got.n == n).all()
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    first = got.drop_duplicates("vec_id")
    assert {k: None if d != d else int(d) for k, d in zip(first.vec_id, first.deviation, strict=True)} == \
        {k: d if d < 1 << 53 else pytest.approx(d) if d < 1 << 63 else None for k, d in enumerate(dev)}
    for c, part in got.groupby("component"):
        assert part.explained.iloc[0] == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
        gap = min(abs(e[c - 1] - o) for i, o in enumerate(e) if i != c - 1) if len(e) > 1 else 1
        if gap > 1e-6 * e[0]:  # else any basis of the shared space is right
            w = part.sort_values("vec_id").whitened.to_numpy()
            want = y @ v[:, c - 1] / np.sqrt(e[c - 1])
            assert min(np.abs(w - want).max(), np.abs(w + want).max()) < 1e-6
    return got


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    bad = [(100, None, "", 0, 0), (101, [1.0, None] * 3, "", 0, 0), (102, [1.0, float("nan")] * 3, "", 0, 0),
           (103, [float("inf")] * 6, "", 0, 0), (104, [], "", 0, 0), (105, [1.0], "", 0, 0)]
    vectors = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6))
    check(spark, np.vstack([vectors, vectors[:3], vectors[:1]]), bad)


def test_whitening_of_ill_conditioned_tables(spark):
    rng = np.random.default_rng(6)
    wide = rng.normal(size=(300, 8)) * np.array([1e6, 1e4, 1e3, 10, 1, 1, .5, .1])
    check(spark, wide)
    constant = wide.copy()
    constant[:, 2], constant[:, 5] = 7.5, 2 * np.floor(constant[:, 4])
    constant[:, 4] = np.floor(constant[:, 4])  # a dependent dimension
    check(spark, constant)
    check(spark, rng.normal(size=(5, 9)) * 10)  # fewer rows than dimensions


def test_whitening_without_variance(spark):
    row = (1, [1.0, 2.0], "c", 1, 2)
    for table in ([], [row], [row, row], [(1, None, "c", 1, 2)], [(1, [], "c", 1, 2)]):
        out = whitening.whiten(spark.createDataFrame(table, SCHEMA))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


def test_whitening_of_huge_entries(spark):
    """Beyond 2**52 / 64 entries count as the bound; what passes 64 bits is null."""
    table = [(None, [1e300, 1.0], "c", 1, 2), (2, [-3e38, 2.0], "c", 1, 2), (3, [0.0, 5.0], "c", 1, 2)]
    got = whitening.whiten(spark.createDataFrame(table, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == {None, 2, 3}
    assert all(r["deviation"] is None for r in got if r["vec_id"] != 3)
    assert all(np.isfinite(r["whitened"]) for r in got)


def test_deviations_are_exact():
    x = np.array([[3, -4], [1 << 40, 7], [5, 5]], np.int64)
    for n, sums in ((3, [10, 11]), (10 ** 12, [10 ** 13 + 1, -7])):
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
        assert whitening._deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]


def test_whitening_query(spark):
    got = op13_whitening(spark, SF).toPandas()
    src = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, dev, y, e, v = brute([r["embedding"] for r in src])
    assert len(got) == 32 * n and got.identity_error.max() < 1e-9
    first = got[got.component == 1].set_index("vec_id")
    for r, d, w in zip(src, dev, y @ v[:, 0] / np.sqrt(e[0]), strict=True):
        assert first.deviation[r["vec_id"]] == d
        assert abs(first.whitened[r["vec_id"]]) == pytest.approx(abs(w), abs=1e-9)
