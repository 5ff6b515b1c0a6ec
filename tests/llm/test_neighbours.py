"""Nearest neighbours against brute force: exact where all leaves are visited, calibrated recall elsewhere."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import neighbours as nb


def plain(rows, chosen, k):
    """{(query id, vector): [(id, score)]} over distinct usable rows."""
    fine = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = {(i, tuple(v)) for i, v in rows if i is not None and fine(v)}
    sizes = [len(v) for _, v in rows]
    length = max(set(sizes), key=lambda n: (sizes.count(n), n), default=0)
    rows = [(i, np.array(v)) for i, v in rows if len(v) == length]
    out = {}
    for i, q in rows:
        if chosen(i):
            best = sorted((-float((q * v).sum()), j) for j, v in rows if j != i)[:k]
            out.setdefault(i, []).append([(j, -s) for s, j in best])
    return out


def awkward():
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, 1, 6).round(3).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)]  # a large group of copies
    rows += [rows[5], rows[5], (9, rows[3][1]), (None, rows[0][1]), (2000, None), (2020, []), (2040, [0.0] * 6), (2060, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (2080, [math.nan] + [1.0] * 5), (2100, [math.inf] + [1.0] * 5), (2120, [1.0, 2.0]), (2140, [40.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    return rows


@pytest.mark.parametrize("leaf", [10_000, 20])
def test_whole_search_is_brute_force(spark, leaf, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK_ROWS", 6 * 40)
    monkeypatch.setattr(nb, "BLOCK_QUERIES", 6 * 10)
    rows = awkward()
    df = spark.createDataFrame([(v, "x", i, 1, 2) for i, v in rows], "embedding array<double>, q string, vec_id bigint, leaf int, ids int")
    got = nb.search(df, df["vec_id"] % 20 == 0, 7, recall=1.0 if leaf > 1000 else 2.0, leaf=leaf).collect()
    want = plain(rows, lambda i: i % 20 == 0, 7)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(want)
    for q, lists in want.items():
        assert len(lists) == 1 and [x[0] for x in found[q]] == list(range(1, 8))
        assert [x[1] for x in found[q]] == [j for j, _ in lists[0]]
        assert np.allclose([x[2] for x in found[q]], [s for _, s in lists[0]], rtol=0, atol=1e-12)


def test_few_candidates_none_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [-1.0, 0.0])], "vec_id int, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in nb.search(df, df["vec_id"] % 20 == 0, 20).collect()}
    assert got == {(0, 1): (20, 0.5), (0, 2): (3, -1.0), (20, 1): (0, 0.5), (20, 2): (3, -0.5)}
    assert nb.search(df, F.lit(False), 20).count() == 0
    assert nb.search(df.where("false"), F.lit(True), 20).count() == 0
    assert nb.search(df.where("vec_id = 0"), F.lit(True), 20).count() == 0


def test_recall_on_clustered_vectors_with_fewer_visits(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (40, 16))
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(0, 0.25, (4000, 16))) * rng.uniform(0.5, 2.0, (4000, 1))  # unequal lengths
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = nb.search(df, df["vec_id"] % 20 == 0, 20, leaf=60, sample=2000, calibration=100).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, 4000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits.append(len(set(np.argsort(-s)[:20].tolist()) & found[q]) / 20)
    assert np.mean(hits) >= 0.9


def test_tree_visits_best_bins_first():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (900, 5))
    tree = nb.fit(x, branches=4, leaf=30)
    own = tree.descend(x)
    assert np.bincount(own, minlength=tree.leaves).max() <= 60 and tree.leaves > 20
    for q in x[:20]:
        seen = tree.visits(q, tree.leaves)
        assert sorted(seen) == list(range(tree.leaves))
    assert np.mean([own[i] in tree.visits(x[i], 3) for i in range(300)]) > 0.95
    same = nb.fit(np.ones((50, 3)), branches=4, leaf=10)
    assert same.leaves == 1 and same.visits(np.zeros(3), 5) == [0]
