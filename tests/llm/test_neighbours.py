"""Nearest neighbours through the tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import neighbours


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 2) for i, v in rows],
                                 "vec_id long, embedding array<float>, leaf string, rb int")


def brute(rows, every, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q, a in good.items():
        if q % every == 0:
            near = sorted((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), i) for i, b in good.items() if i != q)
            out[q] = near[:k]
    return out


@pytest.mark.parametrize("clusters", [3, 60])
def test_recall_against_brute_force(spark, monkeypatch, clusters):
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 40)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 10)
    rng = np.random.default_rng(clusters)
    centres = rng.normal(size=(clusters, 12))
    rows = [(i, (centres[i % clusters] + rng.normal(size=12) * 0.4).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(400)]  # one vector many times
    expect = brute(rows, 20)
    got = neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    hits = total = 0
    for q, near in expect.items():
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += sum(r.score >= -near[-1][0] - 1e-9 for r in own)
        total += 5
    assert hits >= 0.9 * total
    ties = sorted((r for r in got if r.query_id == 0), key=lambda r: r.rank)
    assert [r.vec_id for r in ties] == [2000, 2001, 2002, 2003, 2004]


def test_recall_far_beyond_the_fitted_sample(spark, monkeypatch):
    """A hundredth of the rows in the fit, clustered vectors, calibration outside the fit."""
    monkeypatch.setattr(neighbours, "FIT_ROWS", 200)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(150, 16))
    m = (centres[np.arange(20_000) % 150] + rng.normal(size=(20_000, 16)) * 0.5).astype(np.float32)
    got = neighbours.search(frame(spark, list(enumerate(m.tolist()))), F.col("vec_id") % 100 == 0).toPandas()
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    hits = total = 0
    for q, own in got.groupby("query_id"):
        near = u @ u[q]
        near[q] = -2
        hits += len(set(np.argsort(-near)[:5].tolist()) & set(own["vec_id"]))
        total += 5
    assert total == 1000 and hits >= 0.9 * total


def test_visits_follow_the_lower_bound():
    assert neighbours.enough_visits([[0, 0, 0, 0, 0]] * 50) == 1
    assert neighbours.enough_visits([[0, 1, 2, 3, 9]] * 50) == 10
    assert neighbours.enough_visits([[0] * 5] * 252 + [[7] * 5] * 4) == 1
    assert neighbours.enough_visits([[0] * 5] * 200 + [[7] * 5] * 56) == 8
    assert neighbours.enough_visits([]) == 1


def test_odd_vectors(spark):
    rows = [(0, [1, 0]), (1, [1, 1]), (2, None), (3, [0, 0]), (4, [float("nan"), 1]), (5, [None, 1]), (6, [1e30, 1e30]), (None, [1, 0]),
            (7, [float("inf"), 1]), (8, [1, 2, 3]), (1, [1, 1]), (10, []), (50, [-1, 0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.search(frame(spark, rows), F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 1, 0.707107), (0, 2, 6, 0.707107), (0, 3, 50, -1.0), (50, 1, 1, -0.707107), (50, 2, 6, -0.707107), (50, 3, 0, -1.0)]


def test_no_vectors(spark):
    assert neighbours.search(frame(spark, [(0, [1, 0])]).where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert neighbours.search(frame(spark, [(0, [0, 0])]), F.col("vec_id") % 50 == 0).count() == 0
