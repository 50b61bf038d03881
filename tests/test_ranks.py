"""Distributed ranks against numpy, with buckets forced to be small."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import ranks
from ebbtide.operators.classification import curve, ranking_metrics


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    a = rng.normal(size=700)
    b = np.round(rng.exponential(size=900), 1)  # many ties
    hot = np.full(500, 0.25)  # a third of all rows hold one value
    return {"a": np.concatenate([a, hot]), "b": b, "c": np.array([5.0])}


@pytest.fixture(scope="module")
def frame(spark, values):
    return spark.createDataFrame(
        [(k, float(x)) for k, xs in values.items() for x in xs], "key string, value double")


def test_quantiles_match_linear_interpolation(frame, values):
    steps = [i * 0.1 for i in range(10)] + [1.0]
    found = ranks.exact_quantiles(frame, ["key"], "value", steps)
    for r in found.collect():
        np.testing.assert_allclose(r.q, np.quantile(values[r.key], steps), atol=1e-12)


@pytest.fixture(params=[1, 13])
def ranges(spark, request):
    """Value ranges: one, or more than adaptive execution would leave."""
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums_match_brute_force(frame, values, ranges, descending):
    counts = ranks.value_counts(frame, ["key"], "value", {"n": F.lit(1)})
    assert counts.select(ranks.BUCKET).distinct().count() == ranges
    got = sorted((r.key, r.value, r.n, r.cum_n) for r in ranks.prefix_sums(counts, ["key"], "value", ["n"], descending).collect())
    want = []
    for key, xs in values.items():
        for v in set(xs.tolist()):
            side = (xs >= v) if descending else (xs <= v)
            want.append((key, v, int((xs == v).sum()), int(side.sum())))
    assert got == sorted(want)


def test_quantiles_without_keys(frame, values):
    everything = np.concatenate(list(values.values()))
    q = ranks.exact_quantiles(frame, [], "value", [0.5]).first().q[0]
    assert q == pytest.approx(np.quantile(everything, 0.5))


def slow_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


def slow_ap(y, p):
    total, out, last = y.sum(), 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        flagged = p >= t
        recall = y[flagged].sum() / total
        out += (recall - last) * y[flagged].mean()
        last = recall
    return out


@pytest.mark.parametrize("decimals", [2, 12])
def test_auc_and_average_precision_match_brute_force(spark, decimals, ranges):
    rng = np.random.default_rng(5)
    y = (rng.random(400) < 0.2).astype(int)
    p = np.round(np.clip(rng.random(400) * 0.6 + y * 0.2, 0, 1), decimals)
    scored = spark.createDataFrame(
        [("g", int(a), float(b)) for a, b in zip(y, p)], "k string, y_true int, y_proba double")
    r = ranking_metrics(curve(scored, ["k"]), ["k"]).first()
    assert r.roc_auc == pytest.approx(slow_auc(y, p))
    assert r.pr_auc == pytest.approx(slow_ap(y, p))


def test_one_class_has_no_ranking(spark):
    scored = spark.createDataFrame([(0, 0.1), (0, 0.9)], "y_true int, y_proba double")
    r = ranking_metrics(curve(scored)).first()
    assert r.roc_auc is None and r.pr_auc is None
