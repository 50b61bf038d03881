"""The stored warehouse, quantiles by bracket and count, and models fitted by aggregates, against plain Python."""

import math
import random
from datetime import date, datetime, timedelta
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.operators import (
    asof, calibration, drift, newton, prep, selection, tree_contributions, window_training,
)
from ebbtide.params import Windows
from ebbtide.sources import store
from ebbtide.sources.canonical import Warehouse

CUTOFFS = ("2024-01-01", "2024-03-01", "2024-05-01", "2024-07-01")
WINDOWS = Windows(observation=60, horizon=90)


# The store -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def warehouse(spark):
    """A year and a half of events, one subscriber with a third of them."""
    r = random.Random(2)
    day0 = datetime(2023, 6, 1)
    when = lambda: day0 + timedelta(seconds=r.randrange(550 * 86_400) // r.choice([1, 86_400]) * r.choice([1, 1]))
    people = [(f"s{i}", (day0 + timedelta(days=r.randrange(300))).date(), "via_1") for i in range(60)]
    who = lambda: "s0" if r.random() < 0.33 else f"s{r.randrange(62)}"
    kinds = ["signup", "renewal", "renewal", "renewal", "plan_change", "cancellation"]
    events = [(n, who(), r.choice(kinds), r.choice(schemas.PLAN_TYPES), float(r.randrange(99)), r.random() < 0.5, when()) for n in range(400)]
    events += [(1000 + i, "s1", k, "basic", 1.0, True, datetime(2024, 2, 2, 12)) for i, k in enumerate(["cancellation", "renewal"])]
    sessions = [(n, who(), when(), 5.0) for n in range(900)] + [(5000, "s2", datetime(2024, 1, 1), 1.0), (5001, "s2", datetime(2023, 12, 31, 23, 59), 1.0)]
    payments = [(n, who(), when(), 9.0, r.choice(["failed", "succeeded"]), r.choice([True, False, None])) for n in range(500)]
    tickets = [(n, who(), when(), "x") for n in range(300)]
    frames = [spark.createDataFrame(data, schemas.TABLES[name]) for name, data in zip(
        schemas.TABLES, (people, events, sessions, payments, tickets), strict=True)]
    return Warehouse(*frames)


def test_store_gives_the_same_snapshots_and_panels(spark, warehouse):
    kept = store.write(warehouse, buckets=4)
    wh = kept.warehouse(spark)
    for cutoff in CUTOFFS:
        assert rows(asof.snapshot(wh, cutoff, WINDOWS)) == rows(asof.snapshot(warehouse, cutoff, WINDOWS))
    want = rows(asof.panel(warehouse, CUTOFFS, WINDOWS))
    assert rows(asof.panel(wh, CUTOFFS, WINDOWS)) == want and len(want) > 40
    store.drop(spark, kept)


def test_store_grows_by_new_days_alone(spark, warehouse):
    kept = store.write(warehouse, until="2024-02-02", buckets=3)
    early = rows(asof.snapshot(kept.warehouse(spark), "2024-01-01", Windows(observation=60, horizon=30)))
    assert early == rows(asof.snapshot(warehouse, "2024-01-01", Windows(observation=60, horizon=30)))
    new = Warehouse(*[
        t if n == "subscribers" else t.filter(F.col("occurred_at") >= F.lit("2024-02-02").cast("timestamp_ntz"))
        for n, t in warehouse.tables().items()])  # the old days are not at hand any more
    kept = store.append(new, kept, "2024-04-15")
    assert store.append(new, kept, "2024-04-15") == kept
    kept = store.append(new, kept)
    assert rows(asof.panel(kept.warehouse(spark), CUTOFFS, WINDOWS)) == rows(asof.panel(warehouse, CUTOFFS, WINDOWS))
    with pytest.raises(ValueError):
        store.append(new, kept)


def test_stored_facts_are_not_exchanged(spark, warehouse):
    kept = store.write(warehouse, buckets=4)
    wh = kept.warehouse(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asof.snapshot(wh, "2024-03-01", WINDOWS)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    biggest = wh.activity.groupBy("subscriber_id").count().agg(F.max("count")).first()[0]
    assert biggest <= 551  # a busy subscriber is a row a day


def test_history_of_one_subscriber(spark, warehouse, tmp_path):
    from ebbtide.plans import demo

    every = demo.history(warehouse)
    path = store.write_history(every, f"{tmp_path}/history")
    for who in ("s0", "s7", "nobody"):
        assert [tuple(r) for r in store.read_history(spark, path, who).collect()] == [
            tuple(r) for r in demo.subscriber_history(warehouse, who, None).collect()]


# Quantiles -----------------------------------------------------------------------------

def columns(spark, seed, n):
    rng = np.random.default_rng(seed)
    data = pd.DataFrame({
        "normal": rng.normal(size=n), "ties": rng.integers(0, 4, n).astype(float), "one": np.full(n, 7.0),
        "skew": np.exp(rng.normal(size=n) * 5), "mostly": np.where(rng.random(n) < 0.9, 0.0, rng.normal(size=n)),
        "odd": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)), "none": np.full(n, np.nan)})
    data.loc[data.index[: n // 50], "odd"] = np.inf
    return data, spark.createDataFrame(data).repartition(5).cache()


STEPS = [0.0, 0.01, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 0.999, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 50, 4000])
@pytest.mark.parametrize("settings", [{}, {"ACCURACY": 20, "WITHIN": 40}, {"ACCURACY": 100, "WITHIN": 1}])
def test_column_quantiles(spark, monkeypatch, n, settings):
    for k, v in settings.items():
        monkeypatch.setattr(selection, k, v)
    data, df = columns(spark, n, n)
    for r in selection.column_quantiles(df, list(data.columns), STEPS).collect():
        own = data[r.feature].to_numpy()
        own = own[np.isfinite(own)]
        assert r.n == len(own)
        if not len(own):
            assert r.q is None
            continue
        assert r.q == pytest.approx(np.quantile(own, STEPS).tolist(), rel=1e-12, abs=1e-12)
        assert (r.min, r.max) == (own.min(), own.max())
        assert (r["mean"], r.std) == (pytest.approx(own.mean(), rel=1e-9, abs=1e-12), pytest.approx(own.std(), rel=1e-9, abs=1e-9))


def test_lower_neighbours(spark):
    df = spark.createDataFrame([(float(x),) for x in (3, 1, 2, 2, 9)], "x double")
    q = selection.column_quantiles(df, ["x"], [0.0, 0.2, 0.5, 0.99], interpolate=False).first().q
    assert q == [1.0, 2.0, 2.0, 9.0]


def test_profile_has_the_columns_moments(spark):
    data, df = columns(spark, 1, 400)
    df = df.select(F.col("normal").alias("tenure_days"), F.col("ties").alias("monthly_fee"), F.lit("basic").alias("plan_type"),
                   F.lit(True).alias("is_auto_renew_enabled"), F.col("none").alias("support_tickets_last_90d"))
    got = {r.feature: r for r in drift.reference_profile(df).filter("kind = 'numeric'").collect()}
    own = got["tenure_days"]
    assert (own["std"], own["min"], own["max"]) == tuple(round(float(x), 4) for x in (data.normal.std(ddof=0), data.normal.min(), data.normal.max()))
    none = got["support_tickets_last_90d"]
    assert (none.lo, none.hi, none.share, none["std"], none["min"]) == (0.0, 1.0, 0.0, 0.0, 0.0)


# Newton, windows, calibration ----------------------------------------------------------

def plain_newton(x, y, weight, ridge, steps=50):
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.r_[0.0, np.full(x.shape[1] - 1, ridge)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * w)
    return w


def test_newton_per_group(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 3))
    g = rng.integers(0, 3, 900)
    y = (rng.random(900) < 1 / (1 + np.exp(-(x @ [1, -2, 0.5] + g - 1)))).astype(float)
    weight = rng.integers(1, 5, 900).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "g": g, "y": y, "w": weight})).cache()
    got = newton.fit(df, [F.col(c) for c in "abc"], F.col("y"), F.col("g"), F.col("w"), ridge=0.7)
    for i in range(3):
        assert got[i] == pytest.approx(plain_newton(x[g == i], y[g == i], weight[g == i], 0.7).tolist(), abs=1e-7)


def test_newton_survives_separated_and_constant_rows(spark):
    df = spark.createDataFrame([(float(i), 5.0, float(i > 4)) for i in range(10)], "a double, b double, y double").cache()
    got = newton.fit(df, [F.col("a"), F.col("b")], F.col("y"), ridge=1e-3)[0]
    assert all(math.isfinite(w) for w in got) and got[1] > 0
    assert newton.fit(df.filter("false"), [F.col("a")], F.col("y")) == {}


def panel_rows(spark, n=1200):
    rng = np.random.default_rng(8)
    data = pd.DataFrame({c: rng.integers(0, 30, n).astype(float) for c in schemas.RAW_NUMERIC})
    data["is_auto_renew_enabled"] = rng.random(n) < 0.5
    data["cutoff"] = rng.choice(["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01", "2024-05-01"], n)
    z = 0.1 * data.tenure_days - 0.2 * data.last_activity_days_ago + data.is_auto_renew_enabled * (data.cutoff > "2024-01-15")
    data["dropout"] = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    data.loc[5, "monthly_fee"] = np.nan
    return data, spark.createDataFrame(data).cache()


def test_every_window_has_its_own_model(spark):
    data, df = panel_rows(spark)
    cutoffs = sorted(data.cutoff.unique())
    models = window_training.train(df, cutoffs)
    assert sorted(models.weights) == [3, 4, 5]
    for w in (3, 4, 5):
        own = data[data.cutoff.isin(cutoffs[: w - 2])]
        x = own[list(window_training.INPUTS)].astype(float)
        x = ((x - x.mean()) / x.std(ddof=0)).fillna(0.0).to_numpy()
        assert models.weights[w] == pytest.approx(plain_newton(x, own.dropout.to_numpy(), np.ones(len(own)), 1.0).tolist(), abs=1e-6)
    found = {r.window_id: r for r in window_training.backfill(df, cutoffs, 0.5).collect()}
    assert found[3].previous_pr_auc is None and found[3].promoted
    assert found[5].n_train == int(data.cutoff.isin(cutoffs[:3]).sum()) and found[5].roc_auc > 0.7
    assert len({found[w].pr_auc for w in found}) == 3


def test_moments_merge():
    rng = np.random.default_rng(1)
    parts = [rng.normal(1e6, 1, n) for n in (5, 0, 90, 1)]
    total = window_training.Moments()
    for p in parts:
        total = total + window_training.Moments(len(p), p.mean() if len(p) else 0.0, p.var() * len(p) if len(p) else 0.0)
    every = np.concatenate(parts)
    assert (total.n, total.mean, total.deviation) == (96, pytest.approx(every.mean()), pytest.approx(every.std(), rel=1e-9))


def plain_isotonic(x, y):
    blocks = []
    for v in sorted(set(x)):
        blocks.append([v, v, sum(a == v for a in x), sum(b for a, b in zip(x, y) if a == v)])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    return blocks


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 7), (3, 600), (4, 600)])
def test_isotonic_blocks(spark, monkeypatch, seed, n):
    monkeypatch.setattr(calibration, "FAN", 2)
    rng = np.random.default_rng(seed)
    x = np.round(rng.random(n), 2 if seed == 3 else 6)
    y = (rng.random(n) < x**2).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"y_proba": x, "y_true": y})).repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = calibration.isotonic_blocks(df)
        want = plain_isotonic(x.tolist(), y.tolist())
        assert sorted((r.lo, r.hi, r.n, r.positives) for r in got.collect()) == [tuple(b) for b in want]
        asked = spark.createDataFrame(pd.DataFrame({"y_proba": np.r_[x, 0.0, 1.0, rng.random(50)]}))
        knots = sorted({(e, b[3] / b[2]) for b in want for e in b[:2]})
        for r in calibration.isotonic_map(got)(asked).collect():
            assert r.calibrated == pytest.approx(np.interp(r.y_proba, *zip(*knots)), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sigmoid_is_fitted_on_log_odds(spark):
    rng = np.random.default_rng(5)
    p = rng.random(3000)
    odds = np.log(p / (1 - p))
    y = (rng.random(3000) < 1 / (1 + np.exp(-(0.5 + 2 * odds)))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"y_proba": p, "y_true": y}))
    pos = int(y.sum())
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (3000 - pos + 2))
    assert calibration.sigmoid_weights(df) == pytest.approx(plain_newton(odds[:, None], target, np.ones(3000), 0.0).tolist(), abs=1e-6)
    apart = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (1.0, 1), (0.0, 0)], "y_proba double, y_true int")
    got = [r.calibrated for r in calibration.fit_calibration(apart, "sigmoid")(apart).orderBy("y_proba").collect()]
    assert got == sorted(got) and all(0 < c < 1 for c in got)


# Trees ---------------------------------------------------------------------------------

def plain_shapley(nodes, x, size):
    """By the definition: expectations over all orders of the features."""
    def value(node, known):
        r = nodes[node]
        if r["left"] < 0:
            return 2.0 * r["weight"] * r["prediction"]
        if int(r["feature"]) in known:
            left = x[int(r["feature"])] in r["categories"] if r["categories"] is not None else x[int(r["feature"])] <= r["threshold"]
            return value(r["left"] if left else r["right"], known)
        return sum(nodes[c]["rows"] / r["rows"] * value(c, known) for c in (r["left"], r["right"]))

    out, orders = np.zeros(size), list(permutations(sorted({int(r["feature"]) for r in nodes.values() if r["left"] >= 0})))
    for order in orders:
        for i, f in enumerate(order):
            out[f] += (value(0, set(order[: i + 1])) - value(0, set(order[:i]))) / len(orders)
    return out, value(0, set())


def test_tree_contributions(spark, tmp_path):
    data, df = panel_rows(spark, 900)
    df = df.withColumn("plan_type", F.element_at(F.array(*[F.lit(p) for p in schemas.PLAN_TYPES]), (F.col("tenure_days") % 3 + 1).cast("int")))
    df = df.withColumns({
        "subscriber_id": F.monotonically_increasing_id(), "monthly_fee": F.when(~F.isnan("monthly_fee"), F.col("monthly_fee"))}).cache()
    model = prep.tree_pipeline(prep.fit_preprocessor(df), maxIter=6).fit(prep.with_label(df))
    got = tree_contributions.explain(model, df, f"{tmp_path}/trees", "subscriber_id").collect()
    assert len(got) == 900
    for r in got:
        assert sum(r.contributions.values()) + r.base == pytest.approx(r.log_odds, abs=1e-9)
    names = prep.feature_names(model, df)
    nodes = tree_contributions.node_table(model, f"{tmp_path}/again").toPandas()
    vectors = {r.subscriber_id: r.features.toArray() for r in model.transform(prep.with_label(df)).collect()}
    for r in got[:5]:
        want, base = np.zeros(len(names)), 0.0
        for _, own in nodes.groupby("tree"):
            part, start = plain_shapley({int(n["node"]): n for n in own.to_dict("records")}, vectors[r.subscriber_id], len(names))
            want, base = want + part, base + start
        assert r.base == pytest.approx(base, abs=1e-9)
        assert [r.contributions[n] for n in names] == pytest.approx(want.tolist(), abs=1e-9)


def test_days_are_counted_in_as_many_tasks_as_buckets(spark):
    """Rows are dealt once before they are counted: no second shuffle, and a busy subscriber spreads over days."""
    rows = spark.range(400).select(
        (F.col("id") - F.col("id") % 400).cast("string").alias("subscriber_id"), (F.lit("2020-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(cast(id % 40 as int))")).alias("occurred_at"),
        F.lit(None).cast("timestamp_ntz").alias("seen"), *[F.lit(1).cast("bigint").alias(c) for c in ("sessions", "failures", "discounts", "tickets")])
    wh = Warehouse(None, None, None, None, None, rows)
    dealt = store.daily_activity(wh, tasks=16)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and ", 16), REPARTITION_BY_NUM" in plan
    assert sorted(map(str, dealt.collect())) == sorted(map(str, store.daily_activity(wh).collect()))
    assert dealt.count() == 40 and dealt.agg(F.sum("sessions")).first()[0] == 400
