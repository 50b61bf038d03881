"""Profiles, drift, prediction logs, histograms, rates, alerts and reports."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions import linear
from ebbtide.operators import drift, monitoring, shadow

T0 = datetime(2024, 3, 10, 0, 0)


def values(spark, **columns):
    return spark.createDataFrame(
        [(k, float(v)) for k, vs in columns.items() for v in vs], "feature string, value double")


def psi(spark, reference, live):
    arrays = [F.array(*[F.lit(float(x)) for x in a]) for a in (reference, live)]
    return spark.range(1).select(drift.psi_arrays(*arrays)).first()[0]


def test_psi_algebra(spark):
    assert psi(spark, [0.2, 0.3, 0.5], [0.2, 0.3, 0.5]) == 0.0
    assert math.isfinite(psi(spark, [0.5, 0.5], [1.0, 0.0]))
    assert psi(spark, [0.5, 0.5], [0.2, 0.3, 0.5]) == 0.0
    assert psi(spark, [0.4, 0.6], [0.6, 0.4]) == pytest.approx(
        psi(spark, [0.6, 0.4], [0.4, 0.6]))
    expected = sum((o - r) * math.log(o / r) for r, o in ((0.5, 1.0), (0.5, 1e-6)))
    assert psi(spark, [0.5, 0.5], [1.0, 0.0]) == pytest.approx(expected)


@pytest.mark.parametrize(("value", "verdict"), [
    (0.09, "stable"), (0.1, "moderate"), (0.24, "moderate"), (0.25, "significant")])
def test_verdict_boundaries(spark, value, verdict):
    assert spark.range(1).select(
        drift.verdict_text(drift.verdict_code(F.lit(value)))).first()[0] == verdict


def test_edges_collapse_and_constants_get_a_unit_bin(spark):
    data = values(spark, a=range(101), constant=[5.0] * 9, tied=[0] * 90 + [1, 2])
    edges = {r.feature: r.edges for r in drift.bin_edges(data).collect()}
    np.testing.assert_allclose(edges["a"], np.quantile(range(101), np.linspace(0, 1, 11)))
    assert edges["constant"] == [4.5, 5.5]
    assert edges["tied"] == [0.0, 2.0]


def test_bins_are_half_open_the_last_closed_and_outliers_clipped(spark):
    edges = spark.sql("SELECT 'a' AS feature, array(0D, 1D, 2D) AS edges")
    data = values(spark, a=[-50, 0, 0.99, 1, 2, 100])
    found = {r.bin_no: r.n for r in drift.bin_counts(data, edges).collect()}
    assert found == {0: 3, 1: 3}


def frame(spark, n, fee=lambda i: 10 + i % 20, plan=lambda i: ("basic", "premium")[i % 2]):
    return spark.createDataFrame(
        [(i % 300, float(fee(i)), float(i % 9), i % 50, i % 3, i % 2, 0, plan(i), i % 3 == 0)
         for i in range(n)], schemas.MODEL_INPUT_SCHEMA)


@pytest.fixture(scope="module")
def profile(spark):
    return drift.reference_profile(
        linear.CHAMPION.score(frame(spark, 600), "p"), "p").cache()


def test_shares_add_up_per_feature(profile):
    for r in profile.groupBy("feature").agg(F.sum("share").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_the_same_data_does_not_drift(spark, profile):
    same = linear.CHAMPION.score(frame(spark, 600), "p")
    out = drift.assess(same, profile, "p").first()
    assert out.overall_verdict == "stable" and out.drifted_features == []
    assert out.n_samples == 600 and out.sufficient_sample


def test_a_shift_and_a_new_plan_are_named(spark, profile):
    live = frame(spark, 90, fee=lambda i: 60 + i, plan=lambda i: ("basic", "gold")[i % 2])
    features = drift.drift_features(live, profile)
    by = {r.feature: r for r in features.collect()}
    assert by["monthly_fee"].verdict == "significant"
    assert by["plan_type"].unseen_categories == ["gold"]
    out = drift.assess(live, profile).first()
    assert out.overall_verdict == "significant" and not out.sufficient_sample
    assert {"monthly_fee", "plan_type"} <= set(out.drifted_features)
    assert len(out.top_features) == 5 and out.top_features[0] in ("monthly_fee", "plan_type")


def test_no_profile_or_no_rows_is_unavailable(spark, profile):
    live = frame(spark, 10)
    assert drift.assess(live, None).first().reason.startswith("no reference profile")
    assert drift.assess(live.limit(0), profile).first().available is False


def test_a_column_without_values_stays_in_profile_and_report(spark):
    empty = frame(spark, 200).withColumn("monthly_fee", F.lit(None).cast("double"))
    profile = drift.reference_profile(empty)
    kept = profile.filter("feature = 'monthly_fee'").collect()
    assert [(r.bin_no, r.lo, r.hi, r.share) for r in kept] == [(0, 0.0, 1.0, 0.0)]
    features = {r.feature: r for r in drift.drift_features(frame(spark, 90), profile).collect()}
    assert features["monthly_fee"].verdict == "significant"


# --- logs

def log(spark, n):
    return spark.createDataFrame(
        [(i, T0 + timedelta(seconds=i), i / 1000, int(i >= 500), "high" if i >= 500 else "low")
         for i in range(n)],
        "request_id bigint, served_at timestamp_ntz, dropout_probability double, "
        "predicted_label int, risk_level string")


def test_the_summary_covers_the_newest_rows_and_counts_all(spark):
    r = shadow.log_summary(log(spark, 1000), 100).first()
    assert (r.served_total, r.window_size, r.window_capacity) == (1000, 100, 100)
    assert r.flagged_rate == 1.0 and r["min"] == 0.9 and r["max"] == 0.999
    assert r.p50 == pytest.approx(0.9495) and (r.n_low, r.n_high) == (0, 100)


def test_an_empty_log_is_zeros_and_an_empty_shadow_log_nulls(spark):
    r = shadow.log_summary(log(spark, 0)).first()
    assert (r.served_total, r.window_size, r.flagged_rate, r["mean"], r.n_low) == (0, 0, 0, 0, 0)
    assert shadow.mean_shift(shadow.log_summary(log(spark, 0)), 0.2).first()[3] is None
    pairs = pairs_of(spark, 0)
    s = shadow.shadow_summary(pairs).first()
    assert s.agreement_rate is None and s.challenger_flags_more == 0
    assert shadow.readiness(shadow.shadow_summary(pairs)).first().sufficient_evidence is False


def pairs_of(spark, n):
    requests = frame(spark, max(n, 1)).withColumns({
        "request_id": F.monotonically_increasing_id(),
        "served_at": F.lit(T0).cast("timestamp_ntz")}).limit(n)
    return shadow.shadow_pairs(requests, linear.CHAMPION, linear.CHALLENGER, 0.3, 0.3)


def test_shadow_arithmetic(spark):
    pairs = pairs_of(spark, 300)
    s = shadow.shadow_summary(pairs).first()
    found = pairs.collect()
    agree = np.mean([r.champion_label == r.challenger_label for r in found])
    more = sum(r.challenger_label > r.champion_label for r in found)
    assert s.agreement_rate == pytest.approx(agree, abs=1e-4)
    assert s.challenger_flags_more == more
    assert s.flagged_rate_delta == pytest.approx(
        s.challenger_flagged_rate - s.champion_flagged_rate, abs=2e-4)


def test_the_challenger_cannot_change_the_served_answer(spark):
    requests = frame(spark, 50).withColumns({
        "request_id": F.monotonically_increasing_id(),
        "served_at": F.lit(T0).cast("timestamp_ntz")})
    served = shadow.prediction_log(requests, linear.CHAMPION)
    paired = shadow.shadow_pairs(requests, linear.CHAMPION, linear.CHALLENGER)
    assert rows(served, "request_id", "raw_probability") == rows(
        paired, "request_id", "champion_probability")


def test_sampling_is_repeatable(spark):
    requests = frame(spark, 2000).withColumns({
        "request_id": F.col("monthly_fee") + F.monotonically_increasing_id(),
        "served_at": F.lit(T0).cast("timestamp_ntz")})
    picked = shadow.shadow_pairs(
        requests, linear.CHAMPION, linear.CHALLENGER, sample_rate=0.25)
    assert 300 < picked.count() < 700
    assert rows(picked, "request_id") == rows(picked, "request_id")


# --- histograms and rates

def test_histogram_is_cumulative_and_right_closed(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (7.0,)], "v double")
    found = rows(monitoring.histogram(df, "v", [0.05, 0.1, 1.0]))
    assert found == [(0.05, 1), (0.1, 2), (1.0, 3), (math.inf, 4)]


def quantile(spark, buckets, q):
    df = spark.createDataFrame(buckets, "le double, cumulative bigint")
    found = monitoring.histogram_quantile(df, [q]).collect()
    return found[0].value if found else None


def test_histogram_quantiles(spark):
    buckets = [(0.1, 10), (0.2, 30), (1.0, 40), (math.inf, 40)]
    assert quantile(spark, buckets, 0.5) == pytest.approx(0.15)
    assert quantile(spark, buckets, 0.125) == pytest.approx(0.05)
    assert quantile(spark, [(0.1, 1), (math.inf, 4)], 0.9) == 0.1
    assert quantile(spark, [(0.1, 0), (math.inf, 0)], 0.5) is None


def test_rates_per_window(spark):
    found = monitoring.rates(log(spark, 900), "served_at", ["risk_level"]).orderBy(
        "window_start", "risk_level").collect()
    assert [(r.risk_level, r.n) for r in found] == [
        ("low", 300), ("high", 100), ("low", 200), ("high", 300)]
    assert found[0].rate_per_sec == 1.0


# --- alerts

def samples(spark, metric, points, more=()):
    return spark.createDataFrame(
        [(T0 + timedelta(minutes=m), metric, float(v)) for m, v in points]
        + [(T0 + timedelta(minutes=m), name, float(v)) for m, name, v in more],
        "ts timestamp_ntz, metric string, value double")


def state(spark, alert, metric, points, more=(), now=None):
    found = monitoring.alert_state(
        monitoring.rule_samples(samples(spark, metric, points, more), now=now)).collect()
    return {r.alert: r for r in found}[alert]


def test_a_condition_must_hold_for_its_duration(spark):
    metric = "subscriber_flagged_rate"
    high = [(m, 0.6) for m in range(0, 20, 5)]
    assert state(spark, "FlaggedRateSpike", metric, high).state == "firing"
    assert state(spark, "FlaggedRateSpike", metric, high[:3]).state == "pending"
    dip = [*high[:2], (10, 0.4), (15, 0.6)]
    r = state(spark, "FlaggedRateSpike", metric, dip)
    assert r.state == "pending" and r.started == T0 + timedelta(minutes=15)
    assert state(spark, "FlaggedRateSpike", metric, [*high, (20, 0.5)]).state == "inactive"


def test_runs_cross_midnight_and_days_without_a_gap(spark):
    points = [(m, 0.6) for m in range(0, 4 * 1440, 60)]
    evaluated = monitoring.rule_samples(samples(spark, "subscriber_flagged_rate", points))
    runs = monitoring.alert_episodes(evaluated).collect()
    assert len(runs) == 1 and runs[0].n_samples == 96
    # The clock change of 10 March does not bend zone-less time.
    assert runs[0].held_seconds == 95 * 3600


def test_silence_ends_a_run(spark):
    ten_days = [(0, 0.6), (10 * 1440, 0.6)]
    evaluated = monitoring.rule_samples(samples(spark, "subscriber_flagged_rate", ten_days))
    runs = monitoring.alert_episodes(evaluated).collect()
    assert sorted(r.held_seconds for r in runs) == [0, 0]
    assert monitoring.alert_state(evaluated).first().state == "pending"
    one = monitoring.alert_episodes(evaluated, max_gap_seconds=11 * 86_400).collect()
    assert [r.held_seconds for r in one] == [864_000]


def test_absolute_values_and_guards(spark):
    shift = "subscriber_probability_mean_shift"
    assert state(spark, "ScoreDistributionShift", shift, [(0, -0.2), (30, -0.2)]).state == "firing"
    rate = "subscriber_shadow_agreement_rate"
    low = [(0, 0.5), (30, 0.5)]
    on = [(m, "subscriber_shadow_active", 1) for m in (0, 30)]
    off = [(m, "subscriber_shadow_active", 0) for m in (0, 30)]
    assert state(spark, "ShadowLargeBehaviourChange", rate, low, on).state == "firing"
    assert state(spark, "ShadowLargeBehaviourChange", rate, low, off).state == "inactive"


def test_a_stale_pipeline_is_judged_by_its_age(spark):
    metric = "subscriber_pipeline_last_run_timestamp_seconds"
    ran = (T0 - datetime(1970, 1, 1)).total_seconds()
    late = F.lit("2024-03-11 12:00:01").cast("timestamp_ntz")
    fresh = F.lit("2024-03-11 12:00:00").cast("timestamp_ntz")
    assert state(spark, "PipelineStale", metric, [(0, ran)], now=late).state == "firing"
    assert state(spark, "PipelineStale", metric, [(0, ran)], now=fresh).state == "inactive"


def test_increase_looks_back_fifteen_minutes_across_blocks(spark):
    points = [(m, m // 7) for m in range(0, 120, 2)]
    df = samples(spark, "subscriber_shadow_errors_total", points)
    found = {r.ts: r.increase for r in monitoring.increase(df).collect()}
    assert len(found) == len(points)
    for m, v in points:
        first = min(p for p in points if m - 15 <= p[0] <= m)[1]
        assert found[T0 + timedelta(minutes=m)] == v - first
    flat = samples(spark, "subscriber_shadow_errors_total", [(0, 3), (10, 3)])
    assert monitoring.alert_state(monitoring.rule_samples(flat)).first().state == "inactive"


def test_every_rule_names_a_known_metric_once():
    assert len({r.alert for r in monitoring.RULES}) == len(monitoring.RULES) == 12
    assert {r.op for r in monitoring.RULES} <= {">", ">=", "<", "=="}
    assert all(m.startswith("subscriber_") for m in monitoring.METRICS)


# --- reports

def report(spark, promoted, verdict, passes, available=True):
    training = spark.createDataFrame(
        [(promoted, "improvement -0.0100 below required +0.0050", passes,
          [] if passes else ["recall differs"])],
        "promoted boolean, promotion_reason string, fairness_passes boolean, "
        "fairness_concerns array<string>")
    moved = spark.createDataFrame(
        [(available, verdict, ["monthly_fee", "tenure_days"])],
        "available boolean, overall_verdict string, drifted_features array<string>")
    return monitoring.run_report(training, moved).first()


def test_run_report_reasons(spark):
    quiet = report(spark, True, "moderate", True)
    assert not quiet.needs_attention and quiet.attention_reasons == []
    loud = report(spark, False, "significant", False)
    assert loud.attention_reasons == [
        "challenger rejected: improvement -0.0100 below required +0.0050",
        "significant drift in monthly_fee, tenure_days", "fairness: recall differs"]
    assert not report(spark, None, "significant", None, False).needs_attention


def test_pipeline_gauges_leave_out_what_is_undefined(spark):
    def gauges(*args):
        training = spark.createDataFrame(
            [args[:2]], "promoted boolean, needs_attention boolean")
        df = training.withColumns({
            "available": F.lit(args[2]), "overall_verdict": F.lit(args[3]),
            "n_samples": F.lit(500)})
        out = monitoring.pipeline_samples(df, F.lit(str(T0)).cast("timestamp_ntz"))
        return {r.metric.removeprefix("subscriber_"): r.value for r in out.collect()}

    ran = (T0 - datetime(1970, 1, 1)).total_seconds()
    assert gauges(False, True, True, "significant") == {
        "pipeline_last_run_timestamp_seconds": ran, "pipeline_needs_attention": 1.0,
        "pipeline_promoted": 0.0, "drift_verdict": 2.0, "drift_sample_size": 500.0}
    assert gauges(None, False, False, None) == {
        "pipeline_last_run_timestamp_seconds": ran, "pipeline_needs_attention": 0.0}


def test_verdict_codes(spark):
    out = spark.createDataFrame([("stable",), ("significant",), (None,)], "v string")
    assert [r[0] for r in out.select(monitoring.verdict_gauge(F.col("v"))).collect()] == [0, 2, None]


def test_run_history_is_newest_first(spark):
    versions = spark.createDataFrame([(1, "r1"), (2, "r2"), (3, "r3")], "version int, run_id string")
    aliases = spark.createDataFrame([(2, "champion"), (2, "stable")], "version int, alias string")
    metrics = spark.createDataFrame(
        [(2, "test_f1", 0.5), (2, "train_f1", 0.9)], "version int, metric string, value double")
    found = monitoring.run_history(versions, aliases, metrics, 2).collect()
    assert [r.version for r in found] == [3, 2]
    assert found[1].aliases == ["champion", "stable"] and found[1].metrics == {"test_f1": 0.5}
    assert found[0].aliases == []


def test_reports_make_the_snapshot_once(spark, monkeypatch):
    """Scores and drift of a report come from one stored snapshot."""
    from ebbtide.plans import queries

    calls = []
    base = spark.range(400).select(
        F.col("id").cast("string").alias("subscriber_id"), F.lit("2000-01-01").alias("cutoff"),
        (F.col("id") + 10).cast("int").alias("tenure_days"),
        F.get(F.array(F.lit("basic"), F.lit("premium")), (F.col("id") % 2).cast("int")).alias("plan_type"),
        (F.col("id") * 1.0).alias("monthly_fee"), (F.col("id") % 7).cast("double").alias("avg_session_count_last_30d"),
        *[(F.col("id") % n).cast("int").alias(c) for n, c in (
            (9, "last_activity_days_ago"), (3, "support_tickets_last_90d"), (4, "payment_failures_last_6m"), (5, "discounts_used_last_6m"))],
        (F.col("id") % 2 == 0).alias("is_auto_renew_enabled"), (F.col("id") % 3 == 0).cast("int").alias("dropout"))

    def snapshot(*a, **k):
        calls.append(a)
        return base

    monkeypatch.setattr(queries, "snapshot", snapshot)
    monkeypatch.setattr(queries, "panel", lambda *a, **k: base)
    for name in ("run_report", "report_gauges"):
        calls.clear()
        assert queries.QUERIES[name](spark, "none").count() > 0
        assert len(calls) == 1
