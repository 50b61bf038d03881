"""Confusion, sweeps, calibration, costs, capacity, fairness and the gate."""

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import calibration, classification, decisions, fairness


def scored(spark, pairs):
    return spark.createDataFrame(
        [(int(y), float(p)) for y, p in pairs], "y_true int, y_proba double")


@pytest.fixture(scope="module")
def published(spark):
    """A holdout with known counts at 0.05: 85 hits, 1040 false alarms, 421 misses."""
    parts = [(1, 0.5, 4), (0, 0.5, 4), (1, 0.06, 81), (0, 0.06, 1036), (1, 0.01, 421),
             (0, 0.01, 31496)]
    rows = [spark.range(n).select(F.lit(y).alias("y_true"), F.lit(p).alias("y_proba"))
            for y, p, n in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.cache()


def test_published_counts_give_the_published_rates_and_costs(published):
    r = classification.confusion(published, 0.05).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.n_samples) == (85, 1040, 421, 31496, 33042)
    assert round(r.accuracy, 4) == 0.9558 and round(r.precision, 4) == 0.0756
    assert round(r.recall, 4) == 0.168 and round(r.f1, 4) == 0.1042
    report = decisions.threshold_report(published, 0.05).first()
    assert report.current_total_cost == 137_820
    assert report.optimal_total_cost == 121_312
    assert report.savings == 16_508
    assert report.optimal_flagged == 8


def test_zero_denominators_give_zero(spark):
    r = classification.confusion(scored(spark, [(0, 0.1), (0, 0.2)]), 0.5).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_sweep_equals_one_confusion_per_threshold(spark):
    rows = scored(spark, [((i * 7) % 3 == 0, (i * 37 % 100) / 100) for i in range(100)])
    sweep = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in
             classification.threshold_counts(rows, [0.0, 0.07, 0.29, 0.57, 0.99, 1.0]).collect()}
    for t, cells in sweep.items():
        r = classification.confusion(rows, t).first()
        assert cells == (r.tp, r.fp, r.fn, r.tn)


def test_the_lowest_of_equal_f1_thresholds_wins(spark):
    rows = scored(spark, [(1, 0.8), (0, 0.2)])
    best = classification.tune_threshold(classification.f1_sweep(rows)).first()
    assert (best.threshold, best.f1) == (0.21, 1.0)


def test_class_report_averages(spark):
    rows = scored(spark, [(1, 0.9), (1, 0.1), (0, 0.2), (0, 0.3), (0, 0.8)])
    r = {x["class"]: x for x in classification.class_report(rows, 0.5).collect()}
    assert r["dropout"].precision == 0.5 and r["dropout"].support == 2
    assert r["retained"].recall == pytest.approx(2 / 3)
    assert r["macro avg"].recall == pytest.approx((0.5 + 2 / 3) / 2)
    assert r["weighted avg"].support == 5


# --- calibration

def test_a_score_of_one_lands_in_the_last_bin(spark):
    table = calibration.reliability(scored(spark, [(1, 1.0), (0, 0.0), (1, 0.3)])).collect()
    by_bin = {r.bin: r for r in table}
    assert len(table) == 10
    assert by_bin[9].n == 1 and by_bin[0].n == 1
    # Right-closed: 0.3 is below the third edge, which is a little above 0.3.
    assert by_bin[2].n == 1 and by_bin[3].n == 0
    assert by_bin[5].mean_predicted is None and by_bin[5].gap is None


def test_calibration_arithmetic(spark):
    r = calibration.calibration_metrics(
        scored(spark, [(1, 0.8), (0, 0.8), (0, 0.2), (0, 0.2)])).first()
    assert r.brier_score == pytest.approx((0.04 + 0.64 + 0.04 + 0.04) / 4)
    assert r.expected_calibration_error == pytest.approx(0.5 * 0.3 + 0.5 * 0.2)
    assert r.mean_bias == pytest.approx(0.25)


def test_comparison_needs_a_strictly_lower_error(spark):
    rows = scored(spark, [(1, 0.8), (0, 0.2)]).withColumn("q", F.col("y_proba"))
    assert calibration.compare_calibration(rows, "y_proba", "q").first().improved is False


def test_unknown_calibration_method(spark):
    with pytest.raises(ValueError, match="unknown calibration method"):
        calibration.fit_calibration(scored(spark, [(1, 0.5)]), "platt")


@pytest.mark.parametrize("method", calibration.METHODS)
def test_calibration_is_monotone_and_in_range(spark, method):
    rows = scored(spark, [((i * 13) % 100 < i, i / 100) for i in range(100)])
    out = calibration.fit_calibration(rows, method)(rows).orderBy("y_proba").collect()
    values = [r.calibrated for r in out]
    assert all(0.0 <= v <= 1.0 for v in values)
    assert all(b >= a - 1e-12 for a, b in zip(values, values[1:]))


# --- costs and capacity

def test_prices():
    price = decisions.prices()
    assert price["tp"] == 188.0 and decisions.ratio_of(price) == 12.0
    assert round(decisions.break_even(price), 3) == 0.278
    assert round(decisions.break_even(decisions.prices(keeps=1.0)), 3) == 0.083
    assert decisions.break_even(decisions.prices(keeps=0.0)) == 1.0
    assert decisions.ratio_of(decisions.prices(bother=0)) == float("inf")


def test_equal_costs_prefer_the_higher_threshold(spark):
    rows = scored(spark, [(1, 0.9), (0, 0.1)])
    best = decisions.cost_optimal(decisions.cost_sweep(rows)).first()
    assert best.threshold == 0.9 and best.total_cost == 188.0


def test_a_useless_offer_flags_nobody(spark):
    rows = scored(spark, [(1, 0.5), (0, 0.4), (1, 0.3)])
    best = decisions.cost_optimal(decisions.cost_sweep(rows, decisions.prices(keeps=0.0))).first()
    assert best.flagged == 0


@pytest.mark.parametrize("k", range(1, 7))
def test_top_k_flags_exactly_k(spark, k):
    rows = scored(spark, [(0, p / 10) for p in range(4, 10)])
    r = decisions.capacity_threshold(rows, k).first()
    assert r.offers_used == k


@pytest.mark.parametrize(("k", "threshold", "used"), [
    (3, 0.9, 1), (1, 0.9, 1), (5, 0.5, 5), (0, None, 0), (6, 0.0, 6), (99, 0.0, 6)])
def test_boundary_ties_under_fill(spark, k, threshold, used):
    rows = scored(spark, [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.5), (0, 0.5), (0, 0.1)])
    r = decisions.capacity_threshold(rows, k).first()
    assert (r.capacity_threshold, r.offers_used) == (threshold, used)


def test_no_score_fits_when_the_top_group_is_too_big(spark):
    r = decisions.capacity_threshold(scored(spark, [(1, 0.7)] * 4 + [(0, 0.1)]), 3).first()
    assert (r.capacity_threshold, r.offers_used) == (None, 0)


def test_ladder_rounds_half_to_even_and_drops_repeats(spark):
    def steps(wanted, population):
        row = spark.range(1).select(decisions.budget_steps(F.lit(wanted), F.lit(population)).alias("b"))
        return row.first().b

    assert steps(10, 100) == [2, 5, 8, 10, 12, 15]
    assert steps(2, 2) == [1, 2]
    assert steps(0, 10) == []


@pytest.fixture(scope="module")
def ranked(spark):
    """Risk falls with the score, so that the optimum flags a few dozen."""
    return scored(spark, [(i % 3 == 0 if i < 60 else i % 50 == 0, 1 - i / 200)
                          for i in range(200)]).cache()


def test_ladder_costs_never_rise(ranked):
    ladder = decisions.capacity_ladder(ranked).orderBy("max_offers").collect()
    costs = [r.total_cost for r in ladder]
    assert costs == sorted(costs, reverse=True)
    assert ladder[0].value_per_extra_slot is None
    assert all(r.offers_used <= r.max_offers for r in ladder)


def test_unset_capacity_does_not_bind(ranked):
    r = decisions.capacity_report(ranked).first()
    assert (r.configured, r.max_offers, r.binding, r.shortfall) == (False, None, False, 0)
    assert r.cost_of_constraint == 0.0 and r.constrained_threshold is None


def test_zero_capacity_is_a_real_cap(ranked):
    r = decisions.capacity_report(ranked, 0).first()
    assert r.configured and r.binding and r.constrained_flagged == 0
    assert r.shortfall == r.offers_required


def test_budgets(spark):
    def allowed(budget, population):
        return spark.range(1).select(decisions.offers(F.lit(population), budget).alias("n")).first().n

    for wrong in (-1, 1.5):
        with pytest.raises(ValueError, match="share"):
            allowed(wrong, 10)
    assert (allowed(0.05, 39), allowed(50, 10), allowed(0, 10), allowed(None, 10)) == (1, 10, 0, None)


# --- fairness

def groups(spark, parts):
    rows = [(g, y, p) for g, pairs in parts.items() for y, p in pairs]
    frame = spark.createDataFrame(
        [(g, int(y), float(p)) for g, y, p in rows], "g string, y_true int, y_proba double")
    return fairness.by_attribute(frame, ["g"])


def test_small_and_one_class_groups_stay_with_nulls(spark):
    table = fairness.group_metrics(groups(spark, {
        "big": [(i % 4 == 0, (i % 10) / 10) for i in range(40)],
        "tiny": [(0, 0.9), (0, 0.1)],
    }), 0.5)
    by = {r.group: r for r in table.collect()}
    assert by["tiny"].n == 2 and not by["tiny"].sufficient_sample
    assert by["tiny"].roc_auc is None and by["tiny"].recall is None
    assert by["tiny"].precision == 0.0
    assert by["big"].sufficient_sample


def test_a_group_the_model_cannot_rank_is_named(spark):
    good = [(i % 2, 0.9 if i % 2 else 0.1 + i / 1000) for i in range(400)]
    noise = [(i % 2, 0.3 + ((i * 7919) % 400) / 1000) for i in range(400)]
    report = fairness.disparity(
        fairness.group_metrics(groups(spark, {"good": good, "noise": noise}), 0.5), 0.5).first()
    assert report.weakest_group == "noise" and not report.passes
    assert any("less able to rank" in c for c in report.concerns)


def test_one_usable_value_gives_no_ratio(spark):
    report = fairness.disparity(fairness.group_metrics(groups(spark, {
        "a": [(i % 4 == 0, 0.9) for i in range(40)], "b": [(0, 0.1)] * 40}), 0.5), 0.5).first()
    assert report.selection_rate_ratio is None and report.recall_ratio is None


def test_equal_groups_pass(spark):
    same = [(i % 4 == 0, (i % 20) / 20) for i in range(60)]
    verdict = fairness.audit_verdict(fairness.disparity(
        fairness.group_metrics(groups(spark, {"a": same, "b": same}), 0.5), 0.5)).first()
    assert verdict.passes and verdict.attributes_with_concerns == []


# --- promotion

def gate(spark, challenger, champion, **kw):
    rows = [("challenger", challenger)] + ([] if champion == "none" else [("champion", champion)])
    rankings = spark.createDataFrame(rows, "model string, pr_auc double")
    return classification.promotion_gate(rankings, **kw).first()


@pytest.mark.parametrize(("new", "old", "promoted"), [
    (0.305, 0.300, True), (0.3049, 0.300, False), (0.3, 0.3, False), (0.2, 0.3, False),
    (0.4, "none", True)])
def test_promotion_needs_the_margin(spark, new, old, promoted):
    assert gate(spark, new, old).promoted is promoted


def test_promotion_reasons(spark):
    assert gate(spark, 0.35, 0.30).reason == "beat champion by +0.0500"
    assert gate(spark, 0.29, 0.30).reason == "improvement -0.0100 below required +0.0050"
    assert gate(spark, 0.29, "none").reason == "no incumbent champion"


@pytest.mark.parametrize(("new", "old"), [(None, 0.3), (0.3, None)])
def test_an_undefined_score_raises(spark, new, old):
    with pytest.raises(Exception, match="undefined"):
        gate(spark, new, old)


def test_decision_quality_measures_but_never_applies_calibration(spark):
    from ebbtide.plans.training import decision_quality

    rows = scored(spark, [((i * 13) % 100 < i / 2, i / 100) for i in range(100)]).withColumn(
        "plan_type", F.lit("basic"))
    r = decision_quality(rows, 0.5, "plan_type", held_out=rows).first()
    assert r.calibration_improved and r.calibration_applied is False
    before = calibration.calibration_metrics(rows).first()
    assert r.expected_calibration_error == before.expected_calibration_error
    assert r.fairness_passes and r.offers_required > 0
