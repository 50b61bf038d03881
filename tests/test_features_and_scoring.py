"""Derived features, preprocessing, bands, explanations and what-if."""

import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions import explain, features, linear, risk
from ebbtide.operators import prep, scoring

HIGH = (95, 19.99, 1.0, 45, 4, 3, 3, "standard", False)
LOW = (1200, 34.99, 26.0, 1, 0, 0, 0, "premium", True)
ZERO = (0, 9.99, 0.0, 0, 0, 0, 0, "basic", True)
FORMULA = (200, 34.99, 9.0, 4, 2, 3, 1, "premium", False)


def frame(spark, *records):
    schema = "subscriber_id string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.MODEL_INPUT_SCHEMA)
    return spark.createDataFrame([(f"s{i}", *r) for i, r in enumerate(records)], schema)


def test_formulas(spark):
    r = features.add_derived(frame(spark, FORMULA)).first()
    assert r.friction_score == 5
    assert r.support_tickets_per_month == pytest.approx(2 / 3)
    assert r.payment_failures_per_month == 0.5
    assert r.tenure_months == pytest.approx(200 / 30.44)
    assert r.recency_ratio == pytest.approx(4 / 201)
    assert r.engagement_recency_score == pytest.approx(9 / 5)
    assert r.is_auto_renew_enabled == 0


def test_zero_denominators_are_safe(spark):
    r = features.add_derived(frame(spark, ZERO)).first()
    assert r.recency_ratio == 0.0 and r.fee_per_session == 9.99


@pytest.mark.parametrize(("days", "dormant"), [(0, 0), (5, 0), (21, 0), (22, 1), (90, 1)])
def test_dormant_boundary(spark, days, dormant):
    record = (*LOW[:3], days, *LOW[4:])
    assert features.add_derived(frame(spark, record)).first().is_dormant == dormant


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="monthly_fee"):
        features.add_derived(frame(spark, LOW).drop("monthly_fee"))


def test_infinities_are_swept(spark):
    broken = frame(spark, LOW).withColumn("monthly_fee", F.lit(float("inf")))
    assert features.finite_inputs(broken).first().monthly_fee is None


def test_preprocessor_uses_exact_median_population_deviation_and_smallest_mode(spark):
    records = [(*LOW[:1], fee, *LOW[2:7], plan, True)
               for fee, plan in [(1.0, "basic"), (2.0, "premium"), (3.0, "premium"),
                                 (10.0, "basic"), (None, None)]]
    fitted = prep.fit_preprocessor(frame(spark, *records))
    assert fitted.medians["monthly_fee"] == 2.5
    filled = [1.0, 2.0, 3.0, 10.0, 2.5]
    mean = sum(filled) / 5
    assert fitted.means["monthly_fee"] == pytest.approx(mean)
    assert fitted.deviations["monthly_fee"] == pytest.approx(
        math.sqrt(sum((x - mean) ** 2 for x in filled) / 5))
    assert fitted.modes["plan_type"] == "basic"


def test_an_unknown_plan_is_all_zeros(spark):
    train = frame(spark, LOW, HIGH, ZERO)
    odd = frame(spark, (*LOW[:7], "platinum", True))
    r = prep.fit_preprocessor(train).transform(odd).first()
    assert [r[f"plan_type_{p}"] for p in schemas.PLAN_TYPES] == [0, 0, 0]


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5, 0.97])
def test_low_band_means_label_zero(spark, threshold):
    grid = spark.range(101).select((F.col("id") / 100.0).alias("p"))
    out = grid.select(risk.band(F.col("p"), threshold).alias("b"),
                      risk.label(F.col("p"), threshold).alias("l"))
    assert out.filter((F.col("b") == "low") != (F.col("l") == 0)).count() == 0


def test_reasons_and_signals(spark):
    out = frame(spark, HIGH, LOW).select(risk.risk_factors().alias("f"),
                                         risk.retention_signals().alias("s")).collect()
    assert out[0].f == [
        "inactive for 45 days", "low recent activity (1.0 sessions/30d)",
        "3 payment failures in the last 6 months", "4 support tickets in the last 90 days",
        "auto-renew disabled", "relies on discounts (3 in the last 6 months)"]
    assert out[1].f == []
    assert out[1].s == ["auto-renew enabled", "strong recent engagement",
                        "active in the last few days", "long-tenured subscriber"]


@pytest.mark.parametrize(("p", "text"), [(0.125, "12%"), (0.135, "14%"), (0.005, "0%"), (1.0, "100%")])
def test_percent_rounds_half_to_even(spark, p, text):
    from ebbtide.functions.columns import percent_text

    assert spark.range(1).select(percent_text(F.lit(p))).first()[0] == text


def test_two_decimals_print_the_exact_binary_value(spark):
    from ebbtide.functions.columns import two_decimals

    texts = [2.675, 77.195, 0.125, 0.375, 1.005, 19.99, 0.0, 100.0, 0.1 + 0.2, 999.995, 12.345,
             -3.455, 1e9 + 0.005, *[i / 1000 for i in range(1, 4000, 7)],
             *[i * 1.1 / 3 for i in range(500)]]
    df = spark.createDataFrame([(float(x),) for x in texts], "x double")
    for r in df.select("x", two_decimals(F.col("x")).alias("t")).collect():
        assert r.t == f"{r.x:.2f}", r.x


def test_explanation_falls_back_to_signals_then_default(spark):
    middle = (200, 10.0, 8.0, 10, 0, 0, 0, "basic", True)
    out = scoring.predict(frame(spark, LOW, middle), linear.CHAMPION).collect()
    assert out[0].explanation.startswith("Low dropout risk (")
    assert "strong recent engagement" in out[0].explanation
    assert out[1].explanation.endswith("): auto-renew enabled.")
    assert out[1].explanation_method == "rules"


def wide(spark, *records):
    return features.add_derived(frame(spark, *records)).withColumns(features.plan_dummies())


def test_contributions_add_up_to_the_log_odds(spark):
    df = wide(spark, HIGH, LOW, ZERO, FORMULA)
    means = linear.column_means(df, [c for c, _ in linear.EXPLAINED])
    model = linear.centred("m", -1.0, linear.EXPLAINED, means)
    total = sum((e["total"] for e in explain.grouped(model).values()), F.lit(-1.0))
    for r in df.select(total.alias("sum"), model.logit().alias("z")).collect():
        assert r["sum"] == pytest.approx(r.z)


def test_largest_concepts_first_and_zero_is_no_reason(spark):
    model = linear.LinearModel("m", 0.0, (
        ("tenure_days", 0.001, 0.0), ("monthly_fee", 0.0, 0.0),
        ("last_activity_days_ago", 0.1, 0.0), ("recency_ratio", -9.0, 0.0)))
    r = explain.with_attributions(wide(spark, HIGH), model).first().attributions
    assert [a.feature for a in r] == ["recency", "tenure"]
    assert r[0].contribution == pytest.approx(4.5 - 9 * 45 / 96)
    assert r[0].description == "inactive for 45 days"
    assert r[1].direction == "increases_risk"


def test_first_column_wins_a_tie_and_unknown_columns_are_other(spark):
    model = linear.LinearModel("m", 0.0, (
        ("payment_failures_last_6m", 1.0, 0.0), ("payment_failures_per_month", -6.0, 0.0),
        ("subscriber_age", 2.0, 0.0)))
    df = wide(spark, HIGH).withColumn("subscriber_age", F.lit(1))
    entries = {k: e for k, e in explain.grouped(model).items()}
    r = df.select(entries["payments"].alias("p"), entries["other"].alias("o")).first()
    assert r.p.dominant == "payment_failures_last_6m" and r.o.total == 2.0
    told = explain.with_attributions(df, model).first().attributions
    assert told[0].description == "subscriber age"


def test_flags_state_their_value_whatever_the_direction(spark):
    model = linear.LinearModel("m", 0.0, (("is_auto_renew_enabled", 1.0, 2.0),))
    told = explain.with_attributions(wide(spark, HIGH, LOW), model).collect()
    assert [r.attributions[0].description for r in told] == [
        "auto-renew disabled", "auto-renew enabled"]
    assert all(r.attributions[0].direction == "decreases_risk" for r in told)


def test_attribution_sentence_lists_only_raising_factors(spark):
    df = wide(spark, HIGH).withColumn(
        "is_auto_renew_enabled", F.col("is_auto_renew_enabled").cast("boolean"))
    model = linear.LinearModel("m", 0.0, (
        ("last_activity_days_ago", 0.1, 0.0), ("monthly_fee", -0.1, 0.0)))
    r = scoring.predict_explained(df, linear.CHAMPION, model).first()
    assert r.top_risk_factors == ["inactive for 45 days"]
    assert r.explanation.endswith(": inactive for 45 days, monthly fee of 19.99.")
    assert r.explanation_method == "attribution"


def test_what_if_changes_one_input_and_skips_the_rest(spark):
    levers = [("is_auto_renew_enabled", True), ("monthly_fee", 19.99), ("tenure_days", 5)]
    out = scoring.what_if(frame(spark, HIGH), linear.CHAMPION, levers).collect()
    assert [r.lever for r in out] == ["is_auto_renew_enabled"]
    changed = frame(spark, (*HIGH[:8], True))
    assert out[0].new_probability == pytest.approx(
        linear.CHAMPION.score(changed).first().y_proba)
    assert out[0].delta == pytest.approx(out[0].new_probability - out[0].old_probability)


def test_foreign_scores_keep_every_row(spark):
    df = frame(spark, HIGH, LOW, ZERO, FORMULA)
    out = scoring.score_foreign(df, lambda b: b["monthly_fee"] / 100.0)
    assert rows(out) == [(f"s{i}", r[1] / 100.0) for i, r in enumerate([HIGH, LOW, ZERO, FORMULA])]


def test_a_missing_input_gives_no_score_and_extremes_stay_inside(spark):
    df = frame(spark, LOW).withColumn("monthly_fee", F.lit(None).cast("double"))
    assert linear.CHAMPION.score(df).first().y_proba is None
    far = frame(spark, LOW).withColumn("monthly_fee", F.lit(1e9))
    assert linear.CHAMPION.score(far).first().y_proba == pytest.approx(1 / (1 + math.exp(-30)))


@pytest.fixture(scope="module")
def learnable(spark):
    """Dropout follows recency and failures, with a little noise."""
    n = spark.range(3000)
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    g = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0
    return n.select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("subscriber_id"),
        (200 + F.col("id") % 900).cast("int").alias("tenure_days"),
        F.element_at(F.array(F.lit("basic"), F.lit("standard"), F.lit("premium")),
                     (F.col("id") % 3 + 1).cast("int")).alias("plan_type"),
        (10 + F.col("id") % 7).cast("double").alias("monthly_fee"),
        (F.col("id") % 20).cast("double").alias("avg_session_count_last_30d"),
        (h * 60).cast("int").alias("last_activity_days_ago"),
        F.lit(0).alias("support_tickets_last_90d"),
        (F.col("id") % 4).cast("int").alias("payment_failures_last_6m"),
        F.lit(0).alias("discounts_used_last_6m"),
        (F.col("id") % 2 == 0).alias("is_auto_renew_enabled"),
        ((h > 0.7) | (g > 0.95)).cast("int").alias("dropout"),
    ).cache()


def test_trees_learn_are_repeatable_and_name_their_features(spark, learnable):
    fitted = prep.fit_preprocessor(learnable)
    model = prep.tree_pipeline(fitted, maxIter=5).fit(prep.with_label(learnable))
    from ebbtide.operators.classification import curve, ranking_metrics

    scored = prep.tree_scores(model, learnable)
    assert ranking_metrics(curve(scored)).first().roc_auc > 0.8
    again = prep.tree_pipeline(fitted, maxIter=5).fit(prep.with_label(learnable))
    assert rows(prep.tree_scores(again, learnable)) == rows(scored)
    names = prep.feature_names(model, learnable)
    assert len(names) == 21 and names[:7] == list(schemas.RAW_NUMERIC)
    assert names[16:19] == ["plan_type_basic", "plan_type_premium", "plan_type_standard"]
    top = prep.top_importances(model, learnable, 3).collect()
    assert top[0].feature in ("last_activity_days_ago", "recency_ratio")


def test_artifacts_can_be_read_back(spark, learnable, tmp_path):
    from pyspark.ml import PipelineModel

    from ebbtide.plans import training
    from ebbtide.sources import files

    split = learnable.withColumn(
        "split", F.when(F.pmod(F.hash("subscriber_id"), F.lit(10)) < 6, "train")
        .when(F.pmod(F.hash("subscriber_id"), F.lit(10)) < 8, "validation").otherwise("test"))
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    model = training.fit(train, maxIter=3)
    metrics = training.train_and_evaluate(split, model)
    training.save_artifacts(str(tmp_path), model, metrics, test, train)
    back = PipelineModel.load(f"{tmp_path}/model")
    assert rows(prep.tree_scores(back, test)) == rows(prep.tree_scores(model, test))
    assert files.read_table(spark, f"{tmp_path}/reference_profile").count() > 10
    held = spark.read.option("header", True).csv(f"{tmp_path}/test_split")
    assert held.count() == test.count()
