"""Registered queries: every operator over the provided tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame.  All read whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions import features as feat
from ebbtide.functions import linear
from ebbtide.functions.columns import count_if
from ebbtide.operators import (
    asof, calibration, classification, contract, decisions, drift, fairness, monitoring, prep,
    scoring, selection, shadow, tree_contributions, window_training,
)
from ebbtide.params import Windows
from ebbtide.plans import demo, training
from ebbtide.session import cut, shared_dir
from ebbtide.sources import canonical, files, raw_export, requests, store, tables
from ebbtide.streaming import rates as stream_rates
from ebbtide.streaming import scorer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The provided orders are sparse, so windows are half a year.
WINDOWS = Windows(observation=180, horizon=180)
TEST = "2000-01-01"
CUTOFFS = ("1997-01-01", "1998-01-01", "1999-01-01", TEST)
THRESHOLD = 0.3
CHANNEL = ("acquisition_channel",)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- shared inputs -----------------------------------------------------------

def snapshot(spark, sf, cutoff=TEST, **kw) -> DataFrame:
    return asof.snapshot(canonical.warehouse(spark, sf), cutoff, WINDOWS, **kw)


def panel(spark, sf, cutoffs=CUTOFFS, **kw) -> DataFrame:
    return asof.panel(canonical.warehouse(spark, sf), cutoffs, WINDOWS, **kw)


def _as_scored(rows: DataFrame, model=linear.CHAMPION) -> DataFrame:
    return model.score(rows).withColumn("y_true", F.col(schemas.TARGET))


def scored(spark, sf) -> DataFrame:
    return _as_scored(snapshot(spark, sf, extra=CHANNEL))


def scored_panel(spark, sf) -> DataFrame:
    return _as_scored(panel(spark, sf))


def kept(rows: DataFrame, *columns: str) -> DataFrame:
    """Only the scored columns, stored: for queries that pass over them several times."""
    return cut(rows.select(*columns, "y_true", "y_proba"))


def with_ties(rows: DataFrame) -> DataFrame:
    """The scores as they are, and rounded to two decimals so that they tie."""
    both = F.array(
        F.struct(F.lit("exact").alias("version"), F.col("y_proba").alias("y_proba")),
        F.struct(F.lit("tied").alias("version"), F.round("y_proba", 2).alias("y_proba")),
    )
    return rows.select("cutoff", "y_true", F.explode(both).alias("v")).select(
        "cutoff", "y_true", "v.*")


def run_folder(spark) -> str:
    """A new folder on shared storage."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


# --- point in time -----------------------------------------------------------

@query
def snapshot_asof(spark, sf):
    return snapshot(spark, sf)


@query
def snapshot_month_windows(spark, sf):
    """The default 30-day windows."""
    return asof.snapshot(canonical.warehouse(spark, sf), TEST)


@query
def capped_snapshot(spark, sf):
    return snapshot(spark, sf, max_subscribers=500)


@query
def panel_cutoffs(spark, sf):
    return panel(spark, sf)


@query
def panel_capped(spark, sf):
    return panel(spark, sf, max_subscribers=300)


@query
def panel_rates(spark, sf):
    return asof.panel_rates(panel(spark, sf)).withColumn(
        "dropout_rate", F.round("dropout_rate", 6))


@query
def temporal_split(spark, sf):
    rows = asof.temporal_split(panel(spark, sf), CUTOFFS)
    return rows.groupBy("split").agg(
        F.countDistinct("cutoff").alias("n_cutoffs"), F.count("*").alias("n_rows"),
        F.sum("dropout").alias("dropouts"))


@query
def cutoff_calendar(spark, sf):
    """Cutoffs every 30 days over the span of the event log."""
    span = canonical.read(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return span.select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL '30' DAY"))).alias("cutoff"))


@query
def usable_cutoffs(spark, sf):
    people = canonical.subscribers(spark, sf)
    return asof.usable_cutoffs(people, asof.cutoff_dates(spark, "1995-01-01", "1996-12-31"))


@query
def expanding_backfill(spark, sf):
    """Metrics of the test cutoff of every expanding window."""
    rows = asof.expanding_windows(kept(scored_panel(spark, sf), "cutoff"), CUTOFFS)
    sizes = rows.groupBy("window_id", "test_cutoff").agg(
        *[count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "validation", "test")])
    quality = classification.evaluate(
        rows.filter(F.col("split") == "test"), THRESHOLD, ["window_id"])
    return sizes.join(quality, "window_id").select(
        "window_id", "test_cutoff", "n_train", "n_validation", "n_test", "tp", "fp", "fn", "tn",
        F.round("roc_auc", 4).alias("roc_auc"), F.round("pr_auc", 4).alias("pr_auc"))


@query
def window_training_backfill(spark, sf):
    """A model trained in every expanding window, tested on its last cutoff and gated."""
    rows = window_training.backfill(cut(panel(spark, sf)), CUTOFFS, THRESHOLD)
    return rows.select(
        "window_id", "test_cutoff", "n_train", "n_validation", "n_test", "tp", "fp", "fn", "tn",
        *[F.round(c, 4).alias(c) for c in ("roc_auc", "pr_auc", "previous_pr_auc")], "promoted")


@query
def window_training_weights(spark, sf):
    """Intercept and weights per standard deviation of every window's model."""
    models = window_training.train(cut(panel(spark, sf)), CUTOFFS)
    names = ("intercept", *models.inputs)
    return spark.createDataFrame(
        [(w, n, round(x, 6)) for w, own in models.weights.items() for n, x in zip(names, own, strict=True)],
        "window_id int, input string, weight double")


@query
def latest_scorable_cutoff(spark, sf):
    return asof.latest_scorable(canonical.subscription_events(spark, sf), 180)


@query
def replay_schedule(spark, sf):
    """Half-yearly replayed days, cutoffs every 90 days."""
    today = asof.cutoff_dates(spark, "1999-01-01", "2000-12-31", 182).withColumnRenamed(
        "cutoff", "today")
    orders = canonical.read(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    cutoffs = orders.select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL '90' DAY"))).alias("cutoff"))
    return asof.replay_schedule(cutoffs, today, 180)


@query
def snapshot_cache(spark, sf):
    """Snapshots kept per (cutoff, sample); the second call reads the first's."""
    path = f"{run_folder(spark)}/cache"

    def build(cutoffs):
        return panel(spark, sf, cutoffs, max_subscribers=400)

    tables.cached_snapshots(spark, path, 400, build, CUTOFFS[1:3])
    rows = tables.cached_snapshots(spark, path, 400, build, CUTOFFS[1:])
    return rows.groupBy("cutoff").agg(
        F.count("*").alias("n_rows"), F.sum("dropout").alias("dropouts"))


@query
def snapshot_cache_whole(spark, sf):
    """The cache over the whole population, kept under sample 0."""
    path = f"{run_folder(spark)}/cache"

    def build(cutoffs):
        return panel(spark, sf, cutoffs)

    tables.cached_snapshots(spark, path, 0, build, CUTOFFS[1:3])
    rows = tables.cached_snapshots(spark, path, 0, build, CUTOFFS[1:])
    return rows.groupBy("cutoff").agg(
        F.count("*").alias("n_rows"), F.sum("dropout").alias("dropouts"))


_STORES: dict[tuple, object] = {}


def _kept_store(spark, sf, kind: str, make):
    """What the session has stored of a folder's tables, made at the first call."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _STORES:
        _STORES[key] = make()
    return _STORES[key]


def stored_warehouse(spark, sf) -> canonical.Warehouse:
    """The co-partitioned daily store of the tables, loaded once per session."""
    return _kept_store(spark, sf, "daily", lambda: store.write(canonical.warehouse(spark, sf))).warehouse(spark)


@query
def stored_snapshot(spark, sf):
    """The snapshot from the co-partitioned store: no fact is shuffled."""
    return asof.snapshot(stored_warehouse(spark, sf), TEST, WINDOWS)


@query
def stored_panel(spark, sf):
    """The panel from the co-partitioned store."""
    return asof.panel(stored_warehouse(spark, sf), CUTOFFS, WINDOWS)


@query
def incremental_panel(spark, sf):
    """A store loaded up to a day, grown twice by the days that followed, then a panel of it."""
    wh = canonical.warehouse(spark, sf)
    kept = store.write(wh, until="1997-06-01")
    for until in ("1999-01-01", None):
        kept = store.append(wh, kept, until)
    return asof.panel(kept.warehouse(spark), CUTOFFS, WINDOWS)


@query
def stored_history(spark, sf):
    """One subscriber's records from files sorted by subscriber."""
    path = _kept_store(spark, sf, "history", lambda: store.write_history(
        demo.history(canonical.warehouse(spark, sf)), f"{run_folder(spark)}/history"))
    return store.read_history(spark, path, "7").limit(40)


@query
def csv_round_trip(spark, sf):
    """The held-out split written as CSV and read back under its schema."""
    path = f"{run_folder(spark)}/test_split"
    files.write_csv(
        snapshot(spark, sf).select("subscriber_id", *schemas.MODEL_INPUTS, schemas.TARGET), path)
    return files.read_training_csv(spark, path)


@query
def stratified_split(spark, sf):
    rows = asof.stratified_split(panel(spark, sf), ["subscriber_id", "cutoff"])
    return rows.groupBy("dropout", "split").agg(F.count("*").alias("n"))


# --- features ----------------------------------------------------------------

@query
def model_inputs(spark, sf):
    return feat.finite_inputs(feat.model_inputs(snapshot(spark, sf), "subscriber_id"))


@query
def features_and_target(spark, sf):
    """Target and inputs without identifiers, summarised per plan."""
    rows = feat.features_and_target(panel(spark, sf))
    return rows.groupBy("plan_type").agg(
        F.count("*").alias("n"), F.sum("dropout").alias("dropouts"),
        *[F.round(F.avg(c), 4).alias(c) for c in schemas.RAW_NUMERIC])


@query
def derived_features(spark, sf):
    return feat.add_derived(snapshot(spark, sf)).select(
        "subscriber_id", "is_auto_renew_enabled", "is_dormant", *schemas.DERIVED_NUMERIC)


@query
def imputation_values(spark, sf):
    """Median per numeric feature and most frequent plan, fitted on the panel."""
    rows = cut(feat.add_derived(panel(spark, sf)))
    medians = selection.column_quantiles(rows, schemas.NUMERIC, [0.5]).select(
        "feature", F.round(F.col("q")[0], 6).alias("median"),
        F.lit(None).cast("string").alias("mode"))
    plans = rows.groupBy("plan_type").agg(F.count("*").alias("n"))
    mode = plans.agg(
        F.min_by("plan_type", F.struct(-F.col("n"), "plan_type")).alias("mode")
    ).select(F.lit("plan_type").alias("feature"), F.lit(None).cast("double").alias("median"),
             "mode")
    return medians.unionByName(mode)


@query
def standardized_features(spark, sf):
    """The 21 model columns of the test cutoff, fitted on the earlier cutoffs."""
    fitted = prep.fit_preprocessor(cut(panel(spark, sf, CUTOFFS[:-1])))
    rows = fitted.transform(snapshot(spark, sf), "subscriber_id")
    return rows.select("subscriber_id", *[
        F.round(F.col(c).cast("double"), 5).alias(c)
        for c in rows.columns if c != "subscriber_id"])


# --- scoring -----------------------------------------------------------------

@query
def score_bands(spark, sf):
    rows = scoring.predict(snapshot(spark, sf), linear.CHAMPION, THRESHOLD)
    return rows.select(
        "subscriber_id", F.round("dropout_probability", 4).alias("dropout_probability"),
        "predicted_label", "risk_level")


@query
def risk_factors(spark, sf):
    rows = scoring.predict(snapshot(spark, sf), linear.CHAMPION, THRESHOLD)
    return rows.select(
        "subscriber_id", F.array_join("factors", "; ").alias("factors"),
        F.array_join("signals", "; ").alias("signals"), "explanation",
        F.array_join("top_risk_factors", "; ").alias("top_risk_factors"), "explanation_method")


def _explained(spark, sf) -> tuple[DataFrame, linear.LinearModel]:
    rows = snapshot(spark, sf)
    wide = feat.add_derived(rows).withColumns(feat.plan_dummies()).withColumn(
        "is_auto_renew_enabled", F.col("is_auto_renew_enabled").cast("boolean"))
    # The model is read off the population it explains: one row of means.
    means = linear.column_means(wide, [c for c, _ in linear.EXPLAINED])
    return wide, linear.centred("explainer", -1.8, linear.EXPLAINED, means)


@query
def attributions_top3(spark, sf):
    wide, model = _explained(spark, sf)
    rows = scoring.predict_explained(wide, linear.CHAMPION, model, THRESHOLD)
    each = rows.select(
        "subscriber_id", "explanation", F.array_join("top_risk_factors", "; ").alias("raising"),
        F.posexplode("attributions").alias("position", "a"))
    return each.select(
        "subscriber_id", "position", F.col("a.feature").alias("feature"),
        F.round("a.contribution", 6).alias("contribution"), F.col("a.direction").alias("direction"),
        F.col("a.description").alias("description"), "explanation", "raising")


@query
def attribution_concepts(spark, sf):
    """Contribution of every concept; per row they add up to the log-odds."""
    from ebbtide.functions.explain import grouped

    wide, model = _explained(spark, sf)
    entries = F.array(*[
        F.struct(F.lit(c).alias("concept"), e["total"].alias("total"),
                 e["dominant"].alias("dominant"))
        for c, e in grouped(model).items()])
    return wide.select("subscriber_id", F.explode(entries).alias("e")).select(
        "subscriber_id", "e.concept", F.round("e.total", 6).alias("total"), "e.dominant")


@query
def what_if(spark, sf):
    levers = [("is_auto_renew_enabled", True), ("last_activity_days_ago", 0),
              ("payment_failures_last_6m", 0), ("monthly_fee", 100.0), ("tenure_days", 1000)]
    rows = scoring.what_if(snapshot(spark, sf), linear.CHAMPION, levers)
    return rows.select(
        "subscriber_id", "lever", "new_value",
        *[F.round(c, 6).alias(c) for c in ("old_probability", "new_probability", "delta")])


def _logistic(model: linear.LinearModel):
    """The formula over a pandas batch, standing in for a foreign model.

    It closes over plain numbers, so Python workers need no package of ours.
    """
    intercept, terms = model.intercept, model.terms

    def predict_proba(batch):
        import numpy as np

        total = np.full(len(batch), intercept)
        for name, weight, centre in terms:
            total = total + weight * (batch[name].astype("float64").to_numpy() - centre)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30.0, 30.0)))

    return predict_proba


@query
def foreign_model_scores(spark, sf):
    rows = scoring.score_foreign(snapshot(spark, sf), _logistic(linear.CHAMPION))
    return rows.withColumn("y_proba", F.round("y_proba", 6))


# --- evaluation --------------------------------------------------------------

@query
def confusion(spark, sf):
    rows = classification.confusion(scored_panel(spark, sf), THRESHOLD, ["cutoff"])
    rates = ("positive_rate_actual", "positive_rate_predicted", "accuracy", "precision",
             "recall", "f1")
    return rows.select(
        "cutoff", "threshold", "n_samples", "tp", "fp", "fn", "tn",
        *[F.round(c, 4).alias(c) for c in rates])


def _ranking(spark, sf) -> DataFrame:
    keys = ["cutoff", "version"]
    rows = with_ties(scored_panel(spark, sf))
    return classification.ranking_metrics(classification.curve(rows, keys), keys)


@query
def roc_auc(spark, sf):
    return _ranking(spark, sf).select(
        "cutoff", "version", "positives", "negatives", F.round("roc_auc", 4).alias("roc_auc"))


@query
def avg_precision(spark, sf):
    return _ranking(spark, sf).select("cutoff", "version", F.round("pr_auc", 4).alias("pr_auc"))


@query
def f1_sweep(spark, sf):
    return classification.f1_sweep(scored(spark, sf)).withColumn("f1", F.round("f1", 6))


@query
def f1_best(spark, sf):
    best = classification.tune_threshold(classification.f1_sweep(scored_panel(spark, sf)))
    return best.withColumn("f1", F.round("f1", 4))


@query
def class_report(spark, sf):
    rows = classification.class_report(scored(spark, sf), THRESHOLD)
    return rows.select("class", "support", *[
        F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


@query
def class_balance(spark, sf):
    return classification.class_balance(scored_panel(spark, sf), ["cutoff"]).withColumn(
        "positive_rate", F.round("positive_rate", 6))


@query
def brier_ece(spark, sf):
    return calibration.calibration_metrics(scored_panel(spark, sf), keys=["cutoff"])


@query
def reliability(spark, sf):
    return calibration.reliability(scored(spark, sf))


@query
def calibration_compare(spark, sf):
    """A logistic score against its own shrinkage towards the base rate."""
    rows = scored_panel(spark, sf).withColumn("shrunk", F.col("y_proba") * 0.5)
    return calibration.compare_calibration(rows, "y_proba", "shrunk")


def _split_scores(spark, sf) -> DataFrame:
    return cut(_as_scored(asof.temporal_split(panel(spark, sf), CUTOFFS)).select(
        "split", "y_true", "y_proba"))


@query
def isotonic_blocks(spark, sf):
    """The fitted steps of the isotonic map, over all cutoffs."""
    rows = calibration.isotonic_blocks(kept(scored_panel(spark, sf)))
    return rows.select(*[F.round(c, 9).alias(c) for c in ("lo", "hi", "mean")], "n", "positives")


@query
def sigmoid_weights(spark, sf):
    """Intercept and slope of the logistic curve over log-odds, fitted on all cutoffs."""
    intercept, slope = calibration.sigmoid_weights(kept(scored_panel(spark, sf)))
    return spark.createDataFrame([(round(intercept, 6), round(slope, 6))], "intercept double, slope double")


def _calibrated(spark, sf, method) -> DataFrame:
    rows = _split_scores(spark, sf)
    apply = calibration.fit_calibration(rows.filter(F.col("split") == "validation"), method)
    out = apply(rows.filter(F.col("split") == "test"))
    return calibration.compare_calibration(out, "y_proba", "calibrated").withColumn(
        "method", F.lit(method))


@query
def isotonic_calibration(spark, sf):
    return _calibrated(spark, sf, "isotonic")


@query
def sigmoid_calibration(spark, sf):
    return _calibrated(spark, sf, "sigmoid")


# --- costs and capacity ------------------------------------------------------

@query
def cost_sweep(spark, sf):
    return decisions.cost_sweep(scored(spark, sf))


@query
def cost_optimal(spark, sf):
    return decisions.cost_optimal(decisions.cost_sweep(scored_panel(spark, sf)))


def _tied(spark, sf) -> DataFrame:
    return kept(scored_panel(spark, sf).withColumn("y_proba", F.round("y_proba", 2)))


@query
def capacity_threshold(spark, sf):
    rows = scored_panel(spark, sf).withColumn("y_proba", F.round("y_proba", 2))
    return decisions.capacity_threshold(rows, 250).withColumn(
        "capacity_threshold", F.round("capacity_threshold", 6))


@query
def constrained_threshold(spark, sf):
    return decisions.constrained(_tied(spark, sf), 100)


@query
def capacity_ladder(spark, sf):
    return decisions.capacity_ladder(_tied(spark, sf))


@query
def capacity_report(spark, sf):
    return decisions.capacity_report(_tied(spark, sf), budget=0.01)


@query
def threshold_report(spark, sf):
    return decisions.threshold_report(scored_panel(spark, sf), THRESHOLD)


# --- fairness and promotion --------------------------------------------------

ATTRIBUTES = ("plan_type", "acquisition_channel")


@query
def group_metrics(spark, sf):
    grouped = fairness.by_attribute(kept(scored(spark, sf), *ATTRIBUTES), ATTRIBUTES)
    return fairness.group_metrics(grouped, THRESHOLD)


@query
def disparity(spark, sf):
    rows = fairness.audit(kept(scored(spark, sf), *ATTRIBUTES), ATTRIBUTES, THRESHOLD)
    return rows.withColumn("concerns", F.array_join("concerns", "; "))


@query
def audit(spark, sf):
    verdict = fairness.audit_verdict(
        fairness.audit(kept(scored(spark, sf), *ATTRIBUTES), ATTRIBUTES, THRESHOLD))
    return verdict.withColumn(
        "attributes_with_concerns", F.array_join("attributes_with_concerns", ", "))


def _both_models(rows: DataFrame) -> DataFrame:
    both = F.array(*[
        F.struct(F.lit(m.name).alias("model"), m.probability().alias("y_proba"))
        for m in (linear.CHAMPION, linear.CHALLENGER)])
    return rows.select(F.col("dropout").alias("y_true"), F.explode(both).alias("m")).select(
        "y_true", "m.*")


@query
def promotion_gate(spark, sf):
    rows = _both_models(snapshot(spark, sf))
    rankings = classification.ranking_metrics(classification.curve(rows, ["model"]), ["model"])
    out = classification.promotion_gate(rankings)
    return out.withColumns({
        c: F.col(c).cast("double") for c in ("challenger_score", "champion_score")})


# --- drift -------------------------------------------------------------------

def _profile(spark, sf) -> DataFrame:
    """Profile of the training cutoffs, with the champion's scores."""
    rows = cut(linear.CHAMPION.score(panel(spark, sf, CUTOFFS[:-1]), "p"))
    return cut(drift.reference_profile(rows, "p"))


def _live(spark, sf, rows: DataFrame | None = None) -> DataFrame:
    """The test cutoff, with a higher premium fee so that something moves."""
    rows = snapshot(spark, sf) if rows is None else rows
    return linear.CHAMPION.score(rows.withColumn(
        "monthly_fee", F.when(F.col("plan_type") == "premium", F.col("monthly_fee") * 1.5)
        .otherwise(F.col("monthly_fee"))), "p")


@query
def profile_bins(spark, sf):
    rows = _profile(spark, sf)
    return rows.select(
        "feature", "kind", "bin_no", "category", "n_rows",
        *[F.round(c, 6).alias(c) for c in ("lo", "hi", "share")], "mean", "std", "min", "max")


@query
def profile_stats(spark, sf):
    return drift.numeric_stats(drift.unpivot_numeric(panel(spark, sf, CUTOFFS[:-1])))


@query
def psi_numeric(spark, sf):
    rows = drift.numeric_psi(_live(spark, sf), _profile(spark, sf))
    return rows.select("feature", F.round("psi", 4).alias("psi"), "reference_mean", "live_mean")


@query
def psi_discrete(spark, sf):
    rows = drift.discrete_psi(_live(spark, sf), _profile(spark, sf))
    return rows.select(
        "feature", F.round("psi", 6).alias("psi"),
        F.array_join("unseen_categories", ", ").alias("unseen_categories"))


@query
def psi_prediction(spark, sf):
    rows = drift.prediction_psi(_live(spark, sf), _profile(spark, sf), "p")
    return rows.select("feature", F.round("psi", 4).alias("psi"), "reference_mean", "live_mean")


@query
def drift_features(spark, sf):
    rows = drift.drift_features(cut(_live(spark, sf)), _profile(spark, sf), "p")
    return rows.withColumn("unseen_categories", F.array_join("unseen_categories", ", "))


@query
def drift_report(spark, sf):
    rows = drift.assess(cut(_live(spark, sf)), _profile(spark, sf), "p")
    return rows.withColumns({
        c: F.array_join(c, ", ") for c in ("drifted_features", "top_features")})


@query
def drift_asof(spark, sf):
    """A stored profile against a later cutoff of the warehouse."""
    path = f"{run_folder(spark)}/profile"
    files.write_table(drift.reference_profile(cut(panel(spark, sf, CUTOFFS[:-1]))), path)
    rows = drift.assess(cut(snapshot(spark, sf)), files.read_table(spark, path))
    return rows.withColumns({
        c: F.array_join(c, ", ") for c in ("drifted_features", "top_features")})


# --- catalogue and demo queries ----------------------------------------------

@query
def plan_mix(spark, sf):
    return demo.plan_mix(canonical.warehouse(spark, sf))


@query
def lifecycle_counts(spark, sf):
    return demo.lifecycle_counts(canonical.warehouse(spark, sf))


@query
def channels_top10(spark, sf):
    return demo.top_channels(canonical.warehouse(spark, sf))


@query
def cancellations_monthly(spark, sf):
    return demo.cancellations_per_month(canonical.warehouse(spark, sf), "1997-06-01")


@query
def history_360(spark, sf):
    """The full record of every subscriber."""
    return demo.history(canonical.warehouse(spark, sf))


@query
def subscriber_history(spark, sf):
    return demo.subscriber_history(canonical.warehouse(spark, sf), "7")


@query
def subscriber_sessions(spark, sf):
    return demo.subscriber_sessions(canonical.warehouse(spark, sf), "7")


@query
def subscribers_head(spark, sf):
    return demo.subscribers_head(canonical.warehouse(spark, sf))


@query
def event_log_head(spark, sf):
    return demo.event_log_head(canonical.warehouse(spark, sf))


@query
def cleaning_log(spark, sf):
    wh = canonical.warehouse(spark, sf)
    return demo.cleaning_log(wh, raw_logs(spark, sf), raw_transactions(spark, sf), "1999-01-01")


@query
def arrivals(spark, sf):
    return demo.arrivals(canonical.warehouse(spark, sf), "1999-12-01", TEST)


@query
def table_counts(spark, sf):
    return tables.table_counts(canonical.warehouse(spark, sf).tables())


@query
def total_events(spark, sf):
    return tables.total_events(tables.table_counts(canonical.warehouse(spark, sf).tables()))


@query
def warehouse_summary(spark, sf):
    counts = tables.table_counts(canonical.warehouse(spark, sf).tables())
    return tables.warehouse_summary(counts, "star-schema tables")


@query
def reconcile(spark, sf):
    """Counts of the mapped tables against a loaded copy of them."""
    wh = canonical.warehouse(spark, sf)
    path = run_folder(spark)
    tables.write_warehouse(wh, path)
    stored = tables.read_warehouse(spark, path)
    return tables.reconcile(
        tables.table_counts(wh.tables()), tables.table_counts(stored.tables()))


@query
def key_slices(spark, sf):
    return tables.slice_counts(
        canonical.subscription_events(spark, sf), "event_id", 4_000)


@query
def sql_surface(spark, sf):
    """Parameterised SQL text over the warehouse views."""
    wh = canonical.warehouse(spark, sf)
    return tables.run_sql(
        spark,
        "SELECT plan_type, count(*) AS events FROM subscription_events "
        "WHERE event_type = :kind GROUP BY plan_type",
        wh.tables(), kind="cancellation")


# --- contract ----------------------------------------------------------------

@query
def contract_report(spark, sf):
    return contract.validate_load(canonical.warehouse(spark, sf).tables())


@query
def contract_summary(spark, sf):
    return contract.summarise(contract.validate_load(canonical.warehouse(spark, sf).tables()))


def _buyers(spark, sf) -> DataFrame:
    """A narrower dimension: customers of two segments, so others are orphans."""
    return canonical.subscribers(spark, sf).filter(
        F.col("acquisition_channel").isin("building", "machinery"))


@query
def orphans(spark, sf):
    wh = canonical.warehouse(spark, sf)
    events = {k: v for k, v in wh.tables().items() if k != "subscribers"}
    return contract.orphan_report(events, _buyers(spark, sf))


@query
def orphans_dropped(spark, sf):
    kept = contract.drop_orphans(canonical.subscription_events(spark, sf), _buyers(spark, sf))
    return kept.groupBy("event_type").agg(
        F.count("*").alias("n"), F.countDistinct("subscriber_id").alias("subscribers"))


@query
def presignup(spark, sf):
    wh = canonical.warehouse(spark, sf)
    checks = contract.cross_checks("sessions", wh.sessions, wh.subscribers)
    return checks.filter(F.col("severity") == contract.WARNING)


@query
def request_validation(spark, sf):
    """Snapshot rows as requests, some fields pushed out of range by the data."""
    rows = snapshot(spark, sf).withColumns({
        "plan_type": F.when(F.col("discounts_used_last_6m") > 3, "gold").otherwise(
            F.concat(F.lit(" "), F.initcap("plan_type"), F.lit(" "))),
        "monthly_fee": F.when(F.col("payment_failures_last_6m") > 3, -F.col("monthly_fee"))
        .otherwise(F.col("monthly_fee")),
        "last_activity_days_ago": F.when(
            F.col("support_tickets_last_90d") > 1, F.col("tenure_days") + 1
        ).otherwise(F.col("last_activity_days_ago")),
    })
    return contract.validate_requests(rows).select(
        "subscriber_id", "plan_type", F.array_join("problems", "; ").alias("problems"), "valid")


@query
def train_gate(spark, sf):
    """The gate over a panel whose cheap plans lost their fee."""
    rows = asof.temporal_split(panel(spark, sf), CUTOFFS).withColumns({
        "monthly_fee": F.when(F.col("plan_type") == "basic", None).otherwise(
            F.col("monthly_fee")),
        "dropout": F.when(F.col("split") == "test", 0).otherwise(F.col("dropout")),
    })
    return contract.training_gate(rows)


# --- raw-export mapping ------------------------------------------------------

def raw_members(spark, sf) -> DataFrame:
    """Customers in the raw export's shape; some carry an impossible date."""
    people = canonical.subscribers(spark, sf)
    day = F.when(F.dayofmonth("signup_date") == 1, "20159999").otherwise(
        F.date_format("signup_date", "yyyyMMdd"))
    return people.select(
        F.col("subscriber_id").alias("msno"),
        F.length("acquisition_channel").alias("registered_via"),
        day.alias("registration_init_time"))


def raw_transactions(spark, sf) -> DataFrame:
    """Orders in the raw export's shape, keyed by the order."""
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    orders = canonical.read(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").cast("string").alias("msno"),
        F.get(F.array(*[F.lit(d) for d in (7, 31, 90, 180, 410)]), priority - 1)
        .alias("payment_plan_days"),
        F.round(F.col("o_totalprice") / 1000.0).alias("plan_list_price"),
        F.floor(F.col("o_totalprice") / 1000.0).cast("double").alias("actual_amount_paid"),
        (F.col("o_orderstatus") == "O").cast("int").alias("is_auto_renew"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("transaction_date"),
        ((F.col("o_orderstatus") == "F") & (priority == 1)).cast("int").alias("is_cancel"),
    )


def raw_logs(spark, sf) -> DataFrame:
    """Lines in the raw export's shape; returned ones have negative time."""
    orders = canonical.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = canonical.read(spark, sf, "lineitem")
    return lines.join(orders.hint("shuffle_hash"), lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("msno"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("date"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .otherwise(F.col("l_quantity") * 60.0).alias("total_secs"))


@query
def ingest_subscribers(spark, sf):
    return raw_export.members_to_subscribers(raw_members(spark, sf))


@query
def ingest_events(spark, sf):
    return raw_export.transactions_to_events(raw_transactions(spark, sf)).withColumn(
        "monthly_fee", F.round("monthly_fee", 6))


@query
def ingest_payments(spark, sf):
    return raw_export.transactions_to_payments(raw_transactions(spark, sf))


@query
def ingest_sessions(spark, sf):
    """Sessions since a day; the key is assigned, so it is not compared."""
    return raw_export.logs_to_sessions(raw_logs(spark, sf), "1999-01-01").drop("session_id")


@query
def ingest_load(spark, sf):
    """Map, drop orphans, load twice, count: twice loaded is not doubled."""
    wh = raw_export.build(
        raw_members(spark, sf), raw_transactions(spark, sf).drop("event_id"),
        raw_logs(spark, sf))
    path = run_folder(spark)
    for _ in range(2):
        tables.write_warehouse(wh, path)
    return tables.table_counts(tables.read_warehouse(spark, path).tables())


@query
def ingest_dry_run(spark, sf):
    wh = raw_export.build(
        raw_members(spark, sf), raw_transactions(spark, sf).drop("event_id"),
        raw_logs(spark, sf))
    return contract.summarise(raw_export.dry_run(wh))


@query
def dead_features(spark, sf):
    """Constant model columns of a snapshot without failed payments or tickets."""
    wh = canonical.warehouse(spark, sf)
    rows = asof.snapshot(
        canonical.Warehouse(
            wh.subscribers, wh.subscription_events, wh.sessions,
            wh.payments.withColumn("status", F.lit("succeeded")),
            raw_export.empty_support_tickets(spark)),
        TEST, WINDOWS)
    return raw_export.constant_columns(feat.add_derived(rows), schemas.NUMERIC).select(
        "feature", "constant")


# --- serving log and monitoring ----------------------------------------------

def _requests(spark, sf) -> DataFrame:
    return requests.requests(spark, sf, snapshot(spark, sf))


def _log(spark, sf) -> DataFrame:
    return shadow.prediction_log(_requests(spark, sf), linear.CHAMPION, THRESHOLD)


def _pairs(spark, sf) -> DataFrame:
    return shadow.shadow_pairs(
        _requests(spark, sf), linear.CHAMPION, linear.CHALLENGER, THRESHOLD, THRESHOLD)


@query
def shadow_pairs(spark, sf):
    return _pairs(spark, sf).select(
        "request_id", "champion_label", "challenger_label", "agreed",
        *[F.round(c, 6).alias(c)
          for c in ("champion_probability", "challenger_probability", "divergence")])


@query
def shadow_summary(spark, sf):
    return shadow.shadow_summary(_pairs(spark, sf))


@query
def shadow_readiness(spark, sf):
    return shadow.readiness(shadow.shadow_summary(_pairs(spark, sf)))


@query
def prediction_log_summary(spark, sf):
    return shadow.log_summary(_log(spark, sf))


@query
def mean_score_shift(spark, sf):
    trained = linear.CHAMPION.score(panel(spark, sf, CUTOFFS[:-1])).agg(F.avg("y_proba")).first()
    return shadow.mean_shift(shadow.log_summary(_log(spark, sf)), trained[0])


@query
def prediction_counts(spark, sf):
    return monitoring.prediction_counts(_log(spark, sf))


@query
def score_histogram(spark, sf):
    rows = monitoring.probability_histogram(_log(spark, sf), ["risk_level"])
    return rows.withColumn("le", F.when(F.col("le") == float("inf"), 1e9).otherwise(F.col("le")))


@query
def shadow_histogram(spark, sf):
    rows = monitoring.divergence_histogram(_pairs(spark, sf))
    return rows.withColumn("le", F.when(F.col("le") == float("inf"), 1e9).otherwise(F.col("le")))


@query
def agreement_counts(spark, sf):
    return monitoring.agreement_counts(_pairs(spark, sf))


@query
def histogram_quantile(spark, sf):
    buckets = monitoring.probability_histogram(_log(spark, sf))
    return monitoring.histogram_quantile(buckets, [0.5, 0.9, 0.95, 0.99]).withColumn(
        "value", F.round("value", 6))


@query
def rate_5m(spark, sf):
    rows = monitoring.rates(_log(spark, sf), "served_at", ["risk_level"])
    return rows.withColumn("rate_per_sec", F.round("rate_per_sec", 6))


def _samples(spark, sf) -> DataFrame:
    return cut(monitoring.serving_samples(_log(spark, sf), _pairs(spark, sf), 0.25, "6 hours"))


@query
def metric_samples(spark, sf):
    return _samples(spark, sf).withColumn("value", F.round("value", 4))


@query
def alerts_firing(spark, sf):
    return monitoring.alert_state(monitoring.rule_samples(_samples(spark, sf)))


@query
def alert_persistence(spark, sf):
    return monitoring.alert_episodes(monitoring.rule_samples(_samples(spark, sf)))


@query
def decision_gauges(spark, sf):
    """Numbers of the decision reports as metric rows."""
    rows = kept(scored(spark, sf))
    report = decisions.threshold_report(rows, THRESHOLD)
    ece = calibration.calibration_metrics(rows)
    nested = report.select(F.struct(
        F.struct("savings", "extra_offers_required", "population").alias("costs"),
        F.struct("optimal_threshold", "optimal_total_cost").alias("optimal"),
    ).alias("r")).select("r.*")
    return files.flatten_metrics(nested, "test_").unionByName(
        files.flatten_metrics(ece.select("brier_score", "expected_calibration_error"),
                              "test_calibration_"))


@query
def report_gauges(spark, sf):
    """Decision quality and drift of the test cutoff as gauges, stamped with its day."""
    at = F.lit(f"{TEST} 00:00:00").cast("timestamp_ntz")
    rows = cut(snapshot(spark, sf))
    quality = training.decision_quality(
        kept(_as_scored(rows), "plan_type"), THRESHOLD, "plan_type")
    moved = drift.drift_features(_live(spark, sf, rows), _profile(spark, sf), "p")
    out = monitoring.decision_samples(quality, at).unionByName(monitoring.psi_samples(moved, at))
    return out.withColumn("value", F.round("value", 6))


@query
def report_alerts(spark, sf):
    """The alert rules over the gauges of the decision report."""
    at = F.lit(f"{TEST} 00:00:00").cast("timestamp_ntz")
    quality = training.decision_quality(
        kept(scored(spark, sf), "plan_type"), THRESHOLD, "plan_type")
    samples = cut(monitoring.decision_samples(quality, at))
    return monitoring.alert_state(monitoring.rule_samples(samples))


@query
def run_report(spark, sf):
    """Gate, drift and fairness of one run, with the reasons to look at it."""
    rows = cut(snapshot(spark, sf))
    test = _as_scored(rows)
    rankings = classification.ranking_metrics(
        classification.curve(_both_models(test), ["model"]), ["model"])
    gate = classification.promotion_gate(rankings)
    fair = fairness.audit(test, ["plan_type"], THRESHOLD)
    trained = training.training_summary(gate, fair)
    moved = drift.assess(_live(spark, sf, rows), _profile(spark, sf), "p").select(
        "available", "overall_verdict", "drifted_features")
    return monitoring.run_report(trained, moved).select(
        "promoted", "promotion_reason", "fairness_passes", "overall_verdict",
        F.array_join("attention_reasons", " | ").alias("attention_reasons"), "needs_attention")


@query
def training_headline(spark, sf):
    """The few numbers of a run worth carrying into its report, per split."""
    rows = kept(_as_scored(asof.temporal_split(panel(spark, sf), CUTOFFS)), "split")
    return training.headline(classification.evaluate(rows, THRESHOLD, ["split"]))


@query
def stored_run_report(spark, sf):
    """A run report written as JSON and read back under its schema."""
    path = f"{run_folder(spark)}/last_run"
    report = demo.plan_mix(canonical.warehouse(spark, sf)).agg(
        F.struct(F.sum("events").alias("events"),
                 F.sum("with_auto_renew").alias("with_auto_renew")).alias("ingest"),
        F.lit(False).alias("needs_attention"))
    files.write_report(report, path)
    back = files.read_report(spark, path, report.schema)
    return files.flatten_metrics(back)


@query
def run_history(spark, sf):
    """Each cutoff's evaluation as a model version, newest first."""
    quality = cut(classification.evaluate(
        kept(scored_panel(spark, sf), "cutoff"), THRESHOLD, ["cutoff"]))
    # One row per cutoff.
    version = F.row_number().over(Window.orderBy("cutoff")).alias("version")
    versions = cut(quality.select(version, F.col("cutoff").alias("created"), "*"))
    metrics = versions.select("version", F.explode(F.array(*[
        F.struct(F.lit(f"test_{m}").alias("metric"), F.round(m, 4).alias("value"))
        for m in ("roc_auc", "pr_auc", "recall", "precision")])).alias("m")).select(
        "version", "m.*")
    best = versions.agg(
        F.max_by("version", F.struct(F.round("pr_auc", 4), "version")).alias("version"))
    newest = versions.agg(F.max("version").alias("version"))
    aliases = best.withColumn("alias", F.lit("champion")).unionByName(
        newest.withColumn("alias", F.lit("challenger")))
    rows = monitoring.run_history(versions.select("version", "created"), aliases, metrics, 3)
    return rows.select(
        "version", "created", F.array_join("aliases", ", ").alias("aliases"),
        *[F.col("metrics")[f"test_{m}"].alias(f"test_{m}")
          for m in ("roc_auc", "pr_auc", "recall", "precision")])


@query
def overview(spark, sf):
    """Warehouse, model and drift on one row."""
    counts = tables.table_counts(canonical.warehouse(spark, sf).tables())
    rows = cut(snapshot(spark, sf))
    quality = classification.evaluate(kept(_as_scored(rows)), THRESHOLD)
    moved = drift.assess(_live(spark, sf, rows), _profile(spark, sf), "p")
    return training.overview(counts, quality, moved)


@query
def decision_quality(spark, sf):
    """Calibration, cost and fairness of one scored table as one row."""
    return training.decision_quality(
        kept(scored(spark, sf), "plan_type"), THRESHOLD, "plan_type")


# --- models ------------------------------------------------------------------

@query
def gbt_train_eval(spark, sf):
    """Boosted trees on the training cutoffs, evaluated on the later ones."""
    rows = cut(asof.temporal_split(panel(spark, sf), CUTOFFS))
    return training.train_and_evaluate(rows).select(
        "split", "threshold", "n_samples",
        *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc",
                                           "pr_auc")])


@query
def feature_importances(spark, sf):
    train = cut(panel(spark, sf, CUTOFFS[:-1]))
    model = prep.tree_pipeline(prep.fit_preprocessor(train)).fit(prep.with_label(train))
    return prep.top_importances(model, train)


@query
def tree_explanations(spark, sf):
    """What each feature adds to the boosted trees' log-odds, per row of the test cutoff."""
    model = training.fit(cut(panel(spark, sf, CUTOFFS[:-1])))
    rows = tree_contributions.explain(model, snapshot(spark, sf), f"{run_folder(spark)}/trees", "subscriber_id")
    each = rows.select("subscriber_id", "base", "log_odds", F.explode("contributions").alias("feature", "contribution"))
    return each.filter(F.col("contribution") != 0).select(
        "subscriber_id", "feature", *[F.round(c, 6).alias(c) for c in ("contribution", "base", "log_odds")])


# --- streaming ---------------------------------------------------------------

def _stream_run(spark, sf) -> tuple[str, scorer.ScorerStats]:
    """Write the topic rows, then drain them through the streaming scorer."""
    folder = run_folder(spark)
    requests.write_topic(requests.messages(spark, sf, snapshot(spark, sf)), f"{folder}/topic")
    job = scorer.StreamScorer(
        lambda: linear.CHAMPION, scorer.file_sink(f"{folder}/out"), f"{folder}/checkpoint",
        THRESHOLD)
    stats = job.drain(scorer.file_source(spark, f"{folder}/topic", schemas.MESSAGES, 2))
    return f"{folder}/out", stats


@query
def stream_scored(spark, sf):
    out, _ = _stream_run(spark, sf)
    return scorer.read_output(spark, out, scorer.SCORED).select(
        "source_offset", "subscriber_id", "dropout_probability", "predicted_label", "risk_level",
        "explanation")


@query
def stream_dead_letters(spark, sf):
    out, _ = _stream_run(spark, sf)
    return scorer.read_output(spark, out, scorer.DEAD).select(
        "offset", "partition", "key", "reason", "payload")


@query
def stream_stats(spark, sf):
    out, stats = _stream_run(spark, sf)
    counted = scorer.read_output(spark, out, scorer.SCORED).select(F.lit("scored").alias("o")
        ).unionByName(scorer.read_output(spark, out, scorer.DEAD).select(
            F.lit("dead_lettered").alias("o")))
    return counted.agg(
        F.count("*").alias("messages"), count_if(F.col("o") == "scored").alias("scored"),
        count_if(F.col("o") != "scored").alias("dead_lettered"),
    ).withColumn("agrees_with_runner", (F.col("scored") == stats.scored)
                 & (F.col("dead_lettered") == stats.dead_lettered))


@query
def stream_rate_windows(spark, sf):
    """Five-minute windows per event type: those the drained stream closed, then the open rest."""
    folder = run_folder(spark)
    every = canonical.read(spark, sf, "events")
    events = spark.readStream.schema(every.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = stream_rates.stream_rates(events, "ts", ["event_type"])
    stream_rates.drain_to(rows, f"{folder}/rates", f"{folder}/checkpoint")

    def shown(df, closed):
        return df.select(
            F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type",
            "n", F.round("rate_per_sec", 6).alias("rate_per_sec"), F.lit(closed).alias("closed"))

    closed = shown(spark.read.parquet(f"{folder}/rates"), True)
    rest = shown(monitoring.rates(every, "ts", ["event_type"]), False)
    return closed.unionByName(rest.join(closed, ["window_start", "event_type"], "left_anti"))
