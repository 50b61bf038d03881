"""Histograms, rates, alerts and run reports over logs and metric samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import clip, epoch_seconds, interval_index, reasons
from ebbtide.params import DIVERGENCE_BUCKETS, PROBABILITY_BUCKETS
from ebbtide.session import small_table

VERDICT_CODES = {"stable": 0, "moderate": 1, "significant": 2}


def prediction_counts(log: DataFrame) -> DataFrame:
    """Served predictions by band and label."""
    return log.groupBy("risk_level", "predicted_label").agg(F.count("*").alias("n"))


def agreement_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("agreed").agg(F.count("*").alias("n"))


def histogram(
    df: DataFrame, value: str, bounds: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Cumulative histogram: rows at or below each bound, the last one infinite.

    Rows collapse to their bucket first; only bucket counts fan out to the
    bounds above them.
    """
    limits = [float(b) for b in bounds] + [float("inf")]
    per_bucket = df.groupBy(
        *keys, interval_index(F.col(value), limits[:-1], closed="right").alias("bucket")
    ).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    steps = F.sequence(F.lit(0), F.lit(len(limits) - 1))
    below = F.when(F.col("bucket") <= F.col("at"), F.col("n")).otherwise(0)
    return (
        per_bucket.withColumn("at", F.explode(steps))
        .groupBy(*keys, "at")
        .agg(F.sum(below).alias("cumulative"))
        .select(*keys, F.get(F.array(*[F.lit(x) for x in limits]), F.col("at")).alias("le"),
                "cumulative")
    )


def probability_histogram(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return histogram(log, "dropout_probability", PROBABILITY_BUCKETS, keys)


def divergence_histogram(pairs: DataFrame) -> DataFrame:
    return histogram(pairs, "divergence", DIVERGENCE_BUCKETS)


def histogram_quantile(
    buckets: DataFrame, quantiles: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Quantiles from cumulative buckets, linear inside a bucket.

    The first bucket starts at zero; a quantile in the infinite bucket gives the
    largest finite bound.  Works on a handful of rows per series.
    """
    series = Window.partitionBy(*keys, "quantile").orderBy("le")
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in quantiles]))
    rows = buckets.withColumn("quantile", wanted).withColumns({
        "low": F.coalesce(F.lag("le").over(series), F.lit(0.0)),
        "before": F.coalesce(F.lag("cumulative").over(series), F.lit(0)),
        "total": F.max("cumulative").over(Window.partitionBy(*keys, "quantile")),
    })
    rank = F.col("quantile") * F.col("total")
    inside = F.try_divide(
        rank - F.col("before"), (F.col("cumulative") - F.col("before")).cast("double"))
    value = F.when(F.col("le") == float("inf"), F.col("low")).otherwise(
        F.col("low") + (F.col("le") - F.col("low")) * inside)
    return rows.filter((F.col("cumulative") >= rank) & (F.col("total") > 0)).groupBy(
        *keys, "quantile").agg(F.min_by(value, F.col("le")).alias("value"))


def rates(
    events: DataFrame, ts: str, labels: Sequence[str], width: str = "5 minutes",
    seconds: int = 300,
) -> DataFrame:
    """Events per second and per label in tumbling windows.

    The same expression serves a stream, given a watermark on ``ts``.
    """
    return events.groupBy(F.window(ts, width).alias("w"), *labels).agg(
        F.count("*").alias("n")
    ).select(
        F.col("w.start").alias("window_start"), *labels, "n",
        (F.col("n") / F.lit(float(seconds))).alias("rate_per_sec"),
    )


def unpivot_samples(df: DataFrame, ts: Column, metrics: dict[str, Column]) -> DataFrame:
    """Metric fact rows ``(ts, metric, value)`` from named columns."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
        for name, value in metrics.items()
    ])
    return df.select(ts.alias("ts"), F.explode(pairs).alias("m")).select("ts", "m.*").filter(
        F.col("value").isNotNull())


def serving_samples(
    log: DataFrame, pairs: DataFrame, reference_mean: float, width: str = "1 hour"
) -> DataFrame:
    """Serving and shadow gauges per time window, from the two logs."""
    def windowed(df: DataFrame, *aggs: Column) -> DataFrame:
        return df.groupBy(F.window("served_at", width).alias("w")).agg(*aggs)

    served = windowed(
        log, F.avg(F.col("predicted_label").cast("double")).alias("flagged"),
        F.avg("dropout_probability").alias("mean"))
    shadow = windowed(
        pairs, F.avg(F.col("agreed").cast("int").cast("double")).alias("agreement"),
        (F.avg(F.col("challenger_label").cast("double"))
         - F.avg(F.col("champion_label").cast("double"))).alias("delta"))
    at = F.col("w.start")
    return unpivot_samples(served, at, {
        "subscriber_flagged_rate": F.round("flagged", 4),
        "subscriber_probability_mean_shift": F.round(F.col("mean") - F.lit(reference_mean), 4),
    }).unionByName(unpivot_samples(shadow, at, {
        "subscriber_shadow_active": F.lit(1.0),
        "subscriber_shadow_agreement_rate": F.round("agreement", 4),
        "subscriber_shadow_flagged_rate_delta": F.round("delta", 4),
    }))


def _flag(name: str) -> Column:
    return F.col(name).cast("int")


def decision_samples(quality: DataFrame, ts: Column) -> DataFrame:
    """Gauges of a decision-quality row; an undefined one has no sample."""
    return unpivot_samples(quality, ts, {
        "subscriber_model_calibration_ece": F.col("expected_calibration_error"),
        "subscriber_model_cost_savings_available": F.col("savings"),
        "subscriber_model_offers_required": F.col("offers_required"),
        "subscriber_model_capacity_binding": _flag("binding"),
        "subscriber_model_capacity_shortfall": F.col("shortfall"),
        "subscriber_model_capacity_cost": F.col("cost_of_constraint"),
        "subscriber_model_fairness_passes": _flag("fairness_passes"),
        "subscriber_model_fairness_ratio_selection": F.col("selection_rate_ratio"),
        "subscriber_model_fairness_ratio_recall": F.col("recall_ratio"),
        "subscriber_model_fairness_ratio_roc_auc": F.col("roc_auc_ratio"),
    })


def pipeline_samples(report: DataFrame, ts: Column) -> DataFrame:
    """Gauges of a run report (:func:`run_report` with ``n_samples`` if known).

    A run that trained nothing has no ``promoted`` sample, an unavailable drift
    check no verdict.
    """
    n = F.col("n_samples") if "n_samples" in report.columns else F.lit(None)
    return unpivot_samples(report, ts, {
        "subscriber_pipeline_last_run_timestamp_seconds": epoch_seconds(ts),
        "subscriber_pipeline_needs_attention": _flag("needs_attention"),
        "subscriber_pipeline_promoted": _flag("promoted"),
        "subscriber_drift_verdict": F.when(
            F.col("available"), verdict_gauge(F.col("overall_verdict"))),
        "subscriber_drift_sample_size": F.when(F.col("available"), n),
    })


def psi_samples(features: DataFrame, ts: Column) -> DataFrame:
    """One gauge per drift feature."""
    return features.select(
        ts.alias("ts"), F.concat(F.lit("subscriber_drift_psi_"), F.col("feature")).alias("metric"),
        F.col("psi").alias("value"))


@dataclass(frozen=True)
class AlertRule:
    """``transform(metric) op threshold``, continuously for ``for_seconds``.

    ``guard`` names a metric that must equal 1 at the same time.
    """

    alert: str
    metric: str
    op: str
    threshold: float
    for_seconds: int = 0
    severity: str = "warning"
    transform: str = "value"
    guard: str | None = None


# Longest silence inside a run of a met condition.
MAX_GAP_SECONDS = 86_400

# The alert rules, with their thresholds and durations.
RULES = (
    AlertRule("ModelNotLoaded", "subscriber_model_loaded", "==", 0, 300, "critical"),
    AlertRule("FlaggedRateSpike", "subscriber_flagged_rate", ">", 0.5, 900),
    AlertRule("ScoreDistributionShift", "subscriber_probability_mean_shift", ">", 0.15, 1800,
              transform="abs"),
    AlertRule("SignificantDrift", "subscriber_drift_verdict", ">=", 2, 600),
    AlertRule("PipelineStale", "subscriber_pipeline_last_run_timestamp_seconds", ">", 129_600,
              transform="age"),
    AlertRule("FairnessDisparity", "subscriber_model_fairness_passes", "==", 0, 1800),
    AlertRule("PipelineNeedsAttention", "subscriber_pipeline_needs_attention", "==", 1, 3600,
              "info"),
    AlertRule("RetentionCapacityBinding", "subscriber_model_capacity_binding", "==", 1, 21_600,
              "info"),
    AlertRule("OutreachVolumeUnaffordable", "subscriber_model_offers_required", ">", 5000, 21_600,
              "info"),
    AlertRule("ShadowChallengerErroring", "subscriber_shadow_errors_total", ">", 0,
              transform="increase_15m"),
    AlertRule("ShadowLargeBehaviourChange", "subscriber_shadow_agreement_rate", "<", 0.7, 1800,
              "info", guard="subscriber_shadow_active"),
    AlertRule("ShadowOutreachVolumeShift", "subscriber_shadow_flagged_rate_delta", ">", 0.1, 1800,
              "info", transform="abs", guard="subscriber_shadow_active"),
)
METRICS = tuple(sorted({r.metric for r in RULES} | {r.guard for r in RULES if r.guard}))


def rule_table(spark: SparkSession, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    schema = pa.schema([
        ("alert", pa.string()), ("metric", pa.string()), ("op", pa.string()),
        ("threshold", pa.float64()), ("for_seconds", pa.int64()), ("severity", pa.string()),
        ("transform", pa.string()), ("guard", pa.string()),
    ])
    return small_table(spark, [vars(r) for r in rules], schema)


def increase(samples: DataFrame, seconds: int = 900) -> DataFrame:
    """Add ``increase``: growth against the earliest sample of the last ``seconds``.

    Each sample also visits the next time block as context, so windows run per
    (metric, block) and a long series is never sorted in one task.
    """
    at = epoch_seconds(F.col("ts"))
    block = F.floor(at / seconds)
    visits = samples.withColumn("_s", at).withColumn(
        "_visit", F.explode(F.array(
            F.struct(block.alias("block"), F.lit(True).alias("own")),
            F.struct((block + 1).alias("block"), F.lit(False).alias("own")))))
    recent = Window.partitionBy("metric", "_visit.block").orderBy("_s").rangeBetween(-seconds, 0)
    grown = clip(F.col("value") - F.first("value").over(recent), low=0.0)
    return visits.withColumn("increase", grown).filter("_visit.own").select(
        *samples.columns, "increase")


def rule_samples(
    samples: DataFrame, rules: Sequence[AlertRule] = RULES, now: Column | None = None
) -> DataFrame:
    """Every rule evaluated at every sample of its metric: ``(alert, ts, value, met)``.

    The rules are a fixed dozen rows.  Guards are joined on equal times.
    """
    spark = samples.sparkSession
    counters = sorted({r.metric for r in rules if r.transform == "increase_15m"})
    plain = samples.filter(~F.col("metric").isin(counters)).withColumn(
        "increase", F.lit(None).cast("double"))
    timed = plain.unionByName(increase(samples.filter(F.col("metric").isin(counters))))
    guards = samples.filter(F.col("value") == 1).select(
        F.col("metric").alias("guard"), F.col("ts"), F.lit(True).alias("guarded"))
    rows = timed.join(F.broadcast(rule_table(spark, rules)), "metric").join(
        guards, ["guard", "ts"], "left")
    at = epoch_seconds(F.col("ts") if now is None else now)
    value = (
        F.when(F.col("transform") == "abs", F.abs("value"))
        .when(F.col("transform") == "age", at - F.col("value"))
        .when(F.col("transform") == "increase_15m", F.col("increase"))
        .otherwise(F.col("value"))
    )
    limit = F.col("threshold")
    holds = (
        F.when(F.col("op") == ">", value > limit).when(F.col("op") == ">=", value >= limit)
        .when(F.col("op") == "<", value < limit).otherwise(value == limit)
    )
    open_guard = F.col("guard").isNull() | F.coalesce("guarded", F.lit(False))
    return rows.select(
        "alert", "severity", "for_seconds", "ts", value.alias("value"),
        (holds & open_guard).alias("met"))


def alert_episodes(evaluated: DataFrame, max_gap_seconds: int = MAX_GAP_SECONDS) -> DataFrame:
    """Unbroken runs of a met condition, per alert (gaps and islands).

    A stretch without samples longer than ``max_gap_seconds`` ends a run: silence is not
    a condition that holds.  Two levels: runs inside each day, then runs that touch across
    days.  A long series is sorted day by day, and only its runs meet in one window.
    """
    keys = ("alert", "severity", "for_seconds")

    def numbered(rows: DataFrame, window, first: str, last: str) -> DataFrame:
        silence = epoch_seconds(F.col(first)) - epoch_seconds(F.lag(last).over(window))
        change = F.coalesce(
            (F.lag("met").over(window) != F.col("met")) | (silence > max_gap_seconds), F.lit(True))
        return rows.withColumn("_change", change.cast("int")).withColumn(
            "_run", F.sum("_change").over(window))

    day = F.col("ts").cast("date")
    in_day = Window.partitionBy("alert", "_day").orderBy("ts")
    runs = numbered(evaluated.withColumn("_day", day), in_day, "ts", "ts").groupBy(
        *keys, "_day", "_run", "met"
    ).agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("n"))
    across = Window.partitionBy("alert").orderBy("started")
    merged = numbered(runs.drop("_run"), across, "started", "ended").filter("met").groupBy(
        *keys, "_run"
    ).agg(
        F.min("started").alias("started"), F.max("ended").alias("ended"),
        F.sum("n").alias("n_samples"))
    held = epoch_seconds(F.col("ended")) - epoch_seconds(F.col("started"))
    return merged.withColumn("held_seconds", held.cast("bigint")).withColumn(
        "fired", F.col("held_seconds") >= F.col("for_seconds")).drop("_run")


def alert_state(evaluated: DataFrame) -> DataFrame:
    """State at the newest sample of each alert: inactive, pending or firing."""
    last = evaluated.groupBy("alert").agg(F.max("ts").alias("last_ts"))
    open_runs = alert_episodes(evaluated).join(last, "alert").filter(
        F.col("ended") == F.col("last_ts"))
    return last.join(
        open_runs.select("alert", "severity", "started", "held_seconds", "fired"), "alert", "left"
    ).select(
        "alert", "last_ts",
        F.when(F.col("fired").isNull(), "inactive").when(F.col("fired"), "firing")
        .otherwise("pending").alias("state"),
        "started", F.coalesce("held_seconds", F.lit(0)).alias("held_seconds"),
    )


def run_report(training: DataFrame, drift: DataFrame) -> DataFrame:
    """Whether the last run needs attention, and why.

    One row each in, one row out.  ``training`` has ``promoted``,
    ``promotion_reason``, ``fairness_passes``, ``fairness_concerns``; ``drift``
    has ``available``, ``overall_verdict`` and ``drifted_features``.
    """
    # Merged as a union of one-row frames: no join without a key.
    both = training.unionByName(drift, allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    why = F.coalesce(F.get("fairness_concerns", F.lit(0)), F.lit("disparity detected"))
    attention = reasons(
        (F.col("promoted") == F.lit(False),
         F.concat(F.lit("challenger rejected: "), F.col("promotion_reason"))),
        (F.col("available") & (F.col("overall_verdict") == "significant"),
         F.concat(F.lit("significant drift in "), F.array_join("drifted_features", ", "))),
        (F.col("fairness_passes") == F.lit(False), F.concat(F.lit("fairness: "), why)),
    )
    return row.withColumn("attention_reasons", attention).withColumn(
        "needs_attention", F.size("attention_reasons") > 0)


def verdict_gauge(verdict: Column) -> Column:
    """0, 1 or 2 for a verdict text; NULL when there is none."""
    pairs = [F.lit(x) for item in VERDICT_CODES.items() for x in item]
    return F.create_map(*pairs)[verdict]


def run_history(
    versions: DataFrame, aliases: DataFrame, metrics: DataFrame, limit: int = 20
) -> DataFrame:
    """Newest versions with their aliases and their ``test_`` metrics as a map."""
    names = aliases.groupBy("version").agg(
        F.array_sort(F.collect_list("alias")).alias("aliases"))
    values = metrics.filter(F.col("metric").startswith("test_")).groupBy("version").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))
        .alias("metrics"))
    return (
        versions.join(names, "version", "left").join(values, "version", "left")
        .withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
        .orderBy(F.col("version").desc()).limit(limit)
    )
