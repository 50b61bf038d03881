"""Champion against challenger on the same requests, and the prediction log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import risk
from ebbtide.functions.columns import count_if
from ebbtide.functions.linear import LinearModel
from ebbtide.params import (
    DECISION_THRESHOLD, PREDICTION_WINDOW, SHADOW_MIN_COMPARISONS, SHADOW_WINDOW,
)


def last_rows(log: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` rows: a distributed top-n, never a sort of the whole log."""
    return log.orderBy(F.col("served_at").desc(), F.col("request_id").desc()).limit(n)


def prediction_log(
    requests: DataFrame, model: LinearModel, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Serve every request: probability (four decimals), label and band."""
    scored = model.score(requests, "raw_probability")
    p = F.col("raw_probability")
    return scored.select(
        "request_id", "served_at", "raw_probability",
        F.round(p, 4).alias("dropout_probability"),
        risk.label(p, threshold).alias("predicted_label"),
        risk.band(p, threshold).alias("risk_level"),
    )


def log_summary(log: DataFrame, window: int = PREDICTION_WINDOW) -> DataFrame:
    """Summary of the newest predictions; zeros, not NULLs, when there are none.

    The percentiles are exact: the window bounds what they have to hold.
    """
    p = F.col("dropout_probability")
    total = log.agg(F.count("*").alias("served_total"))
    recent = last_rows(log, window).agg(
        F.count("*").alias("window_size"),
        F.avg(F.col("predicted_label").cast("double")).alias("flagged_rate"),
        F.avg(p).alias("mean"), F.percentile(p, 0.5).alias("p50"),
        F.percentile(p, 0.9).alias("p90"), F.min(p).alias("min"), F.max(p).alias("max"),
        *[count_if(F.col("risk_level") == b).alias(f"n_{b}") for b in ("low", "medium", "high")],
    )
    # One row each, merged without a join.
    merged = total.unionByName(recent, allowMissingColumns=True)
    rates = ("flagged_rate", "mean", "p50", "p90", "min", "max")
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns]).select(
        "served_total", "window_size", F.lit(window).cast("bigint").alias("window_capacity"),
        *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 4).alias(c) for c in rates],
        "n_low", "n_medium", "n_high",
    )


def mean_shift(summary: DataFrame, reference_mean: float | None) -> DataFrame:
    """Rounded live mean minus rounded reference mean; NULL without either."""
    reference = F.lit(reference_mean).cast("double")
    return summary.select(
        "window_size", F.col("mean").alias("live_mean"),
        F.round(reference, 4).alias("reference_mean"),
        F.when(F.col("window_size") > 0, F.round(F.col("mean") - F.round(reference, 4), 4))
        .alias("probability_mean_shift"),
    )


def shadow_pairs(
    requests: DataFrame, champion: LinearModel, challenger: LinearModel,
    champion_threshold: float = DECISION_THRESHOLD,
    challenger_threshold: float = DECISION_THRESHOLD, sample_rate: float = 1.0,
) -> DataFrame:
    """Score each request with both models in one pass.

    Sampling is by a hash of the request id, so a re-run picks the same rows.
    """
    if sample_rate < 1.0:
        draw = F.pmod(F.xxhash64("request_id"), F.lit(1_000_000)) / 1_000_000.0
        requests = requests.filter(draw < sample_rate)
    both = requests.withColumns({
        "champion_probability": champion.probability(),
        "challenger_probability": challenger.probability(),
    })
    a, b = F.col("champion_probability"), F.col("challenger_probability")
    return both.select(
        "request_id", "served_at", a, b,
        risk.label(a, champion_threshold).alias("champion_label"),
        risk.label(b, challenger_threshold).alias("challenger_label"),
    ).withColumns({
        "agreed": F.col("champion_label") == F.col("challenger_label"),
        "divergence": F.abs(a - b),
    })


def shadow_summary(pairs: DataFrame, window: int = SHADOW_WINDOW) -> DataFrame:
    """Agreement and divergence over the newest pairs; rates are NULL without any."""
    def rate(column: Column) -> Column:
        return F.avg(column.cast("double"))

    total = pairs.agg(F.count("*").alias("compared_total"))
    a, b = F.col("champion_label"), F.col("challenger_label")
    recent = last_rows(pairs, window).agg(
        F.count("*").alias("window_size"),
        rate(F.col("agreed").cast("int")).alias("agreement_rate"),
        F.avg("divergence").alias("mean_absolute_divergence"),
        F.max("divergence").alias("max_absolute_divergence"),
        rate(a).alias("champion_flagged_rate"), rate(b).alias("challenger_flagged_rate"),
        count_if((b == 1) & (a == 0)).alias("challenger_flags_more"),
        count_if((b == 0) & (a == 1)).alias("challenger_flags_fewer"),
    )
    merged = total.unionByName(recent, allowMissingColumns=True)
    delta = F.col("challenger_flagged_rate") - F.col("champion_flagged_rate")
    rates = ("agreement_rate", "mean_absolute_divergence", "max_absolute_divergence",
             "champion_flagged_rate", "challenger_flagged_rate")
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns]).select(
        "compared_total", "window_size", F.lit(window).cast("bigint").alias("window_capacity"),
        *[F.round(c, 4).alias(c) for c in rates],
        F.round(delta, 4).alias("flagged_rate_delta"),
        "challenger_flags_more", "challenger_flags_fewer",
    )


def readiness(summary: DataFrame, required: int = SHADOW_MIN_COMPARISONS) -> DataFrame:
    """Whether enough pairs exist to conclude anything."""
    return summary.select(
        (F.col("compared_total") >= required).alias("sufficient_evidence"), "compared_total",
        F.lit(required).cast("bigint").alias("required"),
    )
