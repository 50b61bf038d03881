"""Labels, risk bands and rule-based explanations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.functions.columns import percent_text, reasons
from ebbtide.params import DECISION_THRESHOLD, HEALTHY_AT, HIGH_RISK_SPAN, RISK_AT


def label(probability: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return (probability >= threshold).cast("int")


def band(probability: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """``low`` exactly when the label is 0; the upper half above it is ``high``."""
    high = threshold + (1.0 - threshold) * HIGH_RISK_SPAN
    return (
        F.when(probability < threshold, "low").when(probability >= high, "high").otherwise("medium")
    )


def _text(column: str) -> Column:
    return F.col(column).cast("string")


# The wording of reasons, signals and openings.
def risk_factors(at: Mapping[str, float] = RISK_AT) -> Column:
    """Risk reasons that fired, in order of importance; ``at`` has the limits by input."""
    sessions = F.col("avg_session_count_last_30d")
    return reasons(
        (F.col("last_activity_days_ago") > at["last_activity_days_ago"],
         F.concat(F.lit("inactive for "), _text("last_activity_days_ago"), F.lit(" days"))),
        (sessions < at["avg_session_count_last_30d"],
         F.format_string("low recent activity (%.1f sessions/30d)", sessions)),
        (F.col("payment_failures_last_6m") >= at["payment_failures_last_6m"],
         F.concat(_text("payment_failures_last_6m"),
                  F.lit(" payment failures in the last 6 months"))),
        (F.col("support_tickets_last_90d") >= at["support_tickets_last_90d"],
         F.concat(_text("support_tickets_last_90d"),
                  F.lit(" support tickets in the last 90 days"))),
        (~F.col("is_auto_renew_enabled"), "auto-renew disabled"),
        (F.col("discounts_used_last_6m") >= at["discounts_used_last_6m"],
         F.concat(F.lit("relies on discounts ("), _text("discounts_used_last_6m"),
                  F.lit(" in the last 6 months)"))),
        (F.col("tenure_days") < at["tenure_days"],
         F.concat(F.lit("still new ("), _text("tenure_days"), F.lit(" days since signup)"))),
    )


def retention_signals(at: Mapping[str, float] = HEALTHY_AT) -> Column:
    """Signals that argue against dropout."""
    return reasons(
        (F.col("is_auto_renew_enabled"), "auto-renew enabled"),
        (F.col("avg_session_count_last_30d") >= at["avg_session_count_last_30d"],
         "strong recent engagement"),
        (F.col("last_activity_days_ago") <= at["last_activity_days_ago"], "active in the last few days"),
        (F.col("tenure_days") >= at["tenure_days"], "long-tenured subscriber"),
    )


def opening(risk_level: Column) -> Column:
    return (
        F.when(risk_level == "high", "High dropout risk")
        .when(risk_level == "medium", "Moderate dropout risk")
        .otherwise("Low dropout risk")
    )


def sentence(risk_level: Column, probability: Column, body: Column) -> Column:
    """``<opening> (<p as %>): <body>.``"""
    return F.concat(opening(risk_level), F.lit(" ("), percent_text(probability), F.lit("): "),
                    body, F.lit("."))


def rule_explanation(
    risk_level: Column, probability: Column, factors: Column, signals: Column
) -> Column:
    """Top three reasons, else the retention signals, else a default."""
    body = (
        F.when(F.size(factors) > 0, F.array_join(F.slice(factors, 1, 3), ", "))
        .when(F.size(signals) > 0, F.array_join(signals, ", "))
        .otherwise("no notable risk signals detected")
    )
    return sentence(risk_level, probability, body)
