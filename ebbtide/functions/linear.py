"""A closed-form scorer: a logistic of a weighted sum of model inputs.

Additive in log-odds, so contributions are exact: ``weight * (x - centre)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import clip

LOGIT_LIMIT = 30.0


def logistic(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


@dataclass(frozen=True)
class LinearModel:
    """``terms`` are (column, weight, centre), summed in the given order."""

    name: str
    intercept: float
    terms: tuple[tuple[str, float, float], ...]

    def contribution(self, column: str, weight: float, centre: float) -> Column:
        value = F.col(column).cast("double")
        return F.lit(weight) * (value - F.lit(centre) if centre else value)

    def logit(self) -> Column:
        total = F.lit(self.intercept)
        for term in self.terms:
            total = total + self.contribution(*term)
        return clip(total, -LOGIT_LIMIT, LOGIT_LIMIT)

    def probability(self) -> Column:
        return logistic(self.logit())

    def score(self, df: DataFrame, output: str = "y_proba") -> DataFrame:
        return df.withColumn(output, self.probability())


CHAMPION = LinearModel(
    "champion", -1.8,
    (
        ("last_activity_days_ago", 0.01, 0.0),
        ("avg_session_count_last_30d", -0.18, 0.0),
        ("is_auto_renew_enabled", -0.6, 0.0),
        ("payment_failures_last_6m", 0.4, 0.0),
        ("support_tickets_last_90d", 0.3, 0.0),
        ("discounts_used_last_6m", 0.1, 0.0),
        ("monthly_fee", 0.002, 250.0),
    ),
)
CHALLENGER = LinearModel(
    "challenger", -1.6,
    (
        ("last_activity_days_ago", 0.012, 0.0),
        ("avg_session_count_last_30d", -0.25, 0.0),
        ("is_auto_renew_enabled", -0.3, 0.0),
        ("payment_failures_last_6m", 0.25, 0.0),
        ("support_tickets_last_90d", 0.45, 0.0),
        ("discounts_used_last_6m", 0.15, 0.0),
        ("monthly_fee", 0.001, 250.0),
    ),
)
# Weights over transformed columns, used to explain scores by concept.
EXPLAINED = (
    ("last_activity_days_ago", 0.006),
    ("recency_ratio", 1.5),
    ("is_dormant", 0.35),
    ("avg_session_count_last_30d", -0.1),
    ("sessions_per_day_last_30d", -1.2),
    ("engagement_recency_score", -0.4),
    ("tenure_days", -0.0004),
    ("tenure_months", -0.008),
    ("payment_failures_last_6m", 0.3),
    ("payment_failures_per_month", 0.5),
    ("support_tickets_last_90d", 0.25),
    ("support_tickets_per_month", 0.4),
    ("friction_score", 0.15),
    ("discounts_used_last_6m", 0.12),
    ("discount_dependency", 0.3),
    ("monthly_fee", 0.002),
    ("fee_per_session", 0.003),
    ("is_auto_renew_enabled", -0.6),
    ("plan_type_basic", 0.1),
    ("plan_type_standard", -0.05),
    ("plan_type_premium", -0.2),
)


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Baseline of each column: one aggregate, one row to the driver."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return {c: float(row[c] or 0.0) for c in columns}


def centred(name: str, intercept: float, weights: Sequence[tuple[str, float]],
            means: dict[str, float]) -> LinearModel:
    """A model whose contributions are relative to the population means."""
    return LinearModel(name, intercept, tuple((c, w, means[c]) for c, w in weights))
