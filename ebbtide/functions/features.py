"""Model inputs and derived behavioural features, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.columns import finite
from ebbtide.params import DAYS_PER_MONTH, RISK_AT


def require(df: DataFrame, columns: tuple[str, ...]) -> None:
    """Fail on missing columns; looks at metadata only."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def model_inputs(df: DataFrame, *carry: str) -> DataFrame:
    """The nine inputs in their fixed order, after any carried columns."""
    require(df, schemas.MODEL_INPUTS)
    return df.select(*carry, *schemas.MODEL_INPUTS)


def features_and_target(df: DataFrame) -> DataFrame:
    """Drop the identifiers and turn the target into 0/1."""
    return df.drop("subscriber_id", "cutoff").withColumn(
        schemas.TARGET, F.col(schemas.TARGET).cast("int")
    )


def finite_inputs(df: DataFrame) -> DataFrame:
    """Numeric inputs as doubles with NaN and infinities swept to NULL."""
    return df.withColumns({c: finite(F.col(c)) for c in schemas.RAW_NUMERIC})


def derived_columns(dormant_after: int = RISK_AT["last_activity_days_ago"]) -> dict[str, Column]:
    """Derived features by name.  Denominators are offset, so none can be zero."""
    tenure = F.col("tenure_days").cast("double")
    sessions = F.col("avg_session_count_last_30d")
    recency = F.col("last_activity_days_ago").cast("double")
    tickets = F.col("support_tickets_last_90d")
    failures = F.col("payment_failures_last_6m")
    return {
        "tenure_months": tenure / DAYS_PER_MONTH,
        "sessions_per_day_last_30d": sessions / 30.0,
        "recency_ratio": recency / (tenure + 1.0),
        "engagement_recency_score": sessions / (recency + 1.0),
        "fee_per_session": F.col("monthly_fee") / (sessions + 1.0),
        "support_tickets_per_month": tickets / 3.0,
        "payment_failures_per_month": failures / 6.0,
        "discount_dependency": F.col("discounts_used_last_6m") / 6.0,
        "friction_score": (tickets + failures).cast("double"),
        "is_dormant": (recency > dormant_after).cast("int"),
    }


def add_derived(df: DataFrame) -> DataFrame:
    """All derived features, with the auto-renew flag as 0/1."""
    require(df, schemas.MODEL_INPUTS)
    return df.withColumns(
        {**derived_columns(), "is_auto_renew_enabled": F.col("is_auto_renew_enabled").cast("int")}
    )


def plan_dummies() -> dict[str, Column]:
    """One 0/1 column per known plan; an unknown plan is all zeros."""
    return {
        f"plan_type_{plan}": F.coalesce((F.col("plan_type") == plan).cast("int"), F.lit(0))
        for plan in schemas.PLAN_TYPES
    }
