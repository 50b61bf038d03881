"""Concept-level attributions of a linear score, within one row (no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import two_decimals
from ebbtide.functions.linear import LinearModel
from ebbtide.params import RISK_AT

# Which model column belongs to which business concept.
CONCEPTS: dict[str, tuple[str, ...]] = {
    "recency": ("last_activity_days_ago", "recency_ratio", "is_dormant"),
    "engagement": ("avg_session_count_last_30d", "sessions_per_day_last_30d",
                   "engagement_recency_score"),
    "tenure": ("tenure_days", "tenure_months"),
    "payments": ("payment_failures_last_6m", "payment_failures_per_month"),
    "support": ("support_tickets_last_90d", "support_tickets_per_month"),
    "friction": ("friction_score",),
    "discounts": ("discounts_used_last_6m", "discount_dependency"),
    "price": ("monthly_fee", "fee_per_session"),
    "auto_renew": ("is_auto_renew_enabled",),
    "plan": ("plan_type_basic", "plan_type_standard", "plan_type_premium"),
}
OTHER = "other"


def concept_of(column: str) -> str:
    return next((c for c, members in CONCEPTS.items() if column in members), OTHER)


def grouped(model: LinearModel) -> dict[str, Column]:
    """Per concept: ``struct(total, dominant)``, in order of first appearance.

    The dominant column has the largest absolute contribution; the first one
    wins a tie.
    """
    members: dict[str, list[tuple[str, Column]]] = {}
    for term in model.terms:
        members.setdefault(concept_of(term[0]), []).append((term[0], model.contribution(*term)))
    out: dict[str, Column] = {}
    for concept, parts in members.items():
        total = parts[0][1]
        for _, part in parts[1:]:
            total = total + part
        ranked = F.array(*[
            F.struct(F.abs(part).alias("size"), F.lit(-i).alias("rank"), F.lit(name).alias("name"))
            for i, (name, part) in enumerate(parts)
        ])
        out[concept] = F.struct(total.alias("total"), F.array_max(ranked)["name"].alias("dominant"))
    return out


def _n(column: str) -> Column:
    return F.col(column).cast("string")


def phrase(
    dominant: Column, raises: Column, dormant_after: int = RISK_AT["last_activity_days_ago"]
) -> Column:
    """Describe the dominant column in the subscriber's own numbers."""
    # The two wordings per column (raises risk, lowers risk).
    days, tenure = _n("last_activity_days_ago"), _n("tenure_days")
    sessions = F.col("avg_session_count_last_30d")
    friction = (F.col("support_tickets_last_90d") + F.col("payment_failures_last_6m"))
    per_session = two_decimals(F.col("monthly_fee") / (sessions + 1.0))
    fee = two_decimals(F.col("monthly_fee"))
    low = F.format_string("low recent activity (%.1f sessions/30d)", sessions)
    steady = F.format_string("steady recent activity (%.1f sessions/30d)", sessions)
    new = F.concat(F.lit("only "), tenure, F.lit(" days since signup"))
    settled = F.concat(tenure, F.lit(" days of tenure"))
    failing = F.concat(_n("payment_failures_last_6m"),
                       F.lit(" payment failures in the last 6 months"))
    paying = F.lit("no recent payment trouble")
    calling = F.concat(_n("support_tickets_last_90d"),
                       F.lit(" support tickets in the last 90 days"))
    quiet = F.lit("little contact with support")
    relying = F.concat(F.lit("relies on discounts ("), _n("discounts_used_last_6m"),
                       F.lit(" in the last 6 months)"))
    using = F.concat(_n("discounts_used_last_6m"), F.lit(" discounts used in the last 6 months"))
    wording: dict[str, tuple[Column, Column]] = {
        "last_activity_days_ago": (
            F.concat(F.lit("inactive for "), days, F.lit(" days")),
            F.concat(F.lit("last seen "), days, F.lit(" days ago"))),
        "recency_ratio": (
            F.concat(F.lit("a "), days, F.lit("-day gap is long for a "), tenure,
                     F.lit("-day-old account")),
            F.concat(F.lit("a "), days, F.lit("-day gap is short against "), tenure,
                     F.lit(" days of tenure"))),
        "avg_session_count_last_30d": (low, steady),
        "sessions_per_day_last_30d": (low, steady),
        "engagement_recency_score": (
            F.lit("little activity for how long they have been away"),
            F.lit("active and recently seen")),
        "tenure_days": (new, settled),
        "tenure_months": (new, settled),
        "payment_failures_last_6m": (failing, paying),
        "payment_failures_per_month": (failing, paying),
        "support_tickets_last_90d": (calling, quiet),
        "support_tickets_per_month": (calling, quiet),
        "friction_score": (
            F.concat(F.lit("combined support and billing friction ("),
                     friction.cast("string"), F.lit(" events)")),
            F.lit("few support or billing problems")),
        "discounts_used_last_6m": (relying, using),
        "discount_dependency": (relying, using),
        "monthly_fee": (F.concat(F.lit("high monthly fee ("), fee, F.lit(")")),
                        F.concat(F.lit("monthly fee of "), fee)),
        "fee_per_session": (
            F.concat(F.lit("poor value per session ("), per_session, F.lit(" per session)")),
            F.concat(F.lit("good value per session ("), per_session, F.lit(" per session)"))),
    }
    # Flags state the input's value whatever the direction.
    dormant = F.when(
        F.col("last_activity_days_ago") > dormant_after,
        F.concat(F.lit("dormant - no session in "), days, F.lit(" days")),
    ).otherwise(F.concat(F.lit("active within the last "), days, F.lit(" days")))
    renewing = F.when(
        F.col("is_auto_renew_enabled").cast("boolean"), "auto-renew enabled"
    ).otherwise("auto-renew disabled")
    text = F.when(dominant == "is_auto_renew_enabled", renewing).when(
        dominant == "is_dormant", dormant)
    for name, (up, down) in wording.items():
        text = text.when(dominant == name, F.when(raises, up).otherwise(down))
    return text.when(
        dominant.startswith("plan_type"),
        F.concat(F.lit("on the "), F.coalesce(F.col("plan_type"), F.lit("unknown")),
                 F.lit(" plan")),
    ).otherwise(F.replace(dominant, F.lit("_"), F.lit(" ")))


def with_attributions(df: DataFrame, model: LinearModel, limit: int = 3) -> DataFrame:
    """Add ``attributions``: the strongest concepts of each row by magnitude.

    A total of exactly zero takes its slot in the ranking but is not reported.
    """
    entries = F.array(*[
        F.struct(
            (-F.abs(entry["total"])).alias("weight"), F.lit(i).alias("rank"),
            F.lit(concept).alias("feature"), entry["total"].alias("contribution"),
            entry["dominant"].alias("dominant"),
        )
        for i, (concept, entry) in enumerate(grouped(model).items())
    ])
    def entry(item: Column) -> Column:
        raises = item["contribution"] > 0
        return F.struct(
            item["feature"].alias("feature"),
            item["contribution"].alias("contribution"),
            F.when(raises, "increases_risk").otherwise("decreases_risk").alias("direction"),
            phrase(item["dominant"], raises).alias("description"),
        )

    # The wording is one expression applied to each of the few entries; written
    # out per entry it would triple the generated code.
    top = F.slice(F.array_sort(entries), 1, limit)
    told = F.transform(F.filter(top, lambda x: x["contribution"] != 0.0), entry)
    return df.withColumn("attributions", told)
