"""Fixed table schemas.  Nothing is ever inferred.

Event times are zone-less, so they are ``TIMESTAMP_NTZ``: results do not depend
on the session time zone and time predicates reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_I, _TS, _DATE = T.IntegerType(), T.TimestampNTZType(), T.DateType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


SUBSCRIBERS = _struct(subscriber_id=_S, signup_date=_DATE, acquisition_channel=_S)
SUBSCRIPTION_EVENTS = _struct(
    event_id=_L, subscriber_id=_S, event_type=_S, plan_type=_S, monthly_fee=_D,
    is_auto_renew_enabled=_B, occurred_at=_TS,
)
SESSIONS = _struct(session_id=_L, subscriber_id=_S, occurred_at=_TS, duration_minutes=_D)
PAYMENTS = _struct(
    payment_id=_L, subscriber_id=_S, occurred_at=_TS, amount=_D, status=_S, discount_applied=_B,
)
SUPPORT_TICKETS = _struct(ticket_id=_L, subscriber_id=_S, occurred_at=_TS, category=_S)

# Load order: the dimension first, then the four event tables.
TABLES: dict[str, T.StructType] = {
    "subscribers": SUBSCRIBERS,
    "subscription_events": SUBSCRIPTION_EVENTS,
    "sessions": SESSIONS,
    "payments": PAYMENTS,
    "support_tickets": SUPPORT_TICKETS,
}
KEYS = {
    "subscribers": "subscriber_id",
    "subscription_events": "event_id",
    "sessions": "session_id",
    "payments": "payment_id",
    "support_tickets": "ticket_id",
}
HOLDS = {
    "subscribers": "one row per subscriber",
    "subscription_events": "signups, renewals, plan changes and cancellations",
    "sessions": "one row per usage session",
    "payments": "one row per payment attempt",
    "support_tickets": "one row per support contact",
}

# Domains and identifier length.
EVENT_TYPES = ("signup", "renewal", "plan_change", "cancellation")
PAYMENT_STATUSES = ("succeeded", "failed")
PLAN_TYPES = ("basic", "standard", "premium")
ID_LENGTH = 64

# The model-input columns, in the order the model expects them.
RAW_NUMERIC = (
    "tenure_days",
    "monthly_fee",
    "avg_session_count_last_30d",
    "last_activity_days_ago",
    "support_tickets_last_90d",
    "payment_failures_last_6m",
    "discounts_used_last_6m",
)
CATEGORICAL = ("plan_type",)
RAW_BINARY = ("is_auto_renew_enabled",)
DERIVED_NUMERIC = (
    "tenure_months",
    "sessions_per_day_last_30d",
    "recency_ratio",
    "engagement_recency_score",
    "fee_per_session",
    "support_tickets_per_month",
    "payment_failures_per_month",
    "discount_dependency",
    "friction_score",
)
DERIVED_BINARY = ("is_dormant",)
NUMERIC = RAW_NUMERIC + DERIVED_NUMERIC
BINARY = RAW_BINARY + DERIVED_BINARY
MODEL_INPUTS = RAW_NUMERIC + CATEGORICAL + RAW_BINARY
DISCRETE = CATEGORICAL + RAW_BINARY
TARGET = "dropout"

MODEL_INPUT_SCHEMA = _struct(
    tenure_days=_I, monthly_fee=_D, avg_session_count_last_30d=_D, last_activity_days_ago=_I,
    support_tickets_last_90d=_I, payment_failures_last_6m=_I, discounts_used_last_6m=_I,
    plan_type=_S, is_auto_renew_enabled=_B,
)
FLAT_CSV = T.StructType(
    [T.StructField("subscriber_id", _S)]
    + [
        T.StructField(f.name, _S if f.name == "is_auto_renew_enabled" else f.dataType)
        for f in MODEL_INPUT_SCHEMA
    ]
    + [T.StructField(TARGET, _I)]
)

# Raw export files, as delivered (dates are yyyyMMdd numbers, read as text).
RAW_MEMBERS = _struct(
    msno=_S, city=_I, bd=_I, gender=_S, registered_via=_I, registration_init_time=_S,
)
RAW_TRANSACTIONS = _struct(
    msno=_S, payment_method_id=_I, payment_plan_days=_I, plan_list_price=_D,
    actual_amount_paid=_D, is_auto_renew=_I, transaction_date=_S, membership_expire_date=_S,
    is_cancel=_I,
)
RAW_USER_LOGS = _struct(
    msno=_S, date=_S, num_25=_I, num_50=_I, num_75=_I, num_985=_I, num_100=_I, num_unq=_I,
    total_secs=_D,
)

# Topic rows, the shape of Spark's Kafka source (and of the file source in tests).
MESSAGES = _struct(topic=_S, partition=_I, offset=_L, key=_S, value=T.BinaryType())
