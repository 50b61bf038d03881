"""Analyst queries over the five tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import count_if, midnight
from ebbtide.sources.canonical import Warehouse


def plan_mix(wh: Warehouse) -> DataFrame:
    return wh.subscription_events.groupBy("plan_type").agg(
        F.count("*").alias("events"),
        F.round(F.avg("monthly_fee"), 2).alias("avg_monthly_fee"),
        count_if(F.col("is_auto_renew_enabled")).alias("with_auto_renew"),
    ).orderBy(F.desc("events"), "plan_type")


def lifecycle_counts(wh: Warehouse) -> DataFrame:
    return wh.subscription_events.groupBy("event_type").agg(
        F.count("*").alias("occurrences")).orderBy(F.desc("occurrences"), "event_type")


def top_channels(wh: Warehouse, limit: int = 10) -> DataFrame:
    return wh.subscribers.groupBy("acquisition_channel").agg(
        F.count("*").alias("subscribers")
    ).orderBy(F.desc("subscribers"), "acquisition_channel").limit(limit)


def cancellations_per_month(wh: Warehouse, since: date | str) -> DataFrame:
    month = F.date_trunc("month", F.col("occurred_at")).cast("date")
    return wh.subscription_events.filter(
        (F.col("event_type") == "cancellation") & (F.col("occurred_at") >= midnight(since))
    ).groupBy(month.alias("month")).agg(F.count("*").alias("cancellations")).orderBy("month")


def history(wh: Warehouse) -> DataFrame:
    """Everything known about everybody: events, payments and sessions."""
    def part(kind: str, df: DataFrame, detail, amount) -> DataFrame:
        return df.select("subscriber_id", F.lit(kind).alias("record_type"), "occurred_at",
                         detail.alias("detail"), amount.alias("amount"))

    return (
        part("event", wh.subscription_events, F.col("event_type"), F.round("monthly_fee", 2))
        .unionByName(part("payment", wh.payments, F.col("status"), F.round("amount", 2)))
        .unionByName(part("session", wh.sessions, F.lit("listened"),
                          F.round("duration_minutes", 1)))
    )


def subscriber_history(wh: Warehouse, subscriber_id: str, limit: int | None = 40) -> DataFrame:
    """One subscriber's records in time order; the filter reaches all three scans."""
    rows = history(wh).filter(F.col("subscriber_id") == subscriber_id).orderBy(
        "occurred_at", "record_type", "detail", "amount")
    return rows.limit(limit) if limit else rows


def subscriber_sessions(wh: Warehouse, subscriber_id: str) -> DataFrame:
    """Point lookup in time order."""
    return wh.sessions.filter(F.col("subscriber_id") == subscriber_id).select(
        "occurred_at", "duration_minutes").orderBy("occurred_at", "duration_minutes")


def subscribers_head(wh: Warehouse, limit: int = 10) -> DataFrame:
    return wh.subscribers.orderBy("subscriber_id").limit(limit)


def event_log_head(wh: Warehouse, limit: int = 15) -> DataFrame:
    return wh.subscription_events.orderBy("occurred_at", "event_id").limit(limit).select(
        "subscriber_id", "event_type", "plan_type", F.round("monthly_fee", 2).alias("monthly_fee"),
        "is_auto_renew_enabled", "occurred_at",
    )


def arrivals(wh: Warehouse, start: date | str, end: date | str) -> DataFrame:
    """Rows per event table that arrived in ``[start, end)``."""
    inside = (F.col("occurred_at") >= midnight(start)) & (F.col("occurred_at") < midnight(end))
    parts = [
        df.filter(inside).agg(F.count("*").alias("arrived")).select(
            F.lit(name).alias("table_name"), "arrived")
        for name, df in wh.tables().items()
        if name in ("subscription_events", "payments", "sessions")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def cleaning_log(
    wh: Warehouse, raw_logs: DataFrame, raw_transactions: DataFrame, since: str
) -> DataFrame:
    """What cleaning found, as measured counts with a reason each.

    ``raw_logs`` and ``raw_transactions`` are as delivered; sessions are kept from ``since`` on.
    """
    known = wh.subscribers.select("subscriber_id").distinct()
    lost = wh.subscription_events.groupBy("subscriber_id").agg(F.count("*").alias("n")).join(
        known, "subscriber_id", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("amount"))
    longest = wh.subscribers.agg(
        F.coalesce(F.max(F.length("subscriber_id")), F.lit(0)).cast("bigint").alias("amount"))
    day = F.date_format(F.lit(since).cast("date"), "yyyyMMdd")
    # Both counts of the logs come from one scan.
    logs = raw_logs.agg(
        count_if(F.col("total_secs") < 0).alias("clipped"),
        count_if(F.col("date").cast("string") < day).alias("early"),
    )
    priced = raw_transactions.agg(count_if(~F.col("payment_plan_days").between(28, 31)).alias("amount"))
    # The steps and why they mattered.
    steps = (
        ("Orphan rows removed", lost, "they would vanish silently from every query"),
        ("Longest subscriber id", longest, "the id column must hold it without truncation"),
        ("Prices normalised", priced, "a plan of many months is not comparable to one of a month"),
    )
    of_logs = (
        ("Negative durations clipped", "clipped",
         "dropping the rows would understate activity, which reads as churn risk"),
        ("Session window bounded", "early", "older rows are beyond any feature window"),
    )

    def entry(step: str, amount: Column, why: str) -> Column:
        text = F.concat(F.lit(step), F.lit(": "), amount.cast("string"), F.lit(" - "), F.lit(why))
        return F.struct(F.lit(step).alias("cleaning_step"), amount.alias("amount"),
                        text.alias("why_it_mattered"))

    out = logs.select(F.explode(F.array(*[entry(s, F.col(c), w) for s, c, w in of_logs])).alias("e"))
    for step, df, why in steps:
        out = out.unionAll(df.select(entry(step, F.col("amount"), why).alias("e")))
    return out.select("e.*")
