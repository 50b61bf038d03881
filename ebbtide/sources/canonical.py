"""Adapter: the provided star-schema tables seen as the five warehouse tables.

The engine itself never refers to these source columns; only this module does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemas of the provided files: nothing is inferred, so building a query runs
# no job that reads footers.
SOURCES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


@dataclass(frozen=True)
class Warehouse:
    """The dimension and the four event tables.

    ``activity`` may hold sessions, payments and tickets as one table of counts, where a source
    has them on the same rows or sums them up: ``subscriber_id``, ``occurred_at``, ``seen`` (the
    last session), ``sessions``, ``failures``, ``discounts``, ``tickets``.
    """

    subscribers: DataFrame
    subscription_events: DataFrame
    sessions: DataFrame
    payments: DataFrame
    support_tickets: DataFrame
    activity: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {name: df for name, df in vars(self).items() if name != "activity"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer signs up on the day of the first order."""
    first = (
        read(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    return (
        read(spark, sf_dir, "customer")
        .join(first, "c_custkey")
        .select(
            F.col("c_custkey").cast("string").alias("subscriber_id"),
            F.col("first_order").cast("date").alias("signup_date"),
            F.lower("c_mktsegment").alias("acquisition_channel"),
        )
    )


def subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a lifecycle event.

    The first order per customer comes from an aggregate joined back on the
    order key, so a customer holding a large share of all orders never lands in
    one window partition.
    """
    orders = read(spark, sf_dir, "orders")
    first = orders.groupBy("o_custkey").agg(
        F.min(F.struct("o_orderdate", "o_orderkey")).alias("first")
    ).select(F.col("first.o_orderkey").alias("o_orderkey"), F.lit(True).alias("is_first"))
    priority = F.substring("o_orderpriority", 1, 1)
    return orders.join(first, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        F.when((F.col("o_orderstatus") == "F") & (priority == "1"), "cancellation")
        .when(F.col("is_first"), "signup")
        .otherwise("renewal").alias("event_type"),
        F.when(priority.isin("1", "2"), "premium").when(priority == "3", "standard")
        .otherwise("basic").alias("plan_type"),
        (F.col("o_totalprice") / 1000.0).alias("monthly_fee"),
        (F.col("o_orderstatus") == "O").alias("is_auto_renew_enabled"),
        F.col("o_orderdate").alias("occurred_at"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read(spark, sf_dir, "lineitem")
    # The orders of a task are hashed: its lines, many times as many, are not sorted.
    return lines.join(orders.hint("shuffle_hash"), lines.l_orderkey == orders.o_orderkey)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        F.col("l_shipdate").alias("occurred_at"),
        F.col("l_quantity").alias("duration_minutes"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        F.col("l_shipdate").alias("occurred_at"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("succeeded").alias("status"),
        (F.col("l_discount") >= 0.05).alias("discount_applied"),
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _lines(spark, sf_dir)
        .filter(F.col("l_returnflag") == "A")
        .select(
            F.col("o_custkey").cast("string").alias("subscriber_id"),
            F.col("l_shipdate").alias("occurred_at"),
            F.col("l_linestatus").alias("category"),
        )
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line is a session and a payment, and a ticket if it was returned: one join for all three."""
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("subscriber_id"),
        F.col("l_shipdate").alias("occurred_at"),
        F.col("l_shipdate").alias("seen"),
        F.lit(1).cast("bigint").alias("sessions"),
        (F.col("l_returnflag") == "R").cast("int").cast("bigint").alias("failures"),
        (F.col("l_discount") >= 0.05).cast("int").cast("bigint").alias("discounts"),
        (F.col("l_returnflag") == "A").cast("int").cast("bigint").alias("tickets"),
    )


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(
        subscribers(spark, sf_dir),
        subscription_events(spark, sf_dir),
        sessions(spark, sf_dir),
        payments(spark, sf_dir),
        support_tickets(spark, sf_dir),
        activity(spark, sf_dir),
    )
