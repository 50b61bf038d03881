"""Mapping of the raw subscription export onto the five warehouse tables.

Three CSV files: ``members``, ``transactions``, ``user_logs``.  Each table is
mapped by projections of one scan; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.columns import as_date, clip, ratio
from ebbtide.operators import contract
from ebbtide.params import DAYS_PER_MONTH
from ebbtide.session import cut
from ebbtide.sources.canonical import Warehouse

FILES = {
    "members.csv": schemas.RAW_MEMBERS,
    "transactions.csv": schemas.RAW_TRANSACTIONS,
    "user_logs.csv": schemas.RAW_USER_LOGS,
}
# Model columns this export cannot inform, and why.
DEAD_FEATURES = {
    "payment_failures_last_6m": "the export holds successful payments only",
    "payment_failures_per_month": "the export holds successful payments only",
    "support_tickets_last_90d": "there is no customer-service data",
    "support_tickets_per_month": "there is no customer-service data",
    "friction_score": "both of its parts are constant",
}


def raw_date(text: Column) -> Column:
    """yyyyMMdd to a date; NULL, not an error, when malformed."""
    return F.try_to_date(text.cast("string"), "yyyyMMdd")


def plan_tier(days: Column) -> Column:
    """Tier by plan length: up to 31 days, up to 180, longer."""
    return F.when(days <= 31, "basic").when(days <= 180, "standard").otherwise("premium")


def members_to_subscribers(members: DataFrame) -> DataFrame:
    return members.select(
        F.col("msno").alias("subscriber_id"),
        raw_date(F.col("registration_init_time")).alias("signup_date"),
        F.concat(F.lit("via_"), F.col("registered_via").cast("string"))
        .alias("acquisition_channel"),
    )


def transactions_with_ids(transactions: DataFrame) -> DataFrame:
    """Number the rows in file order (unique, gaps allowed).

    Numbered once and stored: events, payments and their joins all read the same ids.
    """
    return cut(transactions.withColumn("event_id", F.monotonically_increasing_id() + 1))


def flag_first(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Add ``is_first``: the first row per key.  ``order`` must be unique per key.

    The first row comes from a partially aggregated minimum and is joined back
    on the whole order key, so a hot key spreads over all partitions; a window
    would sort all its rows in one task.
    """
    first = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("f")).select(
        F.col(key).alias("_key"), *[F.col(f"f.{c}").alias(f"_{c}") for c in order],
        F.lit(True).alias("_first"),
    )
    match = F.col(key) == F.col("_key")
    for c in order:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    flagged = rows.join(first.hint("shuffle_hash"), match, "left")
    return flagged.select(*rows.columns, F.coalesce("_first", F.lit(False)).alias("is_first"))


def transactions_to_events(transactions: DataFrame) -> DataFrame:
    """One lifecycle event per transaction; the cancel flag wins over position."""
    day = raw_date(F.col("transaction_date"))
    # A row without a readable date sorts last.
    dated = transactions.withColumns({
        "_day": day, "_order": F.coalesce(day, F.lit(date(9999, 12, 31))),
    })
    rows = flag_first(dated, "msno", ["_order", "event_id"])
    return rows.select(
        "event_id",
        F.col("msno").alias("subscriber_id"),
        F.when(F.col("is_cancel") == 1, "cancellation")
        .when(F.col("is_first"), "signup").otherwise("renewal").alias("event_type"),
        plan_tier(F.col("payment_plan_days")).alias("plan_type"),
        (ratio(F.col("actual_amount_paid"), F.col("payment_plan_days")) * DAYS_PER_MONTH)
        .alias("monthly_fee"),
        (F.col("is_auto_renew") == 1).alias("is_auto_renew_enabled"),
        F.col("_day").cast("timestamp_ntz").alias("occurred_at"),
    )


def transactions_to_payments(transactions: DataFrame) -> DataFrame:
    """One payment per transaction.  A row exists only where money moved."""
    return transactions.select(
        F.col("event_id").alias("payment_id"),
        F.col("msno").alias("subscriber_id"),
        raw_date(F.col("transaction_date")).cast("timestamp_ntz").alias("occurred_at"),
        F.col("actual_amount_paid").cast("double").alias("amount"),
        F.lit("succeeded").alias("status"),
        (F.col("actual_amount_paid") < F.col("plan_list_price")).alias("discount_applied"),
    )


def logs_to_sessions(logs: DataFrame, since: date | str | None = None) -> DataFrame:
    """Minutes per log row; negative durations are clipped, never dropped."""
    rows = logs
    if since is not None:
        # Compared on the raw text too, so files partitioned by it are pruned.
        rows = rows.filter(F.col("date").cast("string") >= as_date(since).strftime("%Y%m%d"))
    return rows.select(
        (F.monotonically_increasing_id() + 1).alias("session_id"),
        F.col("msno").alias("subscriber_id"),
        raw_date(F.col("date")).cast("timestamp_ntz").alias("occurred_at"),
        (clip(F.col("total_secs"), low=0.0) / 60.0).alias("duration_minutes"),
    )


def empty_support_tickets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.SUPPORT_TICKETS)


def read_export(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three files under their schemas; all missing ones are named at once."""
    found, missing = {}, []
    for name, schema in FILES.items():
        try:
            found[name] = spark.read.schema(schema).csv(f"{folder}/{name}", header=True)
        except AnalysisException:
            missing.append(name)
    if missing:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(missing)}")
    return found


def build(
    members: DataFrame, transactions: DataFrame, logs: DataFrame,
    sessions_since: date | str | None = None, drop_orphans: bool = True,
) -> Warehouse:
    """All five tables; events run when they are validated or written.

    The members, which every other table meets, are mapped once and stored.
    """
    people = cut(members_to_subscribers(members))
    numbered = transactions_with_ids(transactions)
    tables = [
        transactions_to_events(numbered), logs_to_sessions(logs, sessions_since),
        transactions_to_payments(numbered),
    ]
    if drop_orphans:
        tables = [contract.drop_orphans(t, people) for t in tables]
    return Warehouse(people, *tables, empty_support_tickets(members.sparkSession))


def dry_run(wh: Warehouse) -> DataFrame:
    """Every contract check over the mapped tables; writes nothing."""
    return contract.validate_load(wh.tables())


def constant_columns(df: DataFrame, columns: Sequence[str] = schemas.RAW_NUMERIC) -> DataFrame:
    """Columns with at most one distinct value, from minimum and maximum."""
    pairs = [F.struct(F.lit(c).alias("feature"),
                      F.min(F.col(c).cast("double")).alias("lowest"),
                      F.max(F.col(c).cast("double")).alias("highest")) for c in columns]
    rows = df.agg(F.array(*pairs).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    return rows.withColumn(
        "constant", F.coalesce(F.col("lowest") == F.col("highest"), F.lit(True)))
