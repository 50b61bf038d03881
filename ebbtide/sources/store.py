"""A stored warehouse for point-in-time work: daily facts, co-partitioned by subscriber.

Feature windows begin and end at midnight, so a day is the finest part of a table that any
window can cut off.  The store keeps one row of counts per subscriber and day, and of the
lifecycle the day's last row and its first cancellation.  A subscriber who holds a third of all
events is a row per day here, so hashing by subscriber gives even buckets.

All tables are hashed into the same number of buckets, so the aggregates and joins of a
snapshot or panel read them without an exchange.  New days are appended and read alone
(:func:`append`): what is stored is never read again to add to it.  Rows that arrive for days
before the stored edge are not seen.

Whole records for point look-ups lie in files sorted by subscriber and time
(:func:`write_history`): ranges, not buckets, so a busy subscriber spreads over files, and the
smallest and largest values of a file leave the others unread.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.columns import as_date, midnight
from ebbtide.session import shared_dir
from ebbtide.sources.canonical import Warehouse

ID = "subscriber_id"
PARTS = ("subscribers", "lifecycle", "activity")


def measures(wh: Warehouse) -> DataFrame:
    """Sessions, payments and tickets as rows of counts, from one table if the warehouse has it."""
    if wh.activity is not None:
        return wh.activity
    count = lambda c: c.cast("int").cast("bigint")
    none = F.lit(0).cast("bigint")

    def part(table: DataFrame, **given) -> DataFrame:
        return table.select(
            ID, "occurred_at", given.get("seen", F.lit(None).cast("timestamp_ntz")).alias("seen"),
            *[given.get(c, none).alias(c) for c in ("sessions", "failures", "discounts", "tickets")])

    return (
        part(wh.sessions, seen=F.col("occurred_at"), sessions=count(F.lit(1)))
        .unionByName(part(wh.payments, failures=count(F.col("status") == "failed"), discounts=count(F.col("discount_applied"))))
        .unionByName(part(wh.support_tickets, tickets=count(F.lit(1))))
    )


def _by_day(rows: DataFrame, tasks: int | None) -> DataFrame:
    """Rows with their ``day``, dealt by subscriber and day to so many tasks: each keeps its own in memory."""
    rows = rows.withColumn("day", F.col("occurred_at").cast("date"))
    return rows if tasks is None else rows.repartition(tasks, ID, "day")


def daily_activity(
    wh: Warehouse, since: date | None = None, until: date | None = None, tasks: int | None = None,
) -> DataFrame:
    """Counts per subscriber and day; ``seen`` is the day's last session."""
    counts = ("sessions", "failures", "discounts", "tickets")
    return _by_day(_between(measures(wh), since, until), tasks).groupBy(ID, "day").agg(
        F.max("seen").alias("seen"), *[F.sum(c).alias(c) for c in counts],
    ).select(ID, F.col("day").cast("timestamp_ntz").alias("occurred_at"), "seen", *counts)


def daily_lifecycle(
    wh: Warehouse, since: date | None = None, until: date | None = None, tasks: int | None = None,
) -> DataFrame:
    """The day's last lifecycle row of every subscriber, and its first cancellation if that is another."""
    columns = schemas.TABLES["subscription_events"].names
    row = F.struct("occurred_at", "event_id", *[c for c in columns if c not in ("occurred_at", "event_id", ID)])
    cancelled = F.col("event_type") == "cancellation"
    days = _by_day(_between(wh.subscription_events, since, until), tasks).groupBy(ID, "day").agg(
        F.max(row).alias("last"), F.min(F.when(cancelled, row)).alias("gone"))
    both = F.array_distinct(F.filter(F.array("last", "gone"), lambda r: r.isNotNull()))
    return days.select(ID, F.explode(both).alias("r")).select(*[ID if c == ID else F.col(f"r.{c}").alias(c) for c in columns])


def _between(rows: DataFrame, since: date | None, until: date | None) -> DataFrame:
    if since is not None:
        rows = rows.filter(F.col("occurred_at") >= midnight(since))
    return rows if until is None else rows.filter(F.col("occurred_at") < midnight(until))


@dataclass(frozen=True)
class Store:
    """Names of the stored tables in the session's catalog, and the days they hold: those before ``edge``."""

    name: str
    path: str
    buckets: int
    edge: date | None

    def warehouse(self, spark: SparkSession) -> Warehouse:
        """The stored facts as a warehouse; raw sessions, payments and tickets are not kept."""
        people, lifecycle, activity = (spark.table(f"{self.name}_{p}") for p in PARTS)
        empty = [spark.createDataFrame([], schemas.TABLES[t]) for t in ("sessions", "payments", "support_tickets")]
        return Warehouse(people, lifecycle, *empty, activity)


def _write(df: DataFrame, store: Store, part: str, mode: str) -> None:
    order = [c for c in (ID, "occurred_at") if c in df.columns]
    # The same hash deals rows to tasks and to buckets: a bucket is one file per load.
    (df.repartition(store.buckets, ID).write.mode(mode).format("parquet").option("path", f"{store.path}/{part}")
     .bucketBy(store.buckets, ID).sortBy(*order).saveAsTable(f"{store.name}_{part}"))


def _load(wh: Warehouse, store: Store, since: date | None, mode: str) -> None:
    people = wh.subscribers
    if since is not None:
        people = people.filter(F.col("signup_date") >= F.lit(since))
    if store.edge is not None:
        people = people.filter(F.col("signup_date") < F.lit(store.edge))
    _write(people, store, "subscribers", mode)
    _write(daily_lifecycle(wh, since, store.edge, store.buckets), store, "lifecycle", mode)
    _write(daily_activity(wh, since, store.edge, store.buckets), store, "activity", mode)


def write(wh: Warehouse, until: date | str | None = None, buckets: int | None = None, path: str | None = None) -> Store:
    """Store all days before ``until`` (all there are without it)."""
    spark = wh.subscribers.sparkSession
    name = f"store_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = Store(name, path or f"{shared_dir(spark).rstrip('/')}/{name}", buckets, None if until is None else as_date(until))
    _load(wh, store, None, "overwrite")
    return store


def append(wh: Warehouse, store: Store, until: date | str | None = None) -> Store:
    """Add the days from the stored edge on, up to ``until``; only those are read."""
    if store.edge is None:
        raise ValueError("the store already holds all days")
    if until is not None and as_date(until) <= store.edge:
        return store
    grown = Store(store.name, store.path, store.buckets, None if until is None else as_date(until))
    _load(wh, grown, store.edge, "append")
    return grown


def drop(spark: SparkSession, store: Store) -> None:
    """Forget the tables and delete their files."""
    for part in PARTS:
        spark.sql(f"DROP TABLE IF EXISTS {store.name}_{part}")
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(store.path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


# Records by subscriber -----------------------------------------------------------------

def write_history(records: DataFrame, path: str) -> str:
    """Records in files of neighbouring subscribers and times."""
    records.repartitionByRange(F.col(ID), F.col("occurred_at")).sortWithinPartitions(ID, "occurred_at").write.parquet(path)
    return path


def read_history(spark: SparkSession, path: str, subscriber: str, schema=None) -> DataFrame:
    """One subscriber's records in time order; files that cannot hold them are not read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).filter(F.col(ID) == subscriber).orderBy("occurred_at", "record_type", "detail", "amount")
