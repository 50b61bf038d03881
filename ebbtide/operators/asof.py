"""Point-in-time snapshots and panels.

A feature may use only rows strictly before the cutoff; the label looks at
``[cutoff, cutoff + horizon)``.  All ranges are half-open.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.columns import (
    as_date, clip, count_if, elapsed_days, interval_index, midnight,
)
from ebbtide.params import CUTOFF_STEP_DAYS, MIN_HISTORY_SUBSCRIBERS, Windows
from ebbtide.session import cut, small_table
from ebbtide.sources.canonical import Warehouse

ID = "subscriber_id"
SNAPSHOT_COLUMNS = (
    ID, "cutoff", "tenure_days", "plan_type", "monthly_fee", "avg_session_count_last_30d",
    "last_activity_days_ago", "support_tickets_last_90d", "payment_failures_last_6m",
    "discounts_used_last_6m", "is_auto_renew_enabled", schemas.TARGET,
)
# A capped population of up to this many ids (64 characters each at most), as counted, is
# shipped to all executors; beyond it the semi joins shuffle.
BROADCAST_IDS = 200_000

_STATE = ("plan_type", "monthly_fee", "is_auto_renew_enabled")


def _later(days: Sequence[date]) -> Column:
    """The cutoffs after the signup day."""
    return F.slice(
        F.array(*[F.lit(d) for d in days]),
        interval_index(F.col("signup_date"), [F.lit(d) for d in days]) + 1, len(days))


def capped_populations(subscribers: DataFrame, days: Sequence[date], limit: int) -> DataFrame:
    """Per cutoff ``at`` the first ``limit`` subscribers by id that signed up before it; one scan.

    The first ``limit`` of a cutoff are among the first ``limit`` of each span between
    neighbouring cutoffs up to it.  So spans are cut down first, map-side, and only ``limit``
    rows of each fan out to the cutoffs after them.
    """
    step = interval_index(F.col("signup_date"), [F.lit(d) for d in days])
    known = subscribers.filter(F.col("signup_date") < F.lit(days[-1])).withColumn("_step", step)

    def first(rows: DataFrame, key: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(key).orderBy(ID))
        return rows.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")

    fanned = first(known, "_step").drop("_step").withColumn("at", F.explode(_later(days)))
    return first(fanned, "at")


def _capped(subscribers: DataFrame, days: Sequence[date], limit: int) -> tuple[DataFrame, DataFrame]:
    """The capped populations, stored, and their ids, broadcast if they are few."""
    base = cut(capped_populations(subscribers, days, limit))
    ids = base.select(ID).distinct()
    return base, F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _restrict(table: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Keep rows of the capped population; no filter at all when uncapped."""
    return table if ids is None else table.join(ids, ID, "left_semi")


def _latest_state() -> Column:
    """The last lifecycle row; equal times are decided by the larger event id."""
    return F.max(F.struct("occurred_at", "event_id", *_STATE))


def _activity(wh: Warehouse, sessions: Column, payments: Column, tickets: Column) -> DataFrame:
    """Sessions, payments and tickets as one narrow stream of measures.

    Read from the one table that holds them all, if there is one.  Else one union instead of four joined aggregates: the shuffle carries a single
    set of fixed-width partial sums, so a hot subscriber costs one row per task.
    """
    if wh.activity is not None:
        kept = {"seen": sessions, "sessions": sessions, "failures": payments, "discounts": payments,
                "tickets": tickets}
        return wh.activity.filter(sessions | payments | tickets).select(
            ID, "occurred_at", *[F.when(keep, F.col(name)).alias(name) for name, keep in kept.items()])
    zero = F.lit(0).cast("bigint")
    nothing = F.lit(None).cast("timestamp_ntz")

    def measures(table: DataFrame, keep: Column, **given: Column) -> DataFrame:
        return table.filter(keep).select(
            ID,
            "occurred_at",
            given.get("seen", nothing).alias("seen"),
            *[given.get(name, zero).cast("bigint").alias(name)
              for name in ("sessions", "failures", "discounts", "tickets")],
        )

    one = F.lit(1)
    return (
        measures(wh.sessions, sessions, seen=F.col("occurred_at"), sessions=one)
        .unionByName(measures(
            wh.payments, payments,
            failures=(F.col("status") == "failed").cast("int"),
            discounts=F.col("discount_applied").cast("int"),
        ))
        .unionByName(measures(wh.support_tickets, tickets, tickets=one))
    )


def _finalise(rows: DataFrame, cutoff: Column, extra: Sequence[str]) -> DataFrame:
    """Tenure, recency, defaults and the fixed column order."""
    tenure = clip(F.date_diff(cutoff, F.col("signup_date")), low=0)
    since = elapsed_days(cutoff.cast("timestamp_ntz"), F.col("last_seen"))
    # Never seen means absent since signup; activity before signup is capped.
    recency = F.least(F.coalesce(since, tenure), tenure)
    count = {
        "support_tickets_last_90d": "tickets",
        "payment_failures_last_6m": "failures",
        "discounts_used_last_6m": "discounts",
    }
    values = {
        "cutoff": F.date_format(cutoff, "yyyy-MM-dd"),
        "tenure_days": tenure.cast("int"),
        "avg_session_count_last_30d": F.coalesce(F.col("sessions"), F.lit(0)).cast("double"),
        "last_activity_days_ago": recency.cast("int"),
        **{name: F.coalesce(F.col(source), F.lit(0)).cast("int") for name, source in count.items()},
        schemas.TARGET: F.col("churns").cast("int"),
        **{name: F.col(f"state.{name}") for name in _STATE},
    }
    return rows.select(
        *[values.get(name, F.col(name)).alias(name) for name in SNAPSHOT_COLUMNS], *extra
    )


def snapshot(
    wh: Warehouse,
    cutoff: date | str,
    windows: Windows = Windows(),
    max_subscribers: int | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """One labelled row per subscriber still active at the cutoff.

    Three shuffles, each of map-side partial aggregates (population, lifecycle,
    activity); the joins reuse that partitioning.
    """
    day = as_date(cutoff)
    start = midnight(day)

    def back(days: int) -> Column:
        return midnight(day - timedelta(days=days))

    end = midnight(day + timedelta(days=windows.horizon))
    ids = None
    base = wh.subscribers.filter(F.col("signup_date") < F.lit(day))
    if max_subscribers:
        base, ids = _capped(wh.subscribers, [day], max_subscribers)
        base = base.drop("at")

    occurred = F.col("occurred_at")
    cancelled = F.col("event_type") == "cancellation"
    lifecycle = (
        _restrict(wh.subscription_events.filter(occurred < end), ids)
        .groupBy(ID)
        .agg(
            F.max(F.when(occurred < start, F.struct(
                "occurred_at", "event_id", *_STATE))).alias("state"),
            F.min(F.when(cancelled, occurred)).alias("first_cancellation"),
        )
        .filter(
            F.col("state").isNotNull()
            & (F.col("first_cancellation").isNull() | (F.col("first_cancellation") >= start))
        )
        .withColumn("churns", F.col("first_cancellation").isNotNull())
    )
    activity = (
        _restrict(
            _activity(
                wh,
                occurred < start,
                (occurred >= back(windows.billing)) & (occurred < start),
                (occurred >= back(windows.tickets)) & (occurred < start),
            ),
            ids,
        )
        .groupBy(ID)
        .agg(
            F.max("seen").alias("last_seen"),
            F.sum(F.when(occurred >= back(windows.observation), F.col("sessions")))
            .alias("sessions"),
            F.sum("failures").alias("failures"),
            F.sum("discounts").alias("discounts"),
            F.sum("tickets").alias("tickets"),
        )
    )
    rows = base.join(lifecycle, ID).join(activity, ID, "left")
    return _finalise(rows, F.lit(day), extra)


def _cutoff_segments(
    spark: SparkSession, cutoffs: Sequence[date], windows: Windows
) -> tuple[list[Column], DataFrame]:
    """Time axis cut at every window edge of every cutoff.

    Returns the edges and one row per (segment, cutoff it lies before or in whose
    horizon it lies), with flags saying which windows contain the segment.  Size
    is set by the parameters alone: at most (5 x cutoffs + 1) x cutoffs rows.
    """
    lengths = (0, windows.observation, windows.billing, windows.tickets)
    edges = sorted(
        {c - timedelta(days=n) for c in cutoffs for n in lengths}
        | {c + timedelta(days=windows.horizon) for c in cutoffs}
    )
    rows = []
    for segment in range(len(edges) + 1):
        low = edges[segment - 1] if segment else date.min
        high = edges[segment] if segment < len(edges) else date.max
        for c in cutoffs:
            before = high <= c

            def inside(days: int) -> bool:
                return before and low >= c - timedelta(days=days)

            in_horizon = low >= c and high <= c + timedelta(days=windows.horizon)
            if before or in_horizon:
                rows.append({
                    "segment": segment, "at": c, "before": before, "in_horizon": in_horizon,
                    "in_sessions": inside(windows.observation),
                    "in_billing": inside(windows.billing),
                    "in_tickets": inside(windows.tickets),
                })
    flags = ("before", "in_horizon", "in_sessions", "in_billing", "in_tickets")
    schema = pa.schema([("segment", pa.int32()), ("at", pa.date32())]
                       + [(name, pa.bool_()) for name in flags])
    return [midnight(e) for e in edges], small_table(spark, rows, schema)


def panel(
    wh: Warehouse,
    cutoffs: Sequence[date | str],
    windows: Windows = Windows(),
    max_subscribers: int | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Snapshots of many cutoffs in one pass over each table.

    Rows first collapse to (subscriber, time segment) partial aggregates, so the
    event tables are read and shuffled once whatever the number of cutoffs; only
    those compact rows fan out to the cutoffs they affect.
    """
    spark = wh.subscribers.sparkSession
    days = sorted({as_date(c) for c in cutoffs})
    if not days:
        return snapshot(wh, date(1970, 1, 1), windows, extra=extra).limit(0)
    edges, segments = _cutoff_segments(spark, days, windows)
    segment = interval_index(F.col("occurred_at"), edges).alias("segment")
    last = midnight(days[-1])
    horizon = midnight(days[-1] + timedelta(days=windows.horizon))
    occurred = F.col("occurred_at")

    def since(days_back: int) -> Column:
        """From the first cutoff's window on; no earlier row can count."""
        return (occurred >= midnight(days[0] - timedelta(days=days_back))) & (occurred < last)

    # Each subscriber fans out to the cutoffs after the signup day; no join needed.
    base = wh.subscribers.filter(F.col("signup_date") < F.lit(days[-1])).withColumn(
        "at", F.explode(_later(days)))
    ids = None
    if max_subscribers:
        base, ids = _capped(wh.subscribers, days, max_subscribers)

    by_segment = (
        _restrict(wh.subscription_events.filter(occurred < horizon), ids)
        .groupBy(ID, segment)
        .agg(
            _latest_state().alias("state"),
            count_if(F.col("event_type") == "cancellation").alias("cancellations"),
        )
    )
    lifecycle = (
        by_segment.join(F.broadcast(segments), "segment")
        .groupBy(ID, "at")
        .agg(
            F.max(F.when(F.col("before"), F.col("state"))).alias("state"),
            F.sum(F.when(F.col("before"), F.col("cancellations"))).alias("gone"),
            F.sum(F.when(F.col("in_horizon"), F.col("cancellations"))).alias("leaving"),
        )
        .filter(F.col("state").isNotNull() & (F.coalesce(F.col("gone"), F.lit(0)) == 0))
        .withColumn("churns", F.coalesce(F.col("leaving"), F.lit(0)) > 0)
    )
    measures = ("sessions", "failures", "discounts", "tickets")
    usage = (
        _restrict(
            _activity(wh, occurred < last, since(windows.billing), since(windows.tickets)), ids)
        .groupBy(ID, segment)
        .agg(F.max("seen").alias("seen"), *[F.sum(m).alias(m) for m in measures])
    )
    window_of = dict(sessions="in_sessions", failures="in_billing", discounts="in_billing",
                     tickets="in_tickets")
    activity = (
        usage.join(F.broadcast(segments.filter("before")), "segment")
        .groupBy(ID, "at")
        .agg(
            F.max("seen").alias("last_seen"),
            *[F.sum(F.when(F.col(window_of[m]), F.col(m)).otherwise(0)).alias(m)
              for m in measures],
        )
    )
    rows = base.join(lifecycle, [ID, "at"]).join(activity, [ID, "at"], "left")
    return _finalise(rows, F.col("at"), extra)


def cutoff_dates(
    spark: SparkSession, start: date | str, end: date | str, step_days: int = CUTOFF_STEP_DAYS
) -> DataFrame:
    """Evenly spaced cutoffs, the end included when it is hit."""
    days = F.sequence(
        F.lit(as_date(start)), F.lit(as_date(end)), F.expr(f"INTERVAL '{int(step_days)}' DAY")
    )
    return spark.range(1).select(F.explode(days).alias("cutoff"))


def usable_cutoffs(
    subscribers: DataFrame, cutoffs: DataFrame, min_subscribers: int = MIN_HISTORY_SUBSCRIBERS
) -> DataFrame:
    """Cutoffs with enough signups before them.

    Signups collapse to one row per day first, so the range join works on days
    (a bounded calendar), not on subscribers.
    """
    per_day = subscribers.groupBy("signup_date").agg(F.count("*").alias("signups"))
    return (
        per_day.join(F.broadcast(cutoffs), F.col("signup_date") < F.col("cutoff"))
        .groupBy("cutoff")
        .agg(F.sum("signups").alias("subscribers"))
        .filter(F.col("subscribers") >= min_subscribers)
    )


def panel_rates(rows: DataFrame) -> DataFrame:
    """Rows and dropout rate per cutoff."""
    return rows.groupBy("cutoff").agg(
        F.count("*").alias("n_rows"),
        F.sum(schemas.TARGET).alias("dropouts"),
        F.avg(schemas.TARGET).alias("dropout_rate"),
    )


def split_of(cutoffs: Sequence[date | str]) -> dict[str, str]:
    """Last cutoff tests, the one before validates, the rest train."""
    ordered = sorted({as_date(c).isoformat() for c in cutoffs})
    if len(ordered) < 3:
        raise ValueError(f"a temporal split needs at least 3 cutoffs, got {len(ordered)}")
    names = ["train"] * (len(ordered) - 2) + ["validation", "test"]
    return dict(zip(ordered, names, strict=True))


def temporal_split(rows: DataFrame, cutoffs: Sequence[date | str]) -> DataFrame:
    """Attach the ``split`` of each row's cutoff."""
    assignment = split_of(cutoffs)
    pairs = [F.lit(text) for pair in assignment.items() for text in pair]
    return rows.withColumn("split", F.create_map(*pairs)[F.col("cutoff")])


def require_all_splits(rows: DataFrame) -> DataFrame:
    """Fail when a split came back empty."""
    found = {r["split"] for r in rows.select("split").distinct().collect()}
    empty = {"train", "validation", "test"} - found
    if empty:
        raise ValueError(f"empty split: {', '.join(sorted(empty))}")
    return rows


def expanding_windows(rows: DataFrame, cutoffs: Sequence[date | str]) -> DataFrame:
    """One copy of the panel per expanding window (first 3, 4, ... cutoffs).

    ``window_id`` is the number of cutoffs used; the split is relative to it.
    """
    ordered = sorted({as_date(c).isoformat() for c in cutoffs})
    spark = rows.sparkSession
    assignment = [
        {"window_id": size, "test_cutoff": ordered[size - 1], "cutoff": c, "split": split}
        for size in range(3, len(ordered) + 1)
        for c, split in split_of(ordered[:size]).items()
    ]
    schema = pa.schema([("window_id", pa.int32()), ("test_cutoff", pa.string()),
                        ("cutoff", pa.string()), ("split", pa.string())])
    return rows.join(F.broadcast(small_table(spark, assignment, schema)), "cutoff")


def latest_scorable(events: DataFrame, horizon_days: int) -> DataFrame:
    """The last cutoff whose whole label window lies inside the data."""
    return events.agg(
        F.date_sub(F.max(F.col("occurred_at").cast("date")), horizon_days).alias("cutoff")
    )


def replay_schedule(
    cutoffs: DataFrame, today: DataFrame, horizon_days: int
) -> DataFrame:
    """Which cutoffs each replayed day may use.

    A cutoff is usable once its label window closed by ``today``; the newest
    usable one tests and is never trained on.  Both inputs are parameter-sized.
    """
    ready = today.join(
        F.broadcast(cutoffs), F.date_add("cutoff", horizon_days) <= F.col("today")
    )
    newest = ready.groupBy("today").agg(F.max("cutoff").alias("newest"))
    return ready.join(newest, "today").select(
        "today", "cutoff",
        F.when(F.col("cutoff") == F.col("newest"), "test").otherwise("train").alias("role"),
    )


def stratified_split(
    rows: DataFrame, key: Sequence[str], label: str = schemas.TARGET,
    test: float = 0.15, validation: float = 0.15, seed: int = 42,
) -> DataFrame:
    """Seeded, repeatable split that keeps the class balance.

    Each row draws a uniform number from a hash of its key; per class the rows
    are cut at the exact quantiles of that draw, found by distributed ranks, so
    a majority class never has to fit into one sorted task.
    """
    from ebbtide.operators.ranks import exact_quantiles

    draw = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 52)).cast("double")
    drawn = rows.withColumn("_draw", draw)
    cuts = exact_quantiles(
        drawn, [label], "_draw", [test, test + validation], interpolate=False
    )
    return (
        drawn.join(F.broadcast(cuts), label)
        .withColumn(
            "split",
            F.when(F.col("_draw") < F.col("q")[0], "test")
            .when(F.col("_draw") < F.col("q")[1], "validation")
            .otherwise("train"),
        )
        .drop("_draw", "q")
    )
