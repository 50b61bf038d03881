"""Data contract: one row per check, ``(table_name, check, severity, n_rows, n_ids)``.

Only violated checks are kept by :func:`violations`; an error fails a load, a
warning does not.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.columns import count_if, reasons
from ebbtide.functions.features import require
from ebbtide.session import cut

ERROR, WARNING = "error", "warning"
#: Subscribers whose days one task counts, on average.
SUBSCRIBERS_A_TASK = 5_000
_COLUMNS = ("table_name", "check", "severity", "n_rows", "n_ids")
_DDL = "table_name string, check string, severity string, n_rows bigint, n_ids bigint"


def required_columns(name: str) -> tuple[str, ...]:
    """All columns of a table but the key its storage assigns."""
    key = schemas.KEYS[name]
    return tuple(
        f.name for f in schemas.TABLES[name] if f.name != key or name == "subscribers"
    )


def missing_columns(name: str, df: DataFrame) -> list[str]:
    return [c for c in required_columns(name) if c not in df.columns]


def _row(spark: SparkSession, name: str, check: str, severity: str, n: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("table_name"), F.lit(check).alias("check"),
        F.lit(severity).alias("severity"), F.lit(n).cast("bigint").alias("n_rows"),
        F.lit(None).cast("bigint").alias("n_ids"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _value_rules(name: str) -> list[tuple[str, str, Column]]:
    """(check, severity, violated) per table; all counted in one aggregate."""
    when = "signup_date" if name == "subscribers" else "occurred_at"
    rules = [
        ("empty subscriber_id", ERROR,
         F.col("subscriber_id").isNull() | (F.trim("subscriber_id") == "")),
        (f"subscriber_id longer than {schemas.ID_LENGTH}", ERROR,
         F.length("subscriber_id") > schemas.ID_LENGTH),
        (f"unparseable {when}", ERROR, F.col(when).isNull()),
    ]
    if name == "subscription_events":
        rules += [
            ("unknown event_type", ERROR,
             F.col("event_type").isNull() | ~F.col("event_type").isin(*schemas.EVENT_TYPES)),
            ("negative monthly_fee", ERROR, F.col("monthly_fee") < 0),
        ]
    if name == "sessions":
        rules.append(("negative duration_minutes", ERROR, F.col("duration_minutes") < 0))
    if name == "payments":
        rules += [
            ("unknown status", ERROR,
             F.col("status").isNull() | ~F.col("status").isin(*schemas.PAYMENT_STATUSES)),
            ("negative amount", ERROR, F.col("amount") < 0),
        ]
    return rules


def _broken(name: str) -> list[Column]:
    """Counts of the rows that break each value rule."""
    return [count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(_value_rules(name))]


def _value_rows(name: str) -> list[Column]:
    """One check per value rule, and whether the table is empty, of a row of counts."""
    none = F.lit(None).cast("bigint").alias("n_ids")
    return [
        F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"),
                 F.coalesce(f"r{i}", F.lit(0)).alias("n_rows"), none)
        for i, (check, severity, _) in enumerate(_value_rules(name))
    ] + [F.struct(
        F.lit("empty table: its features are constant").alias("check"),
        F.lit(WARNING).alias("severity"),
        (F.coalesce("total", F.lit(0)) == 0).cast("bigint").alias("n_rows"), none,
    )]


def _named(name: str, counts: DataFrame, checks: list[Column]) -> DataFrame:
    return counts.select(F.explode(F.array(*checks)).alias("c")).select(
        F.lit(name).alias("table_name"), "c.*")


def validate_table(name: str, df: DataFrame, values: bool = True) -> DataFrame:
    """Checks that need this table alone; without ``values`` only columns and keys.

    Missing columns are reported before any value is looked at.  Values take one
    scan and one aggregate; duplicate keys one shuffle of partial counts.
    """
    spark = df.sparkSession
    missing = missing_columns(name, df)
    if missing:
        return _row(spark, name, f"missing required columns: {', '.join(missing)}", ERROR,
                    len(missing))
    counts = df.agg(F.count("*").alias("total"), *_broken(name)) if values else None
    out = _named(name, counts, _value_rows(name)) if values else None
    key = schemas.KEYS[name]
    if key in df.columns:
        repeated = df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        keys = repeated.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_ids"),
        ).select(F.lit(name).alias("table_name"), F.lit(f"duplicate {key}").alias("check"),
                 F.lit(ERROR).alias("severity"), "n_rows", "n_ids")
        out = keys if out is None else out.unionByName(keys)
    return spark.createDataFrame([], _DDL) if out is None else out.select(*_COLUMNS)


def _per_day(events: DataFrame, more: list[Column], tasks: int | None) -> DataFrame:
    """Rows per subscriber and day: what the cross-table checks need of a table.

    A subscriber holding most rows shrinks to one row per day before the join.  With ``tasks``
    the days are dealt to so many, since each keeps its own in memory.
    """
    events = events.withColumn("day", F.col("occurred_at").cast("date"))
    if tasks:
        events = events.repartition(tasks, "subscriber_id", "day")
    return events.groupBy("subscriber_id", "day").agg(
        F.count("*").alias("n"), *more
    )


def cross_checks(
    name: str, events: DataFrame, subscribers: DataFrame, values: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Orphan rows (error) and activity before signup (warning), in one join.

    With ``values`` the value rules are counted on the way, so a table is read once for both.
    """
    known = subscribers.groupBy("subscriber_id").agg(F.min("signup_date").alias("signup_date"))
    rules = [f"r{i}" for i in range(len(_value_rules(name)))] if values else []
    days = _per_day(events, _broken(name) if values else [], tasks).join(
        known.withColumn("known", F.lit(True)).hint("shuffle_hash"), "subscriber_id", "left"
    )
    per_id = days.groupBy("subscriber_id").agg(
        F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("orphans"),
        F.sum(F.when(F.col("day") < F.col("signup_date"), F.col("n")).otherwise(0))
        .alias("early"),
        F.sum("n").alias("total"), *[F.sum(r).alias(r) for r in rules],
    )
    totals = per_id.agg(
        *[f.alias(a) for c in ("orphans", "early") for f, a in (
            (F.coalesce(F.sum(c), F.lit(0)), f"{c}_rows"),
            (count_if(F.col(c) > 0), f"{c}_ids"))],
        F.sum("total").alias("total"), *[F.sum(r).alias(r) for r in rules],
    )

    def row(check: str, severity: str, c: str) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.lit(severity).alias("severity"),
            F.col(f"{c}_rows").alias("n_rows"), F.col(f"{c}_ids").alias("n_ids"))

    checks = [row("rows not in the subscribers table", ERROR, "orphans"),
              row("activity before the subscriber's signup_date", WARNING, "early")]
    return _named(name, totals, checks + (_value_rows(name) if values else []))


def validate_load(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every check of every table given: values and cross-checks of a table in one scan.

    The dimension, which every other table meets, is stored first.  Its size sets into how many
    tasks the days of the other tables are dealt, so that a task's share does not grow.
    """
    people = tables.get("subscribers")
    if people is None or missing_columns("subscribers", people):
        return _union([validate_table(name, df) for name, df in tables.items()])
    people = cut(people)
    least = int(people.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-people.count() // SUBSCRIBERS_A_TASK))
    parts = [validate_table("subscribers", people)]
    for name, df in tables.items():
        if name != "subscribers":
            whole = not missing_columns(name, df)
            parts.append(validate_table(name, df, values=False))
            if whole:
                parts.append(cross_checks(name, df, people, values=True, tasks=tasks).select(*_COLUMNS))
    return _union(parts)


def violations(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("n_rows") > 0)


def summarise(checks: DataFrame) -> DataFrame:
    """Verdict per table."""
    bad = F.col("n_rows") > 0
    return checks.groupBy("table_name").agg(
        F.count("*").alias("n_checks"),
        count_if(bad & (F.col("severity") == ERROR)).alias("n_errors"),
        count_if(bad & (F.col("severity") == WARNING)).alias("n_warnings"),
    ).withColumn(
        "verdict",
        F.when(F.col("n_errors") > 0, "failed").when(F.col("n_warnings") > 0, "ok with warnings")
        .otherwise("ok"),
    )


def drop_orphans(events: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Without rows of unknown subscribers; ids are hashed, so that events are not sorted."""
    ids = subscribers.select("subscriber_id").distinct()
    return events.join(ids.hint("shuffle_hash"), "subscriber_id", "left_semi")


def orphan_report(tables: Mapping[str, DataFrame], subscribers: DataFrame) -> DataFrame:
    """Rows and distinct ids that have no subscriber, per table."""
    ids = subscribers.select("subscriber_id").distinct()

    def one(name: str, df: DataFrame) -> DataFrame:
        per_id = df.groupBy("subscriber_id").agg(F.count("*").alias("n"))
        lost = per_id.join(ids.withColumn("known", F.lit(True)), "subscriber_id", "left")
        unknown = F.col("known").isNull()
        return lost.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)).alias("orphan_rows"),
            count_if(unknown).alias("orphan_ids"),
        ).select(F.lit(name).alias("table_name"), "*")

    return _union([one(name, df) for name, df in tables.items()])


# Accepted range per numeric request field.
REQUEST_RANGES = {
    "tenure_days": (0, 20_000),
    "monthly_fee": (0, 10_000),
    "avg_session_count_last_30d": (0, 10_000),
    "last_activity_days_ago": (0, 20_000),
    "support_tickets_last_90d": (0, 1_000),
    "payment_failures_last_6m": (0, 1_000),
    "discounts_used_last_6m": (0, 1_000),
}


def validate_requests(df: DataFrame) -> DataFrame:
    """Normalise the plan and list the broken rules of each row in ``problems``."""
    require(df, schemas.MODEL_INPUTS)
    rows = df.withColumn("plan_type", F.lower(F.trim("plan_type")))
    tests = [
        (F.col(c).isNull() | ~F.col(c).between(low, high), f"{c} outside [{low}, {high}]")
        for c, (low, high) in REQUEST_RANGES.items()
    ]
    tests += [
        (F.col("plan_type").isNull() | ~F.col("plan_type").isin(*schemas.PLAN_TYPES),
         "unknown plan_type"),
        (F.col("is_auto_renew_enabled").isNull(), "is_auto_renew_enabled missing"),
        (F.col("last_activity_days_ago") > F.col("tenure_days"),
         "last_activity_days_ago exceeds tenure_days"),
    ]
    return rows.withColumn("problems", reasons(*tests)).withColumn(
        "valid", F.size("problems") == 0)


def training_gate(rows: DataFrame) -> DataFrame:
    """Problems that forbid training, one row each; ``rows`` has a ``split`` column.

    One aggregate over both sets.  The plausible churn rate is [0.001, 0.5].
    """
    nulls = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in schemas.MODEL_INPUTS])

    def of(name: str, condition: Column | None = None) -> Column:
        own = F.col("split") == name
        return count_if(own if condition is None else own & condition)

    parts, stats = [], []
    for name, title in (("train", "training"), ("test", "test")):
        n, bad, early, positive = (F.col(f"{name}_{x}") for x in ("n", "nulls", "early", "pos"))
        stats += [
            of(name).alias(f"{name}_n"), of(name, nulls).alias(f"{name}_nulls"),
            of(name, F.col("last_activity_days_ago") > F.col("tenure_days"))
            .alias(f"{name}_early"),
            of(name, F.col(schemas.TARGET) == 1).alias(f"{name}_pos"),
        ]
        share = F.try_divide(positive.cast("double"), n.cast("double"))
        parts += [
            (n == 0, F.lit(f"the {title} set is empty")),
            ((n > 0) & (bad > 0), F.lit(f"the {title} set has missing values")),
            ((n > 0) & (early > 0), F.lit(f"the {title} set has activity before signup")),
            ((n > 0) & ~share.between(0.001, 0.5), F.concat(
                F.lit(f"the {title} churn rate "), F.format_string("%.2f", share * 100.0),
                F.lit("% is implausible"))),
        ]
    parts.append((
        (F.col("test_n") > 0) & ((F.col("test_pos") == 0) | (F.col("test_pos") == F.col("test_n"))),
        F.lit("the test set has only one class, so PR-AUC is undefined"),
    ))
    return rows.agg(*stats).select(F.explode(reasons(*parts)).alias("problem"))
