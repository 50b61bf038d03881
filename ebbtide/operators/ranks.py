"""Exact ranks, prefix sums and quantiles without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import cut

# The range of values that a stored row belongs to, counted from the smallest.
BUCKET = "_bucket"


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column]
) -> DataFrame:
    """One stored row per distinct (keys, value), summed map-side first.

    Stored in ranges of the value, since ranking passes over it several times: a range is
    what one task of the session's shuffle partitions holds, and adaptive execution merges
    small ones.  A re-run task reads the ranges as they were stored.
    """
    return cut(
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[F.sum(expr.cast("bigint")).alias(name) for name, expr in measures.items()])
        .repartitionByRange(F.col(value))
        .withColumn(BUCKET, F.spark_partition_id())
    )


def prefix_sums(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    measures: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """Running totals ``cum_<measure>`` along ``value`` (own row included).

    Two levels: each value range gets one opening row carrying the totals of
    the ranges before it, then one window per range sums up.  Ranges hold an
    even share of the distinct values whatever their distribution, and a hot
    value is already a single row; so one shuffle, no join and no large task.

    ``counts`` comes from :func:`value_counts`.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    step = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    before = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        counts.groupBy(*keys, BUCKET)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(*keys, BUCKET,
                *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(m) for m in measures])
    )
    rows = counts.withColumn("_own", F.lit(True)).unionByName(
        opening.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    running = (
        Window.partitionBy(*keys, BUCKET).orderBy("_own", order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.select(
        "*", *[F.sum(m).over(running).alias(f"cum_{m}") for m in measures]
    ).filter("_own").select(
        *[c for c in counts.columns if c != BUCKET], *[f"cum_{m}" for m in measures])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    interpolate: bool = True,
) -> DataFrame:
    """Exact quantiles per key: array ``q`` in the order of ``probabilities``.

    Linear interpolation between neighbours, or the lower neighbour.  The result
    has one row per key, so keys must be few (features, classes, groups).
    """
    counts = value_counts(df, keys, value, {"n": F.lit(1)})
    ranked = prefix_sums(counts, keys, value, ["n"])
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    # One row per key: the caller's few features, classes or groups.
    joined = ranked.join(F.broadcast(totals), list(keys)) if keys else ranked.withColumn(
        "_total", F.lit(totals.first()["_total"]).cast("bigint")
    )
    picks: list[Column] = []
    for i, p in enumerate(probabilities):
        rank = F.lit(float(p)) * (F.col("_total") - 1 if interpolate else F.col("_total"))
        picks += [
            F.min(F.when(F.col("cum_n") > F.floor(rank), F.col(value))).alias(f"_lo{i}"),
            F.min(F.when(F.col("cum_n") > F.ceil(rank), F.col(value))).alias(f"_hi{i}"),
            F.max(rank - F.floor(rank)).alias(f"_frac{i}"),
        ]
    found = joined.groupBy(*keys).agg(*picks)

    def quantile(i: int) -> Column:
        low = F.col(f"_lo{i}")
        if not interpolate:
            return low
        high = F.coalesce(F.col(f"_hi{i}"), low)
        return low + (high - low) * F.col(f"_frac{i}")

    return found.select(*keys, F.array(*[quantile(i) for i in range(len(probabilities))]).alias("q"))
