"""Reference profiles and population-stability drift.

A profile is one long table, one row per bin or category:
``(feature, kind, bin_no, lo, hi, category, share, mean, std, min, max, n_rows)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.columns import finite, interval_index, ratio
from ebbtide.operators.ranks import exact_quantiles
from ebbtide.operators.selection import column_quantiles
from ebbtide.params import (
    DRIFT_BINS, DRIFT_MIN_SAMPLES, PSI_FLOOR, PSI_MODERATE, PSI_SIGNIFICANT,
)
from ebbtide.session import small_table

PREDICTION = "dropout_probability"
VERDICTS = ("stable", "moderate", "significant")


def unpivot_numeric(df: DataFrame, columns: Sequence[str] = schemas.RAW_NUMERIC) -> DataFrame:
    """``(feature, value)`` for the finite numbers of all columns, in one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), finite(F.col(c)).alias("value"))
        for c in columns if c in df.columns
    ])
    return df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull())


def unpivot_discrete(df: DataFrame, columns: Sequence[str] = schemas.DISCRETE) -> DataFrame:
    """``(feature, category)``; flags read ``true`` / ``false``."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("category"))
        for c in columns if c in df.columns
    ])
    return df.select(F.explode(pairs).alias("p")).select("p.*")


def numeric_stats(values: DataFrame) -> DataFrame:
    """Mean, population deviation and range per feature."""
    return values.groupBy("feature").agg(
        F.count("*").alias("n"),
        F.round(F.avg("value"), 4).alias("mean"),
        F.round(F.stddev_pop("value"), 4).alias("std"),
        F.round(F.min("value"), 4).alias("min"),
        F.round(F.max("value"), 4).alias("max"),
    )


def _edges(q: Column) -> Column:
    """Distinct quantiles as edges; a constant feature gets one unit-wide bin, none at all 0 to 1."""
    distinct = F.array_distinct(F.array_sort(q))
    centre = F.get(q, F.lit(0))
    edges = F.when(F.size(distinct) < 2, F.array(centre - 0.5, centre + 0.5)).otherwise(distinct)
    return F.when(q.isNull(), F.array(F.lit(0.0), F.lit(1.0))).otherwise(edges).alias("edges")


def _steps(bins: int) -> list[float]:
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def bin_edges(values: DataFrame, bins: int = DRIFT_BINS) -> DataFrame:
    """Quantile edges of ``(feature, value)`` rows, for features that are known from the rows alone.

    Quantiles are exact and found by distributed ranks: a continuous feature
    never has to fit one task, however many distinct values it has.
    """
    return exact_quantiles(values, ["feature"], "value", _steps(bins)).select("feature", _edges(F.col("q")))


def column_edges(df: DataFrame, columns: Sequence[str], bins: int = DRIFT_BINS) -> DataFrame:
    """Quantile edges of columns, with ``mean``, ``std``, ``min`` and ``max``; two scans."""
    found = column_quantiles(df, columns, _steps(bins))
    return found.select(
        "feature", _edges(F.col("q")), *[F.round(F.coalesce(c, F.lit(0.0)), 4).alias(c) for c in ("mean", "std", "min", "max")])


def _spine(edges: DataFrame) -> DataFrame:
    """One row per bin of every feature."""
    return edges.select(
        "feature", "edges", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin_no")
    ).select(
        "feature", "bin_no", F.get("edges", F.col("bin_no")).alias("lo"),
        F.get("edges", F.col("bin_no") + 1).alias("hi"),
    )


def bin_counts(values: DataFrame, edges: DataFrame, bins: int = DRIFT_BINS) -> DataFrame:
    """Rows per bin: half-open bins, the last one closed, outliers clipped inward.

    ``edges`` has one row per feature, so it is broadcast.  Comparing with the
    interior edges alone is the clipping.
    """
    index = reduce(
        lambda total, i: total + F.when(
            (F.size("edges") > i + 1) & (F.col("value") >= F.get("edges", F.lit(i))), 1
        ).otherwise(0),
        range(1, bins), F.lit(0),
    )
    return (
        values.join(F.broadcast(edges.select("feature", "edges")), "feature")
        .groupBy("feature", index.alias("bin_no"))
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    )


def score_bin_counts(values: DataFrame, bins: int = DRIFT_BINS) -> DataFrame:
    """Scores per fixed bin: the edges are parameters, so nothing is joined."""
    index = interval_index(F.col("value"), _score_edges(bins)[1:-1])
    return values.groupBy("feature", index.alias("bin_no")).agg(
        F.count("*").alias("n"), F.sum("value").alias("total"))


def _shares(spine: DataFrame, counts: DataFrame) -> DataFrame:
    """Share per bin; empty bins count 0, an empty feature is all zeros.

    The window covers the few bins of a feature.
    """
    feature = Window.partitionBy("feature")
    return spine.join(counts, ["feature", "bin_no"], "left").withColumns({
        "n_values": F.sum("n").over(feature), "_sum": F.sum("total").over(feature),
    }).withColumns({
        "share": F.coalesce(ratio(F.col("n"), F.col("n_values")), F.lit(0.0)),
        "mean": ratio(F.col("_sum"), F.col("n_values")),
    })


def _score_edges(bins: int) -> list[float]:
    """Fixed edges over [0, 1], so score bins never move between runs."""
    return [round(i * (1.0 / bins), 4) for i in range(bins + 1)]


def prediction_edges(df: DataFrame, bins: int = DRIFT_BINS) -> DataFrame:
    edges = F.array(*[F.lit(e) for e in _score_edges(bins)])
    return df.sparkSession.range(1).select(
        F.lit(PREDICTION).alias("feature"), edges.alias("edges"))


def scores_as_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(
        F.lit(PREDICTION).alias("feature"), finite(F.col(column)).alias("value")
    ).filter(F.col("value").isNotNull())


def category_shares(df: DataFrame) -> DataFrame:
    """Relative frequency per category of every discrete feature."""
    counts = unpivot_discrete(df).groupBy("feature", "category").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    return counts.withColumn("n_values", total).select(
        "feature", "category", ratio(F.col("n"), F.col("n_values")).alias("share"), "n_values")


def reference_profile(
    df: DataFrame, score: str | None = None, bins: int = DRIFT_BINS,
) -> DataFrame:
    """The profile of a training frame, optionally with its score distribution.

    Numeric rows carry the feature's mean, deviation and range.  A column that holds
    nothing stays in the profile: one bin, share 0.
    """
    columns = [c for c in schemas.RAW_NUMERIC if c in df.columns]
    edges = column_edges(df, columns, bins)
    none = F.lit(None)
    no_stats = [none.cast("double").alias(c) for c in ("std", "min", "max")]

    def binned(kind: str, e: DataFrame, counts: DataFrame) -> DataFrame:
        return _shares(_spine(e), counts).select(
            "feature", F.lit(kind).alias("kind"), "bin_no", "lo", "hi",
            none.cast("string").alias("category"), "share",
            F.round("mean", 4).alias("mean"), F.col("n_values").alias("n_rows"),
        )

    # One row per numeric feature.
    stats = F.broadcast(edges.select("feature", "std", "min", "max"))
    numeric = binned("numeric", edges, bin_counts(unpivot_numeric(df), edges, bins)).join(stats, "feature")
    out = numeric.unionByName(
        category_shares(df).select(
            "feature", F.lit("discrete").alias("kind"), none.cast("int").alias("bin_no"),
            none.cast("double").alias("lo"), none.cast("double").alias("hi"), "category",
            "share", none.cast("double").alias("mean"), F.col("n_values").alias("n_rows"), *no_stats,
        )
    )
    if score:
        out = out.unionByName(binned(
            "prediction", prediction_edges(df, bins),
            score_bin_counts(scores_as_values(df, score), bins)).select("*", *no_stats))
    return out


def psi_term(reference: Column, live: Column) -> Column:
    """One bin's part of the index; both shares are floored, not shifted."""
    r = F.greatest(reference, F.lit(PSI_FLOOR))
    o = F.greatest(live, F.lit(PSI_FLOOR))
    return (o - r) * F.ln(o / r)


def verdict_code(psi: Column) -> Column:
    return F.when(psi >= PSI_SIGNIFICANT, 2).when(psi >= PSI_MODERATE, 1).otherwise(0)


def verdict_text(code: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in VERDICTS]), code)


def psi_arrays(reference: Column, live: Column) -> Column:
    """Index of two share arrays over the same bins; sizes that differ give 0."""
    parts = F.zip_with(reference, live, psi_term)
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(reference) == F.size(live), total).otherwise(0.0)


def _binned_psi(profile: DataFrame, kind: str, counts: DataFrame) -> DataFrame:
    """PSI per feature over the profile's bins; the profile is parameter-sized."""
    spine = profile.filter(F.col("kind") == kind).select(
        "feature", "bin_no", F.col("share").alias("reference_share"),
        F.col("mean").alias("reference_mean"))
    return _shares(spine, counts).groupBy("feature").agg(
        F.sum(psi_term(F.col("reference_share"), F.col("share"))).alias("psi"),
        F.first("reference_mean").alias("reference_mean"),
        F.round(F.first("mean"), 4).alias("live_mean"),
    ).withColumn("kind", F.lit(kind))


def numeric_psi(df: DataFrame, profile: DataFrame, bins: int = DRIFT_BINS) -> DataFrame:
    edges = profile.filter(F.col("kind") == "numeric").groupBy("feature").agg(
        F.array_sort(F.array_union(F.collect_set("lo"), F.collect_set("hi"))).alias("edges"))
    return _binned_psi(profile, "numeric", bin_counts(unpivot_numeric(df), edges, bins))


def prediction_psi(
    df: DataFrame, profile: DataFrame, score: str, bins: int = DRIFT_BINS
) -> DataFrame:
    counts = score_bin_counts(scores_as_values(df, score), bins)
    return _binned_psi(profile, "prediction", counts)


def aligned_categories(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Reference and live share per category; a side without it counts 0."""
    reference = profile.filter(F.col("kind") == "discrete").select(
        "feature", "category", F.col("share").alias("reference_share"))
    live = category_shares(df).select("feature", "category", F.col("share").alias("live_share"))
    return reference.join(live, ["feature", "category"], "full_outer").select(
        "feature", "category",
        F.coalesce("reference_share", F.lit(0.0)).alias("reference_share"),
        F.coalesce("live_share", F.lit(0.0)).alias("live_share"),
        F.col("reference_share").isNull().alias("unseen"),
    )


def discrete_psi(df: DataFrame, profile: DataFrame) -> DataFrame:
    """PSI per discrete feature.  Unseen categories are listed, as plans are few;
    :func:`aligned_categories` has them as rows."""
    return aligned_categories(df, profile).groupBy("feature").agg(
        F.sum(psi_term(F.col("reference_share"), F.col("live_share"))).alias("psi"),
        F.array_sort(F.collect_list(F.when(F.col("unseen"), F.col("category"))))
        .alias("unseen_categories"),
    ).withColumn("kind", F.lit("discrete"))


def drift_features(
    df: DataFrame, profile: DataFrame, score: str | None = None, bins: int = DRIFT_BINS
) -> DataFrame:
    """One row per feature: index, verdict and what moved.

    The verdict uses the unrounded index; ranking and display use four decimals.
    """
    parts = numeric_psi(df, profile, bins).unionByName(
        discrete_psi(df, profile), allowMissingColumns=True)
    if score:
        parts = parts.unionByName(
            prediction_psi(df, profile, score, bins), allowMissingColumns=True)
    return parts.select(
        "feature", "kind", F.round("psi", 4).alias("psi"),
        verdict_code(F.col("psi")).alias("verdict_code"),
        verdict_text(verdict_code(F.col("psi"))).alias("verdict"),
        "reference_mean", "live_mean", "unseen_categories",
    )


def drift_report(
    features: DataFrame, n_samples: int | Column, min_samples: int = DRIFT_MIN_SAMPLES,
    top: int = 5,
) -> DataFrame:
    """Overall verdict over the feature rows (a handful of them)."""
    rank = F.struct((-F.col("psi")).alias("by"), "feature")
    listed = F.array_sort(F.collect_list(F.when(F.col("verdict_code") > 0, rank)))
    ranked = F.array_sort(F.collect_list(F.when(F.col("kind") != "prediction", rank)))
    n = n_samples if isinstance(n_samples, Column) else F.lit(n_samples).cast("bigint")
    return features.agg(
        F.max("verdict_code").alias("verdict_code"),
        listed["feature"].alias("drifted_features"),
        F.slice(ranked["feature"], 1, top).alias("top_features"),
    ).select(
        n.alias("n_samples"), (n >= min_samples).alias("sufficient_sample"),
        verdict_text(F.col("verdict_code")).alias("overall_verdict"), "verdict_code",
        "drifted_features", "top_features",
    )


def assess(
    df: DataFrame, profile: DataFrame | None, score: str | None = None
) -> DataFrame:
    """Drift of a snapshot against a stored profile, or why there is none."""
    spark = df.sparkSession

    def unavailable(reason: str) -> DataFrame:
        return spark.range(1).select(
            F.lit(False).alias("available"), F.lit(reason).alias("reason"),
            F.lit(None).cast("bigint").alias("n_samples"),
            F.lit(None).cast("boolean").alias("sufficient_sample"),
            F.lit(None).cast("string").alias("overall_verdict"),
            F.lit(None).cast("int").alias("verdict_code"),
            F.lit(None).cast("array<string>").alias("drifted_features"),
            F.lit(None).cast("array<string>").alias("top_features"),
        )

    if profile is None:
        return unavailable("no reference profile has been written yet")
    n = df.count()
    if n == 0:
        return unavailable("no subscribers found as of the cutoff")
    return drift_report(drift_features(df, profile, score), n).select(
        F.lit(True).alias("available"), F.lit(None).cast("string").alias("reason"), "*")
