"""Confusion counts, threshold sweeps and ranking metrics.

Input everywhere: a scored table with ``y_true`` (0/1) and ``y_proba``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import count_if, interval_index, ratio, ratio0
from ebbtide.operators.ranks import prefix_sums, value_counts
from ebbtide.params import DECISION_THRESHOLD, F1_GRID

COUNTS = ("tp", "fp", "fn", "tn")


def confusion_counts(threshold: float | Column) -> dict[str, Column]:
    """The four cells as aggregates, for use in any ``groupBy``."""
    flagged = F.col("y_proba") >= threshold
    positive = F.col("y_true") == 1
    return {
        "tp": count_if(flagged & positive),
        "fp": count_if(flagged & ~positive),
        "fn": count_if(~flagged & positive),
        "tn": count_if(~flagged & ~positive),
    }


def rates() -> dict[str, Column]:
    """Metrics over the count columns; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    n = tp + fp + fn + tn
    return {
        "n_samples": n,
        "positive_rate_actual": ratio(tp + fn, n),
        "positive_rate_predicted": ratio(tp + fp, n),
        "accuracy": ratio(tp + tn, n),
        "precision": ratio0(tp, tp + fp),
        "recall": ratio0(tp, tp + fn),
        "f1": ratio0(2 * tp, 2 * tp + fp + fn),
    }


def confusion(
    scored: DataFrame, threshold: float = DECISION_THRESHOLD, keys: Sequence[str] = ()
) -> DataFrame:
    """Counts and rates at one threshold: one aggregate."""
    cells = [expr.alias(name) for name, expr in confusion_counts(threshold).items()]
    return scored.groupBy(*keys).agg(*cells).select(
        *keys, F.lit(float(threshold)).alias("threshold"), *COUNTS,
        *[expr.alias(name) for name, expr in rates().items()],
    )


def threshold_counts(
    scored: DataFrame, thresholds: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """The four counts at every threshold, from one scan.

    Rows collapse to the interval between neighbouring thresholds; the suffix
    sums then run over at most ``len(thresholds) + 1`` rows per key.
    """
    grid = sorted({float(t) for t in thresholds})
    steps = (
        scored.groupBy(*keys, interval_index(F.col("y_proba"), grid).alias("step"))
        .agg(F.sum(F.col("y_true").cast("bigint")).alias("pos"), F.count("*").alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    reached = F.col("at") <= F.col("step")
    cells = {
        "tp": F.when(reached, F.col("pos")).otherwise(0),
        "fp": F.when(reached, F.col("neg")).otherwise(0),
        "fn": F.when(reached, 0).otherwise(F.col("pos")),
        "tn": F.when(reached, 0).otherwise(F.col("neg")),
    }
    return (
        steps.withColumn("at", F.explode(F.sequence(F.lit(1), F.lit(len(grid)))))
        .groupBy(*keys, "at")
        .agg(*[F.sum(expr).alias(name) for name, expr in cells.items()])
        .select(
            *keys, F.get(F.array(*[F.lit(t) for t in grid]), F.col("at") - 1).alias("threshold"),
            *COUNTS,
        )
    )


def f1_sweep(scored: DataFrame, grid: Sequence[float] = F1_GRID) -> DataFrame:
    """F1 at every grid threshold."""
    counts = threshold_counts(scored, grid)
    return counts.select("threshold", *COUNTS, rates()["f1"].alias("f1"))


def tune_threshold(sweep: DataFrame) -> DataFrame:
    """The best F1; the lowest threshold wins a tie."""
    best = F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold")))
    return sweep.agg(best.alias("best")).select("best.threshold", "best.f1")


def curve(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, with positives and negatives at or above it."""
    y = F.col("y_true")
    counts = value_counts(scored, keys, "y_proba", {"pos": y, "neg": 1 - y})
    return prefix_sums(counts, keys, "y_proba", ["pos", "neg"], descending=True)


def ranking_metrics(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and step-wise average precision from a curve.

    Both are NULL when only one class is present.
    """
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    cum_pos, cum_neg = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    sums = points.groupBy(*keys).agg(
        F.max("cum_pos").alias("positives"),
        F.max("cum_neg").alias("negatives"),
        F.sum(neg * (cum_pos - pos / 2.0)).alias("_pairs"),
        F.sum(F.when(F.col("pos") > 0, pos * cum_pos / (cum_pos + cum_neg)).otherwise(0.0))
        .alias("_steps"),
    )
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return sums.select(
        *keys, "positives", "negatives",
        F.when(both, F.try_divide(F.col("_pairs"), p * n)).alias("roc_auc"),
        F.when(both, F.try_divide(F.col("_steps"), p)).alias("pr_auc"),
    )


def evaluate(
    scored: DataFrame, threshold: float = DECISION_THRESHOLD, keys: Sequence[str] = ()
) -> DataFrame:
    """The full metric row of one split: confusion, rates and ranking."""
    table = confusion(scored, threshold, keys)
    ranking = ranking_metrics(curve(scored, keys), keys).drop("positives", "negatives")
    if keys:
        return table.join(ranking, list(keys))
    # One row each: merged as a union, so no join without a key is needed.
    both = table.unionByName(ranking, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def class_report(scored: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    c = confusion(scored, threshold)
    tp, fp, fn, tn = (F.col(x) for x in COUNTS)

    def row(name: str, hit: Column, false_hit: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            ratio0(hit, hit + false_hit).alias("precision"),
            ratio0(hit, hit + miss).alias("recall"),
            ratio0(2 * hit, 2 * hit + false_hit + miss).alias("f1"),
            (hit + miss).alias("support"),
        )

    both = c.select(row("retained", tn, fn, fp).alias("a"), row("dropout", tp, fp, fn).alias("b"),
                    F.col("n_samples").alias("n"))
    means = {
        "macro avg": lambda m: (F.col(f"a.{m}") + F.col(f"b.{m}")) / 2.0,
        "weighted avg": lambda m: ratio0(
            F.col(f"a.{m}") * F.col("a.support") + F.col(f"b.{m}") * F.col("b.support"),
            F.col("n")),
    }
    averaged = [
        F.struct(F.lit(name).alias("class"),
                 *[f(m).alias(m) for m in ("precision", "recall", "f1")],
                 F.col("n").alias("support"))
        for name, f in means.items()
    ]
    return both.select(F.explode(F.array("a", "b", *averaged)).alias("r")).select("r.*")


def class_balance(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(F.col("y_true").cast("double")).alias("positive_rate")
    )


def promotion_gate(
    rankings: DataFrame, margin: str = "0.0050", challenger: str = "challenger",
    champion: str | None = "champion", metric: str = "pr_auc",
) -> DataFrame:
    """Promote when the challenger beats the champion by at least the margin.

    ``rankings`` has one row per ``model``.  Scores are compared as four-decimal
    numbers, so a gain of exactly the margin promotes.  An undefined score is a
    broken evaluation set and raises.
    """
    def score(name: str) -> Column:
        return F.max(F.when(F.col("model") == name, F.round(F.col(metric), 4)))

    c = F.coalesce(
        score(challenger).cast("decimal(6,4)"),
        F.raise_error(F.lit(f"{metric} is undefined: both classes are needed")).cast("decimal(6,4)"),
    )
    if champion is None:
        return rankings.agg(c.alias("challenger_score")).select(
            "challenger_score", F.lit(None).cast("decimal(6,4)").alias("champion_score"),
            F.lit(True).alias("promoted"), F.lit("no incumbent champion").alias("reason"),
        )
    known = F.max((F.col("model") == champion).cast("int"))
    scores = rankings.agg(c.alias("challenger_score"),
                          score(champion).cast("decimal(6,4)").alias("champion_score"),
                          known.alias("_known"))
    gain = F.col("challenger_score") - F.col("champion_score")
    enough = gain >= F.lit(margin).cast("decimal(6,4)")
    signed = F.concat(F.when(gain >= 0, "+").otherwise(""),
                      gain.cast("decimal(6,4)").cast("string"))
    undefined = F.raise_error(F.lit(f"{metric} of the champion is undefined")).cast("boolean")
    first = F.col("_known") == 0
    return scores.select(
        "challenger_score", "champion_score",
        F.when(first, True).when(F.col("champion_score").isNull(), undefined)
        .otherwise(enough).alias("promoted"),
        F.when(first, "no incumbent champion")
        .when(enough, F.concat(F.lit("beat champion by "), signed))
        .otherwise(F.concat(F.lit("improvement "), signed, F.lit(f" below required +{margin}")))
        .alias("reason"),
    )
