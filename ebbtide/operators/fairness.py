"""Group metrics and disparity across attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import plain_number, ratio, reasons
from ebbtide.operators.classification import confusion_counts, curve, ranking_metrics
from ebbtide.params import DISPARITY_LIMIT, MIN_GROUP_SIZE

KEYS = ("attribute", "group")


def by_attribute(scored: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """One row per (attribute, row): the input of every fairness operator."""
    pairs = F.array(*[
        F.struct(F.lit(a).alias("attribute"),
                 F.coalesce(F.col(a).cast("string"), F.lit("None")).alias("group"))
        for a in attributes
    ])
    return scored.select("y_true", "y_proba", F.explode(pairs).alias("a")).select(
        "a.*", "y_true", "y_proba")


def group_metrics(
    grouped: DataFrame, threshold: float, min_size: int = MIN_GROUP_SIZE
) -> DataFrame:
    """Rates per group, rounded to the four decimals later steps work on.

    Largest groups first.  Undefined rates are NULL; small groups stay, marked insufficient.  A hot
    group only costs partial sums; its AUC uses the bucketed score curve.
    """
    cells = [expr.alias(name) for name, expr in confusion_counts(threshold).items()]
    counts = grouped.groupBy(*KEYS).agg(*cells)
    auc = ranking_metrics(curve(grouped, KEYS), KEYS).select(*KEYS, "roc_auc")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n, positives = tp + fp + fn + tn, tp + fn

    def r(top: Column, bottom: Column) -> Column:
        return F.round(ratio(top, bottom), 4)

    return counts.join(auc, list(KEYS)).select(
        *KEYS, n.alias("n"),
        r(positives, n).alias("base_rate"), r(tp + fp, n).alias("selection_rate"),
        r(tp, positives).alias("recall"), r(tp, tp + fp).alias("precision"),
        r(fn, positives).alias("false_negative_rate"),
        F.round("roc_auc", 4).alias("roc_auc"),
        (n >= min_size).alias("sufficient_sample"),
    ).orderBy("attribute", F.desc("n"), "group")


def _worst_to_best(metric: str) -> Column:
    """Smallest over largest positive value; needs two."""
    usable = F.when(F.col("sufficient_sample") & (F.col(metric) > 0), F.col(metric))
    return F.when(
        F.count(usable) >= 2, F.round(F.try_divide(F.min(usable), F.max(usable)), 4)
    )


def disparity(
    groups: DataFrame, threshold: float, limit: float = DISPARITY_LIMIT
) -> DataFrame:
    """One row per attribute: ratios, concerns, weakest group and verdict.

    Works on the rounded group table.  Groups too small to trust are left out of
    the ratios but counted.
    """
    ranked = F.when(F.col("sufficient_sample") & F.col("roc_auc").isNotNull(),
                    F.struct("roc_auc", -F.col("n"), "group"))
    table = groups.groupBy("attribute").agg(
        F.count("*").alias("n_groups"),
        F.count_if("sufficient_sample").alias("n_groups_evaluated"),
        _worst_to_best("selection_rate").alias("selection_rate_ratio"),
        _worst_to_best("recall").alias("recall_ratio"),
        _worst_to_best("roc_auc").alias("roc_auc_ratio"),
        F.min_by(F.struct("group", "roc_auc", "n"), ranked).alias("weakest"),
    )

    # The concern wording.
    def concern(metric: str, opening: str, ending: str) -> tuple[Column, Column]:
        value = F.col(f"{metric}_ratio")
        return (value < limit, F.concat(
            F.lit(f"{opening} by more than the {limit:g} ratio ("), plain_number(value),
            F.lit(f") - {ending}")))

    table = table.withColumn("concerns", reasons(
        concern("selection_rate", "selection rates differ",
                "check whether the underlying churn rates differ too, which would make this "
                "expected"),
        concern("recall", "recall differs",
                "some groups' churners are being missed far more often"),
        concern("roc_auc", "discrimination differs",
                "the model is measurably less able to rank some groups"),
    ))
    return table.select(
        "attribute", F.lit(round(float(threshold), 4)).alias("threshold"), "n_groups",
        "n_groups_evaluated", F.lit(limit).alias("disparity_threshold"),
        "selection_rate_ratio", "recall_ratio", "roc_auc_ratio",
        F.col("weakest.group").alias("weakest_group"),
        F.col("weakest.roc_auc").alias("weakest_roc_auc"),
        F.col("weakest.n").alias("weakest_n"),
        "concerns", (F.size("concerns") == 0).alias("passes"),
    )


def audit(
    scored: DataFrame, attributes: Sequence[str], threshold: float,
    min_size: int = MIN_GROUP_SIZE, limit: float = DISPARITY_LIMIT,
) -> DataFrame:
    """All attributes at once, from one unpivoted scan."""
    return disparity(
        group_metrics(by_attribute(scored, attributes), threshold, min_size), threshold, limit
    )


def audit_verdict(reports: DataFrame) -> DataFrame:
    """Overall verdict over the few attribute reports."""
    return reports.agg(
        F.bool_and("passes").alias("passes"),
        F.array_sort(F.collect_list(F.when(~F.col("passes"), F.col("attribute"))))
        .alias("attributes_with_concerns"),
    )
