"""Training bundle: fit, tune, evaluate, diagnose, persist."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.operators import calibration, classification, decisions, drift, fairness, prep
from ebbtide.session import cut
from ebbtide.sources import files


def merge_rows(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side, merged as a union: no join without a key."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def fit(train: DataFrame, **overrides) -> PipelineModel:
    """Boosted trees on the preprocessed training rows."""
    return prep.tree_pipeline(prep.fit_preprocessor(train), **overrides).fit(
        prep.with_label(train))


def train_and_evaluate(
    rows: DataFrame, model: PipelineModel | None = None, **overrides
) -> DataFrame:
    """Metrics of validation and test at the threshold tuned on validation.

    ``rows`` is a panel with its ``split``.
    """
    train = rows.filter(F.col("split") == "train").drop("split")
    fitted = model or fit(train, **overrides)
    held_out = cut(prep.tree_scores(fitted, rows.filter(F.col("split") != "train"), "split"))
    tuned = classification.tune_threshold(
        classification.f1_sweep(held_out.filter(F.col("split") == "validation"))
    ).first()
    return classification.evaluate(held_out, tuned["threshold"], ["split"])


def headline(quality: DataFrame) -> DataFrame:
    """The metrics worth carrying into a run report, per split."""
    return quality.select("split", "n_samples", *[
        F.round(c, 4).alias(c) for c in ("roc_auc", "pr_auc", "f1", "precision", "recall")])


def decision_quality(
    scored: DataFrame, threshold: float, attribute: str, price: decisions.Prices = decisions.prices(),
    budget: float | None = None, held_out: DataFrame | None = None,
    method: str = "isotonic",
) -> DataFrame:
    """Calibration, costs, capacity and fairness of one scored table, one row.

    With scores of a ``held_out`` split, a calibration map is fitted on them and
    its effect on this table measured; it is never applied.
    """
    fair = fairness.audit(scored, [attribute], threshold).select(
        "selection_rate_ratio", "recall_ratio", "roc_auc_ratio",
        F.col("passes").alias("fairness_passes"))
    cap = decisions.capacity_report(scored, budget, price).select(
        "offers_required", "binding", "shortfall", "cost_of_constraint")
    cost = decisions.threshold_report(scored, threshold, price).select(
        "savings", "optimal_threshold", "extra_offers_required")
    parts = [calibration.calibration_metrics(scored), cost, cap, fair]
    if held_out is not None:
        tried = calibration.fit_calibration(held_out, method)(scored)
        parts.append(calibration.compare_calibration(tried, "y_proba", "calibrated").select(
            F.lit(method).alias("calibration_method"),
            F.col("improved").alias("calibration_improved"), "ece_improvement",
            F.lit(False).alias("calibration_applied")))
    return merge_rows(*parts)


def training_summary(gate: DataFrame, fair: DataFrame) -> DataFrame:
    """What a run report needs of a training run, one row."""
    return merge_rows(
        gate.select("promoted", F.col("reason").alias("promotion_reason")),
        fair.select(F.col("passes").alias("fairness_passes"),
                    F.col("concerns").alias("fairness_concerns")),
    )


def overview(counts: DataFrame, quality: DataFrame, moved: DataFrame) -> DataFrame:
    """Warehouse size, model quality and the last drift verdict, one row."""
    sizes = counts.agg(F.sum("row_count").alias("total_rows"),
                       F.count("*").alias("n_tables"))
    model = quality.select(
        "n_samples", "threshold",
        *[F.round(c, 4).alias(c) for c in ("roc_auc", "pr_auc", "precision", "recall")])
    drifted = moved.select(
        F.col("available").alias("drift_available"),
        F.coalesce("overall_verdict", F.lit("unavailable")).alias("drift_verdict"))
    return merge_rows(sizes, model, drifted)


def save_artifacts(
    path: str, model: PipelineModel, metrics: DataFrame, test: DataFrame, train: DataFrame,
    score: str | None = None,
) -> None:
    """Model, metrics, held-out split and reference profile side by side."""
    model.write().overwrite().save(f"{path}/model")
    files.write_report(metrics, f"{path}/metrics")
    files.write_csv(test.select(*schemas.MODEL_INPUTS, schemas.TARGET), f"{path}/test_split")
    files.write_table(drift.reference_profile(train, score), f"{path}/reference_profile")
