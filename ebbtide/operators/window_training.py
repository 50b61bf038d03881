"""A model per expanding window, all windows trained together.

Counts, means and squared deviations are kept per cutoff and merged along the cutoffs, so the
scaling of every window comes from one scan.  Training rows fan out to the windows that contain
them, and each Newton step is one aggregate for all windows (:mod:`ebbtide.operators.newton`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.columns import finite
from ebbtide.operators import classification, newton
from ebbtide.operators.asof import expanding_windows
from ebbtide.session import cut, small_table

INPUTS = (*schemas.RAW_NUMERIC, *schemas.RAW_BINARY)
RIDGE = 1.0
#: What a new window's model must add in average precision to replace the one before it.
MARGIN = 0.005


def _number(name: str) -> Column:
    return finite(F.col(name).cast("int") if name in schemas.RAW_BINARY else F.col(name))


@dataclass(frozen=True)
class Moments:
    """Count, mean and sum of squared deviations of some rows; merging two is exact."""

    n: int = 0
    mean: float = 0.0
    squares: float = 0.0

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        off = other.mean - self.mean
        return Moments(n, self.mean + off * other.n / n, self.squares + other.squares + off * off * self.n * other.n / n)

    @property
    def deviation(self) -> float:
        return (self.squares / self.n) ** 0.5 if self.n else 0.0


def moments(rows: DataFrame, inputs: Sequence[str] = INPUTS) -> dict[str, dict[str, Moments]]:
    """Per cutoff and input, from one scan; cutoffs times inputs numbers."""
    found = rows.groupBy("cutoff").agg(*[
        F.struct(F.count(_number(c)).alias("n"), F.avg(_number(c)).alias("mean"), F.var_pop(_number(c)).alias("var")).alias(c)
        for c in inputs]).collect()
    return {r["cutoff"]: {c: Moments(r[c]["n"], r[c]["mean"] or 0.0, (r[c]["var"] or 0.0) * r[c]["n"]) for c in inputs} for r in found}


def scaling(parts: dict[str, dict[str, Moments]], inputs: Sequence[str] = INPUTS) -> dict[int, list[tuple[float, float]]]:
    """Mean and deviation of every input in the training rows of every window.

    The window of the first ``k`` cutoffs trains on all but the last two of them.
    """
    ordered, upto, out = sorted(parts), {c: Moments() for c in inputs}, {}
    for i, cutoff in enumerate(ordered):
        upto = {c: upto[c] + parts[cutoff][c] for c in inputs}
        if i + 3 <= len(ordered):
            out[i + 3] = [(upto[c].mean, upto[c].deviation or 1.0) for c in inputs]
    return out


@dataclass(frozen=True)
class WindowModels:
    """Scaling and weights per window."""

    inputs: tuple[str, ...]
    scales: dict[int, list[tuple[float, float]]]
    weights: dict[int, list[float]]

    def score(self, rows: DataFrame, window: str) -> DataFrame:
        """``y_true`` and ``y_proba`` of rows by the model of the window that they name."""
        facts = [{"_w": w, "_scale": [{"mean": m, "deviation": s} for m, s in self.scales[w]], "_weights": self.weights[w]} for w in self.weights]
        schema = pa.schema([("_w", pa.int32()), ("_scale", pa.list_(pa.struct([("mean", pa.float64()), ("deviation", pa.float64())]))),
                            ("_weights", pa.list_(pa.float64()))])
        # As many rows as windows.
        known = F.broadcast(small_table(rows.sparkSession, facts, schema))
        z = F.get("_weights", F.lit(0))
        for i, x in enumerate(_scaled(self.inputs)):
            z = z + F.get("_weights", F.lit(i + 1)) * x
        return rows.join(known, F.col(window) == F.col("_w")).withColumn("y_proba", newton.sigmoid(z)).withColumn(
            "y_true", F.col(schemas.TARGET)).drop("_w", "_scale", "_weights")


def _scaled(inputs: Sequence[str]) -> list[Column]:
    """Inputs in deviations from the window's mean; what is missing counts as the mean."""
    scale = lambda i: F.get("_scale", F.lit(i))
    return [F.coalesce((_number(c) - scale(i)["mean"]) / scale(i)["deviation"], F.lit(0.0)) for i, c in enumerate(inputs)]


def train(panel: DataFrame, cutoffs: Sequence[str], inputs: Sequence[str] = INPUTS, ridge: float = RIDGE) -> WindowModels:
    """Models of all expanding windows of a stored panel; windows without training rows have none."""
    scales = scaling(moments(panel, inputs), inputs)
    windows = expanding_windows(panel, cutoffs).filter(F.col("split") == "train")
    schema = pa.schema([("window_id", pa.int32()), ("_scale", pa.list_(pa.struct([("mean", pa.float64()), ("deviation", pa.float64())])))])
    known = small_table(panel.sparkSession, [
        {"window_id": w, "_scale": [{"mean": m, "deviation": s} for m, s in scale]} for w, scale in scales.items()], schema)
    rows = cut(windows.join(F.broadcast(known), "window_id").select(
        "window_id", F.col(schemas.TARGET).alias("y"), *[x.alias(f"s{i}") for i, x in enumerate(_scaled(inputs))]))
    weights = newton.fit(rows, [F.col(f"s{i}") for i in range(len(inputs))], F.col("y"), F.col("window_id"), ridge=ridge)
    return WindowModels(tuple(inputs), scales, weights)


def backfill(panel: DataFrame, cutoffs: Sequence[str], threshold: float, ridge: float = RIDGE, margin: float = MARGIN) -> DataFrame:
    """Per window: rows by split, quality of its model on its test cutoff, and the gate.

    The gate compares with the model of the window before, on the same test rows: a model is
    promoted if its average precision is higher by ``margin``, or if it is the first.
    """
    models = train(panel, cutoffs, ridge=ridge)
    rows = expanding_windows(panel, cutoffs)
    sizes = rows.groupBy("window_id", "test_cutoff").agg(*[
        F.count(F.when(F.col("split") == s, 1)).alias(f"n_{s}") for s in ("train", "validation", "test")])
    test = rows.filter(F.col("split") == "test")
    own = cut(models.score(test.withColumn("model", F.col("window_id")), "model").select("window_id", "y_true", "y_proba"))
    earlier = cut(models.score(test.withColumn("model", F.col("window_id") - 1), "model").select("window_id", "y_true", "y_proba"))
    quality = classification.evaluate(own, threshold, ["window_id"])
    before = classification.ranking_metrics(classification.curve(earlier, ["window_id"]), ["window_id"]).select(
        "window_id", F.col("pr_auc").alias("previous_pr_auc"))
    better = F.round("pr_auc", 4) >= F.round("previous_pr_auc", 4) + margin - 1e-9
    return sizes.join(quality, "window_id", "left").join(before, "window_id", "left").withColumn(
        "promoted", F.col("pr_auc").isNotNull() & F.coalesce(better, F.lit(True)))
