"""Logistic models by Newton's method, where a step is one aggregate.

A step needs the sums of the loss, its gradient and its curvature.  They are plain sums over
rows, so they combine map-side and one scan serves every group of rows that has a model of its
own.  What comes to the driver is a square of the number of inputs per group, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import small_table

STEPS, TOLERANCE = 60, 1e-10


def logit(p: Column) -> Column:
    """Log-odds; 0 and 1 count as the nearest numbers that have any."""
    inside = F.greatest(F.least(p, F.lit(1 - 1e-15)), F.lit(1e-15))
    return F.ln(inside / (1 - inside))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def fit(
    rows: DataFrame, inputs: Sequence[Column], target: Column, group: Column | None = None,
    weight: Column | None = None, ridge: float = 0.0,
) -> dict:
    """Intercept and weights per value of ``group`` (one model under 0 without it).

    Minimises the weighted logistic loss plus half ``ridge`` times the squared weights, the
    intercept left out.  Targets may lie between 0 and 1.  ``rows`` is read once per step, so
    it should be stored.  A step that makes the objective worse is halved; curvature that
    cannot be inverted takes the shortest step.
    """
    d = len(inputs) + 1
    names = [f"x{i}" for i in range(d)]
    group = F.lit(0) if group is None else group
    weight = F.lit(1.0) if weight is None else weight
    base = rows.select(
        group.alias("g"), target.cast("double").alias("y"), weight.cast("double").alias("weight"),
        F.lit(1.0).alias("x0"), *[c.cast("double").alias(n) for c, n in zip(inputs, names[1:], strict=True)])
    kind = base.schema["g"].dataType
    groups = [r["g"] for r in base.select("g").distinct().collect()]  # one number per model
    at = {g: np.zeros(d) for g in groups}
    best: dict = {}
    penalty = np.full(d, ridge)
    penalty[0] = 0.0
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    todo = set(groups)
    for _ in range(STEPS):
        if not todo:
            break
        arrow = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind.simpleString()]
        known = small_table(rows.sparkSession, [{"g": g, "w": at[g].tolist()} for g in sorted(todo)],
                            pa.schema([("g", arrow), ("w", pa.list_(pa.float64()))]))
        z = sum((F.col(n) * F.get("w", F.lit(i)) for i, n in enumerate(names)), F.lit(0.0))
        scored = base.join(F.broadcast(known), "g").withColumn("z", z).withColumn("p", sigmoid(F.col("z")))
        scored = scored.withColumns({"r": F.col("weight") * (F.col("y") - F.col("p")), "h": F.col("weight") * F.col("p") * (1 - F.col("p"))})
        loss = F.col("weight") * (F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z"))
        sums = scored.groupBy("g").agg(
            F.sum(loss).alias("loss"), *[F.sum(F.col("r") * F.col(n)).alias(f"g{i}") for i, n in enumerate(names)],
            *[F.sum(F.col("h") * F.col(names[i]) * F.col(names[j])).alias(f"h{i}_{j}") for i, j in pairs]).collect()
        for s in sums:
            g = s["g"]
            value = s["loss"] + 0.5 * float(penalty @ at[g] ** 2)
            if g in best and value > best[g][0] + 1e-9 * abs(best[g][0]):
                at[g] = (at[g] + best[g][1]) / 2  # too far
                if np.abs(at[g] - best[g][1]).max() < TOLERANCE:
                    at[g] = best[g][1]
                    todo.discard(g)
                continue
            best[g] = (value, at[g])
            gradient = np.array([s[f"g{i}"] for i in range(d)]) - penalty * at[g]
            curve = np.diag(penalty)
            for i, j in pairs:
                curve[i, j] += s[f"h{i}_{j}"]
                curve[j, i] = curve[i, j]
            move = np.linalg.lstsq(curve, gradient, rcond=None)[0]
            at[g] = at[g] + move
            if np.abs(move).max() < TOLERANCE:
                todo.discard(g)
    return {g: w.tolist() for g, w in at.items()}
