"""Contributions of features to a fitted tree model's log-odds, exact per row.

A tree's expectation given some features follows the row at splits on those and the training
rows' shares at the others.  A feature's contribution is its Shapley value over these
expectations.  Per leaf it depends on two numbers for each feature of the leaf's path: the share
of rows that the path keeps, and whether the row itself takes it.  So the model becomes a table
with one row per leaf and feature of its path (:func:`leaf_table`), as large as the model, and a
row's contributions are sums over that table.

Contributions and base add up to the model's log-odds on every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.prep import feature_names, with_label

#: A boosted model's probability is the logistic curve of twice its margin.
ODDS = 2.0


def node_table(model: PipelineModel, path: str) -> DataFrame:
    """The nodes of all trees, as the saved model lists them, with each tree's weight.

    ``tree``, ``weight``, ``node``, ``prediction``, ``rows``, ``left``, ``right``, ``feature``,
    ``threshold`` (null at a category split) and ``categories`` that go left.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    trees = model.stages[-1]
    trees.write().overwrite().save(path)
    weights = F.array(*[F.lit(float(w)) for w in trees.treeWeights])
    n = F.col("nodeData")
    split = n["split"]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.get(weights, F.col("treeID")).alias("weight"), n["id"].alias("node"), n["prediction"].alias("prediction"),
        n["rawCount"].cast("double").alias("rows"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        split["featureIndex"].alias("feature"),
        F.when(split["numCategories"] == -1, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(split["numCategories"] >= 0, split["leftCategoriesOrThreshold"]).alias("categories"),
    )


def leaf_table(nodes: pd.DataFrame) -> tuple[pd.DataFrame, float]:
    """One row per leaf and feature of its path, and the base: the trees' mean log-odds.

    ``leaf``, ``value`` (of the leaf, in log-odds), ``feature``, ``share`` (of the rows that its
    splits on the path keep), ``low`` and ``high`` (the values that take the path) and ``allowed``
    (the categories that do, else None).
    """
    out, base, leaf = [], 0.0, 0
    for tree, own in nodes.groupby("tree"):
        by = {int(r["node"]): r for r in own.to_dict("records")}
        stack = [(min(by), 1.0, {})]
        while stack:
            at, reach, path = stack.pop()
            r = by[at]
            if r["left"] < 0:
                value = ODDS * r["weight"] * r["prediction"]
                base += value * reach
                for feature, (share, low, high, allowed) in path.items():
                    out.append((leaf, value, feature, share, low, high, allowed))
                leaf += 1
                continue
            feature = int(r["feature"])
            for child, goes_left in ((int(r["left"]), True), (int(r["right"]), False)):
                part = by[child]["rows"] / r["rows"] if r["rows"] else 0.5
                share, low, high, allowed = path.get(feature, (1.0, -math.inf, math.inf, None))
                if r["categories"] is not None and not np.isscalar(r["categories"]):
                    left = frozenset(float(c) for c in r["categories"])
                    rule = (left, goes_left)
                    allowed = (allowed or ()) + (rule,)
                elif goes_left:
                    high = min(high, r["threshold"])
                else:
                    low = max(low, r["threshold"])
                stack.append((child, reach * part, {**path, feature: (share * part, low, high, allowed)}))
    return pd.DataFrame(out, columns=["leaf", "value", "feature", "share", "low", "high", "allowed"]), base


def _weights(size: int) -> list[float]:
    """Shapley weight of a set of each size out of the other features of a path."""
    return [math.factorial(k) * math.factorial(size - k - 1) / math.factorial(size) for k in range(size)]


def contributions(x: np.ndarray, leaves: pd.DataFrame) -> np.ndarray:
    """Shapley values of rows ``x``, one column per feature."""
    out = np.zeros(x.shape)
    for _, path in leaves.groupby("leaf"):
        value, d = float(path["value"].iloc[0]), len(path)
        taken, shares = [], path["share"].tolist()
        for feature, low, high, allowed in zip(path["feature"], path["low"], path["high"], path["allowed"], strict=True):
            v = x[:, feature]
            fits = (v > low) & (v <= high)
            for left, goes_left in allowed or ():
                fits &= np.isin(v, list(left)) == goes_left
            taken.append(fits.astype(float))
        weight = _weights(d)
        for i, feature in enumerate(path["feature"]):
            others = [j for j in range(d) if j != i]
            total = np.zeros(len(x))
            for k in range(d):
                for known in combinations(others, k):
                    part = np.full(len(x), weight[k])
                    for j in others:
                        part *= taken[j] if j in known else shares[j]
                    total += part
            out[:, feature] += value * (taken[i] - shares[i]) * total
    return out


def explain(model: PipelineModel, df: DataFrame, path: str, *carry: str) -> DataFrame:
    """``base``, ``log_odds`` and ``contributions`` (feature to value) per row; ``path`` takes the model.

    The table of leaves is as large as the model and goes to the tasks.
    """
    nodes = node_table(model, path).toPandas()  # trees times nodes
    leaves, base = leaf_table(nodes)
    names = feature_names(model, df)
    scored = model.transform(with_label(df)).select(
        *carry, vector_to_array("features").alias("x"), (ODDS * vector_to_array("rawPrediction")[1]).alias("log_odds"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = contributions(np.stack(batch["x"].to_numpy()), leaves)
                yield batch.drop(columns="x").assign(base=base, parts=list(found))

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.schema if f.name != "x")
    rows = scored.mapInPandas(run, f"{kept}, base double, parts array<double>")
    return rows.withColumn("contributions", F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.col("parts"))).drop("parts")
