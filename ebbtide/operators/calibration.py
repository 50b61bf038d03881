"""How far probabilities can be trusted as probabilities."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import interval_index, ratio
from ebbtide.operators import newton
from ebbtide.operators.ranks import BUCKET, value_counts
from ebbtide.session import cut

BINS = 10
METHODS = ("isotonic", "sigmoid")
#: Neighbouring ranges whose blocks one task pools, and cells that scores are looked up by.
FAN, CELLS = 16, 4_096


def _edges(bins: int) -> list[float]:
    return [i * (1.0 / bins) for i in range(bins + 1)]


def reliability_bins(scored: DataFrame, bins: int = BINS, keys: Sequence[str] = ()) -> DataFrame:
    """Sums per equal-width, right-closed bin: at most ``bins`` rows per key."""
    p, y = F.col("y_proba"), F.col("y_true").cast("double")
    index = interval_index(p, _edges(bins)[1:-1], closed="right").alias("bin")
    return scored.groupBy(*keys, index).agg(
        F.count("*").alias("n"), F.sum(p).alias("sum_p"), F.sum(y).alias("sum_y"),
        F.sum((p - y) * (p - y)).alias("sum_sq"),
    )


def reliability(scored: DataFrame, bins: int = BINS) -> DataFrame:
    """The reliability table; an empty bin is a row with NULL statistics."""
    edges = F.array(*[F.lit(round(e, 3)) for e in _edges(bins)])
    spine = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    table = spine.join(reliability_bins(scored, bins), "bin", "left")
    mean_p, mean_y = ratio(F.col("sum_p"), F.col("n")), ratio(F.col("sum_y"), F.col("n"))
    return table.select(
        "bin", F.get(edges, F.col("bin")).alias("bin_lower"),
        F.get(edges, F.col("bin") + 1).alias("bin_upper"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        F.round(mean_p, 4).alias("mean_predicted"), F.round(mean_y, 4).alias("observed_rate"),
        F.round(mean_p - mean_y, 4).alias("gap"),
    )


def calibration_metrics(
    scored: DataFrame, bins: int = BINS, keys: Sequence[str] = ()
) -> DataFrame:
    """Brier score, expected calibration error, means and bias: one scan."""
    n, total = F.col("n"), F.sum("n")
    gap = F.abs(F.col("sum_p") / n - F.col("sum_y") / n)
    mean_p, mean_y = F.sum("sum_p") / total, F.sum("sum_y") / total
    return reliability_bins(scored, bins, keys).groupBy(*keys).agg(
        F.round(F.sum("sum_sq") / total, 5).alias("brier_score"),
        F.round(F.sum(n * gap) / total, 5).alias("expected_calibration_error"),
        F.round(mean_p, 4).alias("mean_predicted"),
        F.round(mean_y, 4).alias("observed_rate"),
        F.round(mean_p - mean_y, 4).alias("mean_bias"),
        total.alias("n_samples"),
    )


def compare_calibration(
    scored: DataFrame, raw: str, calibrated: str, bins: int = BINS
) -> DataFrame:
    """Before and after in one scan; improved means a strictly lower rounded ECE."""
    versions = F.explode(F.array(
        F.struct(F.lit("before").alias("version"), F.col(raw).alias("y_proba")),
        F.struct(F.lit("after").alias("version"), F.col(calibrated).alias("y_proba")),
    ))
    both = calibration_metrics(
        scored.select("y_true", versions.alias("v")).select("y_true", "v.*"), bins, ["version"]
    )

    def value(version: str, metric: str):
        return F.max(F.when(F.col("version") == version, F.col(metric)))

    ece = "expected_calibration_error"
    return both.agg(
        value("before", "brier_score").alias("brier_before"),
        value("after", "brier_score").alias("brier_after"),
        value("before", ece).alias("ece_before"),
        value("after", ece).alias("ece_after"),
    ).select(
        "*",
        F.round(F.col("brier_before") - F.col("brier_after"), 5).alias("brier_improvement"),
        F.round(F.col("ece_before") - F.col("ece_after"), 5).alias("ece_improvement"),
        (F.col("ece_after") < F.col("ece_before")).alias("improved"),
    )


def _pool(lo: list, hi: list, n: list, pos: list) -> list[tuple]:
    """Neighbouring blocks pooled until their means rise, with whole numbers throughout."""
    out: list[tuple] = []
    for a, b, rows, hits in zip(lo, hi, n, pos, strict=True):
        while out and out[-1][3] * rows >= hits * out[-1][2]:
            a, _, more, also = out.pop()
            rows, hits = rows + more, hits + also
        out.append((a, b, rows, hits))
    return out


def isotonic_blocks(held_out: DataFrame) -> DataFrame:
    """Blocks of scores with equal fitted probability: ``lo``, ``hi``, ``n``, ``positives``, ``mean``.

    Violators are pooled within ranges of the score, then the blocks of ``FAN`` neighbouring
    ranges are pooled together, round by round.  That is right in any order, since the blocks
    are the sides of the convex minorant of the running sums, and the minorant of parts can
    stand for the parts.  Such a minorant over whole numbers has about ``n ** (2 / 3)``
    sides at most, which bounds what the last task holds.
    """
    y = F.col("y_true").cast("bigint")
    ranged = value_counts(held_out, [], "y_proba", {"n": F.lit(1), "pos": y})
    blocks = ranged.select(F.col(BUCKET).alias("range"), F.col("y_proba").alias("lo"), F.col("y_proba").alias("hi"), "n", "pos")
    schema = "range int, lo double, hi double, n bigint, pos bigint"

    def pooled(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lo")
        found = _pool(*[rows[c].tolist() for c in ("lo", "hi", "n", "pos")])
        return pd.DataFrame(found, columns=["lo", "hi", "n", "pos"]).assign(range=int(rows["range"].min()))[["range", "lo", "hi", "n", "pos"]]

    last = ranged.agg(F.max(BUCKET)).first()[0] or 0
    width = 1
    while True:
        blocks = cut(blocks.groupBy(F.floor(F.col("range") / width).alias("part")).applyInPandas(pooled, schema))
        if width > last:
            return blocks.select("lo", "hi", "n", F.col("pos").alias("positives"), (F.col("pos") / F.col("n")).alias("mean"))
        width *= FAN


def _segments(blocks: DataFrame) -> DataFrame:
    """Straight pieces of the fitted map: level along a block, linear between blocks."""
    order = Window.orderBy("lo")  # the blocks alone
    ahead = blocks.select("lo", "hi", "mean", F.lead("lo").over(order).alias("next_lo"), F.lead("mean").over(order).alias("next_mean"),
                          F.lag("lo").over(order).isNull().alias("first"))
    inf = float("inf")
    level = F.struct(
        F.when(F.col("first"), F.lit(-inf)).otherwise(F.col("lo")).alias("x0"), F.col("mean").alias("y0"),
        F.when(F.col("next_lo").isNull(), F.lit(inf)).otherwise(F.col("hi")).alias("x1"), F.col("mean").alias("y1"))
    gap = F.struct(F.col("hi").alias("x0"), F.col("mean").alias("y0"), F.col("next_lo").alias("x1"), F.col("next_mean").alias("y1"))
    return ahead.select(F.explode(F.filter(F.array(level, gap), lambda s: s["x1"].isNotNull())).alias("s")).select("s.*")


def isotonic_map(blocks: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Adds ``calibrated``, read off the pieces of the cell that a score lies in."""
    cell = lambda x: F.least(F.greatest(F.floor(x * CELLS), F.lit(0)), F.lit(CELLS - 1)).cast("int")
    bounded = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    pieces = _segments(blocks)
    spread = F.explode(F.sequence(cell(bounded(F.col("x0"))), cell(bounded(F.col("x1")))))
    by_cell = cut(pieces.select(spread.alias("_cell"), F.struct("x0", "y0", "x1", "y1").alias("s")).groupBy("_cell").agg(
        F.collect_list("s").alias("_pieces")))  # the blocks and one row a cell

    def transform(scored: DataFrame) -> DataFrame:
        p = F.col("y_proba")
        piece = F.element_at(F.filter("_pieces", lambda s: (s["x0"] <= p) & (p <= s["x1"])), 1)
        flat = (piece["y0"] == piece["y1"]) | (p == piece["x0"])
        along = piece["y0"] + (piece["y1"] - piece["y0"]) * (p - piece["x0"]) / (piece["x1"] - piece["x0"])
        joined = scored.withColumn("_cell", cell(p)).join(by_cell, "_cell", "left")
        return joined.withColumn("calibrated", F.when(flat, piece["y0"]).otherwise(along)).drop("_cell", "_pieces")

    return transform


def sigmoid_weights(held_out: DataFrame) -> list[float]:
    """Intercept and slope of a logistic curve over the log-odds of the score.

    Labels are drawn in towards the middle by one row of either class, so scores that
    separate the classes still have a finite fit.
    """
    rows = cut(held_out.groupBy("y_proba", "y_true").agg(F.count("*").alias("weight")))
    total = rows.agg(F.sum(F.when(F.col("y_true") == 1, F.col("weight")).otherwise(0)).alias("pos"), F.sum("weight").alias("n")).first()
    pos = total["pos"] or 0
    neg = (total["n"] or 0) - pos
    target = F.when(F.col("y_true") == 1, F.lit((pos + 1.0) / (pos + 2.0))).otherwise(F.lit(1.0 / (neg + 2.0)))
    fitted = newton.fit(rows, [newton.logit(F.col("y_proba"))], target, weight=F.col("weight"))
    return fitted.get(0, [0.0, 1.0])


def fit_calibration(held_out: DataFrame, method: str = "isotonic") -> Callable[[DataFrame], DataFrame]:
    """Fit a map from score to probability on rows the model has not seen.

    Rows first collapse to one row per distinct score (and label).  Returns a function adding
    ``calibrated`` to a scored table.  Without rows the isotonic map gives NULL and the
    sigmoid leaves scores as they are.
    """
    if method not in METHODS:
        raise ValueError(f"unknown calibration method {method!r}; use isotonic or sigmoid")
    if method == "isotonic":
        return isotonic_map(isotonic_blocks(held_out))
    intercept, slope = sigmoid_weights(held_out)
    return lambda scored: scored.withColumn(
        "calibrated", newton.sigmoid(F.lit(intercept) + F.lit(slope) * newton.logit(F.col("y_proba"))))
