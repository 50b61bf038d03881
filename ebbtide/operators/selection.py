"""Exact quantiles of many columns by bracket and count.

The first scan sketches every column at once: approximate quantiles a little below and above
each wanted rank bracket it, beside count, mean, deviation and range.  The second scan counts
the rows between the brackets and keeps, summed by value, only what lies inside one: about
``4 / ACCURACY`` of the rows.  The wanted value is then read off by its rank.  What is shuffled
are sketches and the insides of brackets, never the column.

Where a bracket still holds more than ``WITHIN`` rows it is sketched again by itself, which
narrows it by the same factor; a bracket that misses its rank is widened.  So the result is
exact at any size, and no task ranks more than the insides of a column's brackets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import finite
from ebbtide.session import small_table

#: Accuracy of the sketches: ranks are off by one part in so many at most.
ACCURACY = 10_000
#: Rows of one bracket that are ranked one by one.
WITHIN = 200_000
#: Widths of a bracket on either side, in parts of the rank error, until the rank is inside.
MARGINS = (2, 32, 512)

STATS = ("n", "mean", "std", "min", "max")
Interval = tuple[float, float]


def _summary(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> dict[str, dict]:
    """Counts, moments, range and approximate quantiles of every column, in one scan."""
    picked = []
    for c in columns:
        v = finite(F.col(c))
        picked.append(F.struct(
            F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.percentile_approx(v, [float(p) for p in points] or [0.5], ACCURACY).alias("near"),
        ).alias(c))
    return {c: value.asDict() for c, value in df.agg(*picked).first().asDict().items()}  # a few numbers a column


def _merged(brackets: list[Interval]) -> list[Interval]:
    """Overlapping brackets as one interval each, in order."""
    out: list[Interval] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _slot(value: Column, intervals: Sequence[Interval]) -> Column:
    """Odd inside an interval, even between them, growing with the value."""
    total = F.lit(0)
    for low, high in intervals:
        total = total + (value >= low).cast("int") + (value > high).cast("int")
    return total


def _slots(df: DataFrame, intervals: dict[str, list[Interval]], keep: bool) -> DataFrame:
    """Rows per feature and slot; with ``keep`` those inside an interval by value."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), finite(F.col(c)).alias("value"), _slot(finite(F.col(c)), own).alias("slot"))
        for c, own in intervals.items()
    ])
    rows = df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull())
    inside = F.when(F.col("slot") % 2 == 1, F.col("value")) if keep else F.lit(None).cast("double")
    return rows.groupBy("feature", "slot", inside.alias("kept")).agg(
        F.count("*").alias("rows"), F.min("value").alias("least"), F.max("value").alias("most"))


def _narrowed(df: DataFrame, intervals: dict[str, list[Interval]], ranks: dict[str, list[int]]) -> dict[str, list[Interval]]:
    """Intervals that hold few rows or one value: the crowded ones are sketched by themselves."""
    while True:
        held = {(r["feature"], r["slot"]): r["rows"] for r in _slots(df, intervals, keep=False).collect()}  # slots a column
        todo: list[tuple[str, int, list[float], Column]] = []
        for c, own in intervals.items():
            before = 0
            for i, (low, high) in enumerate(own):
                before += held.get((c, 2 * i), 0)
                inside = held.get((c, 2 * i + 1), 0)
                if inside > WITHIN and low < high:
                    points = []
                    for r in ranks[c]:
                        if before - 1 <= r <= before + inside:
                            at, off = (r - before) / inside, MARGINS[0] / ACCURACY + 1 / inside
                            points += [max(0.0, at - off), min(1.0, at + off)]
                    v = finite(F.col(c))
                    todo.append((c, i, points, F.percentile_approx(F.when((v >= low) & (v <= high), v), points or [0.5], ACCURACY)))
                before += inside
        if not todo:
            return intervals
        found = df.agg(*[F.struct(x[3].alias("q")).alias(f"t{i}") for i, x in enumerate(todo)]).first()
        new = {c: list(own) for c, own in intervals.items()}
        for i, (c, at, points, _) in enumerate(todo):
            q = found[f"t{i}"]["q"]
            new[c].remove(intervals[c][at])
            new[c] += list(zip(q[::2], q[1::2], strict=False)) if points else []
        narrowed = {c: _merged(own) for c, own in new.items()}
        if narrowed == intervals:
            return intervals
        intervals = narrowed


def _ranked(df: DataFrame, intervals: dict[str, list[Interval]], ranks: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """The values at the given ranks (from 0) that the intervals hold, or that lie next to them."""
    rows = _slots(df, intervals, keep=True)
    order = Window.partitionBy("feature").orderBy("slot", "kept")  # the insides of a column's brackets
    rows = rows.withColumn("end", F.sum("rows").over(order)).withColumn("start", F.col("end") - F.col("rows"))
    # One row per wanted rank: columns times probabilities.
    wanted = small_table(df.sparkSession, [{"feature": c, "rank": r} for c, own in ranks.items() for r in sorted(set(own))],
                         pa.schema([("feature", pa.string()), ("rank", pa.int64())]))
    found = rows.join(F.broadcast(wanted), "feature").filter((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("end")))
    value = F.coalesce("kept", F.when(F.col("rank") == F.col("start"), F.col("least")).when(
        F.col("rank") == F.col("end") - 1, F.col("most")))
    return {(r["feature"], r["rank"]): r["value"] for r in found.select("feature", "rank", value.alias("value")).collect() if r["value"] is not None}


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], interpolate: bool = True
) -> DataFrame:
    """One row per column: ``feature``, ``n``, ``mean``, ``std``, ``min``, ``max`` and quantiles ``q``.

    Only finite numbers count.  Linear interpolation between neighbours, or the lower
    neighbour.  A column without a number has ``n`` 0 and nulls.  ``df`` is read twice,
    so store it if it is costly.
    """
    inner = sorted({p for p in probabilities if 0 < p < 1})
    off = MARGINS[0] / ACCURACY
    points = [x for p in inner for x in (max(0.0, p - off), min(1.0, p + off))]
    facts = _summary(df, columns, points)
    full = [c for c in columns if facts[c]["n"]]

    def place(c: str, p: float) -> float:
        n = facts[c]["n"]
        return p * (n - 1 if interpolate else n)

    ranks = {c: [r for p in inner for r in (math.floor(place(c, p)), min(math.ceil(place(c, p)), facts[c]["n"] - 1))] for c in full}
    near = {c: dict(zip(points, facts[c]["near"], strict=True)) if points else {} for c in full}
    intervals = {c: _merged([(near[c][max(0.0, p - off)], near[c][min(1.0, p + off)]) for p in inner]) for c in full}
    values: dict[tuple[str, int], float] = {}
    missing = ranks if inner else {}
    for margin in MARGINS[1:] + (None,):
        if not any(missing.values()):
            break
        intervals = {c: intervals[c] for c in missing if missing[c]}
        # The common case needs no narrowing: the sketch leaves so few rows inside.
        if max(facts[c]["n"] for c in intervals) * 2 * MARGINS[0] / ACCURACY > WITHIN:
            intervals = _narrowed(df, intervals, missing)
        values |= _ranked(df, intervals, {c: missing[c] for c in intervals})
        missing = {c: [r for r in own if (c, r) not in values] for c, own in ranks.items()}
        wide = [c for c in missing if missing[c]]
        if wide and margin:
            ps = {c: [(max(0.0, (r - 1) / facts[c]["n"] - margin / ACCURACY), min(1.0, (r + 2) / facts[c]["n"] + margin / ACCURACY))
                      for r in missing[c]] for c in wide}
            again = df.agg(*[
                F.struct(F.percentile_approx(finite(F.col(c)), [x for p in ps[c] for x in p], ACCURACY).alias("q")).alias(c) for c in wide
            ]).first()
            intervals = {c: _merged(list(zip(again[c]["q"][::2], again[c]["q"][1::2], strict=True))) for c in wide}
        elif wide:
            intervals = {c: [(facts[c]["min"], facts[c]["max"])] for c in wide}
            intervals = _narrowed(df, intervals, missing)
            values |= _ranked(df, intervals, {c: missing[c] for c in wide})

    def quantile(c: str, p: float) -> float:
        if p <= 0:
            return facts[c]["min"]
        if p >= 1:
            return facts[c]["max"]
        low = values[c, math.floor(place(c, p))]
        if not interpolate:
            return low
        high = values[c, min(math.ceil(place(c, p)), facts[c]["n"] - 1)]
        return low + (high - low) * (place(c, p) - math.floor(place(c, p)))

    rows = [{"feature": c, **{s: facts[c][s] for s in STATS}, "q": [quantile(c, p) for p in probabilities] if c in full else None} for c in columns]
    schema = pa.schema([("feature", pa.string()), ("n", pa.int64()), *[(s, pa.float64()) for s in STATS[1:]], ("q", pa.list_(pa.float64()))])
    return small_table(df.sparkSession, rows, schema)
