"""Cost-based and capacity-based decision thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import ratio0
from ebbtide.operators.classification import COUNTS, curve, threshold_counts
from ebbtide.params import BOTHER, BUDGET_FRACTIONS, COST_GRID, KEEPS, LOSS, OFFER


Prices = Mapping[str, float]


def prices(
    loss: float = LOSS, bother: float = BOTHER, offer: float = OFFER, keeps: float = KEEPS
) -> dict[str, float]:
    """What one person of each count costs; a kept subscriber still costs the offers that failed."""
    return {"tp": offer + (1.0 - keeps) * loss, "fp": bother, "fn": loss, "tn": 0.0}


def break_even(price: Prices) -> float:
    """The score from which acting costs less than waiting; 1.0 if it never does.

    With chance ``p`` of leaving, acting costs ``p tp + (1 - p) fp`` and waiting ``p fn``.
    """
    saved = price["fn"] - price["tp"]
    return price["fp"] / (price["fp"] + saved) if saved > 0 else 1.0


def with_costs(counts: DataFrame, price: Prices = prices()) -> DataFrame:
    """Price the four counts.  Totals are money: rounded to cents."""
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    n = tp + fp + fn + tn
    total = fn * F.lit(price["fn"]) + fp * F.lit(price["fp"]) + tp * F.lit(price["tp"])
    return counts.withColumns({
        "total_cost": F.round(total, 2),
        "cost_per_subscriber": F.round(ratio0(total, n), 4),
        "flagged": tp + fp,
        "flagged_rate": F.round(ratio0(tp + fp, n), 4),
    })


def ratio_of(price: Prices) -> float:
    """How many needless offers one unnoticed loss is worth; infinite if they are free."""
    return price["fn"] / price["fp"] if price["fp"] else float("inf")


def cost_sweep(
    scored: DataFrame, price: Prices = prices(), grid: Sequence[float] = COST_GRID
) -> DataFrame:
    """Cost at every grid threshold, from one scan."""
    return with_costs(threshold_counts(scored, grid), price)


def _cheapest() -> Column:
    """Arg-min of cost; of equal costs the higher threshold flags fewer people."""
    return F.min_by(
        F.struct("threshold", *COUNTS, "total_cost", "cost_per_subscriber", "flagged",
                 "flagged_rate"),
        F.struct("total_cost", -F.col("threshold")),
    )


def cost_optimal(sweep: DataFrame) -> DataFrame:
    return sweep.agg(_cheapest().alias("best")).select("best.*")


def threshold_report(
    scored: DataFrame, current: float, price: Prices = prices(),
    grid: Sequence[float] = COST_GRID,
) -> DataFrame:
    """Current against analytic and cost-optimal threshold; one scan for all three."""
    analytic = break_even(price)
    table = with_costs(threshold_counts(scored, [*grid, current, analytic]), price)
    detail = F.struct("threshold", "total_cost", "flagged", "flagged_rate",
                      "cost_per_subscriber")
    on_grid = F.col("threshold").isin([float(t) for t in grid])
    report = table.agg(
        F.max(F.when(F.col("threshold") == float(current), detail)).alias("current"),
        F.max(F.when(F.col("threshold") == analytic, detail)).alias("analytic"),
        F.min_by(detail, F.when(on_grid, F.struct("total_cost", -F.col("threshold"))))
        .alias("optimal"),
        F.max(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("population"),
    )
    savings = F.col("current.total_cost") - F.col("optimal.total_cost")
    flat = [
        F.round(F.col(f"{side}.{name}"), 4).alias(f"{side}_{name}") if name == "threshold"
        else F.col(f"{side}.{name}").alias(f"{side}_{name}")
        for side in ("current", "analytic", "optimal")
        for name in ("threshold", "total_cost", "flagged", "flagged_rate", "cost_per_subscriber")
    ]
    return report.select(
        "population", *flat,
        F.lit(round(price["tp"], 2)).alias("cost_true_positive"),
        F.round(F.lit(ratio_of(price)), 2).alias("cost_ratio"),
        F.round(F.abs(F.lit(analytic) - F.col("optimal.threshold")), 4)
        .alias("analytic_vs_empirical_gap"),
        F.round(savings, 2).alias("savings"),
        F.round(ratio0(savings, F.col("population")), 4).alias("savings_per_subscriber"),
        (F.col("optimal.flagged") - F.col("current.flagged")).alias("extra_offers_required"),
    )


def _capped(points: DataFrame, optimum: float, budgets: Sequence[int]) -> DataFrame:
    """Operate each budget at ``max(optimum, k-th score)``: one pass over the curve.

    ``capacity_threshold`` is the lowest score whose whole tie group fits, NULL
    when not even the top group does (then nobody is flagged).
    """
    used = F.col("cum_pos") + F.col("cum_neg")
    picks: list[Column] = [
        F.max("cum_pos").alias("positives"),
        F.max(used).alias("population"),
        F.max("y_proba").alias("top"),
    ]
    for k in budgets:
        fits = used <= k
        picks += [
            F.min(F.when(fits, F.col("y_proba"))).alias(f"cap_{k}"),
            F.max(F.when(fits & (F.col("y_proba") >= optimum),
                         F.struct(used.alias("flagged"), F.col("cum_pos").alias("tp"),
                                  F.col("cum_neg").alias("fp")))).alias(f"at_{k}"),
        ]

    def entry(k: int) -> Column:
        everyone = F.col("population") <= k
        cap = F.when(everyone, 0.0).otherwise(F.col(f"cap_{k}"))
        return F.struct(
            F.lit(k).cast("bigint").alias("max_offers"),
            cap.alias("capacity_threshold"),
            F.greatest(F.lit(optimum), F.coalesce(cap, F.col("top"))).alias("threshold"),
            *[F.coalesce(F.col(f"at_{k}")[c], F.lit(0)).alias(c) for c in ("tp", "fp")],
            F.col("positives"), F.col("population"),
        )

    rows = points.agg(*picks).select(F.explode(F.array(*[entry(k) for k in budgets])).alias("e"))
    return rows.select("e.*").select(
        "max_offers", "capacity_threshold", "threshold", "tp", "fp",
        (F.col("positives") - F.col("tp")).alias("fn"),
        (F.col("population") - F.col("positives") - F.col("fp")).alias("tn"),
    )


def capacity_threshold(scored: DataFrame, max_offers: int) -> DataFrame:
    """The lowest score that fits the budget.  Boundary ties under-fill it."""
    return _capped(curve(scored), 0.0, [max_offers]).select(
        "max_offers", "capacity_threshold",
        (F.col("tp") + F.col("fp")).alias("offers_used"),
    )


def constrained(
    scored: DataFrame, max_offers: int, price: Prices = prices()
) -> DataFrame:
    """Cost at the cheapest threshold that also fits the budget."""
    best = cost_optimal(cost_sweep(scored, price)).first()
    return with_costs(_capped(curve(scored), best["threshold"], [max_offers]), price)


def offers(population: Column, budget: float | None) -> Column:
    """Offers that a budget allows: a number of them, or (below 1, a float) a share; NULL without one."""
    if budget is None:
        return F.lit(None).cast("bigint")
    if budget < 0 or (isinstance(budget, float) and budget > 1):
        raise ValueError("a budget is a number of offers or a share of the population")
    if isinstance(budget, float):
        return F.floor(F.lit(budget) * population).cast("bigint")
    return F.least(F.lit(budget).cast("bigint"), population)


def budget_steps(
    wanted: Column, population: Column, fractions: Sequence[float] = BUDGET_FRACTIONS
) -> Column:
    """Distinct budgets around the wanted number, rising; halves round to even."""
    steps = F.array(*[F.bround(wanted * F.lit(f), 0).cast("bigint") for f in fractions])
    return F.array_sort(F.array_distinct(F.filter(steps, lambda k: (k > 0) & (k <= population))))


def capacity_ladder(
    scored: DataFrame, price: Prices = prices(), points: DataFrame | None = None
) -> DataFrame:
    """What each budget costs and what one more slot is worth.

    The optimum is one row of the sweep; the whole ladder is then one pass over
    the score curve, not one sweep per step.
    """
    everyone = sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0]))
    best = cost_optimal(cost_sweep(scored, price)).select(
        "threshold", budget_steps(F.col("flagged"), everyone).alias("budgets")).first()
    budgets = best["budgets"] or [0]
    table = with_costs(_capped(points if points is not None else curve(scored),
                               best["threshold"], budgets), price)
    # At most six rows.
    order = Window.orderBy("max_offers")
    gained = F.col("max_offers") - F.lag("max_offers").over(order)
    saved = F.lag("total_cost").over(order) - F.col("total_cost")
    return table.filter(F.col("max_offers") > 0).select(
        "max_offers", F.round("threshold", 4).alias("threshold"),
        F.col("flagged").alias("offers_used"), "total_cost",
        F.round(F.try_divide(saved, gained.cast("double")), 2).alias("value_per_extra_slot"),
    )


def capacity_report(
    scored: DataFrame, budget: float | None = None, price: Prices = prices(),
    points: DataFrame | None = None,
) -> DataFrame:
    """Whether the budget binds, the shortfall and what the cap costs."""
    everyone = sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0]))
    best = cost_optimal(cost_sweep(scored, price)).withColumns(
        {"population": everyone, "allowed": offers(everyone, budget)}).first()
    population, wanted, allowed = best["population"], best["flagged"], best["allowed"]
    k = population if allowed is None else allowed
    table = with_costs(_capped(points if points is not None else curve(scored),
                               best["threshold"], [k]), price)
    capped = F.lit(allowed is not None)
    return table.select(
        F.lit(population).cast("bigint").alias("population"),
        F.lit(budget is not None).alias("configured"),
        F.lit(allowed).cast("bigint").alias("max_offers"),
        F.lit(best["threshold"]).alias("unconstrained_threshold"),
        F.lit(wanted).cast("bigint").alias("offers_required"),
        F.lit(best["total_cost"]).alias("unconstrained_cost"),
        F.when(capped, F.round("threshold", 4)).alias("constrained_threshold"),
        F.when(capped, F.col("flagged")).alias("constrained_flagged"),
        F.when(capped, F.col("total_cost")).alias("constrained_cost"),
        (capped & (F.col("flagged") < wanted)).alias("binding"),
        F.lit(0 if allowed is None else max(wanted - allowed, 0)).cast("bigint")
        .alias("shortfall"),
        F.when(capped, F.round(F.col("total_cost") - F.lit(best["total_cost"]), 2))
        .otherwise(0.0).alias("cost_of_constraint"),
    )
