"""Batch scoring, explanations and what-if scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions import risk
from ebbtide.functions.columns import clip
from ebbtide.functions.explain import with_attributions
from ebbtide.functions.linear import LOGIT_LIMIT, LinearModel, logistic
from ebbtide.params import DECISION_THRESHOLD


def predict(
    df: DataFrame, model: LinearModel, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Probability, label, band and the rule-based explanation, per row."""
    scored = model.score(df, "dropout_probability")
    p = F.col("dropout_probability")
    return scored.withColumns({
        "predicted_label": risk.label(p, threshold),
        "risk_level": risk.band(p, threshold),
        "factors": risk.risk_factors(),
        "signals": risk.retention_signals(),
    }).withColumns({
        "explanation": risk.rule_explanation(
            F.col("risk_level"), p, F.col("factors"), F.col("signals")),
        "top_risk_factors": F.slice("factors", 1, 3),
        "explanation_method": F.lit("rules"),
    })


def predict_explained(
    df: DataFrame, model: LinearModel, explainer: LinearModel,
    threshold: float = DECISION_THRESHOLD, limit: int = 3,
) -> DataFrame:
    """Like :func:`predict`, explained by attributions where a row has any.

    The sentence quotes both directions; ``top_risk_factors`` only those that
    raise the risk.  Rows without attributions keep the rule-based text.
    """
    rows = with_attributions(predict(df, model, threshold), explainer, limit)
    found = F.size("attributions") > 0
    texts = F.col("attributions")["description"]
    raising = F.filter("attributions", lambda a: a["contribution"] > 0)["description"]
    return rows.withColumns({
        "explanation": F.when(
            found,
            risk.sentence(F.col("risk_level"), F.col("dropout_probability"),
                          F.array_join(texts, ", ")),
        ).otherwise(F.col("explanation")),
        "top_risk_factors": F.when(found, raising).otherwise(F.col("top_risk_factors")),
        "explanation_method": F.when(found, "attribution").otherwise(F.col("explanation_method")),
    })


def what_if(
    df: DataFrame, model: LinearModel, levers: Sequence[tuple[str, float | bool | str]],
    key: Sequence[str] = ("subscriber_id",),
) -> DataFrame:
    """Re-score each row once per lever with exactly that input changed.

    ``levers`` are (column, new value).  A lever that leaves the row unchanged is
    dropped, as is one whose column the model does not use.  The fan-out is the
    number of levers; nothing is shuffled.
    """
    used = [name for name, _, _ in model.terms]

    def rescored(column: str, value: float | bool | str) -> Column:
        total = F.lit(model.intercept)
        for name, weight, centre in model.terms:
            if name == column:
                x = F.lit(value).cast("double")
                total = total + F.lit(weight) * (x - F.lit(centre) if centre else x)
            else:
                total = total + model.contribution(name, weight, centre)
        return logistic(clip(total, -LOGIT_LIMIT, LOGIT_LIMIT))

    types = {f.name: f.dataType for f in schemas.MODEL_INPUT_SCHEMA}
    options = F.array(*[
        F.when(
            F.col(column) != F.lit(value).cast(types[column]),
            F.struct(
                F.lit(column).alias("lever"), F.lit(str(value).lower()).alias("new_value"),
                F.col(column).cast("string").alias("old_value"),
                rescored(column, value).alias("new_probability"),
            ),
        )
        for column, value in levers if column in used
    ])
    return (
        model.score(df, "old_probability")
        .select(*key, "old_probability", F.explode(F.array_compact(options)).alias("o"))
        .select(*key, "o.*", "old_probability",
                (F.col("o.new_probability") - F.col("old_probability")).alias("delta"))
    )


def score_foreign(
    df: DataFrame, predict_proba: Callable[[pd.DataFrame], Sequence[float]],
    key: Sequence[str] = ("subscriber_id",), output: str = "y_proba",
) -> DataFrame:
    """Score with a model Spark cannot express, in Arrow batches.

    ``predict_proba`` gets the nine inputs of a batch and must be picklable; it
    sees one batch at a time, never a whole partition.
    """
    rows = df.select(*key, *schemas.MODEL_INPUTS)
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    kept = ", ".join(f"{k} {fields[k]}" for k in key)
    inputs = list(schemas.MODEL_INPUTS)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[list(key)].assign(**{output: list(predict_proba(batch[inputs]))})

    return rows.mapInPandas(score, f"{kept}, {output} double")
