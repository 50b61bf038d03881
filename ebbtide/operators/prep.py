"""Preprocessing (impute, scale, one-hot) and the boosted-tree pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions.features import add_derived, plan_dummies
from ebbtide.operators.selection import column_quantiles


@dataclass(frozen=True)
class Preprocessor:
    """Fitted statistics: a few numbers per feature."""

    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]
    modes: dict[str, str]

    def scaled(self, name: str) -> Column:
        """Median-imputed, centred, divided by the population deviation."""
        filled = F.coalesce(F.col(name).cast("double"), F.lit(self.medians[name]))
        return (filled - F.lit(self.means[name])) / F.lit(self.deviations[name] or 1.0)

    def transform(self, df: DataFrame, *carry: str) -> DataFrame:
        """The 21 model columns: scaled numbers, plan dummies, flags."""
        rows = add_derived(df).withColumns({
            name: F.coalesce(F.col(name), F.lit(mode)) for name, mode in self.modes.items()
        })
        return rows.select(
            *carry,
            *[self.scaled(n).alias(n) for n in schemas.NUMERIC],
            *[c.alias(n) for n, c in plan_dummies().items()],
            *[F.col(n).cast("double").alias(n) for n in schemas.BINARY],
        )


def category_modes(df: DataFrame, columns: Sequence[str] = schemas.CATEGORICAL) -> dict[str, str]:
    """Most frequent value per column; the smallest wins a tie.  One scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns])
    counts = df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("category").isNotNull()).groupBy(
        "feature", "category").agg(F.count("*").alias("n"))
    modes = counts.groupBy("feature").agg(F.min_by("category", F.struct(-F.col("n"), "category")).alias("mode"))
    found = {r["feature"]: r["mode"] for r in modes.collect()}  # one row per column
    return {c: found.get(c) for c in columns}


def fit_preprocessor(train: DataFrame) -> Preprocessor:
    """Exact medians, then means and deviations of the imputed columns.

    The imputed moments follow from those of the numbers there are: the values put in all
    equal the median.
    """
    derived = add_derived(train)
    total = derived.count()
    medians, means, deviations = {}, {}, {}
    for r in column_quantiles(derived, schemas.NUMERIC, [0.5]).collect():
        name, n = r["feature"], r["n"]
        medians[name] = r["q"][0] if n else 0.0
        part = n / total if total else 0.0
        mean, std = (r["mean"], r["std"]) if n else (0.0, 0.0)
        off = mean - medians[name]
        means[name] = medians[name] + part * off
        deviations[name] = (part * std**2 + part * (1 - part) * off**2) ** 0.5
    return Preprocessor(medians, means, deviations, category_modes(train))


# Boosting parameters.
GBT = dict(maxIter=300, stepSize=0.05, maxDepth=3, subsamplingRate=0.9, minInstancesPerNode=20,
           seed=42)


def tree_pipeline(fitted: Preprocessor, **overrides) -> Pipeline:
    """Raw rows to probability, as one saveable object."""
    params = {**GBT, **overrides}
    months, third, sixth = "30.44D", "3.0D", "6.0D"
    derive = SQLTransformer(statement=f"""
        SELECT *, CAST(is_auto_renew_enabled AS DOUBLE) AS f_is_auto_renew_enabled,
          CAST(last_activity_days_ago > 21 AS DOUBLE) AS f_is_dormant,
          tenure_days / {months} AS tenure_months,
          avg_session_count_last_30d / 30.0D AS sessions_per_day_last_30d,
          last_activity_days_ago / (tenure_days + 1.0D) AS recency_ratio,
          avg_session_count_last_30d / (last_activity_days_ago + 1.0D)
            AS engagement_recency_score,
          monthly_fee / (avg_session_count_last_30d + 1.0D) AS fee_per_session,
          support_tickets_last_90d / {third} AS support_tickets_per_month,
          payment_failures_last_6m / {sixth} AS payment_failures_per_month,
          discounts_used_last_6m / {sixth} AS discount_dependency,
          CAST(support_tickets_last_90d + payment_failures_last_6m AS DOUBLE) AS friction_score,
          coalesce(plan_type, '{fitted.modes["plan_type"]}') AS f_plan
        FROM __THIS__""")
    scaled = ", ".join(
        f"(coalesce(CAST({n} AS DOUBLE), {fitted.medians[n]!r}D) - ({fitted.means[n]!r}D))"
        f" / {(fitted.deviations[n] or 1.0)!r}D AS f_{n}"
        for n in schemas.NUMERIC
    )
    scale = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    index = StringIndexer(inputCol="f_plan", outputCol="f_plan_index", handleInvalid="keep",
                          stringOrderType="alphabetAsc")
    encode = OneHotEncoder(inputCol="f_plan_index", outputCol="f_plan_type", dropLast=True)
    assemble = VectorAssembler(
        inputCols=[f"f_{n}" for n in schemas.NUMERIC] + ["f_plan_type"]
        + [f"f_{n}" for n in schemas.BINARY],
        outputCol="features",
    )
    trees = GBTClassifier(featuresCol="features", labelCol="label", **params)
    return Pipeline(stages=[derive, scale, index, encode, assemble, trees])


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col(schemas.TARGET).cast("double"))


def tree_scores(model: PipelineModel, df: DataFrame, *carry: str) -> DataFrame:
    """``y_true`` and ``y_proba`` of a fitted tree pipeline."""
    scored = model.transform(with_label(df))
    return scored.select(
        *carry, F.col("label").cast("int").alias("y_true"),
        vector_to_array("probability")[1].alias("y_proba"))


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the assembled vector's slots, from its metadata."""
    schema = model.transform(with_label(df.limit(0))).schema
    groups = schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)
    return [name.removeprefix("f_") for _, name in slots]


def top_importances(model: PipelineModel, df: DataFrame, limit: int = 10) -> DataFrame:
    """The strongest features of a fitted tree model, descending."""
    names = feature_names(model, df)
    weights = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(names, weights, strict=True), key=lambda x: (-x[1], x[0]))[:limit]
    return df.sparkSession.createDataFrame(
        [(n, round(float(w), 4)) for n, w in ranked], "feature string, importance double")
