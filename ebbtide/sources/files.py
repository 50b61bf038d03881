"""CSV, profile and report files at the edge of the system."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide import schemas


def yes_no(text: Column) -> Column:
    """Text flags: true, 1 and yes are true, in any case."""
    return F.lower(text.cast("string")).isin("true", "1", "yes")


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """The flat training file.  A header without the target column is an error."""
    header = spark.read.option("header", True).csv(path).columns
    if schemas.TARGET not in header:
        raise ValueError(f"{path} has no '{schemas.TARGET}' column")
    types = {f.name: f.dataType for f in schemas.FLAT_CSV}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.withColumn("is_auto_renew_enabled", yes_no(F.col("is_auto_renew_enabled")))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored profile or report table; ``None`` when it was never written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON; the newest run replaces the one before."""
    report.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException:
        return None


def flatten_metrics(df: DataFrame, prefix: str = "") -> DataFrame:
    """Numbers of a nested one-row report as ``(metric, value)``.

    Names are the path joined by ``_``; flags, texts and arrays are skipped.
    """
    def walk(schema: T.StructType, path: str, name: str) -> list[Column]:
        found: list[Column] = []
        for f in schema:
            at = f"{path}.{f.name}" if path else f.name
            if isinstance(f.dataType, T.StructType):
                found += walk(f.dataType, at, f"{name}{f.name}_")
            elif isinstance(f.dataType, T.NumericType):
                found.append(F.struct(F.lit(f"{name}{f.name}").alias("metric"),
                                      F.col(at).cast("double").alias("value")))
        return found

    return df.select(F.explode(F.array(*walk(df.schema, "", prefix))).alias("m")).select(
        "m.*").filter(F.col("value").isNotNull())
