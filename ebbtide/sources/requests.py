"""Adapter: the provided ``events`` table as scoring requests and topic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.sources.canonical import read


def requests(spark, sf_dir: str, snapshot: DataFrame) -> DataFrame:
    """Every event of a user in the snapshot asks for that user's score."""
    events = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.col("ts").alias("served_at"),
        F.col("user_id").cast("string").alias("subscriber_id"), "event_type",
    )
    return events.join(snapshot.drop("event_type"), "subscriber_id")


#: Size of a topic file's row groups: what one task reads at least.
ROW_GROUP = 1 << 20


def write_topic(rows: DataFrame, path: str) -> None:
    """Topic rows as files of small row groups, so that several tasks share the files of a batch."""
    rows.repartition("offset").write.option("parquet.block.size", ROW_GROUP).parquet(path)


def messages(spark, sf_dir: str, snapshot: DataFrame) -> DataFrame:
    """Topic rows: good requests, and the ways a message can be bad.

    Errors carry text cut off before its closing brace, signups an array, users
    outside the snapshot an object without the required keys.
    """
    inputs = F.struct("subscriber_id", *schemas.MODEL_INPUTS)
    known = snapshot.select("subscriber_id", F.to_json(inputs).alias("_good"))
    events = read(spark, sf_dir, "events").withColumn(
        "subscriber_id", F.col("user_id").cast("string"))
    user = F.col("user_id").cast("string")
    value = (
        F.when(F.col("event_type") == "error",
               F.substring("props", F.lit(1), F.length("props") - 1))
        .when(F.col("event_type") == "signup",
              F.concat(F.lit("["), user, F.lit(", "), F.col("event_id").cast("string"),
                       F.lit("]")))
        .when(F.col("_good").isNull(),
              F.concat(F.lit('{"subscriber_id": "'), user, F.lit('", "tenure_days": 10}')))
        .otherwise(F.col("_good"))
    )
    return events.join(known, "subscriber_id", "left").select(
        F.lit("subscriber-events").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("subscriber_id").alias("key"),
        value.cast("binary").alias("value"),
    )
