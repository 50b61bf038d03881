"""Session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ebbtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder of its own.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="ebbtide-")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage and drop its lineage.

    Used where one result feeds several passes: they all read the same bytes,
    also after executors were lost.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def small_table(spark: SparkSession, rows: Sequence[dict], schema: pa.Schema) -> DataFrame:
    """A driver-built table of parameters as a local relation (no Python workers)."""
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=schema))
