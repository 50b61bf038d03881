"""Warehouse tables: create, load, append, count, reconcile, slice."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.sources.canonical import Warehouse

DEFAULT_SLICE = 5_000_000


def run_sql(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], **args) -> DataFrame:
    """Parameterised SQL over the given frames (``:name`` markers)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or None)


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Create the five Parquet tables as the catalog knows them, unpartitioned."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def drop_tables(spark: SparkSession, database: str = "default") -> None:
    for name in reversed(schemas.TABLES):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def conform(name: str, df: DataFrame) -> DataFrame:
    """Columns in schema order and type; an unassigned key is numbered."""
    schema, key = schemas.TABLES[name], schemas.KEYS[name]
    if key not in df.columns:
        df = df.withColumn(key, F.monotonically_increasing_id() + 1)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_warehouse(wh: Warehouse, path: str, mode: str = "overwrite") -> None:
    """Load all tables.  Overwriting makes a repeated load idempotent.

    Event tables are partitioned by month, so time predicates prune folders.
    The rebalance gives each month whole files and splits a month that is too
    big for one; rows in a file are sorted by subscriber for min/max skipping.
    """
    for name, df in wh.tables().items():
        rows = conform(name, df)
        if name == "subscribers":
            rows.write.mode(mode).parquet(f"{path}/{name}")
            continue
        (rows.withColumn("month", F.date_format("occurred_at", "yyyy-MM"))
         .hint("rebalance", F.col("month"))
         .sortWithinPartitions("month", "subscriber_id", "occurred_at")
         .write.mode(mode).partitionBy("month").parquet(f"{path}/{name}"))


def append_rows(name: str, df: DataFrame, path: str) -> None:
    rows = conform(name, df)
    if name == "subscribers":
        rows.write.mode("append").parquet(f"{path}/{name}")
    else:
        rows.withColumn("month", F.date_format("occurred_at", "yyyy-MM")).write.mode(
            "append").partitionBy("month").parquet(f"{path}/{name}")


def read_warehouse(spark: SparkSession, path: str) -> Warehouse:
    """The stored tables; a table never written reads as empty."""
    def table(name: str) -> DataFrame:
        schema = schemas.TABLES[name]
        try:
            return spark.read.parquet(f"{path}/{name}").select(*schema.names)
        except AnalysisException:
            return spark.createDataFrame([], schema)

    return Warehouse(*[table(name) for name in schemas.TABLES])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; a plain count reads Parquet footers only."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def total_events(counts: DataFrame) -> DataFrame:
    """All rows but those of the dimension."""
    return counts.filter(F.col("table_name") != "subscribers").agg(
        F.sum("row_count").alias("total_events"))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Compare two count frames: ok, MISMATCH or missing."""
    want = source.select("table_name", F.col("row_count").alias("source_rows"))
    got = target.select("table_name", F.col("row_count").alias("target_rows"))
    both = want.join(got, "table_name", "full_outer")
    return both.withColumn(
        "status",
        F.when(F.col("target_rows").isNull() | F.col("source_rows").isNull(), "missing")
        .when(F.col("source_rows") == F.col("target_rows"), "ok").otherwise("MISMATCH"),
    )


def warehouse_summary(counts: DataFrame, source: str) -> DataFrame:
    """Counts with what each table holds and where it came from."""
    pairs = [F.lit(text) for item in schemas.HOLDS.items() for text in item]
    return counts.select(
        "table_name", "row_count",
        F.create_map(*pairs)[F.col("table_name")].alias("what_it_holds"),
        F.lit(source).alias("source"),
    )


def slices(spark: SparkSession, first: int, last: int, size: int = DEFAULT_SLICE) -> DataFrame:
    """Key ranges ``(low, high]`` that cover ``first..last`` exactly once."""
    if last < first:
        return spark.range(0).select(F.col("id").alias("low"), F.col("id").alias("high"))
    return spark.range(first - 1, last, size).select(
        F.col("id").alias("low"),
        F.least(F.col("id") + size, F.lit(last)).cast("bigint").alias("high"))


def slice_counts(df: DataFrame, key: str, size: int = DEFAULT_SLICE) -> DataFrame:
    """Rows per key slice, to check a sliced copy."""
    first, last = df.agg(F.min(key), F.max(key)).first()
    if first is None:
        return slices(df.sparkSession, 1, 0).withColumn("row_count", F.lit(0).cast("bigint"))
    low = F.floor((F.col(key) - first) / F.lit(size)) * size + (first - 1)
    counts = df.groupBy(low.cast("bigint").alias("low")).agg(F.count("*").alias("n"))
    return slices(df.sparkSession, first, last, size).join(counts, "low", "left").select(
        "low", "high", F.coalesce("n", F.lit(0)).alias("row_count"))


def copy_sliced(df: DataFrame, key: str, path: str, size: int = DEFAULT_SLICE) -> None:
    """Copy a table as ranges of its key, columns in their fixed order."""
    first, last = df.agg(F.min(key), F.max(key)).first()
    parts = 1 if first is None else max(1, -(-(last - first + 1) // size))
    df.repartitionByRange(parts, key).write.mode("overwrite").parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, first: int, last: int,
    partitions: int, **options: str,
) -> DataFrame:
    """Sliced parallel read from a database; needs its driver on the class path."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        .option("partitionColumn", key).option("lowerBound", first)
        .option("upperBound", last).option("numPartitions", partitions).load()
    )


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Truncate and reload a database table in parallel."""
    (df.write.format("jdbc").options(url=url, dbtable=table, **options)
     .option("truncate", "true").mode("overwrite").save())


def cached_snapshots(spark: SparkSession, path: str, sample: int, build, cutoffs) -> DataFrame:
    """Snapshots keyed by (cutoff, sample): the past does not change.

    ``build(missing)`` makes the panel of the cutoffs not stored yet; each lands
    in its own folder, so a repeated call only reads.
    """
    wanted = sorted({str(c) for c in cutoffs})

    def stored() -> DataFrame | None:
        try:
            found = spark.read.parquet(path)
        except AnalysisException:
            return None
        return found.filter(F.col("sample") == sample).withColumn(
            "cutoff", F.col("cutoff").cast("string"))

    before = stored()
    known = set() if before is None else {
        r["cutoff"] for r in before.select("cutoff").distinct().collect()
    }
    missing = [c for c in wanted if c not in known]
    if missing:
        (build(missing).withColumn("sample", F.lit(sample)).write.mode("append")
         .partitionBy("cutoff", "sample").parquet(path))
    return stored().filter(F.col("cutoff").isin(wanted))
