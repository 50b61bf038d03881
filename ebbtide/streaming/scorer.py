"""The streaming scorer: parse, route, score, write both outputs, then commit.

Offsets are committed by the checkpoint only after ``foreachBatch`` returned, so
any failure re-reads the batch.  The file sink replaces both outputs per batch id,
also with nothing, so a re-run batch lands once and in one output only.  A topic
can only be appended to: there a re-run batch is written again, and readers tell
repeats by ``source_offset``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbtide.functions.linear import LinearModel
from ebbtide.operators.scoring import predict
from ebbtide.params import DECISION_THRESHOLD
from ebbtide.streaming.messages import ID, as_topic_rows, dead_letters, parse, unusable

SCORED, DEAD = "scored", "dead_lettered"


class ModelUnavailable(RuntimeError):
    """No model to score with: the batch must be read again later."""


def caused_by_rows(failure: Exception) -> bool:
    """Whether the rows' values raised it, so that another attempt would fail alike.

    Expressions raise data exceptions (SQL state class 22) or are told to raise (P0001),
    Python functions a Python exception. Anything else may pass.
    """
    state = getattr(failure, "getSqlState", lambda: None)() or ""
    return isinstance(failure, PythonException) or state.startswith("22") or state == "P0001"


Score = Callable[[DataFrame, LinearModel, float], DataFrame]


def _inputs(messages: DataFrame) -> DataFrame:
    """Parsed rows with their model inputs as columns."""
    rows = parse(messages)
    rows = rows.withColumn("error", F.coalesce("error", unusable()))
    return rows.select(*[c for c in rows.columns if c != "features"], "features.*")


def route(
    messages: DataFrame, model: LinearModel, threshold: float = DECISION_THRESHOLD,
    score: Score = predict,
) -> DataFrame:
    """One row per message with its ``route``; a bad row never costs a good one."""
    scored = score(_inputs(messages), model, threshold)
    return scored.withColumn("route", F.when(F.col("error").isNull(), SCORED).otherwise(DEAD))


SCORES = {
    "dropout_probability": "double", "predicted_label": "int", "risk_level": "string",
    "explanation": "string", "top_risk_factors": "array<string>", "explanation_method": "string",
}


def route_failed(messages: DataFrame, failure: Exception) -> DataFrame:
    """Every message dead-lettered: scoring itself failed on this batch."""
    said = str(failure).strip().partition("\n")[0]
    reason = F.lit(f"scoring error: {said or type(failure).__name__}")
    nothing = {c: F.lit(None).cast(kind) for c, kind in SCORES.items()}
    return _inputs(messages).withColumns({
        **nothing, "error": F.coalesce("error", reason), "route": F.lit(DEAD)})


def scored_records(routed: DataFrame) -> DataFrame:
    """The output record; the subscriber id is carried beside the model inputs."""
    return routed.filter(F.col("route") == SCORED).select(
        ID, F.current_timestamp().alias("scored_at"), F.col("offset").alias("source_offset"),
        F.round("dropout_probability", 4).alias("dropout_probability"), "predicted_label",
        "risk_level", "explanation", "top_risk_factors", "explanation_method",
    )


def dead_records(routed: DataFrame) -> DataFrame:
    return dead_letters(routed.filter(F.col("route") == DEAD))


Sink = Callable[[DataFrame, str, int], None]


def file_sink(path: str) -> Sink:
    """Replace one folder per output and batch: writing a batch twice changes nothing."""
    def write(rows: DataFrame, output: str, batch_id: int) -> None:
        if output == SCORED:
            # Scores of one subscriber end up in one file, in source order.
            rows = rows.repartition(ID).sortWithinPartitions(ID, "source_offset")
        rows.write.mode("overwrite").parquet(f"{path}/{output}/batch_id={batch_id}")

    return write


def kafka_sink(servers: str, topics: dict[str, str], **options: str) -> Sink:
    """Scores keyed by subscriber, dead letters without a key; needs the connector."""
    def write(rows: DataFrame, output: str, batch_id: int) -> None:
        (as_topic_rows(rows, ID if output == SCORED else None)
         .write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("kafka.acks", "all").option("topic", topics[output]).options(**options).save())

    return write


def kafka_source(spark, servers: str, topic: str, per_batch: int = 200, **options: str):
    """Topic rows from the earliest offset; needs the connector on the class path."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_batch).options(**options).load()
        .select("topic", "partition", "offset", F.col("key").cast("string").alias("key"), "value")
    )


def file_source(spark, path: str, schema, files_per_batch: int = 1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(
        path)


@dataclass
class ScorerStats:
    """Totals over the life of a scorer, kept on the driver: numbers only."""

    batches: int = 0
    messages: int = 0
    scored: int = 0
    dead_lettered: int = 0
    retries: int = 0
    commits: int = 0
    produce_failures: int = 0


@dataclass
class StreamScorer:
    """Binds a model source, a sink and a checkpoint.

    ``load_model`` is asked once per batch; it returns ``None`` while there is
    no model, which fails the batch without writing anything, as does
    :class:`ModelUnavailable` raised while scoring.  Errors that the rows'
    values cause (:func:`caused_by_rows`) dead-letter the batch's rows.  Any other error
    may pass, as a lost executor or a full disk does: the batch is scored again
    up to ``attempts`` times, and then fails, to be read again.
    """

    load_model: Callable[[], LinearModel | None]
    sink: Sink
    checkpoint: str
    threshold: float = DECISION_THRESHOLD
    score: Score = predict
    attempts: int = 3
    stats: ScorerStats = field(default_factory=ScorerStats)

    def _routed(self, batch: DataFrame, model: LinearModel) -> tuple[DataFrame, dict[str, int]]:
        """The stored routed batch and its rows per route."""
        def stored(rows: DataFrame) -> tuple[DataFrame, dict[str, int]]:
            kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                found = kept.groupBy("route").count().collect()
            except Exception:
                kept.unpersist()
                raise
            return kept, {r["route"]: r["count"] for r in found}

        for left in range(self.attempts - 1, -1, -1):
            try:
                return stored(route(batch, model, self.threshold, self.score))
            except ModelUnavailable:
                self.stats.retries += 1
                raise
            except Exception as failure:  # noqa: BLE001 - told apart below
                if caused_by_rows(failure):
                    return stored(route_failed(batch, failure))
                self.stats.retries += 1
                if not left:
                    raise
        raise AssertionError("attempts must be positive")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        self.stats.batches += 1
        model = self.load_model()
        if model is None:
            self.stats.retries += 1
            raise ModelUnavailable("no model is available; the batch stays uncommitted")
        routed, counts = self._routed(batch, model)
        try:
            self.sink(scored_records(routed), SCORED, batch_id)
            self.sink(dead_records(routed), DEAD, batch_id)
        except Exception:
            self.stats.produce_failures += 1
            raise
        finally:
            routed.unpersist()
        self.stats.commits += 1
        self.stats.messages += sum(counts.values())
        self.stats.scored += counts.get(SCORED, 0)
        self.stats.dead_lettered += counts.get(DEAD, 0)

    def start(self, source: DataFrame, interval: str | None = None) -> StreamingQuery:
        """Run until stopped, or drain what is there when no interval is given.

        Stopping between batches is always safe: the checkpoint holds the rest.
        """
        writer = source.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", self.checkpoint)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def drain(self, source: DataFrame) -> ScorerStats:
        query = self.start(source)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        return self.stats


def read_output(spark, path: str, output: str, schema=None) -> DataFrame:
    """All batches of one output; with a schema, nothing written yet reads as empty."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.option("basePath", f"{path}/{output}").parquet(
            f"{path}/{output}/batch_id=*")
    except AnalysisException:
        if schema is None:
            raise
        return spark.createDataFrame([], schema)
