"""Poison messages, routing, replay after failures, and windowed rates."""

import json
import math
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions import linear
from ebbtide.operators import monitoring
from ebbtide.sources import requests
from ebbtide.streaming import messages, rates, scorer

GOOD = {
    "subscriber_id": "S1", "tenure_days": 95, "monthly_fee": 19.99,
    "avg_session_count_last_30d": 1.0, "last_activity_days_ago": 45,
    "support_tickets_last_90d": 4, "payment_failures_last_6m": 3, "discounts_used_last_6m": 3,
    "plan_type": "standard", "is_auto_renew_enabled": False,
}


def topic(spark, *values):
    def raw(v):
        return v if isinstance(v, bytes) else json.dumps(v).encode()

    return spark.createDataFrame(
        [("in", 0, n, None, bytearray(raw(v))) for n, v in enumerate(values)], schemas.MESSAGES)


def errors(spark, *values):
    out = messages.parse(topic(spark, *values))
    return [r.error for r in out.orderBy("offset").collect()]


def test_every_kind_of_bad_message_has_its_reason(spark):
    assert errors(
        spark, GOOD, b"{not json at all", [1, 2, 3], {"subscriber_id": "X", "tenure_days": 10},
        b"\xff\xfe{}", 3, "text", None, True, 1.5, b"", json.dumps(GOOD).encode() + b" x",
        json.dumps(GOOD).encode() + b'],["', json.dumps(GOOD).encode() + b'},{"v":1',
    ) == [
        None,
        "message at offset 1 is not valid JSON",
        "expected a JSON object, got list",
        "missing required fields: " + ", ".join(
            c for c in schemas.MODEL_INPUTS if c != "tenure_days"),
        "message at offset 4 is not valid JSON",
        "expected a JSON object, got int",
        "expected a JSON object, got str",
        "expected a JSON object, got NoneType",
        "expected a JSON object, got bool",
        "expected a JSON object, got float",
        "message at offset 10 is not valid JSON",
        "message at offset 11 is not valid JSON",
        "message at offset 12 is not valid JSON",
        "message at offset 13 is not valid JSON",
    ]


def test_a_null_under_a_required_key_counts_as_present(spark):
    odd = {**GOOD, "plan_type": None}
    assert errors(spark, odd) == [None]
    routed = scorer.route(topic(spark, odd, {**GOOD, "tenure_days": "many"},
                                {**GOOD, "tenure_days": 95.0}, {**GOOD, "tenure_days": 9.5}),
                          linear.CHAMPION).orderBy("offset").collect()
    assert [r.error for r in routed] == [
        "scoring error: no usable value for plan_type",
        "scoring error: no usable value for tenure_days", None,
        "scoring error: no usable value for tenure_days"]


def test_dead_letters_keep_where_what_and_why(spark):
    routed = scorer.route(topic(spark, b"\xffA", [1, 2]), linear.CHAMPION)
    found = scorer.dead_records(routed).orderBy("offset").collect()
    assert [(r.topic, r.partition, r.offset, r.key) for r in found] == [
        ("in", 0, 0, None), ("in", 0, 1, None)]
    assert found[0].payload == "�A" and bytes(found[0].raw) == b"\xffA"
    assert found[1].payload == "[1, 2]" and found[1].failed_at is not None


def test_scored_records_match_batch_scoring(spark):
    routed = scorer.route(topic(spark, GOOD, [1]), linear.CHAMPION)
    out = scorer.scored_records(routed).collect()
    assert len(out) == 1 and out[0].subscriber_id == "S1" and out[0].source_offset == 0
    # By hand: -1.8 + 0.45 - 0.18 + 1.2 + 1.2 + 0.3 + 0.002 * (19.99 - 250) = 0.70998.
    assert out[0].dropout_probability == pytest.approx(1 / (1 + math.exp(-0.70998)), abs=1e-4)
    assert out[0].risk_level == "medium" and out[0].predicted_label == 1
    assert out[0].top_risk_factors[0] == "inactive for 45 days"


def test_topic_rows_are_keyed_by_subscriber(spark):
    routed = scorer.route(
        topic(spark, GOOD, {k: v for k, v in GOOD.items() if k != "subscriber_id"}),
        linear.CHAMPION)
    out = messages.as_topic_rows(scorer.scored_records(routed), messages.ID).collect()
    assert {r.key for r in out} == {"S1", None}
    assert json.loads(bytes(out[0].value))["risk_level"] == "medium"


@pytest.fixture()
def feed(spark, tmp_path):
    """Two files of messages and a scorer reading one file per batch."""
    path = str(tmp_path / "topic")
    topic(spark, GOOD, b"{oops", {**GOOD, "subscriber_id": "S2"}).coalesce(1).write.parquet(path)
    topic(spark, [1], {**GOOD, "subscriber_id": "S3"}).coalesce(1).write.mode("append").parquet(path)

    def source():
        return scorer.file_source(spark, path, schemas.MESSAGES)

    return source, str(tmp_path / "out"), str(tmp_path / "checkpoint")


def outputs(spark, out):
    return (sorted(r.subscriber_id for r in scorer.read_output(spark, out, scorer.SCORED).collect()),
            scorer.read_output(spark, out, scorer.DEAD).count())


def test_drain_scores_good_rows_and_keeps_bad_ones(spark, feed):
    source, out, checkpoint = feed
    job = scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint)
    stats = job.drain(source())
    assert outputs(spark, out) == (["S1", "S2", "S3"], 2)
    assert (stats.batches, stats.messages, stats.scored, stats.dead_lettered, stats.commits) == (
        2, 5, 3, 2, 2)
    # Drained: nothing is read again.
    again = scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint)
    assert again.drain(source()).batches == 0


def test_without_a_model_nothing_is_written_or_committed(spark, feed):
    source, out, checkpoint = feed
    job = scorer.StreamScorer(lambda: None, scorer.file_sink(out), checkpoint)
    with pytest.raises(Exception, match="no model is available"):
        job.drain(source())
    assert job.stats.retries >= 1 and job.stats.commits == 0
    import os
    assert not os.path.exists(out)
    back = scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint)
    assert back.drain(source()).scored == 3
    assert outputs(spark, out) == (["S1", "S2", "S3"], 2)


def test_a_failed_output_is_replayed_without_duplicates(spark, feed):
    source, out, checkpoint = feed
    write = scorer.file_sink(out)

    def broken(df, output, batch_id):
        if output == scorer.DEAD and batch_id == 1:
            raise OSError("disk full")
        write(df, output, batch_id)

    job = scorer.StreamScorer(lambda: linear.CHAMPION, broken, checkpoint)
    with pytest.raises(Exception, match="disk full"):
        job.drain(source())
    assert job.stats.produce_failures == 1 and job.stats.commits == 1
    scorer.StreamScorer(lambda: linear.CHAMPION, write, checkpoint).drain(source())
    assert outputs(spark, out) == (["S1", "S2", "S3"], 2)


def test_a_scoring_failure_dead_letters_the_batch_and_goes_on(spark, feed):
    source, out, checkpoint = feed

    def broken(df, model, threshold):
        failing = F.when(F.col("subscriber_id") == "S2", F.raise_error(F.lit("model exploded")))
        return scorer.predict(df, model, threshold).withColumn(
            "risk_level", F.coalesce(failing.cast("string"), F.col("risk_level")))

    job = scorer.StreamScorer(
        lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint, score=broken)
    stats = job.drain(source())
    found = scorer.read_output(spark, out, scorer.DEAD).collect()
    failed = [r.reason for r in found if r.reason.startswith("scoring error")]
    assert len(failed) == 2 and "model exploded" in failed[0]
    # The other batch is whole: S3 scored, its neighbour dead-lettered.
    assert outputs(spark, out) == (["S3"], 4)
    assert (stats.scored, stats.dead_lettered, stats.commits) == (1, 4, 2)


def offsets(spark, out):
    """Offsets per output, with how often each is there."""
    scored = [r[0] for r in scorer.read_output(spark, out, scorer.SCORED).select("source_offset").collect()]
    dead = [r[0] for r in scorer.read_output(spark, out, scorer.DEAD).select("offset").collect()]
    return sorted(scored), sorted(dead)


def test_a_passing_failure_is_scored_again_and_not_blamed_on_rows(spark, feed):
    source, out, checkpoint = feed
    failures = [OSError("executor lost")]

    def flaky(df, model, threshold):
        if failures:
            raise failures.pop()
        return scorer.predict(df, model, threshold)

    stats = scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint, score=flaky).drain(source())
    assert outputs(spark, out) == (["S1", "S2", "S3"], 2) and stats.retries == 1


def test_a_lasting_failure_fails_the_batch_and_writes_nothing(spark, feed):
    source, out, checkpoint = feed

    def broken(df, model, threshold):
        raise OSError("no disk")

    job = scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint, score=broken)
    with pytest.raises(Exception, match="no disk"):
        job.drain(source())
    assert job.stats.commits == 0 and job.stats.retries == job.attempts
    scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint).drain(source())
    assert outputs(spark, out) == (["S1", "S2", "S3"], 2)


def test_no_model_while_scoring_keeps_the_batch(spark, feed):
    source, out, checkpoint = feed

    def gone(df, model, threshold):
        raise scorer.ModelUnavailable("unloaded")

    job = scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint, score=gone)
    with pytest.raises(Exception, match="unloaded"):
        job.drain(source())
    assert job.stats.commits == 0 and job.stats.dead_lettered == 0


def test_a_replay_that_routes_otherwise_leaves_each_offset_in_one_output(spark, feed):
    source, out, checkpoint = feed
    write = scorer.file_sink(out)

    def half(df, output, batch_id):
        if output == scorer.DEAD:
            raise OSError("disk full")
        write(df, output, batch_id)

    with pytest.raises(Exception, match="disk full"):
        scorer.StreamScorer(lambda: linear.CHAMPION, half, checkpoint).drain(source())

    def failing(df, model, threshold):
        return scorer.predict(df, model, threshold).withColumn("risk_level", F.raise_error(F.lit("bad")).cast("string"))

    scorer.StreamScorer(lambda: linear.CHAMPION, write, checkpoint, score=failing).drain(source())
    scored, dead = offsets(spark, out)
    assert scored == [] and dead == [0, 0, 1, 1, 2]  # the offsets of the two files


def test_an_empty_topic_is_no_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    job = scorer.StreamScorer(
        lambda: linear.CHAMPION, scorer.file_sink(str(tmp_path / "out")),
        str(tmp_path / "checkpoint"))
    assert job.drain(scorer.file_source(
        spark, str(tmp_path / "empty"), schemas.MESSAGES)).batches == 0


def test_a_running_query_stops_between_batches(spark, feed):
    source, out, checkpoint = feed
    job = scorer.StreamScorer(lambda: linear.CHAMPION, scorer.file_sink(out), checkpoint)
    query = job.start(source(), "200 milliseconds")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None and outputs(spark, out) == (["S1", "S2", "S3"], 2)


def test_closed_windows_equal_the_batch_rates(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(t0 + timedelta(seconds=20 * i), "ab"[i % 2]) for i in range(360)],
        "ts timestamp_ntz, kind string")
    events.coalesce(1).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    rates.drain_to(rates.stream_rates(stream, "ts", ["kind"]), str(tmp_path / "rates"),
                   str(tmp_path / "checkpoint"))
    got = rows(spark.read.parquet(str(tmp_path / "rates")).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")))
    closed = t0 + timedelta(seconds=20 * 359) - timedelta(minutes=15)
    want = rows(monitoring.rates(events, "ts", ["kind"]).filter(
        F.col("window_start") <= F.lit(str(closed)).cast("timestamp_ntz")))
    assert got == want and len(got) == 42


def test_files_of_a_batch_are_read_by_several_tasks(spark, tmp_path):
    """One file of many messages is not one task."""
    sent = spark.range(80_000, numPartitions=1).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit("k").alias("key"), F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("value"))
    requests.write_topic(sent, f"{tmp_path}/topic")
    groups = [pq.ParquetFile(f).num_row_groups for f in tmp_path.glob("topic/*.parquet")]
    assert min(groups) > 1
    back = spark.read.parquet(f"{tmp_path}/topic")
    assert back.count() == 80_000 and sent.exceptAll(back).count() == 0
