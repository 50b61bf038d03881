"""Raw-export mapping, the data contract and warehouse tables."""

from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.operators import contract
from ebbtide.sources import files, raw_export, tables
from ebbtide.sources.canonical import Warehouse

MEMBERS = """msno,city,bd,gender,registered_via,registration_init_time
aaa,1,24,male,7,20150101
bbb,13,0,,9,20160302
ccc,5,31,female,7,20140715
"""
TRANSACTIONS = """msno,payment_method_id,payment_plan_days,plan_list_price,actual_amount_paid,\
is_auto_renew,transaction_date,membership_expire_date,is_cancel
aaa,41,30,149,149,1,20150101,20150131,0
aaa,41,30,149,99,1,20150201,20150303,0
bbb,36,410,1788,1788,0,20160302,20170415,0
ccc,40,7,30,30,1,20140715,20140722,0
ccc,40,7,30,30,1,20140722,20140729,1
"""
LOGS = """msno,date,num_25,num_50,num_75,num_985,num_100,num_unq,total_secs
aaa,20150102,3,1,0,2,30,28,7200.5
aaa,20150103,1,0,1,0,12,11,3000.0
bbb,20160303,0,2,1,0,4,6,900.0
ccc,20140716,8,1,0,3,51,47,-50.0
"""


@pytest.fixture()
def folder(tmp_path):
    for name, text in (("members", MEMBERS), ("transactions", TRANSACTIONS), ("user_logs", LOGS)):
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def load(spark, folder, **kw):
    found = raw_export.read_export(spark, folder)
    return raw_export.build(*[found[f] for f in raw_export.FILES], **kw)


def test_members(spark, folder):
    assert rows(load(spark, folder).subscribers) == [
        ("aaa", date(2015, 1, 1), "via_7"), ("bbb", date(2016, 3, 2), "via_9"),
        ("ccc", date(2014, 7, 15), "via_7")]


def test_lifecycle_events(spark, folder):
    events = load(spark, folder).subscription_events
    found = {(r.subscriber_id, r.occurred_at.date()): r for r in events.collect()}
    assert found["aaa", date(2015, 1, 1)].event_type == "signup"
    assert found["aaa", date(2015, 2, 1)].event_type == "renewal"
    assert found["ccc", date(2014, 7, 15)].event_type == "signup"
    # The cancel flag wins over the position.
    assert found["ccc", date(2014, 7, 22)].event_type == "cancellation"
    long = found["bbb", date(2016, 3, 2)]
    assert long.event_type == "signup" and long.plan_type == "premium"
    assert long.monthly_fee == pytest.approx(1788 / 410 * 30.44)
    assert not long.is_auto_renew_enabled
    assert found["ccc", date(2014, 7, 15)].plan_type == "basic"


@pytest.mark.parametrize(("days", "tier"), [
    (0, "basic"), (31, "basic"), (32, "standard"), (180, "standard"), (181, "premium")])
def test_plan_tiers(spark, days, tier):
    assert spark.range(1).select(raw_export.plan_tier(F.lit(days))).first()[0] == tier


def test_payments(spark, folder):
    found = load(spark, folder).payments.orderBy("payment_id").collect()
    assert [r.discount_applied for r in found] == [False, True, False, False, False]
    assert {r.status for r in found} == {"succeeded"}


def test_negative_time_is_clipped_and_kept(spark, folder):
    found = sorted(r.duration_minutes for r in load(spark, folder).sessions.collect())
    assert found == [0.0, 15.0, 50.0, pytest.approx(7200.5 / 60)]


def test_session_history_can_be_bounded(spark, folder):
    assert load(spark, folder, sessions_since="2015-01-03").sessions.count() == 2


def test_a_malformed_date_is_null_and_counted(spark):
    members = spark.createDataFrame(
        [("a", 1, 1, None, 7, "20159999")], schemas.RAW_MEMBERS)
    people = raw_export.members_to_subscribers(members)
    assert rows(people) == [("a", None, "via_7")]
    bad = contract.violations(contract.validate_table("subscribers", people))
    assert rows(bad, "check", "n_rows") == [("unparseable signup_date", 1)]


def test_a_first_row_is_found_for_a_hot_key(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 7).alias("day"), "id")
    first = raw_export.flag_first(frame, "k", ["day", "id"])
    assert first.count() == 3000
    hot = first.filter("k = 'hot' and is_first").collect()
    assert [(r.day, r.id) for r in hot] == [(0, 0)]
    assert first.filter("is_first").count() == first.select("k").distinct().count()


def test_orphans_are_dropped_and_reported(spark, folder):
    found = raw_export.read_export(spark, folder)
    people = found["members.csv"].filter("msno <> 'ccc'")
    wh = raw_export.build(people, found["transactions.csv"], found["user_logs.csv"])
    assert wh.subscription_events.count() == 3 and wh.sessions.count() == 3
    full = load(spark, folder)
    report = contract.orphan_report(
        {"sessions": full.sessions, "payments": full.payments}, wh.subscribers)
    assert rows(report) == [("payments", 5, 2, 1), ("sessions", 4, 1, 1)]


def test_missing_files_are_all_named(spark, tmp_path):
    (tmp_path / "members.csv").write_text(MEMBERS)
    with pytest.raises(FileNotFoundError, match="transactions.csv, user_logs.csv"):
        raw_export.read_export(spark, str(tmp_path))


def test_dead_features_are_constant(spark, folder):
    report = raw_export.constant_columns(
        spark.createDataFrame([(0, 1.0), (0, 2.0)], "support_tickets_last_90d int, monthly_fee double"),
        ["support_tickets_last_90d", "monthly_fee"])
    assert rows(report, "feature", "constant") == [
        ("monthly_fee", False), ("support_tickets_last_90d", True)]
    assert "friction_score" in raw_export.DEAD_FEATURES


def counts(df):
    return {r.table_name: r.row_count for r in tables.table_counts(df.tables()).collect()}


EXPECTED = {"subscribers": 3, "subscription_events": 5, "payments": 5, "sessions": 4,
            "support_tickets": 0}


def test_loading_twice_does_not_double_and_reads_back(spark, folder, tmp_path):
    wh = load(spark, folder)
    path = str(tmp_path / "wh")
    tables.write_warehouse(wh, path)
    tables.write_warehouse(wh, path)
    stored = tables.read_warehouse(spark, path)
    assert counts(stored) == EXPECTED
    for name, df in stored.tables().items():
        assert df.schema.simpleString() == schemas.TABLES[name].simpleString()
    checked = tables.reconcile(
        tables.table_counts(wh.tables()), tables.table_counts(stored.tables()))
    assert {r.status for r in checked.collect()} == {"ok"}
    tables.append_rows("sessions", stored.sessions.limit(1), path)
    again = tables.reconcile(
        tables.table_counts(wh.tables()),
        tables.table_counts({"sessions": tables.read_warehouse(spark, path).sessions}))
    status = {r.table_name: r.status for r in again.collect()}
    assert status["sessions"] == "MISMATCH" and status["payments"] == "missing"


def test_a_dry_run_writes_nothing_and_passes(spark, folder):
    verdicts = contract.summarise(raw_export.dry_run(load(spark, folder)))
    assert {r.table_name: r.verdict for r in verdicts.collect()} == {
        "subscribers": "ok", "subscription_events": "ok", "sessions": "ok", "payments": "ok",
        "support_tickets": "ok with warnings"}


def test_hashed_ids_survive_and_long_ones_fail(spark, tmp_path):
    real = "Rb9UwLQTrxzBVwCB6+bCcSQWZ9JiNLC9dXtM1oEsZA8="
    people = spark.createDataFrame(
        [(real, date(2020, 1, 1), "x"), ("i" * 65, date(2020, 1, 1), "x")], schemas.SUBSCRIBERS)
    tables.append_rows("subscribers", people, str(tmp_path))
    stored = tables.read_warehouse(spark, str(tmp_path)).subscribers
    assert real in {r.subscriber_id for r in stored.collect()}
    bad = contract.violations(contract.validate_table("subscribers", stored))
    assert rows(bad, "check", "n_rows") == [("subscriber_id longer than 64", 1)]


# --- contract

def people(spark, *ids, signup=date(2020, 1, 1)):
    return spark.createDataFrame([(i, signup, "via_7") for i in ids], schemas.SUBSCRIBERS)


def used(spark, *ids, at=datetime(2020, 2, 1)):
    return spark.createDataFrame(
        [(n, i, at, 12.0) for n, i in enumerate(ids)], schemas.SESSIONS)


def found(checks):
    return {(r.table_name, r.check): (r.severity, r.n_rows, r.n_ids)
            for r in contract.violations(checks).collect()}


def test_missing_columns_come_before_values(spark):
    only = found(contract.validate_table("sessions", used(spark, "").select("subscriber_id")))
    assert list(only) == [
        ("sessions", "missing required columns: occurred_at, duration_minutes")]


def test_unknown_event_type(spark):
    event = spark.createDataFrame(
        [(1, "a", "resurrection", "basic", 1.0, True, datetime(2020, 1, 1))],
        schemas.SUBSCRIPTION_EVENTS)
    assert ("subscription_events", "unknown event_type") in found(
        contract.validate_table("subscription_events", event))


def test_orphans_fail_and_early_activity_warns(spark):
    checks = contract.validate_load({
        "subscribers": people(spark, "a", "b", signup=date(2020, 6, 1)),
        "sessions": used(spark, "a", "a", "z", "z", "z")})
    assert found(checks) == {
        ("sessions", "rows not in the subscribers table"): ("error", 3, 1),
        ("sessions", "activity before the subscriber's signup_date"): ("warning", 2, 1)}
    verdict = {r.table_name: r.verdict for r in contract.summarise(checks).collect()}
    assert verdict == {"subscribers": "ok", "sessions": "failed"}


def test_duplicate_subscribers_fail(spark):
    assert found(contract.validate_table("subscribers", people(spark, "a", "a"))) == {
        ("subscribers", "duplicate subscriber_id"): ("error", 2, 1)}


def test_an_empty_table_warns(spark):
    tickets = raw_export.empty_support_tickets(spark)
    (key, value), = found(contract.validate_table("support_tickets", tickets)).items()
    assert "constant" in key[1] and value[0] == "warning"


REQUEST = "tenure_days int, plan_type string, monthly_fee double, " \
    "avg_session_count_last_30d double, last_activity_days_ago int, " \
    "support_tickets_last_90d int, payment_failures_last_6m int, discounts_used_last_6m int, " \
    "is_auto_renew_enabled boolean"


@pytest.mark.parametrize(("row", "problems"), [
    ((10, " Premium ", 1.0, 1.0, 10, 0, 0, 0, True), []),
    ((10, "gold", 1.0, 1.0, 5, 0, 0, 0, True), ["unknown plan_type"]),
    ((10, "basic", -1.0, 1.0, 5, 0, 0, 0, True), ["monthly_fee outside [0, 10000]"]),
    ((10, "basic", 1.0, 1.0, 11, 0, 0, 0, True), ["last_activity_days_ago exceeds tenure_days"]),
    ((None, "basic", 1.0, 1.0, 1, 0, 0, 0, None),
     ["tenure_days outside [0, 20000]", "is_auto_renew_enabled missing"]),
])
def test_request_rules(spark, row, problems):
    r = contract.validate_requests(spark.createDataFrame([row], REQUEST)).first()
    assert r.problems == problems and r.valid is (not problems)


def gate_rows(spark, train, test):
    schema = f"split string, dropout int, {REQUEST}"
    base = (100, "basic", 1.0, 1.0, 5, 0, 0, 0, True)
    return spark.createDataFrame(
        [("train", y, *base) for y in train] + [("test", y, *base) for y in test], schema)


@pytest.mark.parametrize(("train", "test", "problems"), [
    ([0, 0, 1], [0, 1, 0], []),
    ([], [0, 1, 0], ["the training set is empty"]),
    ([1, 1, 1], [0, 1, 0], ["the training churn rate 100.00% is implausible"]),
    ([0, 0, 1], [0, 0], ["the test churn rate 0.00% is implausible",
                         "the test set has only one class, so PR-AUC is undefined"]),
])
def test_training_gate(spark, train, test, problems):
    out = [r.problem for r in contract.training_gate(gate_rows(spark, train, test)).collect()]
    assert out == problems


# --- tables and files

@pytest.mark.parametrize(("first", "last", "size"), [
    (1, 10, 3), (1, 9, 3), (5, 5, 100), (1, 1, 1), (7, 23, 4), (3, 2, 5)])
def test_slices_cover_every_key_once(spark, first, last, size):
    bounds = sorted(map(tuple, tables.slices(spark, first, last, size).collect()))
    covered = [k for low, high in bounds for k in range(low + 1, high + 1)]
    assert covered == list(range(first, last + 1))
    assert all(high - low <= size for low, high in bounds)


def test_a_sliced_copy_is_whole(spark, tmp_path):
    df = spark.range(5, 1005).withColumnRenamed("id", "event_id")
    tables.copy_sliced(df, "event_id", str(tmp_path / "copy"), 300)
    back = spark.read.parquet(str(tmp_path / "copy"))
    assert back.count() == 1000
    assert [r.row_count for r in tables.slice_counts(back, "event_id", 300).orderBy("low").collect()
            ] == [300, 300, 300, 100]


def test_create_and_drop(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ebbtide_test")
    tables.create_tables(spark, "ebbtide_test")
    tables.create_tables(spark, "ebbtide_test")
    assert {t.name for t in spark.catalog.listTables("ebbtide_test")} == set(schemas.TABLES)
    assert spark.table("ebbtide_test.payments").schema.simpleString() == (
        schemas.PAYMENTS.simpleString())
    tables.drop_tables(spark, "ebbtide_test")
    assert spark.catalog.listTables("ebbtide_test") == []


def test_training_csv_needs_its_target_and_reads_flags(spark, tmp_path):
    head = ",".join(f.name for f in schemas.FLAT_CSV)
    (tmp_path / "a.csv").write_text(
        head + "\na,1,2.0,3.0,1,0,0,0,basic,Yes,1\nb,1,2.0,3.0,1,0,0,0,basic,0,0\n")
    found = files.read_training_csv(spark, str(tmp_path / "a.csv"))
    assert rows(found, "subscriber_id", "is_auto_renew_enabled", "dropout") == [
        ("a", True, 1), ("b", False, 0)]
    (tmp_path / "b.csv").write_text("subscriber_id,plan_type\na,basic\n")
    with pytest.raises(ValueError, match="dropout"):
        files.read_training_csv(spark, str(tmp_path / "b.csv"))


def test_absent_profiles_and_reports_are_none(spark, tmp_path):
    assert files.read_table(spark, str(tmp_path / "nothing")) is None
    assert files.read_report(spark, str(tmp_path / "nothing"), schemas.SESSIONS) is None


def test_flattening_skips_flags_and_texts(spark):
    df = spark.sql("SELECT named_struct('f1', 0.5D, 'ok', true, 'cm', named_struct('tp', 3)) AS "
                   "test, 'x' AS name, 7 AS n")
    assert rows(files.flatten_metrics(df, "run_")) == [
        ("run_n", 7.0), ("run_test_cm_tp", 3.0), ("run_test_f1", 0.5)]


def test_snapshot_cache_builds_only_what_is_missing(spark, tmp_path):
    asked = []

    def build(cutoffs):
        asked.append(list(cutoffs))
        return spark.createDataFrame([(c, 1) for c in cutoffs], "cutoff string, n int")

    path = str(tmp_path / "cache")
    tables.cached_snapshots(spark, path, 5, build, ["2024-01-01", "2024-02-01"])
    out = tables.cached_snapshots(spark, path, 5, build, ["2024-02-01", "2024-03-01"])
    assert asked == [["2024-01-01", "2024-02-01"], ["2024-03-01"]]
    assert rows(out, "cutoff") == [("2024-02-01",), ("2024-03-01",)]
    tables.cached_snapshots(spark, path, 9, build, ["2024-02-01"])
    assert asked[-1] == ["2024-02-01"]
    assert isinstance(Warehouse, type)


def test_whole_snapshot_cache_leaves_nobody_out(spark, tmp_path):
    import __spark_entry__

    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tmp_path.as_uri())
    sf, made = "/root/testdata/sf0.01", __spark_entry__.queries()
    got = {str(r.cutoff): (r.n_rows, r.dropouts) for r in made["snapshot_cache_whole"](spark, sf).collect()}
    whole = made["panel_cutoffs"](spark, sf).groupBy("cutoff").agg({"*": "count", "dropout": "sum"}).collect()
    assert got == {c: n for c, n in {str(r["cutoff"]): (r["count(1)"], r["sum(dropout)"]) for r in whole}.items() if c in got}
    assert len(got) == len(__spark_entry__.registered.CUTOFFS) - 1 and max(n for n, _ in got.values()) > 400


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_are_dealt_to_tasks_by_subscribers(spark, monkeypatch):
    """The days of a table are in memory, so their tasks grow with the subscribers."""
    people = spark.range(60).select(
        F.col("id").cast("string").alias("subscriber_id"), F.lit("2020-01-05").cast("date").alias("signup_date"),
        F.lit("a").alias("acquisition_channel"))
    sessions = spark.range(600).select(
        F.col("id").alias("session_id"), (F.col("id") % 70).cast("string").alias("subscriber_id"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(cast(id % 9 as int))")).alias("occurred_at"),
        F.lit(1.0).alias("duration_minutes"))
    plain = contract.validate_load({"subscribers": people, "sessions": sessions}).collect()
    monkeypatch.setattr(contract, "SUBSCRIBERS_A_TASK", 3)
    dealt = contract.validate_load({"subscribers": people, "sessions": sessions})
    assert "hashpartitioning(subscriber_id" in _plan(dealt) and ", 20), REPARTITION_BY_NUM" in _plan(dealt)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain))


def test_members_are_mapped_once_and_no_rows_are_sorted_for_joins(spark):
    members = spark.createDataFrame([("a", 3, "20200101"), ("b", 4, "20200102")], ["msno", "registered_via", "registration_init_time"])
    paid = spark.createDataFrame(
        [("a", 30, 10.0, 10.0, 1, "20200103", 0), ("x", 30, 10.0, 10.0, 1, "20200104", 0)],
        ["msno", "payment_plan_days", "plan_list_price", "actual_amount_paid", "is_auto_renew", "transaction_date", "is_cancel"])
    logs = spark.createDataFrame([("a", "20200103", 60.0), ("x", "20200103", 60.0)], ["msno", "date", "total_secs"])
    wh = raw_export.build(members, paid, logs)
    assert "Scan ExistingRDD" in _plan(wh.subscribers)
    for table in (wh.subscription_events, wh.sessions, wh.payments):
        assert "SortMergeJoin" not in _plan(table) and [r.subscriber_id for r in table.collect()] == ["a"]
