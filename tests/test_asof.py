"""Point-in-time rules on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.operators import asof
from ebbtide.params import Windows
from ebbtide.sources.canonical import Warehouse

CUTOFF = date(2024, 6, 1)
T0 = datetime(2024, 6, 1)


def build(spark, people, events=(), sessions=(), payments=(), tickets=()):
    """People as (id, signup); other tables without their keys."""
    def frame(name, given):
        return spark.createDataFrame(list(given), schemas.TABLES[name])

    return Warehouse(
        frame("subscribers", [(i, d, "via_7") for i, d in people]),
        frame("subscription_events", [
            (n, i, kind, plan, fee, renew, at)
            for n, (i, kind, plan, fee, renew, at) in enumerate(events, 1)]),
        frame("sessions", [(n, i, at, 10.0) for n, (i, at) in enumerate(sessions, 1)]),
        frame("payments", [
            (n, i, at, 9.9, status, discount)
            for n, (i, at, status, discount) in enumerate(payments, 1)]),
        frame("support_tickets", [(n, i, at, "x") for n, (i, at) in enumerate(tickets, 1)]),
    )


def signup(i, at=datetime(2023, 1, 1), plan="basic", fee=10.0, renew=True, kind="signup"):
    return (i, kind, plan, fee, renew, at)


def days(n):
    return timedelta(days=n)


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def test_only_sessions_inside_the_window_count(spark):
    wh = build(
        spark, [("a", date(2023, 1, 1))], [signup("a")],
        [("a", T0 - days(5))] * 3 + [("a", T0 - days(200))] * 5)
    assert one(asof.snapshot(wh, CUTOFF)).avg_session_count_last_30d == 3.0


def test_window_edges_are_half_open(spark):
    wh = build(
        spark, [("a", date(2023, 1, 1))], [signup("a")],
        [("a", T0 - days(30)), ("a", T0), ("a", T0 - days(30) - timedelta(seconds=1))],
        [("a", T0 - days(180), "failed", True), ("a", T0, "failed", True)],
        [("a", T0 - days(90)), ("a", T0)])
    row = one(asof.snapshot(wh, CUTOFF))
    assert row.avg_session_count_last_30d == 1.0
    assert (row.payment_failures_last_6m, row.discounts_used_last_6m) == (1, 1)
    assert row.support_tickets_last_90d == 1


def test_later_rows_change_no_feature(spark):
    people, events = [("a", date(2023, 1, 1))], [signup("a")]
    before = [("a", T0 - days(3))]
    quiet = asof.snapshot(build(spark, people, events, before), CUTOFF).drop("dropout")
    busy = asof.snapshot(build(
        spark, people,
        events + [signup("a", T0 + days(2), "premium", 99.0, False, "plan_change")],
        before + [("a", T0 + days(n % 20)) for n in range(200)],
        [("a", T0 + days(n), "failed", True) for n in range(15)],
        [("a", T0 + days(n)) for n in range(25)],
    ), CUTOFF).drop("dropout")
    assert quiet.collect() == busy.collect()


@pytest.mark.parametrize(("horizon", "label"), [(30, 0), (100, 0), (101, 1), (200, 1)])
def test_label_uses_a_half_open_horizon(spark, horizon, label):
    wh = build(spark, [("a", date(2023, 1, 1))],
               [signup("a"), signup("a", T0 + days(100), kind="cancellation")])
    assert one(asof.snapshot(wh, CUTOFF, Windows(horizon=horizon))).dropout == label


def test_a_cancellation_at_the_cutoff_is_a_label_not_an_exclusion(spark):
    wh = build(spark, [("a", date(2023, 1, 1))],
               [signup("a"), signup("a", T0, kind="cancellation")])
    assert one(asof.snapshot(wh, CUTOFF)).dropout == 1


def test_gone_subscribers_are_left_out(spark):
    wh = build(
        spark, [("a", date(2023, 1, 1)), ("b", date(2023, 1, 1))],
        [signup("a"), signup("b"), signup("b", T0 - days(9), kind="cancellation"),
         signup("b", T0 - days(2), kind="renewal"), signup("b", T0 + days(2), kind="cancellation")])
    assert one(asof.snapshot(wh, CUTOFF)).subscriber_id == "a"


def test_same_day_signup_is_excluded_also_under_a_cap(spark):
    wh = build(spark, [("a", CUTOFF), ("b", date(2024, 5, 31))],
               [signup("a", T0 - days(1)), signup("b", T0 - days(1))])
    assert one(asof.snapshot(wh, CUTOFF, max_subscribers=1)).subscriber_id == "b"


def test_no_state_before_the_cutoff_drops_the_subscriber(spark):
    wh = build(spark, [("a", date(2023, 1, 1))], [signup("a", T0 + days(1))])
    assert asof.snapshot(wh, CUTOFF).count() == 0


def test_equal_times_take_the_larger_event_id(spark):
    at = T0 - days(3)
    wh = build(spark, [("a", date(2023, 1, 1))],
               [signup("a", at, "basic"), signup("a", at, "premium", kind="renewal")])
    assert one(asof.snapshot(wh, CUTOFF)).plan_type == "premium"


def test_recency_counts_full_days_over_all_history(spark):
    people = [(i, date(2023, 6, 1)) for i in "abcd"]
    wh = build(
        spark, people, [signup(i) for i in "abcd"],
        [("a", T0 - timedelta(hours=1)), ("b", T0 - days(300)),
         ("c", datetime(2020, 1, 1))])
    found = {r.subscriber_id: r.last_activity_days_ago
             for r in asof.snapshot(wh, CUTOFF).collect()}
    # One hour before midnight is zero days; never active means since signup;
    # activity before signup is capped by the tenure.
    assert found == {"a": 0, "b": 300, "c": 366, "d": 366}


def test_empty_warehouse_gives_an_empty_snapshot_with_a_label(spark):
    out = asof.snapshot(build(spark, []), CUTOFF)
    assert out.columns == list(asof.SNAPSHOT_COLUMNS)
    assert out.count() == 0


@pytest.fixture(scope="module")
def busy_wh(spark):
    """Forty subscribers with overlapping histories, one of them very busy."""
    people = [(f"s{i:02d}", date(2023, 1, 1) + days(i * 7)) for i in range(40)]
    kinds = ("renewal", "renewal", "plan_change", "cancellation")
    events = [signup(i, datetime(2023, 1, 1) + days(n * 7)) for n, (i, _) in enumerate(people)]
    events += [
        (f"s{n % 40:02d}", kinds[(n * 7) % 4 if n % 11 == 0 else n % 2],
         ("basic", "standard", "premium")[n % 3], float(n), n % 2 == 0,
         datetime(2023, 2, 1) + days((n * 13) % 700)) for n in range(200)]
    sessions = [("s03" if n % 3 == 0 else f"s{n % 40:02d}",
                 datetime(2023, 1, 1) + timedelta(hours=(n * 37) % 16000)) for n in range(900)]
    payments = [(f"s{n % 40:02d}", datetime(2023, 1, 1) + days((n * 5) % 660),
                 "failed" if n % 4 == 0 else "succeeded", n % 3 == 0) for n in range(400)]
    tickets = [(f"s{n % 17:02d}", datetime(2023, 1, 1) + days((n * 3) % 660)) for n in range(200)]
    return build(spark, people, events, sessions, payments, tickets)


CUTS = [date(2023, 9, 1) + days(30 * n) for n in range(8)]


@pytest.mark.parametrize("cap", [None, 10])
def test_panel_equals_the_snapshots(busy_wh, cap):
    windows = Windows(45, 60)
    panel = asof.panel(busy_wh, CUTS, windows, cap).cache()
    assert panel.groupBy("subscriber_id", "cutoff").count().filter("count > 1").count() == 0
    for cut in CUTS[::3]:
        part = panel.filter(F.col("cutoff") == cut.isoformat())
        single = asof.snapshot(busy_wh, cut, windows, cap)
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, single.collect()))
    panel.unpersist()


def test_no_cutoffs_give_an_empty_panel(busy_wh):
    assert asof.panel(busy_wh, []).count() == 0


def test_cutoff_spacing_and_inclusive_end(spark):
    found = [r.cutoff for r in asof.cutoff_dates(spark, "2024-01-01", "2024-03-01").collect()]
    assert found == [date(2024, 1, 1), date(2024, 1, 31), date(2024, 3, 1)]


def test_split_needs_three_cutoffs_and_orders_them():
    with pytest.raises(ValueError, match="at least 3"):
        asof.split_of(["2024-01-01", "2024-02-01"])
    assert asof.split_of(["2024-03-01", "2024-01-01", "2024-02-01", "2024-04-01"]) == {
        "2024-01-01": "train", "2024-02-01": "train", "2024-03-01": "validation",
        "2024-04-01": "test"}


def test_an_empty_split_is_an_error(spark):
    frame = spark.createDataFrame([("2024-01-01",), ("2024-02-01",)], "cutoff string")
    split = asof.temporal_split(frame, ["2024-01-01", "2024-02-01", "2024-03-01"])
    with pytest.raises(ValueError, match="test"):
        asof.require_all_splits(split)


def test_usable_cutoffs_need_history(spark):
    people = spark.createDataFrame(
        [(f"s{i}", date(2024, 1, 1) + days(i), "x") for i in range(100)], schemas.SUBSCRIBERS)
    cuts = asof.cutoff_dates(spark, "2024-01-01", "2024-04-01")
    found = {(r.cutoff, r.subscribers) for r in asof.usable_cutoffs(people, cuts, 50).collect()}
    assert found == {(date(2024, 3, 1), 60), (date(2024, 3, 31), 90)}


def test_replay_never_trains_on_the_test_cutoff_or_open_labels(spark):
    cuts = asof.cutoff_dates(spark, "2016-11-01", "2017-03-01")
    today = spark.createDataFrame([(date(2017, 1, 1),), (date(2017, 3, 1),)], "today date")
    found = asof.replay_schedule(cuts, today, 30).collect()
    for r in found:
        assert r.cutoff + days(30) <= r.today
    tests = {r.today: r.cutoff for r in found if r.role == "test"}
    assert all(r.cutoff < tests[r.today] for r in found if r.role == "train")


def test_stratified_split_keeps_exact_shares_and_is_repeatable(spark):
    frame = spark.range(1000).select(
        F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("dropout"))
    first = asof.stratified_split(frame, ["k"])
    counts = {(r.dropout, r.split): r["count"]
              for r in first.groupBy("dropout", "split").count().collect()}
    assert counts == {(0, "test"): 135, (0, "validation"): 135, (0, "train"): 630,
                      (1, "test"): 15, (1, "validation"): 15, (1, "train"): 70}
    again = asof.stratified_split(frame.repartition(7), ["k"])
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
