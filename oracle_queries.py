"""DuckDB SQL for the registered queries, written against the provided tables.

Independent of the Spark code: window functions and row-wise formulas instead of
segments, buckets and prefix sums.
"""

from __future__ import annotations

TEST = "2000-01-01"
CUTOFFS = ("1997-01-01", "1998-01-01", "1999-01-01", TEST)
T = 0.3

BASE = """
firsts AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1),
subscribers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS subscriber_id, CAST(first_order AS DATE) AS signup_date,
         lower(c_mktsegment) AS acquisition_channel
  FROM customer JOIN firsts ON o_custkey = c_custkey),
subscription_events AS (
  SELECT o_orderkey AS event_id, CAST(o_custkey AS VARCHAR) AS subscriber_id,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN 'cancellation'
              WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
              THEN 'signup' ELSE 'renewal' END AS event_type,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'premium'
              WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'standard' ELSE 'basic' END AS plan_type,
         o_totalprice / CAST(1000 AS DOUBLE) AS monthly_fee,
         o_orderstatus = 'O' AS is_auto_renew_enabled, o_orderdate AS occurred_at
  FROM orders),
lines AS (
  SELECT CAST(o_custkey AS VARCHAR) AS subscriber_id, l_shipdate AS occurred_at, l_quantity,
         l_extendedprice, l_discount, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
sessions AS (SELECT subscriber_id, occurred_at, l_quantity AS duration_minutes FROM lines),
payments AS (
  SELECT subscriber_id, occurred_at, l_extendedprice * (1 - l_discount) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'succeeded' END AS status,
         l_discount >= CAST(0.05 AS DOUBLE) AS discount_applied
  FROM lines),
support_tickets AS (
  SELECT subscriber_id, occurred_at, l_linestatus AS category FROM lines WHERE l_returnflag = 'A')
"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n" + select


def snap(name: str, cutoff: str, observation: int = 180, horizon: int = 180,
         cap: int | None = None) -> str:
    """One point-in-time snapshot as a CTE, with the channel as an extra column."""
    c = f"TIMESTAMP '{cutoff} 00:00:00'"
    limit = f"ORDER BY subscriber_id LIMIT {cap}" if cap else ""
    return f"""
{name} AS (
  WITH base AS (SELECT * FROM subscribers WHERE signup_date < DATE '{cutoff}' {limit}),
  latest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subscriber_id
                   ORDER BY occurred_at DESC, event_id DESC) AS rn
                   FROM subscription_events WHERE occurred_at < {c}) WHERE rn = 1),
  sw AS (SELECT subscriber_id, count(*) AS n FROM sessions
         WHERE occurred_at >= {c} - INTERVAL {observation} DAY AND occurred_at < {c} GROUP BY 1),
  sr AS (SELECT subscriber_id, max(occurred_at) AS last_ever FROM sessions
         WHERE occurred_at < {c} GROUP BY 1),
  pw AS (SELECT subscriber_id, sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS failures,
                sum(CASE WHEN discount_applied THEN 1 ELSE 0 END) AS discounts
         FROM payments WHERE occurred_at >= {c} - INTERVAL 180 DAY AND occurred_at < {c}
         GROUP BY 1),
  tw AS (SELECT subscriber_id, count(*) AS n FROM support_tickets
         WHERE occurred_at >= {c} - INTERVAL 90 DAY AND occurred_at < {c} GROUP BY 1),
  gone AS (SELECT DISTINCT subscriber_id FROM subscription_events
           WHERE event_type = 'cancellation' AND occurred_at < {c}),
  churned AS (SELECT DISTINCT subscriber_id FROM subscription_events
              WHERE event_type = 'cancellation' AND occurred_at >= {c}
                AND occurred_at < {c} + INTERVAL {horizon} DAY),
  joined AS (
    SELECT b.*, l.plan_type, l.monthly_fee, l.is_auto_renew_enabled,
           DATE '{cutoff}' - b.signup_date AS tenure,
           floor(epoch({c} - sr.last_ever) / 86400) AS since,
           sw.n AS n_sessions, failures, discounts, tw.n AS n_tickets
    FROM base b JOIN latest l USING (subscriber_id)
    LEFT JOIN sw USING (subscriber_id) LEFT JOIN sr USING (subscriber_id)
    LEFT JOIN pw USING (subscriber_id) LEFT JOIN tw USING (subscriber_id)
    WHERE b.subscriber_id NOT IN (SELECT subscriber_id FROM gone))
  SELECT subscriber_id, '{cutoff}' AS cutoff, CAST(greatest(tenure, 0) AS INTEGER) AS tenure_days,
         plan_type, monthly_fee, CAST(coalesce(n_sessions, 0) AS DOUBLE)
           AS avg_session_count_last_30d,
         CAST(least(coalesce(CASE WHEN since < 0 THEN 0 ELSE since END, tenure), tenure) AS INTEGER)
           AS last_activity_days_ago,
         CAST(coalesce(n_tickets, 0) AS INTEGER) AS support_tickets_last_90d,
         CAST(coalesce(failures, 0) AS INTEGER) AS payment_failures_last_6m,
         CAST(coalesce(discounts, 0) AS INTEGER) AS discounts_used_last_6m,
         is_auto_renew_enabled,
         CAST(subscriber_id IN (SELECT subscriber_id FROM churned) AS INTEGER) AS dropout,
         acquisition_channel
  FROM joined)"""


def panel(name: str, cutoffs=CUTOFFS, cap: int | None = None) -> str:
    parts = [snap(f"{name}_{i}", c, cap=cap) for i, c in enumerate(cutoffs)]
    union = " UNION ALL ".join(f"SELECT * FROM {name}_{i}" for i in range(len(cutoffs)))
    return ",\n".join(parts) + f",\n{name} AS ({union})"


SNAP = snap("snap", TEST)
PANEL = panel("panel")
TRAIN = panel("train", CUTOFFS[:-1])
COLUMNS = """subscriber_id, cutoff, tenure_days, plan_type, monthly_fee,
 avg_session_count_last_30d, last_activity_days_ago, support_tickets_last_90d,
 payment_failures_last_6m, discounts_used_last_6m, is_auto_renew_enabled, dropout"""


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def money(x: str, places: int = 2) -> str:
    """Round the decimal value of a double, half away from zero, as a numeric type does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(30, 15)), {places}) AS DOUBLE)"


def proba(model: str, fee: str = "monthly_fee", **swap: str) -> str:
    weights = {
        "champion": (-1.8, (0.01, -0.18, -0.6, 0.4, 0.3, 0.1, 0.002)),
        "challenger": (-1.6, (0.012, -0.25, -0.3, 0.25, 0.45, 0.15, 0.001)),
    }[model]
    columns = ["last_activity_days_ago", "avg_session_count_last_30d",
               "CAST(is_auto_renew_enabled AS INTEGER)", "payment_failures_last_6m",
               "support_tickets_last_90d", "discounts_used_last_6m",
               f"({fee} - CAST(250 AS DOUBLE))"]
    z = d(weights[0]) + "".join(f" + {d(w)} * {c}" for w, c in zip(weights[1], columns))
    return f"(1.0 / (1.0 + exp(-greatest({d(-30.0)}, least({d(30.0)}, {z})))))"


def scored(name: str, source: str, model: str = "champion") -> str:
    return (f"{name} AS (SELECT *, dropout AS y_true, CAST({proba(model)} AS DOUBLE) AS y_proba "
            f"FROM {source})")


SCORED = scored("scored", "snap")
SCORED_PANEL = scored("scored", "panel")
TIED = """
tied AS (SELECT cutoff, y_true, 'exact' AS version, y_proba FROM scored
         UNION ALL SELECT cutoff, y_true, 'tied', round(y_proba, 2) FROM scored)"""
Q: dict[str, str] = {}

# --- point in time
Q["snapshot_asof"] = with_(SNAP, select=f"SELECT {COLUMNS} FROM snap")
Q["stored_snapshot"] = Q["snapshot_asof"]
Q["snapshot_month_windows"] = with_(snap("snap", TEST, 30, 30), select=f"SELECT {COLUMNS} FROM snap")
Q["capped_snapshot"] = with_(snap("snap", TEST, cap=500), select=f"SELECT {COLUMNS} FROM snap")
Q["panel_cutoffs"] = with_(PANEL, select=f"SELECT {COLUMNS} FROM panel")
Q["panel_capped"] = with_(panel("panel", cap=300), select=f"SELECT {COLUMNS} FROM panel")
Q["panel_rates"] = with_(PANEL, select="""
SELECT cutoff, count(*) AS n_rows, CAST(sum(dropout) AS BIGINT) AS dropouts,
       round(avg(dropout), 6) AS dropout_rate FROM panel GROUP BY cutoff""")
SPLIT = """
split AS (SELECT *, CASE WHEN cutoff = '2000-01-01' THEN 'test'
                         WHEN cutoff = '1999-01-01' THEN 'validation' ELSE 'train' END AS split
          FROM panel)"""
Q["temporal_split"] = with_(PANEL, SPLIT, select="""
SELECT split, count(DISTINCT cutoff) AS n_cutoffs, count(*) AS n_rows,
       CAST(sum(dropout) AS BIGINT) AS dropouts FROM split GROUP BY split""")
Q["cutoff_calendar"] = """
SELECT CAST(unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
                                   INTERVAL 30 DAY)) AS DATE) AS cutoff FROM orders"""
Q["usable_cutoffs"] = with_("""
cutoffs AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1996-12-31',
                                               INTERVAL 30 DAY)) AS DATE) AS cutoff)""", select="""
SELECT cutoff, count(*) AS subscribers FROM cutoffs JOIN subscribers ON signup_date < cutoff
GROUP BY cutoff HAVING count(*) >= 50""")

AUC = """
(SELECT {keys} sum(y_true) AS p, sum(1 - y_true) AS n,
        (sum(CASE WHEN y_true = 1 THEN r ELSE 0 END) - sum(y_true) * (sum(y_true) + 1) / 2.0)
          / nullif(CAST(sum(y_true) AS DOUBLE) * sum(1 - y_true), 0) AS roc_auc
 FROM (SELECT *, rank() OVER (PARTITION BY {part} ORDER BY y_proba)
              + (count(*) OVER (PARTITION BY {part}, y_proba) - 1) / 2.0 AS r FROM {src})
 GROUP BY {part})"""
AP = """
(SELECT {keys} CASE WHEN max(total) > 0 AND max(n_all) > max(total)
                    THEN sum(hits * cum_pos / cum_all) / max(total) END AS pr_auc
 FROM (SELECT {keys} y_proba, CAST(sum(y_true) AS DOUBLE) AS hits,
              sum(sum(y_true)) OVER w AS cum_pos, sum(count(*)) OVER w AS cum_all,
              sum(sum(y_true)) OVER (PARTITION BY {part}) AS total,
              sum(count(*)) OVER (PARTITION BY {part}) AS n_all
       FROM {src} GROUP BY {part}, y_proba
       WINDOW w AS (PARTITION BY {part} ORDER BY y_proba DESC))
 GROUP BY {part})"""


def auc(src: str, *keys: str) -> str:
    part = ", ".join(keys) or "true"
    return AUC.format(src=src, part=part, keys="".join(f"{k}, " for k in keys))


def ap(src: str, *keys: str) -> str:
    part = ", ".join(keys) or "true"
    return AP.format(src=src, part=part, keys="".join(f"{k}, " for k in keys))


CELLS = f"""count(*) FILTER (WHERE y_proba >= {T} AND y_true = 1) AS tp,
 count(*) FILTER (WHERE y_proba >= {T} AND y_true = 0) AS fp,
 count(*) FILTER (WHERE y_proba < {T} AND y_true = 1) AS fn,
 count(*) FILTER (WHERE y_proba < {T} AND y_true = 0) AS tn"""
Q["expanding_backfill"] = with_(PANEL, SCORED_PANEL, f"""
per AS (SELECT cutoff, count(*) AS n, {CELLS} FROM scored GROUP BY cutoff),
ranked AS (SELECT a.cutoff, roc_auc, pr_auc FROM {auc("scored", "cutoff")} a
           JOIN {ap("scored", "cutoff")} b USING (cutoff)),
numbered AS (SELECT *, row_number() OVER (ORDER BY cutoff) AS i, sum(n) OVER (ORDER BY cutoff) AS upto,
                    lag(n) OVER (ORDER BY cutoff) AS previous FROM per JOIN ranked USING (cutoff))""",
    select="""
SELECT CAST(i AS INTEGER) AS window_id, cutoff AS test_cutoff,
       CAST(upto - n - previous AS BIGINT) AS n_train,
       previous AS n_validation, n AS n_test, tp, fp, fn, tn, round(roc_auc, 4) AS roc_auc,
       round(pr_auc, 4) AS pr_auc FROM numbered WHERE i >= 3""")


def newton(name: str, src: str, d: int, steps: int = 14, ridge: float = 0.0) -> list[str]:
    """Logistic fits per ``g`` of ``src(g, y, weight, x0..)``, every step written out.

    The linear system of a step is solved by Gauss-Jordan elimination, one CTE per column.
    The last CTE is ``name(g, w0..)``.
    """
    sums = ", ".join(
        [f"sum(weight * (y - p) * x{i}) - {d_(ridge if i else 0)} * any_value(w{i}) AS b{i}" for i in range(d)]
        + [f"sum(weight * p * (1 - p) * x{i} * x{j}){f' + {d_(ridge)}' if i == j and i else ''} AS h{i}_{j}"
           for i in range(d) for j in range(d)] + [f"any_value(w{i}) AS w{i}" for i in range(d)])
    z = " + ".join(f"w{i} * x{i}" for i in range(d))
    out = [f"{name}_w0 AS MATERIALIZED (SELECT g, {', '.join(f'CAST(0 AS DOUBLE) AS w{i}' for i in range(d))} FROM {src} GROUP BY g)"]
    for t in range(steps):
        out.append(f"{name}_e{t}_0 AS MATERIALIZED (SELECT g, {sums} FROM (SELECT s.*, 1 / (1 + exp(-({z}))) AS p, "
                   f"{', '.join(f'w{i}' for i in range(d))} FROM {src} s JOIN {name}_w{t} USING (g)) GROUP BY g)")
        for k in range(d):
            less = [f"h{i}_{j} - h{i}_{k} * h{k}_{j} / h{k}_{k} AS h{i}_{j}" for i in range(d) for j in range(k + 1, d) if i != k]
            less += [f"b{i} - h{i}_{k} * b{k} / h{k}_{k} AS b{i}" for i in range(d) if i != k]
            out.append(f"{name}_e{t}_{k + 1} AS MATERIALIZED (SELECT * REPLACE ({', '.join(less)}) FROM {name}_e{t}_{k})"
                       if less else f"{name}_e{t}_{k + 1} AS (SELECT * FROM {name}_e{t}_{k})")
        last = name if t == steps - 1 else f"{name}_w{t + 1}"
        out.append(f"{last} AS MATERIALIZED (SELECT g, {', '.join(f'w{i} + b{i} / h{i}_{i} AS w{i}' for i in range(d))} FROM {name}_e{t}_{d})")
    return out


def d_(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


WINDOW_INPUTS = ("tenure_days", "monthly_fee", "avg_session_count_last_30d", "last_activity_days_ago", "support_tickets_last_90d",
                 "payment_failures_last_6m", "discounts_used_last_6m", "CAST(is_auto_renew_enabled AS INTEGER)")
_W = range(len(WINDOW_INPUTS))
WINDOWS_TRAINED = (PANEL, """
calendar AS (SELECT cutoff, row_number() OVER (ORDER BY cutoff) AS i FROM (SELECT DISTINCT cutoff FROM panel)),
trained AS MATERIALIZED (SELECT CAST(w.i AS INTEGER) AS g, p.* FROM calendar w JOIN calendar c ON c.i <= w.i - 2 JOIN panel p ON p.cutoff = c.cutoff
                         WHERE w.i >= 3)""",
    "scaling AS MATERIALIZED (SELECT g, " + ", ".join(
        f"avg({c}) AS m{i}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s{i}" for i, c in enumerate(WINDOW_INPUTS)) + " FROM trained GROUP BY g)",
    "design AS MATERIALIZED (SELECT g, CAST(dropout AS DOUBLE) AS y, CAST(1 AS DOUBLE) AS weight, CAST(1 AS DOUBLE) AS x0, " + ", ".join(
        f"coalesce(({c} - m{i}) / s{i}, 0) AS x{i + 1}" for i, c in enumerate(WINDOW_INPUTS)) + " FROM trained JOIN scaling USING (g))",
    *newton("fitted", "design", len(WINDOW_INPUTS) + 1, ridge=1.0))
Q["window_training_weights"] = with_(*WINDOWS_TRAINED, select=" UNION ALL ".join(
    f"SELECT g AS window_id, '{n}' AS input, round(w{i}, 6) AS weight FROM fitted" for i, n in enumerate(
        ("intercept", *[c.removeprefix("CAST(").removesuffix(" AS INTEGER)") for c in WINDOW_INPUTS]))))


def window_scores(name: str, back: int) -> str:
    """Test rows of each window scored by the model of the window ``back`` before it."""
    z = "w0 + " + " + ".join(f"w{i + 1} * coalesce(({c} - m{i}) / s{i}, 0)" for i, c in enumerate(WINDOW_INPUTS))
    return (f"{name} AS MATERIALIZED (SELECT CAST(c.i AS INTEGER) AS window_id, cutoff, dropout AS y_true, 1 / (1 + exp(-({z}))) AS y_proba "
            f"FROM panel JOIN calendar c USING (cutoff) JOIN scaling s ON s.g = c.i - {back} JOIN fitted f ON f.g = s.g)")


Q["window_training_backfill"] = with_(*WINDOWS_TRAINED, window_scores("own", 0), window_scores("earlier", 1), f"""
per AS (SELECT window_id, any_value(cutoff) AS test_cutoff, count(*) AS n_test, {CELLS} FROM own GROUP BY window_id),
parts AS (SELECT CAST(w.i AS INTEGER) AS window_id, count(*) FILTER (WHERE c.i <= w.i - 2) AS n_train,
                 count(*) FILTER (WHERE c.i = w.i - 1) AS n_validation
          FROM calendar w JOIN calendar c ON c.i <= w.i JOIN panel p ON p.cutoff = c.cutoff WHERE w.i >= 3 GROUP BY w.i),
ranked AS (SELECT a.window_id, roc_auc, pr_auc FROM {auc("own", "window_id")} a JOIN {ap("own", "window_id")} b USING (window_id)),
before AS (SELECT window_id, pr_auc AS previous_pr_auc FROM {ap("earlier", "window_id")})""", select="""
SELECT window_id, test_cutoff, n_train, n_validation, n_test, tp, fp, fn, tn, round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc,
       round(previous_pr_auc, 4) AS previous_pr_auc,
       coalesce(round(pr_auc, 4) >= round(previous_pr_auc, 4) + 0.005 - 1e-9, true) AS promoted
FROM per JOIN parts USING (window_id) JOIN ranked USING (window_id) LEFT JOIN before USING (window_id)""")
Q["latest_scorable_cutoff"] = """
SELECT CAST(max(o_orderdate)::DATE - INTERVAL 180 DAY AS DATE) AS cutoff FROM orders"""
Q["replay_schedule"] = """
WITH today AS (SELECT CAST(unnest(generate_series(DATE '1999-01-01', DATE '2000-12-31',
                                                  INTERVAL 182 DAY)) AS DATE) AS today),
cutoffs AS (SELECT CAST(unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
                                               INTERVAL 90 DAY)) AS DATE) AS cutoff FROM orders)
SELECT today, cutoff,
       CASE WHEN cutoff = max(cutoff) OVER (PARTITION BY today) THEN 'test' ELSE 'train' END AS role
FROM today JOIN cutoffs ON cutoff + INTERVAL 180 DAY <= today"""
Q["stratified_split"] = with_(PANEL, select="""
SELECT dropout, split, CASE split WHEN 'test' THEN t WHEN 'validation' THEN v - t ELSE n - v END AS n
FROM (SELECT dropout, count(*) AS n,
             CAST(floor(CAST(0.15 AS DOUBLE) * count(*)) AS BIGINT) AS t,
             CAST(floor(CAST(0.3 AS DOUBLE) * count(*)) AS BIGINT) AS v
      FROM panel GROUP BY dropout),
     (VALUES ('train'), ('validation'), ('test')) s(split)""")

Q["snapshot_cache"] = with_(panel("panel", CUTOFFS[1:], cap=400), select="""
SELECT cutoff, count(*) AS n_rows, CAST(sum(dropout) AS BIGINT) AS dropouts FROM panel
GROUP BY cutoff""")
Q["snapshot_cache_whole"] = with_(panel("panel", CUTOFFS[1:]), select="""
SELECT cutoff, count(*) AS n_rows, CAST(sum(dropout) AS BIGINT) AS dropouts FROM panel
GROUP BY cutoff""")
Q["csv_round_trip"] = with_(SNAP, select="SELECT * EXCLUDE (cutoff, acquisition_channel) FROM snap")

# --- features
Q["model_inputs"] = with_(SNAP, select="""
SELECT subscriber_id, CAST(tenure_days AS DOUBLE) AS tenure_days, monthly_fee,
       avg_session_count_last_30d, CAST(last_activity_days_ago AS DOUBLE) AS last_activity_days_ago,
       CAST(support_tickets_last_90d AS DOUBLE) AS support_tickets_last_90d,
       CAST(payment_failures_last_6m AS DOUBLE) AS payment_failures_last_6m,
       CAST(discounts_used_last_6m AS DOUBLE) AS discounts_used_last_6m, plan_type,
       is_auto_renew_enabled FROM snap""")
NUMERIC = ["tenure_days", "monthly_fee", "avg_session_count_last_30d", "last_activity_days_ago",
           "support_tickets_last_90d", "payment_failures_last_6m", "discounts_used_last_6m"]
Q["features_and_target"] = with_(PANEL, select=f"""
SELECT plan_type, count(*) AS n, CAST(sum(dropout) AS BIGINT) AS dropouts,
       {", ".join(f"round(avg({c}), 4) AS {c}" for c in NUMERIC)} FROM panel GROUP BY plan_type""")
DERIVED = {
    "tenure_months": f"CAST(tenure_days AS DOUBLE) / {d(30.44)}",
    "sessions_per_day_last_30d": "avg_session_count_last_30d / 30",
    "recency_ratio": "CAST(last_activity_days_ago AS DOUBLE) / (tenure_days + 1)",
    "engagement_recency_score": "avg_session_count_last_30d / (last_activity_days_ago + 1)",
    "fee_per_session": "monthly_fee / (avg_session_count_last_30d + 1)",
    "support_tickets_per_month": "CAST(support_tickets_last_90d AS DOUBLE) / 3",
    "payment_failures_per_month": "CAST(payment_failures_last_6m AS DOUBLE) / 6",
    "discount_dependency": "CAST(discounts_used_last_6m AS DOUBLE) / 6",
    "friction_score": "CAST(support_tickets_last_90d + payment_failures_last_6m AS DOUBLE)",
}
ALL_NUMERIC = NUMERIC + list(DERIVED)


def wide(name: str, source: str) -> str:
    extra = ", ".join(f"{e} AS {c}" for c, e in DERIVED.items())
    dummies = ", ".join(
        f"CAST(plan_type = '{p}' AS INTEGER) AS plan_type_{p}"
        for p in ("basic", "standard", "premium"))
    return (f"{name} AS (SELECT *, {extra}, {dummies}, "
            f"CAST(last_activity_days_ago > 21 AS INTEGER) AS is_dormant FROM {source})")


Q["derived_features"] = with_(SNAP, wide("w", "snap"), select=f"""
SELECT subscriber_id, CAST(is_auto_renew_enabled AS INTEGER) AS is_auto_renew_enabled, is_dormant,
       {", ".join(DERIVED)} FROM w""")
Q["imputation_values"] = with_(PANEL, wide("w", "panel"), select=" UNION ALL ".join([
    f"SELECT '{c}' AS feature, round(CAST(quantile_cont(CAST({c} AS DOUBLE), 0.5) AS DOUBLE), 6) "
    f"AS median, CAST(NULL AS VARCHAR) AS mode FROM w" for c in ALL_NUMERIC] + ["""
(SELECT 'plan_type', CAST(NULL AS DOUBLE), plan_type FROM w GROUP BY plan_type
 ORDER BY count(*) DESC, plan_type LIMIT 1)"""]))
Q["standardized_features"] = with_(SNAP, TRAIN, wide("w", "snap"), wide("t", "train"), f"""
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ALL_NUMERIC)}
       FROM t)""", select=f"""
SELECT subscriber_id, {", ".join(f"round(({c} - m_{c}) / s_{c}, 5) AS {c}" for c in ALL_NUMERIC)},
       CAST(plan_type_basic AS DOUBLE) AS plan_type_basic,
       CAST(plan_type_standard AS DOUBLE) AS plan_type_standard,
       CAST(plan_type_premium AS DOUBLE) AS plan_type_premium,
       CAST(is_auto_renew_enabled AS DOUBLE) AS is_auto_renew_enabled,
       CAST(is_dormant AS DOUBLE) AS is_dormant
FROM w, st""")

# --- scoring
BAND = f"""CASE WHEN y_proba < {T} THEN 'low' WHEN y_proba >= {T} + (1.0 - {T}) * 0.5 THEN 'high'
 ELSE 'medium' END"""
LABEL = f"CAST(y_proba >= {T} AS INTEGER)"
Q["score_bands"] = with_(SNAP, SCORED, select=f"""
SELECT subscriber_id, round(y_proba, 4) AS dropout_probability, {LABEL} AS predicted_label,
       {BAND} AS risk_level FROM scored""")
PERCENT = "CAST(CAST(round_even(y_proba * 100, 0) AS BIGINT) AS VARCHAR) || '%'"
OPENING = f"""CASE {BAND} WHEN 'high' THEN 'High dropout risk' WHEN 'medium'
 THEN 'Moderate dropout risk' ELSE 'Low dropout risk' END || ' (' || {PERCENT} || '): '"""
RULES = f"""
rules AS (SELECT *, list_filter([
    CASE WHEN last_activity_days_ago > 21
         THEN 'inactive for ' || last_activity_days_ago || ' days' END,
    CASE WHEN avg_session_count_last_30d < 4
         THEN 'low recent activity (' || printf('%.1f', avg_session_count_last_30d)
              || ' sessions/30d)' END,
    CASE WHEN payment_failures_last_6m >= 2
         THEN payment_failures_last_6m || ' payment failures in the last 6 months' END,
    CASE WHEN support_tickets_last_90d >= 3
         THEN support_tickets_last_90d || ' support tickets in the last 90 days' END,
    CASE WHEN NOT is_auto_renew_enabled THEN 'auto-renew disabled' END,
    CASE WHEN discounts_used_last_6m >= 3
         THEN 'relies on discounts (' || discounts_used_last_6m || ' in the last 6 months)' END,
    CASE WHEN tenure_days < 60 THEN 'still new (' || tenure_days || ' days since signup)' END
  ], lambda x: x IS NOT NULL) AS factors, list_filter([
    CASE WHEN is_auto_renew_enabled THEN 'auto-renew enabled' END,
    CASE WHEN avg_session_count_last_30d >= 12 THEN 'strong recent engagement' END,
    CASE WHEN last_activity_days_ago <= 3 THEN 'active in the last few days' END,
    CASE WHEN tenure_days >= 365 THEN 'long-tenured subscriber' END
  ], lambda x: x IS NOT NULL) AS signals FROM scored),
told AS (SELECT *, {OPENING} || CASE
    WHEN len(factors) > 0 THEN array_to_string(factors[1:3], ', ')
    WHEN len(signals) > 0 THEN array_to_string(signals, ', ')
    ELSE 'no notable risk signals detected' END || '.' AS explanation FROM rules)"""
Q["risk_factors"] = with_(SNAP, SCORED, RULES, select="""
SELECT subscriber_id, array_to_string(factors, '; ') AS factors,
       array_to_string(signals, '; ') AS signals, explanation,
       array_to_string(factors[1:3], '; ') AS top_risk_factors, 'rules' AS explanation_method
FROM told""")
CONCEPTS = {
    "recency": ("last_activity_days_ago", "recency_ratio", "is_dormant"),
    "engagement": ("avg_session_count_last_30d", "sessions_per_day_last_30d",
                   "engagement_recency_score"),
    "tenure": ("tenure_days", "tenure_months"),
    "payments": ("payment_failures_last_6m", "payment_failures_per_month"),
    "support": ("support_tickets_last_90d", "support_tickets_per_month"),
    "friction": ("friction_score",),
    "discounts": ("discounts_used_last_6m", "discount_dependency"),
    "price": ("monthly_fee", "fee_per_session"),
    "auto_renew": ("is_auto_renew_enabled",),
    "plan": ("plan_type_basic", "plan_type_standard", "plan_type_premium"),
}
EXPLAINED = {
    "last_activity_days_ago": 0.006, "recency_ratio": 1.5, "is_dormant": 0.35,
    "avg_session_count_last_30d": -0.1, "sessions_per_day_last_30d": -1.2,
    "engagement_recency_score": -0.4, "tenure_days": -0.0004, "tenure_months": -0.008,
    "payment_failures_last_6m": 0.3, "payment_failures_per_month": 0.5,
    "support_tickets_last_90d": 0.25, "support_tickets_per_month": 0.4, "friction_score": 0.15,
    "discounts_used_last_6m": 0.12, "discount_dependency": 0.3, "monthly_fee": 0.002,
    "fee_per_session": 0.003, "is_auto_renew_enabled": -0.6, "plan_type_basic": 0.1,
    "plan_type_standard": -0.05, "plan_type_premium": -0.2,
}
_parts = " UNION ALL ".join(
    f"SELECT subscriber_id, {i} AS pos, '{c}' AS name, "
    f"'{next(k for k, v in CONCEPTS.items() if c in v)}' AS concept, "
    f"{d(w)} * (CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) AS part FROM w"
    for i, (c, w) in enumerate(EXPLAINED.items()))
PARTS = f"""
parts AS ({_parts}),
concepts AS (SELECT subscriber_id, concept, sum(part) AS total, min(pos) AS pos,
                    arg_max(name, struct_pack(a := abs(part), b := -pos)) AS dominant
             FROM parts GROUP BY subscriber_id, concept)"""
Q["attribution_concepts"] = with_(SNAP, wide("w", "snap"), PARTS, select="""
SELECT subscriber_id, concept, round(total, 6) AS total, dominant FROM concepts""")


def fmt2(x: str) -> str:
    return f"printf('%.2f', {x})"


PHRASE = f"""CASE
 WHEN dominant = 'is_auto_renew_enabled'
   THEN CASE WHEN is_auto_renew_enabled THEN 'auto-renew enabled' ELSE 'auto-renew disabled' END
 WHEN dominant = 'is_dormant' THEN CASE WHEN last_activity_days_ago > 21
   THEN 'dormant - no session in ' || last_activity_days_ago || ' days'
   ELSE 'active within the last ' || last_activity_days_ago || ' days' END
 WHEN dominant = 'last_activity_days_ago' THEN CASE WHEN total > 0
   THEN 'inactive for ' || last_activity_days_ago || ' days'
   ELSE 'last seen ' || last_activity_days_ago || ' days ago' END
 WHEN dominant = 'recency_ratio' THEN CASE WHEN total > 0
   THEN 'a ' || last_activity_days_ago || '-day gap is long for a ' || tenure_days
        || '-day-old account'
   ELSE 'a ' || last_activity_days_ago || '-day gap is short against ' || tenure_days
        || ' days of tenure' END
 WHEN dominant IN ('avg_session_count_last_30d', 'sessions_per_day_last_30d')
   THEN CASE WHEN total > 0 THEN 'low' ELSE 'steady' END || ' recent activity ('
        || printf('%.1f', avg_session_count_last_30d) || ' sessions/30d)'
 WHEN dominant = 'engagement_recency_score' THEN CASE WHEN total > 0
   THEN 'little activity for how long they have been away' ELSE 'active and recently seen' END
 WHEN concept = 'tenure' THEN CASE WHEN total > 0
   THEN 'only ' || tenure_days || ' days since signup' ELSE tenure_days || ' days of tenure' END
 WHEN concept = 'payments' THEN CASE WHEN total > 0
   THEN payment_failures_last_6m || ' payment failures in the last 6 months'
   ELSE 'no recent payment trouble' END
 WHEN concept = 'support' THEN CASE WHEN total > 0
   THEN support_tickets_last_90d || ' support tickets in the last 90 days'
   ELSE 'little contact with support' END
 WHEN concept = 'friction' THEN CASE WHEN total > 0
   THEN 'combined support and billing friction ('
        || (support_tickets_last_90d + payment_failures_last_6m) || ' events)'
   ELSE 'few support or billing problems' END
 WHEN concept = 'discounts' THEN CASE WHEN total > 0
   THEN 'relies on discounts (' || discounts_used_last_6m || ' in the last 6 months)'
   ELSE discounts_used_last_6m || ' discounts used in the last 6 months' END
 WHEN dominant = 'monthly_fee' THEN CASE WHEN total > 0
   THEN 'high monthly fee (' || {fmt2("monthly_fee")} || ')'
   ELSE 'monthly fee of ' || {fmt2("monthly_fee")} END
 WHEN dominant = 'fee_per_session' THEN CASE WHEN total > 0 THEN 'poor' ELSE 'good' END
   || ' value per session (' || {fmt2("monthly_fee / (avg_session_count_last_30d + 1)")}
   || ' per session)'
 ELSE 'on the ' || plan_type || ' plan' END"""
Q["attributions_top3"] = with_(SNAP, scored("ranked_scores", "snap"), wide("w", "ranked_scores"),
                               PARTS, f"""
top AS (SELECT *, row_number() OVER (PARTITION BY subscriber_id ORDER BY abs(total) DESC, pos) AS rn
        FROM concepts QUALIFY rn <= 3),
texts AS (SELECT *, {PHRASE} AS description
          FROM top JOIN w USING (subscriber_id) WHERE total <> 0)""", select=f"""
SELECT subscriber_id, CAST(rn - 1 AS INTEGER) AS position, concept AS feature,
       round(total, 6) AS contribution,
       CASE WHEN total > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction, description,
       {OPENING} || string_agg(description, ', ' ORDER BY rn)
         OVER (PARTITION BY subscriber_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
         || '.' AS explanation,
       coalesce(string_agg(description, '; ' ORDER BY rn) FILTER (WHERE total > 0)
         OVER (PARTITION BY subscriber_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
         '') AS raising
FROM texts""")
_levers = {
    "is_auto_renew_enabled": ("true", "NOT is_auto_renew_enabled", "true"),
    "last_activity_days_ago": ("0", "last_activity_days_ago <> 0", "0"),
    "payment_failures_last_6m": ("0", "payment_failures_last_6m <> 0", "0"),
    "monthly_fee": ("100.0", "monthly_fee <> 100", "CAST(100 AS DOUBLE)"),
}
Q["what_if"] = with_(SNAP, SCORED, select="""
SELECT subscriber_id, lever, new_value, round(y_proba, 6) AS old_probability,
       round(p, 6) AS new_probability, round(p - y_proba, 6) AS delta FROM (""" + " UNION ALL ".join(
    f"SELECT subscriber_id, '{c}' AS lever, '{text}' AS new_value, y_proba, "
    f"(SELECT {proba('champion')} FROM (SELECT s.* REPLACE ({value} AS {c}))) AS p "
    f"FROM scored s WHERE {cond}" for c, (text, cond, value) in _levers.items()) + ")")

Q["foreign_model_scores"] = with_(SNAP, SCORED, select="""
SELECT subscriber_id, round(y_proba, 6) AS y_proba FROM scored""")

# --- evaluation
Q["confusion"] = with_(PANEL, SCORED_PANEL, f"""
c AS (SELECT cutoff, count(*) AS n, {CELLS} FROM scored GROUP BY cutoff)""", select=f"""
SELECT cutoff, {d(T)} AS threshold, n AS n_samples, tp, fp, fn, tn,
       round(CAST(tp + fn AS DOUBLE) / n, 4) AS positive_rate_actual,
       round(CAST(tp + fp AS DOUBLE) / n, 4) AS positive_rate_predicted,
       round(CAST(tp + tn AS DOUBLE) / n, 4) AS accuracy,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 4) AS recall,
       round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1 FROM c""")
Q["roc_auc"] = with_(PANEL, SCORED_PANEL, TIED, select=f"""
SELECT cutoff, version, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives,
       round(roc_auc, 4) AS roc_auc FROM {auc("tied", "cutoff", "version")}""")
Q["avg_precision"] = with_(PANEL, SCORED_PANEL, TIED, select=f"""
SELECT cutoff, version, round(pr_auc, 4) AS pr_auc FROM {ap("tied", "cutoff", "version")}""")


def sweep(name: str, source: str, low: int, high: int) -> str:
    return f"""
{name} AS (SELECT g / CAST(100 AS DOUBLE) AS threshold,
  count(*) FILTER (WHERE y_proba >= g / CAST(100 AS DOUBLE) AND y_true = 1) AS tp,
  count(*) FILTER (WHERE y_proba >= g / CAST(100 AS DOUBLE) AND y_true = 0) AS fp,
  count(*) FILTER (WHERE y_proba < g / CAST(100 AS DOUBLE) AND y_true = 1) AS fn,
  count(*) FILTER (WHERE y_proba < g / CAST(100 AS DOUBLE) AND y_true = 0) AS tn
 FROM {source}, generate_series({low}, {high}) AS t(g) GROUP BY g)"""


F1 = "coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)"
Q["f1_sweep"] = with_(SNAP, SCORED, sweep("s", "scored", 5, 95), select=f"""
SELECT threshold, tp, fp, fn, tn, round({F1}, 6) AS f1 FROM s""")
Q["f1_best"] = with_(PANEL, SCORED_PANEL, sweep("s", "scored", 5, 95), select=f"""
SELECT threshold, round({F1}, 4) AS f1 FROM s ORDER BY {F1} DESC, threshold LIMIT 1""")
Q["class_report"] = with_(SNAP, SCORED, f"""
c AS (SELECT {CELLS} FROM scored),
r AS (SELECT 'retained' AS class, tn AS hit, fn AS false_hit, fp AS miss FROM c
      UNION ALL SELECT 'dropout', tp, fp, fn FROM c),
m AS (SELECT class, hit + miss AS support,
        coalesce(CAST(hit AS DOUBLE) / nullif(hit + false_hit, 0), 0) AS precision,
        coalesce(CAST(hit AS DOUBLE) / nullif(hit + miss, 0), 0) AS recall,
        coalesce(CAST(2 * hit AS DOUBLE) / nullif(2 * hit + false_hit + miss, 0), 0) AS f1 FROM r)""",
    select="""
SELECT class, support, round(precision, 4) AS precision, round(recall, 4) AS recall,
       round(f1, 4) AS f1 FROM m
UNION ALL SELECT 'macro avg', CAST(sum(support) AS BIGINT), round(avg(precision), 4),
       round(avg(recall), 4), round(avg(f1), 4) FROM m
UNION ALL SELECT 'weighted avg', CAST(sum(support) AS BIGINT),
       round(sum(precision * support) / sum(support), 4),
       round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4)
FROM m""")
Q["class_balance"] = with_(PANEL, select="""
SELECT cutoff, count(*) AS n, round(avg(dropout), 6) AS positive_rate FROM panel GROUP BY cutoff""")


def ece_bins(source: str, keys: str, p: str = "y_proba") -> str:
    edges = " + ".join(f"CAST({p} > {i} * (1.0 / CAST(10 AS DOUBLE)) AS INTEGER)"
                       for i in range(1, 10))
    return f"""(SELECT {keys} {edges} AS bin, count(*) AS n, avg({p}) AS mp, avg(y_true) AS my,
      sum(({p} - y_true) * ({p} - y_true)) AS sq, sum({p}) AS sp, sum(y_true) AS sy
      FROM {source} GROUP BY ALL)"""


METRICS = """round(sum(sq) / sum(n), 5) AS brier_score,
 round(sum(n * abs(mp - my)) / sum(n), 5) AS expected_calibration_error"""
Q["brier_ece"] = with_(PANEL, SCORED_PANEL, select=f"""
SELECT cutoff, {METRICS}, round(sum(sp) / sum(n), 4) AS mean_predicted,
       round(sum(sy) / sum(n), 4) AS observed_rate,
       round(sum(sp) / sum(n) - sum(sy) / sum(n), 4) AS mean_bias,
       CAST(sum(n) AS BIGINT) AS n_samples
FROM {ece_bins("scored", "cutoff,")} GROUP BY cutoff""")
Q["reliability"] = with_(SNAP, SCORED, select=f"""
SELECT CAST(b AS INTEGER) AS bin, round(b * (1.0 / CAST(10 AS DOUBLE)), 3) AS bin_lower,
       round((b + 1) * (1.0 / CAST(10 AS DOUBLE)), 3) AS bin_upper, coalesce(n, 0) AS n,
       round(mp, 4) AS mean_predicted, round(my, 4) AS observed_rate, round(mp - my, 4) AS gap
FROM generate_series(0, 9) AS t(b) LEFT JOIN {ece_bins("scored", "")} x ON x.bin = b""")
Q["calibration_compare"] = with_(PANEL, SCORED_PANEL, f"""
shrunk AS (SELECT y_true, y_proba * CAST(0.5 AS DOUBLE) AS y_proba FROM scored),
a AS (SELECT {METRICS} FROM {ece_bins("scored", "")}),
b AS (SELECT {METRICS} FROM {ece_bins("shrunk", "")})""", select="""
SELECT a.brier_score AS brier_before, b.brier_score AS brier_after,
       a.expected_calibration_error AS ece_before, b.expected_calibration_error AS ece_after,
       round(a.brier_score - b.brier_score, 5) AS brier_improvement,
       round(a.expected_calibration_error - b.expected_calibration_error, 5) AS ece_improvement,
       b.expected_calibration_error < a.expected_calibration_error AS improved FROM a, b""")



def isotonic(name: str, src: str) -> list[str]:
    """Blocks of the isotonic fit: corners of the convex minorant, where all chords from the left
    are less steep than all chords to the right.  The last CTE is ``name(lo, hi, n, positives, mean)``."""
    return [f"""
{name}_p AS MATERIALIZED (
  SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS DOUBLE) AS x, CAST(0 AS DOUBLE) AS n, CAST(0 AS DOUBLE) AS s
  UNION ALL SELECT row_number() OVER (ORDER BY y_proba), y_proba, CAST(sum(n) OVER (ORDER BY y_proba) AS DOUBLE),
                   CAST(sum(pos) OVER (ORDER BY y_proba) AS DOUBLE)
  FROM (SELECT y_proba, count(*) AS n, sum(y_true) AS pos FROM {src} GROUP BY 1)),
{name}_c AS MATERIALIZED (
  SELECT i, max(down) AS down, min(up) AS up FROM (
    SELECT b.i, (b.s - a.s) / (b.n - a.n) AS down, NULL AS up FROM {name}_p a JOIN {name}_p b ON a.i < b.i
    UNION ALL SELECT a.i, NULL, (b.s - a.s) / (b.n - a.n) FROM {name}_p a JOIN {name}_p b ON a.i < b.i) GROUP BY i),
{name}_v AS (SELECT i, n, s, x, lag(i) OVER w AS pi, lag(n) OVER w AS pn, lag(s) OVER w AS ps
  FROM {name}_p JOIN {name}_c USING (i) WHERE down IS NULL OR up IS NULL OR down < up - 1e-12 WINDOW w AS (ORDER BY i)),
{name} AS MATERIALIZED (SELECT f.x AS lo, v.x AS hi, CAST(v.n - pn AS BIGINT) AS n, CAST(v.s - ps AS BIGINT) AS positives,
  (v.s - ps) / (v.n - pn) AS mean FROM {name}_v v JOIN {name}_p f ON f.i = v.pi + 1)"""]


Q["isotonic_blocks"] = with_(PANEL, SCORED_PANEL, *isotonic("blocks", "scored"), select="""
SELECT round(lo, 9) AS lo, round(hi, 9) AS hi, round(mean, 9) AS mean, n, positives FROM blocks""")


def platt(name: str, src: str) -> list[str]:
    inside = "greatest(least(y_proba, 1 - 1e-15), 1e-15)"
    return [f"""
{name}_n AS (SELECT CAST(sum(y_true) AS DOUBLE) AS pos, CAST(count(*) - sum(y_true) AS DOUBLE) AS neg FROM {src}),
{name}_d AS MATERIALIZED (SELECT 0 AS g, CASE WHEN y_true = 1 THEN (pos + 1) / (pos + 2) ELSE 1 / (neg + 2) END AS y, CAST(1 AS DOUBLE) AS weight,
  CAST(1 AS DOUBLE) AS x0, ln({inside} / (1 - {inside})) AS x1 FROM {src}, {name}_n)""", *newton(name, f"{name}_d", 2)]


Q["sigmoid_weights"] = with_(PANEL, SCORED_PANEL, *platt("fitted", "scored"), select="""
SELECT round(w0, 6) AS intercept, round(w1, 6) AS slope FROM fitted""")
HELD_OUT = (PANEL, SCORED_PANEL, f"""
held_out AS (SELECT y_true, y_proba FROM scored WHERE cutoff = '{CUTOFFS[-2]}'),
tested AS (SELECT y_true, y_proba FROM scored WHERE cutoff = '{TEST}')""")
BEFORE_AFTER = f"""
a AS (SELECT {METRICS} FROM {ece_bins("tested", "")}),
b AS (SELECT {METRICS} FROM {ece_bins("mapped", "")})"""
IMPROVED = """
SELECT '{method}' AS method, a.brier_score AS brier_before, b.brier_score AS brier_after,
       a.expected_calibration_error AS ece_before, b.expected_calibration_error AS ece_after,
       round(a.brier_score - b.brier_score, 5) AS brier_improvement,
       round(a.expected_calibration_error - b.expected_calibration_error, 5) AS ece_improvement,
       b.expected_calibration_error < a.expected_calibration_error AS improved FROM a, b"""
Q["isotonic_calibration"] = with_(*HELD_OUT, *isotonic("blocks", "held_out"), """
knots AS (SELECT x, y, lead(x) OVER (ORDER BY x) AS next_x, lead(y) OVER (ORDER BY x) AS next_y
          FROM (SELECT lo AS x, mean AS y FROM blocks UNION SELECT hi, mean FROM blocks)),
mapped AS (SELECT y_true, CASE WHEN k.x IS NULL THEN (SELECT min(mean) FROM blocks) WHEN next_x IS NULL THEN k.y
                               ELSE k.y + (next_y - k.y) * (t.y_proba - k.x) / (next_x - k.x) END AS y_proba
           FROM tested t ASOF LEFT JOIN knots k ON t.y_proba >= k.x)""", BEFORE_AFTER, select=IMPROVED.format(method="isotonic"))
Q["sigmoid_calibration"] = with_(*HELD_OUT, *platt("fitted", "held_out"), """
mapped AS (SELECT y_true, 1 / (1 + exp(-(w0 + w1 * ln(p / (1 - p))))) AS y_proba
           FROM (SELECT y_true, greatest(least(y_proba, 1 - 1e-15), 1e-15) AS p FROM tested), fitted)""",
    BEFORE_AFTER, select=IMPROVED.format(method="sigmoid"))

# --- costs
TP_COST = "CAST(188 AS DOUBLE)"
COST = f"round(fn * CAST(240 AS DOUBLE) + fp * CAST(20 AS DOUBLE) + tp * {TP_COST}, 2)"
PRICED = f"""{COST} AS total_cost, round({COST} / (tp + fp + fn + tn), 4) AS cost_per_subscriber,
 tp + fp AS flagged, round(CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn), 4) AS flagged_rate"""
Q["cost_sweep"] = with_(SNAP, SCORED, sweep("s", "scored", 1, 99), select=f"""
SELECT threshold, tp, fp, fn, tn, {PRICED} FROM s""")
Q["cost_optimal"] = with_(PANEL, SCORED_PANEL, sweep("s", "scored", 1, 99), select=f"""
SELECT threshold, tp, fp, fn, tn, {PRICED} FROM s ORDER BY total_cost, threshold DESC LIMIT 1""")
ROUNDED = "rounded AS (SELECT y_true, round(y_proba, 2) AS y_proba FROM scored)"
# Rows sorted by score; k-th and (k+1)-th decide the boundary.
ORDERED = """
ordered AS (SELECT *, row_number() OVER (ORDER BY y_proba DESC) AS rn,
                   count(*) OVER () AS n_all FROM rounded)"""


def kth(k: str, src: str = "ordered") -> str:
    """The capacity threshold for ``k`` offers, NULL when nobody fits."""
    return f"""CASE WHEN {k} >= (SELECT max(n_all) FROM {src}) THEN CAST(0 AS DOUBLE) ELSE
 (SELECT CASE WHEN a.y_proba > b.y_proba THEN a.y_proba
         ELSE (SELECT min(c.y_proba) FROM {src} c WHERE c.y_proba > a.y_proba) END
  FROM {src} a JOIN {src} b ON b.rn = a.rn + 1 WHERE a.rn = {k}) END"""


Q["capacity_threshold"] = with_(PANEL, SCORED_PANEL, ROUNDED, ORDERED, f"""
t AS (SELECT {kth("250")} AS t)""", select="""
SELECT CAST(250 AS BIGINT) AS max_offers, round(t, 6) AS capacity_threshold,
       (SELECT count(*) FROM rounded WHERE y_proba >= t) AS offers_used FROM t""")
BEST = sweep("s", "rounded", 1, 99) + f""",
best AS (SELECT threshold, tp + fp AS wanted, {COST} AS total_cost, tp + fp + fn + tn AS population
         FROM s ORDER BY total_cost, threshold DESC LIMIT 1)"""
AT = """SELECT count(*) FILTER (WHERE y_proba >= {t} AND y_true = 1) AS tp,
 count(*) FILTER (WHERE y_proba >= {t} AND y_true = 0) AS fp,
 count(*) FILTER (WHERE y_proba < {t} AND y_true = 1) AS fn,
 count(*) FILTER (WHERE y_proba < {t} AND y_true = 0) AS tn"""
# Above every score when nobody fits the budget.
OP = "CASE WHEN cap IS NULL THEN CAST(2 AS DOUBLE) ELSE greatest(best.threshold, cap) END"
SHOWN = "greatest(threshold, coalesce(cap, (SELECT max(y_proba) FROM rounded)))"
Q["constrained_threshold"] = with_(PANEL, SCORED_PANEL, ROUNDED, ORDERED, BEST, f"""
caps AS (SELECT {kth("100")} AS cap),
op AS (SELECT best.threshold, cap, {OP} AS t FROM best, caps),
cells AS ({AT.format(t="(SELECT t FROM op)")} FROM rounded)""", select=f"""
SELECT CAST(100 AS BIGINT) AS max_offers, cap AS capacity_threshold, {SHOWN} AS threshold,
       tp, fp, fn, tn, {PRICED} FROM op, cells""")
Q["capacity_ladder"] = with_(PANEL, SCORED_PANEL, ROUNDED, ORDERED, BEST, f"""
fractions AS (SELECT unnest([0.25, 0.5, 0.75, 1.0, 1.25, 1.5]) AS f),
ks AS (SELECT DISTINCT CAST(round_even(wanted * CAST(f AS DOUBLE), 0) AS BIGINT) AS k
       FROM best, fractions WHERE round_even(wanted * CAST(f AS DOUBLE), 0) BETWEEN 1 AND population),
bounds AS (SELECT k, a.y_proba AS at_k, b.y_proba AS after_k, n.n_all
           FROM ks LEFT JOIN ordered a ON a.rn = k LEFT JOIN ordered b ON b.rn = k + 1,
                (SELECT max(n_all) AS n_all FROM ordered) n),
caps AS (SELECT k, CASE WHEN k >= n_all THEN CAST(0 AS DOUBLE) WHEN at_k > after_k THEN at_k
                        ELSE (SELECT min(y_proba) FROM rounded WHERE y_proba > at_k) END AS cap
         FROM bounds),
op AS (SELECT k, best.threshold, cap, {OP} AS t FROM best, caps),
cells AS (SELECT k, op.threshold, cap, count(*) FILTER (WHERE y_proba >= t AND y_true = 1) AS tp,
                 count(*) FILTER (WHERE y_proba >= t AND y_true = 0) AS fp,
                 count(*) FILTER (WHERE y_proba < t AND y_true = 1) AS fn,
                 count(*) FILTER (WHERE y_proba < t AND y_true = 0) AS tn
          FROM op, rounded GROUP BY k, op.threshold, cap),
priced AS (SELECT k, {SHOWN} AS shown, {PRICED} FROM cells)""", select="""
SELECT k AS max_offers, round(shown, 4) AS threshold, flagged AS offers_used, total_cost,
       round((lag(total_cost) OVER (ORDER BY k) - total_cost) / (k - lag(k) OVER (ORDER BY k)), 2)
         AS value_per_extra_slot FROM priced""")
Q["capacity_report"] = with_(PANEL, SCORED_PANEL, ROUNDED, ORDERED, BEST, f"""
lim AS (SELECT CAST(floor({d(0.01)} * population) AS BIGINT) AS k FROM best),
caps AS (SELECT {kth("(SELECT k FROM lim)")} AS cap),
op AS (SELECT best.threshold, cap, {OP} AS t FROM best, caps),
cells AS ({AT.format(t="(SELECT t FROM op)")} FROM rounded),
priced AS (SELECT *, {PRICED} FROM cells)""", select=f"""
SELECT population, true AS configured, k AS max_offers, best.threshold AS unconstrained_threshold,
       wanted AS offers_required, best.total_cost AS unconstrained_cost,
       round((SELECT {SHOWN} FROM op), 4) AS constrained_threshold, flagged AS constrained_flagged,
       priced.total_cost AS constrained_cost, flagged < wanted AS binding,
       greatest(wanted - k, 0) AS shortfall,
       round(priced.total_cost - best.total_cost, 2) AS cost_of_constraint
FROM best, lim, priced""")


def detail(side: str, source: str) -> str:
    return ", ".join(
        (f"round({source}.{c}, 4)" if c == "threshold" else f"{source}.{c}") + f" AS {side}_{c}"
        for c in ("threshold", "total_cost", "flagged", "flagged_rate", "cost_per_subscriber"))


ANALYTIC = f"({d(20.0)} / ({d(20.0)} + ({d(240.0)} - {TP_COST})))"


def threshold_ctes(source: str) -> str:
    return sweep("s", source, 1, 99) + f""",
opt AS (SELECT threshold, {PRICED} FROM s ORDER BY total_cost, threshold DESC LIMIT 1),
cur AS (SELECT {d(T)} AS threshold, {PRICED} FROM ({AT.format(t=d(T))} FROM {source})),
ana AS (SELECT {ANALYTIC} AS threshold, {PRICED} FROM ({AT.format(t=ANALYTIC)} FROM {source})),
pop AS (SELECT count(*) AS population FROM {source})"""


Q["threshold_report"] = with_(PANEL, SCORED_PANEL, threshold_ctes("scored"), select=f"""
SELECT population, {detail("current", "cur")}, {detail("analytic", "ana")},
       {detail("optimal", "opt")}, CAST(188 AS DOUBLE) AS cost_true_positive,
       CAST(12 AS DOUBLE) AS cost_ratio,
       round(abs(ana.threshold - opt.threshold), 4) AS analytic_vs_empirical_gap,
       round(cur.total_cost - opt.total_cost, 2) AS savings,
       round((cur.total_cost - opt.total_cost) / population, 4) AS savings_per_subscriber,
       opt.flagged - cur.flagged AS extra_offers_required
FROM cur, ana, opt, pop""")

# --- fairness
GROUPED = """
grouped AS (SELECT 'plan_type' AS attribute, plan_type AS "group", y_true, y_proba FROM scored
            UNION ALL SELECT 'acquisition_channel', acquisition_channel, y_true, y_proba
            FROM scored)"""
GROUPS = f"""
cells AS (SELECT attribute, "group", count(*) AS n, {CELLS} FROM grouped GROUP BY ALL),
groups AS (SELECT attribute, "group", cells.n,
  round(CAST(tp + fn AS DOUBLE) / cells.n, 4) AS base_rate,
  round(CAST(tp + fp AS DOUBLE) / cells.n, 4) AS selection_rate,
  round(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 4) AS recall,
  round(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 4) AS precision,
  round(CAST(fn AS DOUBLE) / nullif(tp + fn, 0), 4) AS false_negative_rate,
  round(roc_auc, 4) AS roc_auc, cells.n >= 30 AS sufficient_sample
 FROM cells JOIN {auc("grouped", "attribute", '"group"')} a USING (attribute, "group"))"""


def spread(metric: str) -> str:
    usable = f"FILTER (WHERE sufficient_sample AND {metric} > 0)"
    return (f"CASE WHEN count(*) {usable} >= 2 THEN round(min({metric}) {usable} "
            f"/ max({metric}) {usable}, 4) END AS {metric}_ratio")


def plain(x: str) -> str:
    return f"regexp_replace(printf('%.4f', {x}), '\\.?0+$', '')"


AUDIT = f"""
ratios AS (SELECT attribute, count(*) AS n_groups,
  count(*) FILTER (WHERE sufficient_sample) AS n_groups_evaluated,
  {spread("selection_rate")}, {spread("recall")}, {spread("roc_auc")} FROM groups GROUP BY attribute),
weak AS (SELECT * FROM groups WHERE sufficient_sample AND roc_auc IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY attribute ORDER BY roc_auc, n DESC, "group") = 1),
audit AS (SELECT r.*, list_filter([
  CASE WHEN selection_rate_ratio < 0.8 THEN 'selection rates differ by more than the 0.8 ratio ('
    || {plain("selection_rate_ratio")} || ') - check whether the underlying churn rates differ too, '
    || 'which would make this expected' END,
  CASE WHEN recall_ratio < 0.8 THEN 'recall differs by more than the 0.8 ratio ('
    || {plain("recall_ratio")} || ') - some groups'' churners are being missed far more often' END,
  CASE WHEN roc_auc_ratio < 0.8 THEN 'discrimination differs by more than the 0.8 ratio ('
    || {plain("roc_auc_ratio")} || ') - the model is measurably less able to rank some groups' END
  ], lambda x: x IS NOT NULL) AS concerns, w."group" AS weakest_group, w.roc_auc AS weakest_roc_auc,
  w.n AS weakest_n FROM ratios r LEFT JOIN weak w USING (attribute))"""
Q["group_metrics"] = with_(SNAP, SCORED, GROUPED, GROUPS, select="SELECT * FROM groups")
Q["disparity"] = with_(SNAP, SCORED, GROUPED, GROUPS, AUDIT, select=f"""
SELECT attribute, {d(T)} AS threshold, n_groups, n_groups_evaluated,
       {d(0.8)} AS disparity_threshold, selection_rate_ratio, recall_ratio, roc_auc_ratio,
       weakest_group, weakest_roc_auc, weakest_n, array_to_string(concerns, '; ') AS concerns,
       len(concerns) = 0 AS passes FROM audit""")
Q["audit"] = with_(SNAP, SCORED, GROUPED, GROUPS, AUDIT, select="""
SELECT bool_and(len(concerns) = 0) AS passes,
       coalesce(string_agg(attribute, ', ' ORDER BY attribute) FILTER (WHERE len(concerns) > 0), '')
         AS attributes_with_concerns FROM audit""")
GATE = f"""
models AS (SELECT 'champion' AS model, y_true, y_proba FROM scored
  UNION ALL SELECT 'challenger', dropout, CAST({proba("challenger")} AS DOUBLE) FROM snap),
gate AS (SELECT round(max(pr_auc) FILTER (WHERE model = 'challenger'), 4) AS challenger_score,
                round(max(pr_auc) FILTER (WHERE model = 'champion'), 4) AS champion_score
         FROM {ap("models", "model")}),
decision AS (SELECT *, CAST(challenger_score AS DECIMAL(6, 4))
                       - CAST(champion_score AS DECIMAL(6, 4)) AS gain FROM gate),
decided AS (SELECT challenger_score, champion_score, gain >= 0.0050 AS promoted,
  CASE WHEN gain >= 0.0050 THEN 'beat champion by ' || printf('%+.4f', CAST(gain AS DOUBLE))
       ELSE 'improvement ' || printf('%+.4f', CAST(gain AS DOUBLE)) || ' below required +0.0050' END
    AS reason FROM decision)"""
Q["promotion_gate"] = with_(SNAP, SCORED, GATE, select="SELECT * FROM decided")

# --- drift
_values = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {{src}}" for c in NUMERIC)


def unpivot(name: str, src: str) -> str:
    return f"{name} AS ({_values.format(src=src)})"


EDGES = """
ranked_values AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS r,
                         count(*) OVER (PARTITION BY feature) AS n FROM ref_values),
steps AS (SELECT CAST(i AS INTEGER) AS i,
                 CASE WHEN i = 10 THEN CAST(1 AS DOUBLE) ELSE i * (1.0 / CAST(10 AS DOUBLE)) END AS p
          FROM generate_series(0, 10) AS t(i)),
wanted AS (SELECT feature, i, p * (n - 1) AS pos FROM (SELECT DISTINCT feature, n FROM ranked_values), steps),
edges AS (SELECT DISTINCT w.feature, lo.value + (coalesce(hi.value, lo.value) - lo.value)
                 * (pos - floor(pos)) AS edge
          FROM wanted w JOIN ranked_values lo ON lo.feature = w.feature AND lo.r = floor(pos)
          LEFT JOIN ranked_values hi ON hi.feature = w.feature AND hi.r = ceil(pos)),
num_bins AS (SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS INTEGER)
               AS bin_no, edge AS lo, lead(edge) OVER (PARTITION BY feature ORDER BY edge) AS hi
             FROM edges QUALIFY hi IS NOT NULL),
bins AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY bin_no) = 1 AS is_first,
                row_number() OVER (PARTITION BY feature ORDER BY bin_no DESC) = 1 AS is_last
         FROM (SELECT * FROM num_bins UNION ALL
               SELECT 'dropout_probability', CAST(b AS INTEGER),
                      round(b * (1.0 / CAST(10 AS DOUBLE)), 4),
                      round((b + 1) * (1.0 / CAST(10 AS DOUBLE)), 4)
               FROM generate_series(0, 9) AS t(b)))"""


def shares(name: str, values: str) -> str:
    return f"""
{name} AS (SELECT b.feature, b.bin_no, b.lo, b.hi, count(v.value) AS n,
  (SELECT count(*) FROM {values} x WHERE x.feature = b.feature) AS n_rows,
  CAST(count(v.value) AS DOUBLE) / (SELECT count(*) FROM {values} x WHERE x.feature = b.feature)
    AS share, (SELECT avg(x.value) FROM {values} x WHERE x.feature = b.feature) AS mean
 FROM bins b LEFT JOIN {values} v ON v.feature = b.feature
   AND (v.value >= b.lo OR b.is_first) AND (v.value < b.hi OR b.is_last)
 GROUP BY b.feature, b.bin_no, b.lo, b.hi)"""


def categories(name: str, src: str) -> str:
    return f"""
{name} AS (SELECT feature, category, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {src}) AS share,
                  (SELECT count(*) FROM {src}) AS n_rows
  FROM (SELECT 'plan_type' AS feature, plan_type AS category FROM {src}
        UNION ALL SELECT 'is_auto_renew_enabled', CAST(is_auto_renew_enabled AS VARCHAR) FROM {src})
  GROUP BY feature, category)"""


REF = (TRAIN, scored("ref", "train"),
       f"ref_values AS ({_values.format(src='ref')} UNION ALL "
       "SELECT 'dropout_probability', y_proba FROM ref)",
       EDGES.replace("FROM ref_values),", "FROM ref_values WHERE feature <> 'dropout_probability'),"),
       shares("ref_shares", "ref_values"), categories("ref_cats", "ref"))
LIVE = (SNAP, """
moved AS (SELECT * REPLACE (CASE WHEN plan_type = 'premium' THEN monthly_fee * CAST(1.5 AS DOUBLE)
                            ELSE monthly_fee END AS monthly_fee) FROM snap)""",
        scored("live", "moved"),
        f"live_values AS ({_values.format(src='live')} UNION ALL "
        "SELECT 'dropout_probability', y_proba FROM live)",
        shares("live_shares", "live_values"), categories("live_cats", "live"))
TERM = ("(greatest({o}, 1e-6) - greatest({r}, 1e-6)) * ln(greatest({o}, 1e-6) / greatest({r}, 1e-6))")
PSI = f"""
num_psi AS (SELECT r.feature, sum({TERM.format(o="l.share", r="r.share")}) AS psi,
                   round(max(r.mean), 4) AS reference_mean, round(max(l.mean), 4) AS live_mean
            FROM ref_shares r JOIN live_shares l USING (feature, bin_no) GROUP BY r.feature),
cat_psi AS (SELECT feature, sum({TERM.format(o="coalesce(l.share, 0)", r="coalesce(r.share, 0)")}) AS psi,
                   coalesce(string_agg(category, ', ' ORDER BY category)
                            FILTER (WHERE r.share IS NULL), '') AS unseen_categories
            FROM ref_cats r FULL JOIN live_cats l USING (feature, category) GROUP BY feature),
all_psi AS (SELECT feature, CASE WHEN feature = 'dropout_probability' THEN 'prediction'
                            ELSE 'numeric' END AS kind, psi, reference_mean, live_mean,
                   CAST(NULL AS VARCHAR) AS unseen_categories FROM num_psi
            UNION ALL SELECT feature, 'discrete', psi, NULL, NULL, unseen_categories FROM cat_psi),
codes AS (SELECT *, CASE WHEN psi >= 0.25 THEN 2 WHEN psi >= 0.1 THEN 1 ELSE 0 END AS code
          FROM all_psi)"""
REF_STATS = f"""
ref_stats AS (SELECT feature, round(stddev_pop(value), 4) AS std, {money("min(value)", 4)} AS min,
                     {money("max(value)", 4)} AS max
              FROM ref_values WHERE feature <> 'dropout_probability' GROUP BY feature)"""
Q["profile_bins"] = with_(*REF, REF_STATS, select="""
SELECT feature, CASE WHEN feature = 'dropout_probability' THEN 'prediction' ELSE 'numeric' END AS kind,
       bin_no, CAST(NULL AS VARCHAR) AS category, n_rows, round(lo, 6) AS lo, round(hi, 6) AS hi,
       round(share, 6) AS share, round(mean, 4) AS mean, std, min, max
FROM ref_shares LEFT JOIN ref_stats USING (feature)
UNION ALL SELECT feature, 'discrete', NULL, category, n_rows, NULL, NULL, round(share, 6), NULL, NULL, NULL, NULL
FROM ref_cats""")
Q["profile_stats"] = with_(TRAIN, unpivot("v", "train"), select=f"""
SELECT feature, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std,
       {money("min(value)", 4)} AS min, {money("max(value)", 4)} AS max FROM v GROUP BY feature""")
Q["psi_numeric"] = with_(*REF, *LIVE, PSI, select="""
SELECT feature, round(psi, 4) AS psi, reference_mean, live_mean FROM num_psi
WHERE feature <> 'dropout_probability'""")
Q["psi_prediction"] = with_(*REF, *LIVE, PSI, select="""
SELECT feature, round(psi, 4) AS psi, reference_mean, live_mean FROM num_psi
WHERE feature = 'dropout_probability'""")
Q["psi_discrete"] = with_(*REF, *LIVE, PSI, select="""
SELECT feature, round(psi, 6) AS psi, unseen_categories FROM cat_psi""")
VERDICT = "CASE {c} WHEN 2 THEN 'significant' WHEN 1 THEN 'moderate' ELSE 'stable' END"
Q["drift_features"] = with_(*REF, *LIVE, PSI, select=f"""
SELECT feature, kind, round(psi, 4) AS psi, CAST(code AS INTEGER) AS verdict_code,
       {VERDICT.format(c="code")} AS verdict, reference_mean, live_mean, unseen_categories FROM codes""")
DRIFT = f"""
drift AS (SELECT (SELECT count(*) FROM live) AS n_samples, CAST(max(code) AS INTEGER) AS verdict_code,
  coalesce(string_agg(feature, ', ' ORDER BY round(psi, 4) DESC, feature) FILTER (WHERE code > 0), '')
    AS drifted_features,
  array_to_string((list(feature ORDER BY round(psi, 4) DESC, feature)
    FILTER (WHERE kind <> 'prediction'))[1:5], ', ') AS top_features FROM codes),
verdict AS (SELECT *, {VERDICT.format(c="verdict_code")} AS overall_verdict FROM drift)"""
Q["drift_report"] = with_(*REF, *LIVE, PSI, DRIFT, select="""
SELECT true AS available, CAST(NULL AS VARCHAR) AS reason, n_samples,
       n_samples >= 100 AS sufficient_sample, overall_verdict, verdict_code, drifted_features,
       top_features FROM verdict""")

# A later cutoff as it is, without scores.
PLAIN_LIVE = tuple(part.replace("monthly_fee * CAST(1.5 AS DOUBLE)", "monthly_fee") for part in LIVE)
Q["drift_asof"] = with_(*REF, *PLAIN_LIVE,
                        PSI.replace("FROM num_psi\n", "FROM num_psi WHERE feature <> "
                                    "'dropout_probability'\n"), DRIFT, select="""
SELECT true AS available, CAST(NULL AS VARCHAR) AS reason, n_samples,
       n_samples >= 100 AS sufficient_sample, overall_verdict, verdict_code, drifted_features,
       top_features FROM verdict""")

# --- catalogue and demo queries
Q["plan_mix"] = with_(select="""
SELECT plan_type, count(*) AS events, round(avg(monthly_fee), 2) AS avg_monthly_fee,
       count(*) FILTER (WHERE is_auto_renew_enabled) AS with_auto_renew
FROM subscription_events GROUP BY plan_type""")
Q["lifecycle_counts"] = with_(select="""
SELECT event_type, count(*) AS occurrences FROM subscription_events GROUP BY event_type""")
Q["channels_top10"] = with_(select="""
SELECT acquisition_channel, count(*) AS subscribers FROM subscribers GROUP BY 1
ORDER BY subscribers DESC, acquisition_channel LIMIT 10""")
Q["cancellations_monthly"] = with_(select="""
SELECT CAST(date_trunc('month', occurred_at) AS DATE) AS month, count(*) AS cancellations
FROM subscription_events WHERE event_type = 'cancellation' AND occurred_at >= '1997-06-01'
GROUP BY 1""")


HISTORY = f"""
history AS (SELECT subscriber_id, 'event' AS record_type, occurred_at, event_type AS detail,
                   {money("monthly_fee")} AS amount FROM subscription_events
  UNION ALL SELECT subscriber_id, 'payment', occurred_at, status, {money("amount")} FROM payments
  UNION ALL SELECT subscriber_id, 'session', occurred_at, 'listened', {money("duration_minutes", 1)}
            FROM sessions)"""
Q["history_360"] = with_(HISTORY, select="SELECT * FROM history")
Q["subscriber_history"] = with_(HISTORY, select="""
SELECT * FROM history WHERE subscriber_id = '7'
ORDER BY occurred_at, record_type, detail, amount LIMIT 40""")
Q["subscriber_sessions"] = with_(select="""
SELECT occurred_at, duration_minutes FROM sessions WHERE subscriber_id = '7'""")
Q["subscribers_head"] = with_(select="SELECT * FROM subscribers ORDER BY subscriber_id LIMIT 10")
Q["event_log_head"] = with_(select="""
SELECT subscriber_id, event_type, plan_type, """ + money("monthly_fee") + """ AS monthly_fee,
       is_auto_renew_enabled, occurred_at FROM subscription_events
ORDER BY occurred_at, event_id LIMIT 15""")
Q["cleaning_log"] = with_("""
steps AS (SELECT 'Orphan rows removed' AS cleaning_step,
    (SELECT count(*) FROM subscription_events
     WHERE subscriber_id NOT IN (SELECT subscriber_id FROM subscribers)) AS amount,
    'they would vanish silently from every query' AS why
  UNION ALL SELECT 'Longest subscriber id', (SELECT max(length(subscriber_id)) FROM subscribers),
    'the id column must hold it without truncation'
  UNION ALL SELECT 'Negative durations clipped',
    (SELECT count(*) FROM lines WHERE l_returnflag = 'R' AND l_quantity > 0),
    'dropping the rows would understate activity, which reads as churn risk'
  UNION ALL SELECT 'Prices normalised',
    (SELECT count(*) FROM orders WHERE substr(o_orderpriority, 1, 1) <> '2'),
    'a plan of many months is not comparable to one of a month'
  UNION ALL SELECT 'Session window bounded',
    (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < '1999-01-01'),
    'older rows are beyond any feature window')""", select="""
SELECT cleaning_step, amount, cleaning_step || ': ' || amount || ' - ' || why AS why_it_mattered
FROM steps""")
WINDOW_MONTH = "occurred_at >= '1999-12-01' AND occurred_at < '2000-01-01'"
Q["arrivals"] = with_(select=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS arrived FROM {t} WHERE {WINDOW_MONTH}"
    for t in ("subscription_events", "payments", "sessions")))
HOLDS = {
    "subscribers": "one row per subscriber",
    "subscription_events": "signups, renewals, plan changes and cancellations",
    "sessions": "one row per usage session",
    "payments": "one row per payment attempt",
    "support_tickets": "one row per support contact",
}
COUNTS = "counts AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, '{h}' AS what_it_holds FROM {t}"
    for t, h in HOLDS.items()) + ")"
Q["table_counts"] = with_(COUNTS, select="SELECT table_name, row_count FROM counts")
Q["total_events"] = with_(COUNTS, select="""
SELECT CAST(sum(row_count) AS BIGINT) AS total_events FROM counts WHERE table_name <> 'subscribers'""")
Q["warehouse_summary"] = with_(COUNTS, select="""
SELECT *, 'star-schema tables' AS source FROM counts""")
Q["reconcile"] = with_(COUNTS, select="""
SELECT table_name, row_count AS source_rows, row_count AS target_rows, 'ok' AS status FROM counts""")
Q["key_slices"] = """
WITH r AS (SELECT min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders),
s AS (SELECT unnest(generate_series(first - 1, last - 1, 4000)) AS low, last FROM r),
b AS (SELECT low, least(low + 4000, last) AS high FROM s)
SELECT low, high, (SELECT count(*) FROM orders WHERE o_orderkey > low AND o_orderkey <= high)
  AS row_count FROM b"""
Q["sql_surface"] = with_(select="""
SELECT plan_type, count(*) AS events FROM subscription_events WHERE event_type = 'cancellation'
GROUP BY plan_type""")

# --- contract
EVENT_TABLES = ("subscription_events", "sessions", "payments", "support_tickets")


def _checks(t: str, numbered: bool = False) -> list[str]:
    when = "signup_date" if t == "subscribers" else "occurred_at"
    rules = [
        ("empty subscriber_id", "error", "subscriber_id IS NULL OR trim(subscriber_id) = ''"),
        ("subscriber_id longer than 64", "error", "length(subscriber_id) > 64"),
        (f"unparseable {when}", "error", f"{when} IS NULL"),
    ]
    rules += {
        "subscription_events": [
            ("unknown event_type", "error",
             "event_type NOT IN ('signup', 'renewal', 'plan_change', 'cancellation')"),
            ("negative monthly_fee", "error", "monthly_fee < 0")],
        "sessions": [("negative duration_minutes", "error", "duration_minutes < 0")],
        "payments": [("unknown status", "error", "status NOT IN ('succeeded', 'failed')"),
                     ("negative amount", "error", "amount < 0")],
    }.get(t, [])
    rows = [f"SELECT '{t}' AS table_name, '{c}' AS \"check\", '{s}' AS severity, "
            f"count(*) AS n_rows, CAST(NULL AS BIGINT) AS n_ids FROM {t} WHERE {w}"
            for c, s, w in rules]
    rows.append(f"SELECT '{t}', 'empty table: its features are constant', 'warning', "
                f"CAST(count(*) = 0 AS BIGINT), NULL FROM {t}")
    key = {"subscribers": "subscriber_id", "subscription_events": "event_id"}.get(t)
    if numbered and not key:
        key = {"sessions": "session_id", "payments": "payment_id"}.get(t, "ticket_id")
    if key:
        rows.append(f"SELECT '{t}', 'duplicate {key}', 'error', "
                    f"CAST(coalesce(sum(n), 0) AS BIGINT), count(*) FROM "
                    f"(SELECT {key}, count(*) AS n FROM {t} GROUP BY 1 HAVING count(*) > 1)")
    if t != "subscribers":
        rows.append(f"SELECT '{t}', 'rows not in the subscribers table', 'error', count(*), "
                    f"count(DISTINCT subscriber_id) FROM {t} "
                    "WHERE subscriber_id NOT IN (SELECT subscriber_id FROM subscribers)")
        rows.append(f"SELECT '{t}', 'activity before the subscriber''s signup_date', 'warning', "
                    f"count(*), count(DISTINCT subscriber_id) FROM {t} JOIN subscribers "
                    "USING (subscriber_id) WHERE CAST(occurred_at AS DATE) < signup_date")
    return rows


CHECKS = "checks AS (" + " UNION ALL ".join(
    c for t in ("subscribers", *EVENT_TABLES) for c in _checks(t)) + ")"
SUMMARY = """
SELECT table_name, count(*) AS n_checks,
       count(*) FILTER (WHERE n_rows > 0 AND severity = 'error') AS n_errors,
       count(*) FILTER (WHERE n_rows > 0 AND severity = 'warning') AS n_warnings,
       CASE WHEN count(*) FILTER (WHERE n_rows > 0 AND severity = 'error') > 0 THEN 'failed'
            WHEN count(*) FILTER (WHERE n_rows > 0 AND severity = 'warning') > 0
            THEN 'ok with warnings' ELSE 'ok' END AS verdict FROM checks GROUP BY table_name"""
Q["contract_report"] = with_(CHECKS, select="SELECT * FROM checks")
Q["contract_summary"] = with_(CHECKS, select=SUMMARY)
BUYERS = """
buyers AS (SELECT subscriber_id FROM subscribers
           WHERE acquisition_channel IN ('building', 'machinery'))"""
Q["orphans"] = with_(BUYERS, select=" UNION ALL ".join(f"""
SELECT '{t}' AS table_name, count(*) AS total_rows,
  count(*) FILTER (WHERE subscriber_id NOT IN (SELECT subscriber_id FROM buyers)) AS orphan_rows,
  count(DISTINCT subscriber_id) FILTER (WHERE subscriber_id NOT IN
    (SELECT subscriber_id FROM buyers)) AS orphan_ids FROM {t}""" for t in EVENT_TABLES))
Q["orphans_dropped"] = with_(BUYERS, select="""
SELECT event_type, count(*) AS n, count(DISTINCT subscriber_id) AS subscribers
FROM subscription_events WHERE subscriber_id IN (SELECT subscriber_id FROM buyers)
GROUP BY event_type""")
Q["presignup"] = with_(select=[c for c in _checks("sessions") if "before the" in c][0]
                       .replace("'sessions',", "'sessions' AS table_name,")
                       .replace("signup_date',", "signup_date' AS \"check\",")
                       .replace("'warning',", "'warning' AS severity,")
                       .replace("count(*),", "count(*) AS n_rows,")
                       .replace("count(DISTINCT subscriber_id) FROM",
                                "count(DISTINCT subscriber_id) AS n_ids FROM"))
RANGES = (("tenure_days", 20000), ("monthly_fee", 10000), ("avg_session_count_last_30d", 10000),
          ("last_activity_days_ago", 20000), ("support_tickets_last_90d", 1000),
          ("payment_failures_last_6m", 1000), ("discounts_used_last_6m", 1000))
_problems = ", ".join(
    [f"CASE WHEN {c} IS NULL OR {c} < 0 OR {c} > {hi} THEN '{c} outside [0, {hi}]' END"
     for c, hi in RANGES]
    + ["CASE WHEN plan_type NOT IN ('basic', 'standard', 'premium') THEN 'unknown plan_type' END",
       "CASE WHEN is_auto_renew_enabled IS NULL THEN 'is_auto_renew_enabled missing' END",
       "CASE WHEN last_activity_days_ago > tenure_days "
       "THEN 'last_activity_days_ago exceeds tenure_days' END"])
Q["request_validation"] = with_(SNAP, f"""
r AS (SELECT * REPLACE (
        CASE WHEN discounts_used_last_6m > 3 THEN 'gold' ELSE plan_type END AS plan_type,
        CASE WHEN payment_failures_last_6m > 3 THEN -monthly_fee ELSE monthly_fee END AS monthly_fee,
        CASE WHEN support_tickets_last_90d > 1 THEN tenure_days + 1 ELSE last_activity_days_ago END
          AS last_activity_days_ago) FROM snap),
p AS (SELECT *, list_filter([{_problems}], lambda x: x IS NOT NULL) AS problems FROM r)""",
    select="""
SELECT subscriber_id, plan_type, array_to_string(problems, '; ') AS problems,
       len(problems) = 0 AS valid FROM p""")
Q["train_gate"] = with_(PANEL, SPLIT, """
g AS (SELECT split, count(*) AS n, count(*) FILTER (WHERE plan_type = 'basic') AS nulls,
             count(*) FILTER (WHERE last_activity_days_ago > tenure_days) AS early,
             CASE WHEN split = 'test' THEN 0 ELSE sum(dropout) END AS pos
      FROM split WHERE split <> 'validation' GROUP BY split),
t AS (SELECT *, CASE split WHEN 'train' THEN 'training' ELSE 'test' END AS title FROM g)""",
    select="""
SELECT 'the ' || title || ' set has missing values' AS problem FROM t WHERE nulls > 0
UNION ALL SELECT 'the ' || title || ' set has activity before signup' FROM t WHERE early > 0
UNION ALL SELECT 'the ' || title || ' churn rate ' || printf('%.2f', 100.0 * pos / n)
  || '% is implausible' FROM t WHERE pos / CAST(n AS DOUBLE) NOT BETWEEN 0.001 AND 0.5
UNION ALL SELECT 'the test set has only one class, so PR-AUC is undefined' FROM t
WHERE split = 'test' AND (pos = 0 OR pos = n)""")

# --- raw-export mapping
Q["ingest_subscribers"] = with_(select="""
SELECT subscriber_id, CASE WHEN day(signup_date) = 1 THEN NULL ELSE signup_date END AS signup_date,
       'via_' || length(acquisition_channel) AS acquisition_channel FROM subscribers""")
RAW = """
raw AS (SELECT *, CAST(o_custkey AS VARCHAR) AS subscriber_id,
          [7, 31, 90, 180, 410][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS days,
          round(o_totalprice / CAST(1000 AS DOUBLE)) AS list_price,
          floor(o_totalprice / CAST(1000 AS DOUBLE)) AS paid FROM orders)"""
Q["ingest_events"] = with_(RAW, select=f"""
SELECT o_orderkey AS event_id, subscriber_id,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN 'cancellation'
            WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE),
                                    o_orderkey) = 1 THEN 'signup' ELSE 'renewal' END AS event_type,
       CASE WHEN days <= 31 THEN 'basic' WHEN days <= 180 THEN 'standard' ELSE 'premium' END
         AS plan_type, round(paid / days * {d(30.44)}, 6) AS monthly_fee,
       o_orderstatus = 'O' AS is_auto_renew_enabled,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS occurred_at FROM raw""")
Q["ingest_payments"] = with_(RAW, select="""
SELECT o_orderkey AS payment_id, subscriber_id,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS occurred_at, paid AS amount,
       'succeeded' AS status, paid < list_price AS discount_applied FROM raw""")
Q["ingest_sessions"] = with_(select="""
SELECT subscriber_id, CAST(CAST(occurred_at AS DATE) AS TIMESTAMP) AS occurred_at,
       CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS duration_minutes
FROM lines WHERE occurred_at >= '1999-01-01'""")
Q["ingest_load"] = with_(COUNTS, select="""
SELECT table_name, CASE table_name WHEN 'support_tickets' THEN 0
         WHEN 'payments' THEN (SELECT count(*) FROM orders) ELSE row_count END AS row_count
FROM counts""")
# The mapped export under the table names, its rows numbered.
MAPPED = f"""
firsts AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1),
subscribers AS (SELECT CAST(c_custkey AS VARCHAR) AS subscriber_id,
    CASE WHEN day(first_order) = 1 THEN NULL ELSE CAST(first_order AS DATE) END AS signup_date
  FROM customer JOIN firsts ON o_custkey = c_custkey),{RAW},
subscription_events AS (SELECT o_orderkey AS event_id, subscriber_id, o_orderdate AS occurred_at,
    'renewal' AS event_type, paid / days AS monthly_fee FROM raw),
payments AS (SELECT o_orderkey AS payment_id, subscriber_id, o_orderdate AS occurred_at,
    'succeeded' AS status, paid AS amount FROM raw),
sessions AS (SELECT row_number() OVER () AS session_id, CAST(o_custkey AS VARCHAR) AS subscriber_id,
    l_shipdate AS occurred_at, CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END
      AS duration_minutes FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
support_tickets AS (SELECT payment_id AS ticket_id, subscriber_id, occurred_at FROM payments
                    WHERE false)"""
Q["ingest_dry_run"] = f"WITH {MAPPED}, checks AS (" + " UNION ALL ".join(
    c for t in ("subscribers", *EVENT_TABLES) for c in _checks(t, True)) + ")" + SUMMARY
Q["dead_features"] = with_(SNAP, """
z AS (SELECT * REPLACE (0 AS support_tickets_last_90d, 0 AS payment_failures_last_6m) FROM snap)""",
    wide("w", "z"), select=" UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c}) = max({c}) AS constant FROM w" for c in ALL_NUMERIC))

# --- serving log and monitoring
LOG = f"""
req AS (SELECT e.event_id AS request_id, e.ts AS served_at, s.*
        FROM events e JOIN snap s ON s.subscriber_id = CAST(e.user_id AS VARCHAR)),
served AS (SELECT *, dropout AS y_true, CAST({proba("champion")} AS DOUBLE) AS y_proba,
                  CAST({proba("challenger")} AS DOUBLE) AS c_proba FROM req),
log AS (SELECT request_id, served_at, round(y_proba, 4) AS dropout_probability,
               {LABEL} AS predicted_label, {BAND} AS risk_level FROM served),
pairs AS (SELECT request_id, served_at, y_proba AS champion_probability,
                 c_proba AS challenger_probability, {LABEL} AS champion_label,
                 CAST(c_proba >= {T} AS INTEGER) AS challenger_label,
                 {LABEL} = CAST(c_proba >= {T} AS INTEGER) AS agreed,
                 abs(y_proba - c_proba) AS divergence FROM served)"""
Q["shadow_pairs"] = with_(SNAP, LOG, select="""
SELECT request_id, champion_label, challenger_label, agreed,
       round(champion_probability, 6) AS champion_probability,
       round(challenger_probability, 6) AS challenger_probability,
       round(divergence, 6) AS divergence FROM pairs""")
RECENT = "(SELECT * FROM {t} ORDER BY served_at DESC, request_id DESC LIMIT 5000)"
Q["shadow_summary"] = with_(SNAP, LOG, select=f"""
SELECT (SELECT count(*) FROM pairs) AS compared_total, count(*) AS window_size,
       CAST(5000 AS BIGINT) AS window_capacity,
       round(avg(CAST(agreed AS INTEGER)), 4) AS agreement_rate,
       round(avg(divergence), 4) AS mean_absolute_divergence,
       round(max(divergence), 4) AS max_absolute_divergence,
       round(avg(champion_label), 4) AS champion_flagged_rate,
       round(avg(challenger_label), 4) AS challenger_flagged_rate,
       round(avg(challenger_label) - avg(champion_label), 4) AS flagged_rate_delta,
       count(*) FILTER (WHERE challenger_label > champion_label) AS challenger_flags_more,
       count(*) FILTER (WHERE challenger_label < champion_label) AS challenger_flags_fewer
FROM {RECENT.format(t="pairs")}""")
Q["shadow_readiness"] = with_(SNAP, LOG, select="""
SELECT count(*) >= 200 AS sufficient_evidence, count(*) AS compared_total,
       CAST(200 AS BIGINT) AS required FROM pairs""")
Q["prediction_log_summary"] = with_(SNAP, LOG, select=f"""
SELECT (SELECT count(*) FROM log) AS served_total, count(*) AS window_size,
       CAST(5000 AS BIGINT) AS window_capacity,
       round(coalesce(avg(predicted_label), 0), 4) AS flagged_rate,
       round(avg(dropout_probability), 4) AS mean,
       round(quantile_cont(dropout_probability, 0.5), 4) AS p50,
       round(quantile_cont(dropout_probability, 0.9), 4) AS p90,
       round(min(dropout_probability), 4) AS min, round(max(dropout_probability), 4) AS max,
       count(*) FILTER (WHERE risk_level = 'low') AS n_low,
       count(*) FILTER (WHERE risk_level = 'medium') AS n_medium,
       count(*) FILTER (WHERE risk_level = 'high') AS n_high
FROM {RECENT.format(t="log")}""")
Q["mean_score_shift"] = with_(SNAP, LOG, TRAIN, scored("ref", "train"), select=f"""
SELECT count(*) AS window_size, round(avg(dropout_probability), 4) AS live_mean,
       round((SELECT avg(y_proba) FROM ref), 4) AS reference_mean,
       round(round(avg(dropout_probability), 4) - round((SELECT avg(y_proba) FROM ref), 4), 4)
         AS probability_mean_shift FROM {RECENT.format(t="log")}""")
Q["prediction_counts"] = with_(SNAP, LOG, select="""
SELECT risk_level, predicted_label, count(*) AS n FROM log GROUP BY ALL""")
P_BUCKETS = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.85, 1.0)
D_BUCKETS = (0.01, 0.025, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 1.0)


def bucket_list(bounds) -> str:
    return "unnest([" + ", ".join(d(b) for b in bounds) + ", 1e9])"


Q["score_histogram"] = with_(SNAP, LOG, select=f"""
SELECT risk_level, le, count(*) FILTER (WHERE dropout_probability <= le) AS cumulative
FROM log, (SELECT {bucket_list(P_BUCKETS)} AS le) GROUP BY risk_level, le""")
Q["shadow_histogram"] = with_(SNAP, LOG, select=f"""
SELECT le, count(*) FILTER (WHERE divergence <= le) AS cumulative
FROM pairs, (SELECT {bucket_list(D_BUCKETS)} AS le) GROUP BY le""")
Q["agreement_counts"] = with_(SNAP, LOG, select="""
SELECT agreed, count(*) AS n FROM pairs GROUP BY agreed""")
Q["histogram_quantile"] = with_(SNAP, LOG, f"""
h AS (SELECT le, count(*) FILTER (WHERE dropout_probability <= le) AS cum
      FROM log, (SELECT {bucket_list(P_BUCKETS)} AS le) GROUP BY le),
b AS (SELECT le, cum, coalesce(lag(le) OVER (ORDER BY le), 0) AS low,
             coalesce(lag(cum) OVER (ORDER BY le), 0) AS before, max(cum) OVER () AS total FROM h),
qs AS (SELECT unnest([{", ".join(d(x) for x in (0.5, 0.9, 0.95, 0.99))}]) AS quantile)""", select="""
SELECT quantile, round(CASE WHEN le = 1e9 THEN low
         ELSE low + (le - low) * (quantile * total - before) / nullif(cum - before, 0) END, 6) AS value
FROM qs, b WHERE cum >= quantile * total
QUALIFY row_number() OVER (PARTITION BY quantile ORDER BY le) = 1""")
Q["rate_5m"] = with_(SNAP, LOG, select="""
SELECT time_bucket(INTERVAL 5 MINUTE, served_at) AS window_start, risk_level, count(*) AS n,
       round(count(*) / CAST(300 AS DOUBLE), 6) AS rate_per_sec FROM log GROUP BY 1, 2""")
SAMPLES = """
w1 AS (SELECT time_bucket(INTERVAL 6 HOUR, served_at) AS ts, avg(predicted_label) AS flagged,
              avg(dropout_probability) AS mean FROM log GROUP BY 1),
w2 AS (SELECT time_bucket(INTERVAL 6 HOUR, served_at) AS ts, avg(CAST(agreed AS INTEGER)) AS agreement,
              avg(challenger_label) - avg(champion_label) AS delta FROM pairs GROUP BY 1),
samples AS (
  SELECT ts, 'subscriber_flagged_rate' AS metric, round(flagged, 4) AS value FROM w1
  UNION ALL SELECT ts, 'subscriber_probability_mean_shift', round(mean - CAST(0.25 AS DOUBLE), 4) FROM w1
  UNION ALL SELECT ts, 'subscriber_shadow_active', CAST(1 AS DOUBLE) FROM w2
  UNION ALL SELECT ts, 'subscriber_shadow_agreement_rate', round(agreement, 4) FROM w2
  UNION ALL SELECT ts, 'subscriber_shadow_flagged_rate_delta', round(delta, 4) FROM w2)"""
Q["metric_samples"] = with_(SNAP, LOG, SAMPLES, select="SELECT * FROM samples")
ALERTS = """
met AS (
  SELECT 'FlaggedRateSpike' AS alert, 'warning' AS severity, 900 AS for_seconds, ts,
         value > 0.5 AS met FROM samples WHERE metric = 'subscriber_flagged_rate'
  UNION ALL SELECT 'ScoreDistributionShift', 'warning', 1800, ts, abs(value) > 0.15
    FROM samples WHERE metric = 'subscriber_probability_mean_shift'
  UNION ALL SELECT 'ShadowLargeBehaviourChange', 'info', 1800, ts, value < 0.7
    FROM samples WHERE metric = 'subscriber_shadow_agreement_rate'
  UNION ALL SELECT 'ShadowOutreachVolumeShift', 'info', 1800, ts, abs(value) > 0.1
    FROM samples WHERE metric = 'subscriber_shadow_flagged_rate_delta'),
islands AS (SELECT *, row_number() OVER (PARTITION BY alert ORDER BY ts)
                   - row_number() OVER (PARTITION BY alert, met ORDER BY ts) AS island FROM met),
episodes AS (SELECT alert, severity, CAST(for_seconds AS BIGINT) AS for_seconds, min(ts) AS started,
                    max(ts) AS ended, count(*) AS n_samples,
                    CAST(epoch(max(ts) - min(ts)) AS BIGINT) AS held_seconds
             FROM islands WHERE met GROUP BY alert, severity, for_seconds, island)"""
Q["alert_persistence"] = with_(SNAP, LOG, SAMPLES, ALERTS, select="""
SELECT *, held_seconds >= for_seconds AS fired FROM episodes""")
Q["alerts_firing"] = with_(SNAP, LOG, SAMPLES, ALERTS, select="""
SELECT l.alert, last_ts, CASE WHEN e.alert IS NULL THEN 'inactive'
         WHEN held_seconds >= for_seconds THEN 'firing' ELSE 'pending' END AS state, started,
       coalesce(held_seconds, 0) AS held_seconds
FROM (SELECT alert, max(ts) AS last_ts FROM met GROUP BY alert) l
LEFT JOIN episodes e ON e.alert = l.alert AND e.ended = l.last_ts""")
ECE1 = f"e AS (SELECT {METRICS} FROM {ece_bins('scored', '')})"
Q["decision_gauges"] = with_(SNAP, SCORED, threshold_ctes("scored"), ECE1, select="""
SELECT 'test_costs_savings' AS metric, round(cur.total_cost - opt.total_cost, 2) AS value FROM cur, opt
UNION ALL SELECT 'test_costs_extra_offers_required', CAST(opt.flagged - cur.flagged AS DOUBLE) FROM cur, opt
UNION ALL SELECT 'test_costs_population', CAST(population AS DOUBLE) FROM pop
UNION ALL SELECT 'test_optimal_optimal_threshold', round(threshold, 4) FROM opt
UNION ALL SELECT 'test_optimal_optimal_total_cost', total_cost FROM opt
UNION ALL SELECT 'test_calibration_brier_score', brier_score FROM e
UNION ALL SELECT 'test_calibration_expected_calibration_error', expected_calibration_error FROM e""")
PLAN_GROUPS = """
grouped AS (SELECT 'plan_type' AS attribute, plan_type AS "group", y_true, y_proba FROM scored)"""
Q["run_report"] = with_(*REF, *LIVE, PSI, DRIFT, SCORED, GATE, PLAN_GROUPS, GROUPS, AUDIT, """
r AS (SELECT promoted, reason AS promotion_reason, len(concerns) = 0 AS fairness_passes, concerns,
             overall_verdict, drifted_features FROM decided, audit, verdict),
a AS (SELECT *, list_filter([
    CASE WHEN NOT promoted THEN 'challenger rejected: ' || promotion_reason END,
    CASE WHEN overall_verdict = 'significant' THEN 'significant drift in ' || drifted_features END,
    CASE WHEN NOT fairness_passes THEN 'fairness: ' || concerns[1] END
  ], lambda x: x IS NOT NULL) AS why FROM r)""", select="""
SELECT promoted, promotion_reason, fairness_passes, overall_verdict,
       array_to_string(why, ' | ') AS attention_reasons, len(why) > 0 AS needs_attention FROM a""")
Q["training_headline"] = with_(PANEL, SPLIT, scored("scored", "split"), f"""
c AS (SELECT split, count(*) AS n_samples, {CELLS} FROM scored GROUP BY split)""", select=f"""
SELECT split, n_samples, round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc,
       round({F1}, 4) AS f1, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 4) AS recall
FROM c JOIN {auc("scored", "split")} a USING (split) JOIN {ap("scored", "split")} b USING (split)""")
Q["stored_run_report"] = with_(select="""
SELECT 'ingest_events' AS metric, CAST(count(*) AS DOUBLE) AS value FROM subscription_events
UNION ALL SELECT 'ingest_with_auto_renew', CAST(count(*) AS DOUBLE) FROM subscription_events
WHERE is_auto_renew_enabled""")
Q["run_history"] = with_(PANEL, SCORED_PANEL, f"""
per AS (SELECT cutoff, {CELLS} FROM scored GROUP BY cutoff),
v AS (SELECT cutoff AS created, CAST(row_number() OVER (ORDER BY cutoff) AS INTEGER) AS version,
             round(roc_auc, 4) AS test_roc_auc, round(pr_auc, 4) AS test_pr_auc,
             round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 4) AS test_recall,
             round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 4) AS test_precision
      FROM per JOIN {auc("scored", "cutoff")} a USING (cutoff) JOIN {ap("scored", "cutoff")} b
        USING (cutoff))""", select="""
SELECT version, created, array_to_string(list_filter([
         CASE WHEN version = (SELECT max(version) FROM v) THEN 'challenger' END,
         CASE WHEN version = (SELECT version FROM v ORDER BY test_pr_auc DESC, version DESC LIMIT 1)
              THEN 'champion' END], lambda x: x IS NOT NULL), ', ') AS aliases,
       test_roc_auc, test_pr_auc, test_recall, test_precision
FROM v ORDER BY version DESC LIMIT 3""")
Q["overview"] = with_(*REF, *LIVE, PSI, DRIFT, SCORED, COUNTS, f"""
c AS (SELECT count(*) AS n_samples, {CELLS} FROM scored)""", select=f"""
SELECT (SELECT CAST(sum(row_count) AS BIGINT) FROM counts) AS total_rows,
       (SELECT count(*) FROM counts) AS n_tables, c.n_samples, {d(T)} AS threshold,
       round((SELECT roc_auc FROM {auc("scored")}), 4) AS roc_auc,
       round((SELECT pr_auc FROM {ap("scored")}), 4) AS pr_auc,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 4) AS recall,
       true AS drift_available, overall_verdict AS drift_verdict FROM c, verdict""")
QUALITY = (SNAP, SCORED, threshold_ctes("scored"), ECE1, PLAN_GROUPS, GROUPS, AUDIT, """
m AS (SELECT count(*) AS n_samples, avg(y_proba) AS mp, avg(y_true) AS my FROM scored)""", """
quality AS (
SELECT brier_score, expected_calibration_error, round(mp, 4) AS mean_predicted,
       round(my, 4) AS observed_rate, round(mp - my, 4) AS mean_bias, n_samples,
       round(cur.total_cost - opt.total_cost, 2) AS savings,
       round(opt.threshold, 4) AS optimal_threshold,
       opt.flagged - cur.flagged AS extra_offers_required, opt.flagged AS offers_required,
       false AS binding, CAST(0 AS BIGINT) AS shortfall, CAST(0 AS DOUBLE) AS cost_of_constraint,
       selection_rate_ratio, recall_ratio, roc_auc_ratio, len(concerns) = 0 AS fairness_passes
FROM e, cur, opt, audit, m)""")
Q["decision_quality"] = with_(*QUALITY, select="SELECT * FROM quality")
_gauges = {
    "calibration_ece": "expected_calibration_error", "cost_savings_available": "savings",
    "offers_required": "offers_required", "capacity_binding": "binding",
    "capacity_shortfall": "shortfall", "capacity_cost": "cost_of_constraint",
    "fairness_passes": "fairness_passes", "fairness_ratio_selection": "selection_rate_ratio",
    "fairness_ratio_recall": "recall_ratio", "fairness_ratio_roc_auc": "roc_auc_ratio",
}
_gauge_rows = " UNION ALL ".join(
    f"SELECT 'subscriber_model_{name}' AS metric, CAST({c} AS DOUBLE) AS value FROM quality"
    for name, c in _gauges.items())
Q["report_gauges"] = with_(*QUALITY, *REF, *LIVE[1:], PSI, select=f"""
SELECT TIMESTAMP '2000-01-01 00:00:00' AS ts, metric, round(value, 6) AS value FROM (
  {_gauge_rows} UNION ALL SELECT 'subscriber_drift_psi_' || feature, round(psi, 4) FROM codes)
WHERE value IS NOT NULL""")
Q["report_alerts"] = with_(*QUALITY, select="""
SELECT alert, TIMESTAMP '2000-01-01 00:00:00' AS last_ts,
       CASE WHEN met THEN 'pending' ELSE 'inactive' END AS state,
       CASE WHEN met THEN TIMESTAMP '2000-01-01 00:00:00' END AS started,
       CAST(0 AS BIGINT) AS held_seconds
FROM (SELECT 'FairnessDisparity' AS alert, NOT fairness_passes AS met FROM quality
      UNION ALL SELECT 'RetentionCapacityBinding', binding FROM quality
      UNION ALL SELECT 'OutreachVolumeUnaffordable', offers_required > 5000 FROM quality)""")

# --- streaming: the same results in batch
MESSAGES = """
msg AS (SELECT e.*, CAST(user_id AS VARCHAR) AS key, s.subscriber_id AS known
        FROM events e LEFT JOIN snap s ON s.subscriber_id = CAST(e.user_id AS VARCHAR))"""
GOOD = "event_type NOT IN ('error', 'signup') AND known IS NOT NULL"
Q["stream_scored"] = with_(SNAP, SCORED, RULES, MESSAGES, select=f"""
SELECT event_id AS source_offset, subscriber_id, round(y_proba, 4) AS dropout_probability,
       {LABEL} AS predicted_label, {BAND} AS risk_level, explanation
FROM msg JOIN told ON subscriber_id = known WHERE {GOOD}""")
Q["stream_dead_letters"] = with_(SNAP, MESSAGES, select=f"""
SELECT event_id AS "offset", CAST(user_id % 4 AS INTEGER) AS partition, key,
       CASE event_type WHEN 'error' THEN 'message at offset ' || event_id || ' is not valid JSON'
         WHEN 'signup' THEN 'expected a JSON object, got list'
         ELSE 'missing required fields: monthly_fee, avg_session_count_last_30d, '
           || 'last_activity_days_ago, support_tickets_last_90d, payment_failures_last_6m, '
           || 'discounts_used_last_6m, plan_type, is_auto_renew_enabled' END AS reason,
       CASE event_type WHEN 'error' THEN substr(props, 1, length(props) - 1)
         WHEN 'signup' THEN '[' || key || ', ' || event_id || ']'
         ELSE '{{"subscriber_id": "' || key || '", "tenure_days": 10}}' END AS payload
FROM msg WHERE NOT ({GOOD})""")
Q["stream_stats"] = with_(SNAP, MESSAGES, select=f"""
SELECT count(*) AS messages, count(*) FILTER (WHERE {GOOD}) AS scored,
       count(*) FILTER (WHERE NOT ({GOOD})) AS dead_lettered, true AS agrees_with_runner FROM msg""")
Q["stream_rate_windows"] = """
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       count(*) AS n, round(count(*) / CAST(300 AS DOUBLE), 6) AS rate_per_sec,
       time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
         <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE AS closed
FROM events
GROUP BY time_bucket(INTERVAL 5 MINUTE, ts), event_type"""

# --- the stored warehouse holds what the tables hold
Q["stored_panel"] = Q["panel_cutoffs"]
Q["incremental_panel"] = Q["panel_cutoffs"]
Q["stored_history"] = Q["subscriber_history"]
