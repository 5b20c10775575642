"""Queries: Structured Streaming operators (H1-H3) with batch SQL oracles
(stream result = batch result)."""

from __future__ import annotations

from quench.plans.registry import register
from quench.sources.fixtures import table
from quench.streaming import monitor, sessions

EV_CTE = ("ev AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END "
          "AS value FROM events)")


def _ev(body: str, extra: str = "") -> str:
    return "WITH " + EV_CTE + (",\n" + extra if extra else "") + "\n" + body


@register("h1_stream_clean_derive", _ev(
    "SELECT event_id, ts, event_type, coalesce(value, m) AS value_filled, "
    "coalesce(value, m) * coalesce(value, m) AS value_squared, CAST(value IS NULL AS INTEGER) AS was_missing "
    "FROM ev CROSS JOIN med", "med AS (SELECT quantile_cont(value, 0.5) AS m FROM ev)"),
    ["value_filled", "value_squared"])
def q_h1(spark, sf_dir):
    return monitor.stream_clean_derive(spark, sf_dir)


@register("h2_stream_window_monitor", _ev(
    "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events, "
    "count(*) - count(value) AS n_missing, avg(value) AS avg_value, "
    "(count(*) - count(value)) / count(*) AS missing_rate, count(CASE WHEN value > 200.0 THEN 1 END) AS n_above_limit "
    "FROM ev GROUP BY 1, 2"), ["avg_value", "missing_rate"])
def q_h2(spark, sf_dir):
    return monitor.stream_window_monitor(spark, sf_dir, "1 hour", None, "2 hours")


_SESSIONS = _ev(
    "SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events, "
    "count(*) - count(value) AS n_missing FROM g GROUP BY user_id, sid",
    "s AS (SELECT user_id, ts, value, event_id, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) "
    "IS NULL OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 "
    "END AS new_s FROM ev),\n"
    "g AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid "
    "FROM s)")


@register("h2_session_windows", _SESSIONS)
def q_h2s(spark, sf_dir):
    return monitor.sessions(table(spark, sf_dir, "events"), "30 minutes")


@register("h2_stream_sessions", _SESSIONS)
def q_h2_stream_sessions(spark, sf_dir):
    return monitor.stream_sessions(spark, sf_dir, "30 minutes")


@register("h2_stateful_sessions", _SESSIONS)
def q_h2_stateful_sessions(spark, sf_dir):
    return sessions.stream_sessions_stateful(spark, sf_dir, "30 minutes")


@register("h2_stream_sliding_windows", _ev(
    "SELECT s AS window_start, event_type, count(*) AS n_events, count(*) - count(value) AS n_missing, avg(value) AS avg_value, "
    "(count(*) - count(value)) / count(*) AS missing_rate, count(CASE WHEN value > 200.0 THEN 1 END) AS n_above_limit "
    "FROM w GROUP BY 1, 2",
    "w AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS s FROM ev UNION ALL "
    "SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE AS s FROM ev)"), ["avg_value", "missing_rate"])
def q_h2_sliding(spark, sf_dir):
    return monitor.stream_window_monitor(spark, sf_dir, "1 hour", "30 minutes", "2 hours")


@register("h2_stream_outlier_rate", _ev(
    "SELECT date_trunc('day', ts) AS window_start, count(value) AS n_value, "
    "count(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers, "
    "count(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 END) / nullif(count(value), 0) AS outlier_rate "
    "FROM ev CROSS JOIN q GROUP BY 1",
    "q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ev)"), ["outlier_rate"])
def q_h2_outlier_rate(spark, sf_dir):
    return monitor.stream_outlier_rate(spark, sf_dir)


@register("h3_stream_dedupe", _ev("SELECT event_id, ts, user_id, event_type, value FROM ev"), ["value"])
def q_h3(spark, sf_dir):
    return monitor.stream_dedupe(spark, sf_dir, "2 hours")
