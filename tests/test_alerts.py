"""Pending/firing intervals, rule routing and notification times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeride.functions.schemas import METRIC_SAMPLE
from lakeride.operators import alerts as A

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def active(spark, minutes, key="s"):
    return spark.createDataFrame([("m", key, T0 + dt.timedelta(minutes=m), 1.0) for m in minutes],
                                 "metric string, labels_key string, eval_ts timestamp_ntz, value double")


def test_for_duration_and_gaps(spark):
    # active 0..4, gap at 5, active 6..7
    got = A.firing_intervals(active(spark, [0, 1, 2, 3, 4, 6, 7]), "1m", "2m").collect()
    assert len(got) == 1
    (r,) = got
    assert (r.pending_at, r.firing_at, r.last_active_at, r.resolved_at) == (
        T0, T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=4), T0 + dt.timedelta(minutes=5))
    assert len(A.firing_intervals(active(spark, [0, 1, 2, 3, 4, 6, 7]), "1m", "0m").collect()) == 2


def test_long_run_across_chunks(spark):
    mins = list(range(0, 4000))  # longer than one islands chunk (1440 steps)
    (r,) = A.firing_intervals(active(spark, mins), "1m", "5m").collect()
    assert r.pending_at == T0 and r.last_active_at == T0 + dt.timedelta(minutes=3999)


def test_alert_rules_on_samples(spark):
    rows = []
    # job down: numRunningJobs = 0 for 4 minutes -> pending at 0, fires at 2m (for 2m)
    for m in range(0, 4):
        rows.append(("flink_jobmanager_numRunningJobs", {"job": "flink-jobmanager"},
                     T0 + dt.timedelta(minutes=m), 0.0))
    # failed DQ freshness task counter increments in gold_aggregation; other dag ignored
    for m, v in [(10, 1), (11, 2)]:
        for dag in ("gold_aggregation", "other_dag"):
            rows.append(("airflow_task_finish_total",
                         {"dag_id": dag, "task_id": "dq_check_freshness", "state": "failed"},
                         T0 + dt.timedelta(minutes=m), float(v)))
    out = A.alert_rules(spark.createDataFrame(rows, METRIC_SAMPLE)).collect()
    names = sorted(r.alertname for r in out)
    assert names == ["DQGateFreshnessFailed", "FlinkJobNotRunning"]
    down = next(r for r in out if r.alertname == "FlinkJobNotRunning")
    assert down.firing_at == T0 + dt.timedelta(minutes=2)
    dq = next(r for r in out if r.alertname == "DQGateFreshnessFailed")
    assert 'dag_id="gold_aggregation"' in dq.labels_key and dq.severity == "critical"


def test_routes_first_match(spark):
    df = spark.createDataFrame([("a", "critical", "dq_gate"), ("b", "critical", "airflow"),
                                ("c", "warning", "kafka"), ("d", "info", "x")],
                               "alertname string, severity string, component string")
    got = {r.alertname: (r.route, r.group_wait_s, r.repeat_interval_s) for r in A.route_alerts(df).collect()}
    assert got == {"a": (1, 10, 1800), "b": (2, 10, 1800), "c": (3, 60, 7200), "d": (0, 30, 3600)}


def test_notification_schedule_repeats_and_guard(spark):
    iv = spark.createDataFrame([
        ("KafkaConsumerLagHigh", "warning", "kafka", "p0", T0, T0, T0 + dt.timedelta(hours=5), None),
        ("KafkaConsumerLagHigh", "warning", "kafka", "p1", T0, T0 + dt.timedelta(hours=4),
         T0 + dt.timedelta(hours=6), None),
        ("FlinkJobRestarting", "warning", "flink", "x", T0, T0, T0, None)],  # shorter than group_wait
        "alertname string, severity string, component string, labels_key string, pending_at timestamp_ntz, "
        "firing_at timestamp_ntz, last_active_at timestamp_ntz, resolved_at timestamp_ntz")
    got = A.notification_schedule(iv, "1m").orderBy("notify_at").collect()
    times = [r.notify_at for r in got]
    # group fires 0h..6h (two members merge); first notice after 1m, then every 2h
    assert times == [T0 + dt.timedelta(minutes=1), T0 + dt.timedelta(hours=2, minutes=1),
                     T0 + dt.timedelta(hours=4, minutes=1)]
    assert all(r.alertname == "KafkaConsumerLagHigh" for r in got)


def _interval(name, key, start, end, severity="warning", component="kafka"):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    return (name, severity, component, key, at(start), at(start), at(end - 1), at(end))


def _plain_notices(rows, wait, every, repeat):
    """Flush by flush, in minutes: (born, at, status, firing, joined, left)."""
    out, f = [], None
    while True:
        starts = [a for _, a, _ in rows if f is None or a > f]
        if not starts:
            return out
        born = min(starts)
        f, before, told = born + wait, set(), None
        while True:
            now = {k for k, a, b in rows if a <= f < b}
            if now != before:
                out.append((born, f, "firing" if now else "resolved", len(now), len(now - before), len(before - now)))
                told = f
            elif now and f - told >= repeat:
                out.append((born, f, "repeat", len(now), 0, 0))
                told = f
            if not now:
                break
            before, f = now, f + every


@pytest.mark.parametrize("seed", range(4))
def test_group_notices_against_flush_by_flush(spark, seed):
    import random

    r = random.Random(seed)
    rows = []
    for key in "abcd":
        at = r.randrange(40)
        for _ in range(r.randrange(1, 25)):
            end = at + r.choice([1, 2, 3, 7, 30, 400])
            rows.append((key, at, end))
            at = end + r.choice([1, 2, 6, 50, 2000])
    iv = spark.createDataFrame(
        [_interval("KafkaConsumerLagHigh", *x) for x in rows] + [_interval("Short", "x", 3, 4, "critical", "other")],
        "alertname string, severity string, component string, labels_key string, pending_at timestamp_ntz, "
        "firing_at timestamp_ntz, last_active_at timestamp_ntz, resolved_at timestamp_ntz")
    minute = lambda t: (t - T0).total_seconds() / 60
    got = A.group_notices(iv, "1m").collect()
    lag = sorted((minute(x.group_firing_at), minute(x.notify_at), x.status, x.firing, x.joined, x["left"])
                 for x in got if x.alertname == "KafkaConsumerLagHigh")
    assert lag == sorted(_plain_notices(rows, 1, 5, 120))
    # half a minute of waiting is over while the other one still fires
    assert [(minute(x.notify_at), x.status) for x in sorted(got, key=lambda x: x.notify_at) if x.alertname == "Short"] == [
        (3.5, "firing"), (8.5, "resolved")]


def test_firing_summary_counts_all_rules(spark):
    iv = spark.createDataFrame([("FlinkJobNotRunning", "critical", "flink", "k", T0, T0, T0, T0)],
                               "alertname string, severity string, component string, labels_key string, "
                               "pending_at timestamp_ntz, firing_at timestamp_ntz, last_active_at timestamp_ntz, "
                               "resolved_at timestamp_ntz")
    out = {r.alertname: r for r in A.firing_summary(iv).collect()}
    assert len(out) == 7
    assert out["FlinkJobNotRunning"].state == "FIRING" and out["FlinkJobNotRunning"].rules_fired == 1
    assert out["KafkaConsumerLagHigh"].state == "inactive"
