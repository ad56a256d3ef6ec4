"""Metric-series semantics on small hand-made series, plus a brute-force
property check of the bucketed range evaluation."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeride.functions.schemas import METRIC_SAMPLE
from lakeride.operators import metrics as M

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def samples(spark, pts, metric="c", labels=None):
    labels = labels or {"job": "a"}
    return spark.createDataFrame([(metric, labels, T0 + dt.timedelta(seconds=s), float(v)) for s, v in pts],
                                 METRIC_SAMPLE)


def brute_increase(pts, range_s, step_s, end_s):
    """Reset-corrected last-minus-first over (t - range, t] for t on the grid."""
    pts = sorted(pts)
    adj, acc, prev = [], 0.0, None
    for s, v in pts:
        if prev is not None:
            acc += v if v < prev else v - prev
        adj.append((s, acc))
        prev = v
    out = {}
    for t in range(0, end_s + range_s + step_s, step_s):
        inside = [a for s, a in adj if t - range_s < s <= t]
        if len(inside) >= 2:
            out[t] = inside[-1] - inside[0]
    return out


def as_map(df, col):
    return {int((r.eval_ts - T0).total_seconds()): r[col] for r in df.collect()}


def test_increase_with_reset_and_birth(spark):
    # 0s:5 60s:7 120s:2 (reset) 180s:4
    df = samples(spark, [(0, 5), (60, 7), (120, 2), (180, 4)])
    got = as_map(M.counter_increase(df, "5m", "1m"), "increase")
    assert got[180] == 2 + 2 + 2  # 5->7 (+2), reset to 2 (+2), 2->4 (+2)
    assert got[60] == 2           # first sample is the baseline
    assert 0 not in got           # a single sample gives no value


def test_range_is_left_open(spark):
    df = samples(spark, [(0, 1), (60, 2), (120, 3)])
    got = as_map(M.counter_increase(df, "1m", "1m"), "increase")
    # at t=60 the range (0, 60] holds only one sample -> absent
    assert got == {}
    got = as_map(M.counter_increase(df, "2m", "1m"), "increase")
    assert got == {60: 1.0, 120: 1.0}  # (60, 180] holds one sample only


def test_rate_per_second(spark):
    df = samples(spark, [(0, 0), (30, 30), (60, 60)])
    got = as_map(M.counter_rate(df, "2m", "1m"), "rate")
    assert got[60] == 60 / 120


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3600), st.integers(0, 50)), min_size=1, max_size=40,
                unique_by=lambda p: p[0]),
       st.sampled_from([("5m", "1m"), ("1h", "15m"), ("10m", "4m"), ("2m", "5m")]))
def test_increase_matches_brute_force(spark, pts, rs):
    r, s = rs
    got = as_map(M.counter_increase(samples(spark, pts), r, s, chunk="10m"), "increase")
    want = brute_increase(pts, M.seconds(r), M.seconds(s), 3600)
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9
        assert got[k] >= 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3600), st.floats(0, 50, allow_subnormal=False)), min_size=2, max_size=30, unique_by=lambda p: p[0]),
       st.integers(1, 20))
def test_fractional_increase_is_never_negative_and_flat_is_zero(spark, pts, chunk_min):
    flat = [(4000 + 17 * i, 0.1 + 0.2) for i in range(200)]
    got = as_map(M.counter_increase(samples(spark, pts + flat), "10m", "1m", chunk=f"{chunk_min}m"), "increase")
    assert all(v >= 0.0 for v in got.values())
    assert all(got[t] == 0.0 for t in got if 4000 + 600 <= t <= 4000 + 17 * 199)


def brute_extrapolated(pts, r, s, end):
    out = {}
    for t in range(0, end + r + s, s):
        w = sorted((a, v) for a, v in pts if t - r < a <= t)
        if len(w) < 2:
            continue
        inc = sum(b if b < a else b - a for (_, a), (_, b) in zip(w, w[1:]))
        span = w[-1][0] - w[0][0]
        mean = span / (len(w) - 1)
        left, right = w[0][0] - (t - r), t - w[-1][0]
        left = left if left < 1.1 * mean else mean / 2
        right = right if right < 1.1 * mean else mean / 2
        if inc > 0:
            left = min(left, span * w[0][1] / inc)
        out[t] = inc * (span + left + right) / span
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2400), st.integers(0, 50)), min_size=1, max_size=40, unique_by=lambda p: p[0]))
def test_extrapolated_increase_matches_its_definition(spark, pts):
    got = as_map(M.counter_increase(samples(spark, pts), "5m", "1m", extrapolate=True), "increase")
    want = brute_extrapolated(pts, 300, 60, 2400)
    assert set(got) == set(want) and all(abs(got[t] - want[t]) < 1e-6 for t in want)


def test_label_sets_with_quotes_have_different_keys(spark):
    rows = [({"a": "x", "b": "y"},), ({"a": 'x",b="y'},), ({"a": "x\\", "b": "y"},)]
    df = spark.createDataFrame(rows, "l map<string,string>")
    assert df.select(M.labels_key(F.col("l")).alias("k")).distinct().count() == 3


def test_gauge_samples_scan_once_without_ordered_windows(spark, sf0001):
    from lakeride.plans.catalog_metrics import samples as derived
    plan = M.instant_last(derived(spark, sf0001, "up"), "1m")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Window [") == 1  # the one over buckets


def test_no_counter_window_spans_a_series(spark, sf0001):
    from lakeride.plans.catalog_metrics import samples as derived
    plan = M.counter_increase(derived(spark, sf0001, "airflow_task_finish_total"), "1h", "15m")._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "labels_key" in line:
            assert "_b#" in line or "_c#" in line


def test_increase_invariant_to_offset(spark):
    pts = [(0, 1), (50, 4), (130, 9), (200, 15)]
    a = as_map(M.counter_increase(samples(spark, pts), "3m", "1m"), "increase")
    b = as_map(M.counter_increase(samples(spark, [(s, v + 1000) for s, v in pts]), "3m", "1m"), "increase")
    assert a == b


@pytest.mark.parametrize("chunk", ["5m", "7m", "1d"])
def test_instant_last_in_chunks_of_time(spark, chunk):
    import random

    r = random.Random(5)
    times = sorted(r.sample(range(0, 200 * 60), 60))
    base = dt.datetime(2024, 1, 1, 0, 0)
    df = spark.createDataFrame([("up", {"job": "a"}, base + dt.timedelta(seconds=t), float(t)) for t in times], METRIC_SAMPLE)
    got = {(x.eval_ts - base).total_seconds(): x.value for x in M.instant_last(df, "1m", "5m", chunk=chunk).collect()}
    want = {}
    for t in range(0, 220 * 60, 60):
        inside = [x for x in times if t - 300 < x <= t]
        if inside:
            want[float(t)] = float(inside[-1])
    assert got == want
    plan = M.instant_last(df, chunk=chunk)._jdf.queryExecution().optimizedPlan().toString()
    assert all("_c#" in line for line in plan.splitlines() if "Window [" in line)


def test_instant_last_lookback(spark):
    df = samples(spark, [(10, 1), (70, 2)])
    got = as_map(M.instant_last(df, "1m", "5m"), "value")
    assert got[60] == 1 and got[120] == 2
    assert 0 not in got                      # before the first sample
    assert got[360] == 2 and 420 not in got  # 70 + 300 = 370 > 360; 420 is past the lookback


def test_label_matchers_are_anchored(spark):
    df = spark.createDataFrame([
        ("m", {"dag_id": "gold_aggregation"}, T0, 1.0),
        ("m", {"dag_id": "gold_aggregation_v2"}, T0, 1.0),
        ("m", {"dag_id": "test_alert_scenarios"}, T0, 1.0),
        ("m", {}, T0, 1.0)], METRIC_SAMPLE)
    sel = M.select_series(df, "m", {"dag_id": ("=~", "gold_aggregation|test_alert_scenarios")})
    assert sel.count() == 2
    assert M.select_series(df, "m", {"dag_id": ""}).count() == 1  # absent label matches ""


def test_map_metric_names_rules(spark):
    lines = spark.createDataFrame([
        ("airflow.ti.finish.dagA.task1.failed", T0, 1.0),
        ("airflow.ti.finish.dagA.task1.failed.extra", T0, 1.0),   # too many parts -> dropped
        ("airflow.dagrun.duration.success.dagB", T0, 3.0),
        ("airflow.scheduler.tasks.running", T0, 4.0),
        ("something.else", T0, 5.0)], "name string, ts timestamp_ntz, value double")
    out = {r.metric: r for r in M.map_metric_names(lines).collect()}
    assert set(out) == {"airflow_task_finish_total", "airflow_dagrun_duration_seconds",
                        "airflow_scheduler_tasks_running"}
    assert out["airflow_task_finish_total"].labels == {"dag_id": "dagA", "task_id": "task1", "state": "failed"}
    assert out["airflow_dagrun_duration_seconds"].labels == {"dag_id": "dagB", "status": "success"}


def test_threshold_bands_and_up_down(spark):
    df = spark.createDataFrame([(0.0,), (999.0,), (1000.0,), (10000.0,), (None,)], "v double")
    bands = [r.b for r in df.select(M.threshold_bands(F.col("v"), M.LAG_BANDS).alias("b")).collect()]
    assert bands == ["green", "green", "yellow", "red", None]
    ud = [r.s for r in df.select(M.up_down(F.col("v")).alias("s")).collect()]
    assert ud[0] == "DOWN" and ud[1] is None


def test_series_ratio_guards_zero(spark):
    vec = spark.createDataFrame([("x_sum", "k", T0, 10.0), ("x_count", "k", T0, 0.0),
                                 ("x_sum", "j", T0, 10.0), ("x_count", "j", T0, 4.0)],
                                "metric string, labels_key string, eval_ts timestamp_ntz, value double")
    got = {r.labels_key: r.value for r in M.series_ratio(vec, "x_sum", "x_count").collect()}
    assert got == {"k": None, "j": 2.5}


def test_fixture_series_key_equals_canonical(spark, sf0001):
    from lakeride.sources import fixtures as FX
    s = FX.metric_samples(FX.load_table(spark, sf0001, "events"))
    assert s.filter(F.col("labels_key") != M.labels_key(F.col("labels"))).count() == 0


def test_count_birth_option(spark):
    df = samples(spark, [(30, 1), (90, 1)])
    base = as_map(M.counter_increase(df, "5m", "1m"), "increase")
    born = as_map(M.counter_increase(df, "5m", "1m", count_birth=True), "increase")
    assert base[120] == 0.0          # born at 1: the first sample is only the baseline
    assert born[60] == 1.0 and born[120] == 1.0
