"""DuckDB statements for the metric and alert queries.

Samples are restated over ``events`` with plain per-series window functions;
range functions expand every sample to the eval instants whose range holds
it (``generate_series``) and aggregate, the textbook definition.
"""

from __future__ import annotations

import math

from ..functions.timecols import seconds
from ..operators.metrics import STATSD_RULES, rule_regex
from ..sources.fixtures import DAG_IDS, SCRAPE_JOBS, TASK_IDS
from . import params as P
from .oracle import q

US = 1_000_000


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SAMPLES = f"""ev AS (SELECT event_id, ts, event_type, value FROM events),
fin AS (
  SELECT event_id, ts, {_list(DAG_IDS)}[event_id % 3 + 1] AS dag_id,
         {_list(TASK_IDS)}[event_id % 4 + 1] AS task_id,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS state
  FROM ev),
dur AS (
  SELECT event_id, ts, value,
         CASE WHEN event_id % 2 = 0 THEN 'gold_aggregation' ELSE 'test_dq_and_batch' END AS dag_id
  FROM ev WHERE event_type = 'signup'),
samples AS (
  SELECT 'airflow_task_finish_total' AS metric,
         'dag_id="' || dag_id || '",state="' || state || '",task_id="' || task_id || '"' AS labels_key,
         dag_id, task_id, state, NULL AS job, NULL AS consumergroup, NULL AS topic, NULL AS "partition", ts,
         CAST(COUNT(*) OVER (PARTITION BY dag_id, task_id, state, CAST(ts AS DATE)
                             ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value
  FROM fin
  UNION ALL
  SELECT 'kafka_consumergroup_lag',
         'consumergroup="flink-etl-pipeline",partition="' || CAST(event_id % 3 AS VARCHAR) || '",topic="raw.trip.events"',
         NULL, NULL, NULL, NULL, 'flink-etl-pipeline', 'raw.trip.events', CAST(event_id % 3 AS VARCHAR), ts,
         value * 100
  FROM ev WHERE event_type = 'click'
  UNION ALL
  SELECT 'up', 'job="' || {_list(SCRAPE_JOBS)}[event_id % 6 + 1] || '"',
         NULL, NULL, NULL, {_list(SCRAPE_JOBS)}[event_id % 6 + 1], NULL, NULL, NULL, ts,
         CASE WHEN value < 1 THEN 0.0 ELSE 1.0 END
  FROM ev WHERE event_type = 'view'
  UNION ALL
  SELECT 'flink_jobmanager_numRunningJobs', 'job="flink-jobmanager"',
         NULL, NULL, NULL, 'flink-jobmanager', NULL, NULL, NULL, ts,
         CASE WHEN value < 5 THEN 0.0 ELSE 1.0 END
  FROM ev WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'airflow_task_duration_seconds_sum', 'dag_id="' || dag_id || '",task_id="insert_gold_trips_hourly"',
         dag_id, 'insert_gold_trips_hourly', NULL, NULL, NULL, NULL, NULL, ts,
         CAST(SUM(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY dag_id ORDER BY ts, event_id
                                ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(100 AS DOUBLE)
  FROM dur
  UNION ALL
  SELECT 'airflow_task_duration_seconds_count', 'dag_id="' || dag_id || '",task_id="insert_gold_trips_hourly"',
         dag_id, 'insert_gold_trips_hourly', NULL, NULL, NULL, NULL, NULL, ts,
         CAST(COUNT(*) OVER (PARTITION BY dag_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  FROM dur
  UNION ALL
  SELECT 'flink_jobmanager_job_numRestarts', 'job="flink-jobmanager"',
         NULL, NULL, NULL, 'flink-jobmanager', NULL, NULL, NULL, ts,
         CAST(COUNT(*) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  FROM ev WHERE event_type = 'error')"""


def _where(metric: str | None, matchers: dict | None = None) -> str:
    conds = [] if metric is None else [f"metric = '{metric}'"]
    for k, spec in (matchers or {}).items():
        op, val = ("=", spec) if isinstance(spec, str) else spec
        col = f'COALESCE("{k}", \'\')'
        conds.append(f"{col} = '{val}'" if op == "=" else f"regexp_full_match({col}, '{val}')")
    return " AND ".join(conds) or "TRUE"


def increase_cte(name: str, src: str, where: str, range_: str, step: str) -> str:
    r, s = seconds(range_) * US, seconds(step) * US
    return f"""{name}_d AS (
  SELECT metric, labels_key, ts, value,
         lag(value) OVER (PARTITION BY metric, labels_key ORDER BY ts, value) AS prev
  FROM {src} WHERE {where}),
{name}_a AS (
  SELECT metric, labels_key, ts,
         SUM(CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END)
           OVER (PARTITION BY metric, labels_key ORDER BY ts, value ROWS UNBOUNDED PRECEDING) AS adj
  FROM {name}_d),
{name}_e AS (
  SELECT metric, labels_key, adj,
         unnest(generate_series((epoch_us(ts) + {s - 1}) // {s},
                                (epoch_us(ts) + {r} + {s - 1}) // {s} - 1)) AS m
  FROM {name}_a),
{name} AS (
  SELECT metric, labels_key, m, make_timestamp(m * {s}) AS eval_ts,
         MAX(adj) - MIN(adj) AS value, COUNT(*) AS samples
  FROM {name}_e GROUP BY metric, labels_key, m HAVING COUNT(*) >= 2)"""


def instant_cte(name: str, src: str, where: str, step: str, lookback: str = "5m") -> str:
    lb, s = seconds(lookback) * US, seconds(step) * US
    return f"""{name}_e AS (
  SELECT metric, labels_key, ts, value, dag_id, task_id, state, job, consumergroup, topic, "partition",
         unnest(generate_series((epoch_us(ts) + {s - 1}) // {s},
                                (epoch_us(ts) + {lb} + {s - 1}) // {s} - 1)) AS m
  FROM {src} WHERE {where}),
{name} AS (
  SELECT metric, labels_key, m, make_timestamp(m * {s}) AS eval_ts, arg_max(value, ts) AS value,
         any_value(dag_id) AS dag_id, any_value(task_id) AS task_id, any_value(state) AS state,
         any_value(job) AS job, any_value(consumergroup) AS consumergroup, any_value(topic) AS topic,
         any_value("partition") AS "partition"
  FROM {name}_e GROUP BY metric, labels_key, m)"""


def _r6(x: str) -> str:
    return f"ROUND({x}, 6)"


GAUGES = "metric IN ('kafka_consumergroup_lag', 'up', 'flink_jobmanager_numRunningJobs')"
STEP = P.METRIC_STEP

# ---- name mapping ------------------------------------------------------------


def _statsd_lines() -> str:
    dag = f"{_list(DAG_IDS)}[event_id % 3 + 1]"
    task = f"{_list(TASK_IDS)}[(event_id // 8) % 4 + 1]"
    state = "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END"
    return f"""lines AS (
  SELECT ts,
    CASE event_id % 8
      WHEN 0 THEN 'airflow.ti.finish.' || {dag} || '.' || {task} || '.' || {state}
      WHEN 1 THEN 'airflow.ti.start.' || {dag} || '.' || {task}
      WHEN 2 THEN 'airflow.dag.' || {dag} || '.' || {task} || '.duration'
      WHEN 3 THEN 'airflow.dagrun.duration.' || {state} || '.' || {dag}
      WHEN 4 THEN 'airflow.scheduler.tasks.running'
      WHEN 5 THEN 'airflow.dag_processing.total_parse_time'
      WHEN 6 THEN 'airflow.ti.finish.' || {dag} || '.' || {task} || '.' || {state} || '.extra'
      ELSE 'flink.' || event_type || '.records' END AS name,
    CASE WHEN event_id % 8 IN (0, 1, 6) THEN 1.0 ELSE value END AS value
  FROM events)"""


def _mapped() -> str:
    metric_case, key_case = [], []
    for match, mtype, metric, labels, action in STATSD_RULES:
        rx = rule_regex(match, mtype)
        cond = f"regexp_matches(name, '{rx}')"
        if action == "drop":
            metric_case.append(f"WHEN {cond} THEN NULL")
            key_case.append(f"WHEN {cond} THEN NULL")
            continue
        parts = []
        for k, v in sorted(labels.items()):
            val = (f"regexp_extract(name, '{rx}', {int(v[1:])})" if v.startswith("$") else f"'{v}'")
            parts.append(f"'{k}=\"' || {val} || '\"'")
        metric_case.append(f"WHEN {cond} THEN '{metric}'")
        key_case.append(f"WHEN {cond} THEN " + (" || ',' || ".join(parts) if parts else "''"))
    return f"""mapped AS (
  SELECT CASE {' '.join(metric_case)} END AS metric,
         CASE {' '.join(key_case)} END AS labels_key, ts, value, name
  FROM lines)"""


q("map_metric_names", f"""WITH {_statsd_lines()}, {_mapped()}
SELECT metric, labels_key, ts, value FROM mapped WHERE metric IS NOT NULL""")

q("run_state_counts", f"""WITH {_statsd_lines()}, {_mapped()}
SELECT regexp_extract(name, '{rule_regex("airflow.ti.finish.*.*.*", "glob")}', 1) AS dag_id,
       regexp_extract(name, '{rule_regex("airflow.ti.finish.*.*.*", "glob")}', 2) AS task_id,
       regexp_extract(name, '{rule_regex("airflow.ti.finish.*.*.*", "glob")}', 3) AS state,
       COUNT(*) AS finishes
FROM mapped WHERE metric = 'airflow_task_finish_total' GROUP BY 1, 2, 3""")

# ---- gauges & counters -------------------------------------------------------------

q("instant_last", f"""WITH {SAMPLES}, {instant_cte('v', 'samples', GAUGES, STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value')} AS value FROM v""")

q("counter_increase", f"""WITH {SAMPLES},
{increase_cte('inc', 'samples', _where('airflow_task_finish_total'), P.INCREASE_RANGE, P.INCREASE_STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value')} AS increase FROM inc""")

q("counter_rate", f"""WITH {SAMPLES},
{increase_cte('inc', 'samples', _where('airflow_task_finish_total'), P.RATE_RANGE, STEP)}
SELECT metric, labels_key, eval_ts, {_r6(f'value / {float(seconds(P.RATE_RANGE))}')} AS rate FROM inc""")

q("restart_increase", f"""WITH {SAMPLES},
{increase_cte('inc', 'samples', _where('flink_jobmanager_job_numRestarts'), '10m', STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value')} AS increase FROM inc""")



def extrapolated_cte(name: str, src: str, range_: str, step: str) -> str:
    """The scaled increase from its definition, over each sample expanded to its ranges."""
    r, s = seconds(range_) * US, seconds(step) * US
    return f"""{name}_x AS (
  SELECT metric, labels_key, epoch_us(ts) AS t, value,
         unnest(generate_series((epoch_us(ts) + {s - 1}) // {s}, (epoch_us(ts) + {r} + {s - 1}) // {s} - 1)) AS m
  FROM {src}),
{name}_y AS (
  SELECT *, lag(value) OVER (PARTITION BY metric, labels_key, m ORDER BY t, value) AS prev FROM {name}_x),
{name}_z AS (
  SELECT metric, labels_key, m, COUNT(*) AS n, MIN(t) AS t0, MAX(t) AS t1, arg_min(value, t) AS v0,
         SUM(CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END) AS inc
  FROM {name}_y GROUP BY 1, 2, 3 HAVING COUNT(*) >= 2),
{name}_w AS (
  SELECT *, CAST(t1 - t0 AS DOUBLE) AS span, CAST(t1 - t0 AS DOUBLE) / (n - 1) AS mean,
         CAST(t0 - (m * {s} - {r}) AS DOUBLE) AS s_gap, CAST(m * {s} - t1 AS DOUBLE) AS e_gap FROM {name}_z),
{name} AS (
  SELECT metric, labels_key, make_timestamp(m * {s}) AS eval_ts,
    CASE WHEN span = 0 THEN inc ELSE inc * (span
      + least(CASE WHEN s_gap < 1.1 * mean THEN s_gap ELSE mean / 2 END,
              CASE WHEN inc > 0 AND v0 >= 0 THEN span * v0 / inc ELSE 'infinity'::DOUBLE END)
      + CASE WHEN e_gap < 1.1 * mean THEN e_gap ELSE mean / 2 END) / span END AS value
  FROM {name}_w)"""


q("restart_increase_extrapolated", f"""WITH {SAMPLES},
part AS (SELECT * FROM samples WHERE metric = 'flink_jobmanager_job_numRestarts'),
{extrapolated_cte('inc', 'part', '10m', STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value')} AS increase FROM inc""")

q("rate_5m", f"""WITH {SAMPLES},
part AS (SELECT * FROM samples WHERE metric = 'flink_jobmanager_job_numRestarts'),
{extrapolated_cte('inc', 'part', '5m', STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value / 300.0')} AS rate, {_r6('value / 300.0 * 60')} AS per_minute FROM inc""")

q("fractional_increase", f"""WITH {SAMPLES},
part AS (SELECT metric, labels_key, ts, value % 100 AS value FROM samples WHERE metric = 'airflow_task_duration_seconds_sum'),
{increase_cte('inc', 'part', 'TRUE', '2h', P.INCREASE_STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value')} AS increase FROM inc""")

q("sum_by_labels", f"""WITH {SAMPLES},
{increase_cte('inc', 'samples', _where('airflow_task_finish_total'), P.RATE_RANGE, STEP)}
SELECT i.eval_ts, s.state, {_r6(f'SUM(i.value / {float(seconds(P.RATE_RANGE))})')} AS rate
FROM inc i JOIN (SELECT DISTINCT labels_key, state FROM samples
                 WHERE metric = 'airflow_task_finish_total') s USING (labels_key)
GROUP BY i.eval_ts, s.state""")

q("avg_duration", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric LIKE 'airflow_task_duration_seconds_%'", STEP)}
SELECT labels_key, eval_ts,
       MAX(value) FILTER (WHERE metric = 'airflow_task_duration_seconds_sum') /
         NULLIF(MAX(value) FILTER (WHERE metric = 'airflow_task_duration_seconds_count'), 0) AS avg_seconds
FROM v WHERE metric IN ('airflow_task_duration_seconds_sum', 'airflow_task_duration_seconds_count')
GROUP BY labels_key, eval_ts
HAVING COUNT(*) FILTER (WHERE metric = 'airflow_task_duration_seconds_sum') > 0
   AND COUNT(*) FILTER (WHERE metric = 'airflow_task_duration_seconds_count') > 0""")

q("series_reduce", f"""WITH {SAMPLES}, {instant_cte('v', 'samples', GAUGES, STEP)}
SELECT metric, labels_key, {_r6('arg_max(value, eval_ts) FILTER (WHERE value IS NOT NULL)')} AS last_not_null,
       {_r6('SUM(value)')} AS total, {_r6('AVG(value)')} AS mean, {_r6('MAX(value)')} AS max
FROM v GROUP BY metric, labels_key""")

_panels = " UNION ALL ".join(
    f"""SELECT '{name}' AS panel_range, metric, labels_key, {_r6('arg_max(value, eval_ts) FILTER (WHERE value IS NOT NULL)')} AS last_not_null,
       {_r6('SUM(value)')} AS total, {_r6('AVG(value)')} AS mean, {_r6('MAX(value)')} AS max
FROM v WHERE eval_ts >= TIMESTAMP '{start}' AND eval_ts <= TIMESTAMP '{P.PANEL_END}' GROUP BY metric, labels_key"""
    for name, start in (("1h", "2024-01-16 09:00:00"), ("3h", "2024-01-16 07:00:00")))
q("series_reduce_ranges", f"WITH {SAMPLES}, {instant_cte('v', 'samples', GAUGES, STEP)} {_panels}")

q("threshold_bands_jobs", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric = 'flink_jobmanager_numRunningJobs'", STEP)}
SELECT labels_key, eval_ts, {_r6('value')} AS value, CASE WHEN value >= 1 THEN 'green' ELSE 'red' END AS band,
       CASE WHEN value >= 2 THEN 'green' ELSE 'red' END AS band_of_two
FROM v""")

q("threshold_bands_counts", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric IN ('kafka_consumergroup_lag', 'flink_jobmanager_job_numRestarts')", STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value')} AS value,
       CASE WHEN value >= 5000 THEN 'red' WHEN value >= 500 THEN 'yellow' ELSE 'blue' END AS objects,
       CASE WHEN value >= 1000 THEN 'red' WHEN value >= 200 THEN 'yellow' ELSE 'purple' END AS small_objects,
       CASE WHEN value >= 104857600 THEN 'red' WHEN value >= 10485760 THEN 'yellow' ELSE 'green' END AS bytes,
       CASE WHEN value >= 3 THEN 'red' WHEN value >= 1 THEN 'yellow' ELSE 'green' END AS restarts,
       CASE WHEN value >= 5 THEN 'red' WHEN value >= 1 THEN 'yellow' ELSE 'green' END AS checkpoints
FROM v""")

q("threshold_bands", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric = 'kafka_consumergroup_lag'", STEP)}
SELECT labels_key, eval_ts, {_r6('value')} AS value,
       CASE WHEN value IS NULL THEN NULL WHEN value >= 10000 THEN 'red'
            WHEN value >= 1000 THEN 'yellow' ELSE 'green' END AS band
FROM v""")

q("consumer_lag", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric = 'kafka_consumergroup_lag'", STEP)}
SELECT eval_ts, COALESCE(consumergroup, '') AS consumergroup, COALESCE(topic, '') AS topic,
       {_r6('SUM(value)')} AS lag
FROM v GROUP BY 1, 2, 3""")

q("consumer_lag_total", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric = 'kafka_consumergroup_lag'", STEP)}
SELECT eval_ts, {_r6('SUM(value)')} AS lag FROM v GROUP BY eval_ts""")

q("consumer_lag_partition", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric = 'kafka_consumergroup_lag' AND topic = 'raw.trip.events'", STEP)}
SELECT "partition", eval_ts, {_r6('value')} AS value FROM v""")

q("target_status", f"""WITH {SAMPLES}, {instant_cte('v', 'samples', "metric = 'up'", STEP)}
SELECT COALESCE(job, '') AS job, eval_ts, {_r6('value')} AS value,
       CASE WHEN value = 1 THEN 'UP' WHEN value = 0 THEN 'DOWN' END AS status
FROM v""")

q("threshold_state", f"""WITH {SAMPLES},
{instant_cte('v', 'samples', "metric = 'kafka_consumergroup_lag'", STEP)}
SELECT metric, labels_key, eval_ts, {_r6('value')} AS value FROM v WHERE value > 10000""")


def islands_sql(src: str, keys: list[str], k: str = "k") -> str:
    ks = ", ".join(keys)
    return f"""(SELECT {ks}, MIN({k}) AS start_k, MAX({k}) AS end_k FROM (
    SELECT {ks}, {k}, {k} - row_number() OVER (PARTITION BY {ks} ORDER BY {k}) AS grp
    FROM (SELECT DISTINCT {ks}, {k} FROM {src}) x) y
  GROUP BY {ks}, grp)"""


def _ts(expr: str, step_us: int) -> str:
    return f"make_timestamp(({expr}) * {step_us})"


_s15 = seconds(P.INCREASE_STEP) * US
_f30 = math.ceil(seconds(P.FIRING_FOR) / seconds(P.INCREASE_STEP))
q("firing_intervals", f"""WITH {SAMPLES},
{increase_cte('inc', 'samples', _where('airflow_task_finish_total', {'state': 'success'}),
              P.FIRING_RANGE, P.INCREASE_STEP)},
act AS (SELECT metric, labels_key, m AS k FROM inc WHERE value > {P.FIRING_THRESHOLD})
SELECT metric, labels_key, {_ts('start_k', _s15)} AS pending_at, {_ts(f'start_k + {_f30}', _s15)} AS firing_at,
       {_ts('end_k', _s15)} AS last_active_at, {_ts('end_k + 1', _s15)} AS resolved_at
FROM {islands_sql('act', ['metric', 'labels_key'])} i
WHERE start_k + {_f30} <= end_k""")

# ---- alert rules -----------------------------------------------------------------


# Fixed values, stated again on purpose so that a wrong rule shows: name, severity, component,
# metric, range in minutes (None: instant), task, threshold, minutes it must hold.
_DQ = "dag_id IN ('gold_aggregation', 'test_alert_scenarios') AND state = 'failed' AND task_id = "
RULES_AS_SQL = (
    ("DQGateFreshnessFailed", "critical", "dq_gate", "airflow_task_finish_total", "1h", _DQ + "'dq_check_freshness'", "> 0", 0),
    ("DQGateValidityFailed", "critical", "dq_gate", "airflow_task_finish_total", "1h", _DQ + "'dq_check_invalid_ratio'", "> 0", 0),
    ("DQGateNullCheckFailed", "critical", "dq_gate", "airflow_task_finish_total", "1h", _DQ + "'dq_check_null_critical_fields'", "> 0", 0),
    ("FlinkJobNotRunning", "critical", "flink", "flink_jobmanager_numRunningJobs", None, "TRUE", "< 1", 2),
    ("FlinkJobRestarting", "warning", "flink", "flink_jobmanager_job_numRestarts", "10m", "TRUE", "> 3", 0),
    ("KafkaConsumerLagHigh", "warning", "kafka", "kafka_consumergroup_lag", None, "TRUE", "> 10000", 5),
    ("GoldAggregationFailed", "critical", "airflow", "airflow_task_finish_total", "2h", _DQ + "'insert_gold_trips_hourly'", "> 0", 0),
)


def _alert_ctes() -> str:
    s = seconds(STEP)
    ctes, parts = [], []
    for i, (alert, severity, component, metric, range_, cond, hit, minutes) in enumerate(RULES_AS_SQL):
        name = f"r{i}"
        where = f"metric = '{metric}' AND {cond}"
        ctes.append(increase_cte(name, "samples", where, range_, STEP) if range_ else instant_cte(name, "samples", where, STEP))
        f = math.ceil(minutes * 60 / s)
        parts.append(f"SELECT '{alert}' AS alertname, '{severity}' AS severity, '{component}' AS component, "
                     f"labels_key, m AS k, {f} AS for_steps FROM {name} WHERE value {hit}")
    su = s * US
    ctes.append("act AS (" + "\nUNION ALL\n".join(parts) + ")")
    ctes.append(f"""alerts AS (
  SELECT alertname, severity, component, labels_key,
         {_ts('start_k', su)} AS pending_at, {_ts('start_k + for_steps', su)} AS firing_at,
         {_ts('end_k', su)} AS last_active_at, {_ts('end_k + 1', su)} AS resolved_at
  FROM {islands_sql('act', ['alertname', 'severity', 'component', 'labels_key', 'for_steps'])} i
  WHERE start_k + for_steps <= end_k)""")
    return ",\n".join(ctes)


ALERTS = f"{SAMPLES},\n{_alert_ctes()}"


def _route_case() -> tuple[str, str, str]:
    """Route number, group wait and repeat interval in seconds, stated again from the policy."""
    gate = "severity = 'critical' AND component = 'dq_gate'"
    jobs = "severity = 'critical' AND component IN ('flink', 'airflow')"
    low = "severity = 'warning'"
    pick = lambda a, b, c, d: f"CASE WHEN {gate} THEN {a} WHEN {jobs} THEN {b} WHEN {low} THEN {c} ELSE {d} END"
    return (pick(1, 2, 3, 0), f"CAST({pick(10, 10, 60, 30)} AS BIGINT)", f"CAST({pick(1800, 1800, 7200, 3600)} AS BIGINT)")


_RID, _WAIT, _REP = _route_case()
ROUTED = f"""routed AS (
  SELECT *, {_RID} AS route, {_WAIT} AS group_wait_s, {_REP} AS repeat_interval_s FROM alerts)"""

q("alert_rules", f"WITH {ALERTS}\nSELECT * FROM alerts")

q("route_alerts", f"""WITH {ALERTS}, {ROUTED}
SELECT alertname, severity, component, route, group_wait_s, repeat_interval_s,
       COUNT(*) AS intervals, COUNT(DISTINCT labels_key) AS series
FROM routed GROUP BY ALL""")

_su = seconds(STEP) * US
q("notification_schedule", f"""WITH {ALERTS}, {ROUTED},
steps AS (
  SELECT alertname, severity, route, group_wait_s, repeat_interval_s,
         unnest(generate_series(epoch_us(firing_at) // {_su}, epoch_us(last_active_at) // {_su})) AS k
  FROM routed),
eps AS {islands_sql('steps', ['alertname', 'severity', 'route', 'group_wait_s', 'repeat_interval_s'])},
notes AS (
  SELECT alertname, severity, route, start_k,
         unnest(generate_series(start_k * {_su} + group_wait_s * {US}, end_k * {_su},
                                repeat_interval_s * {US})) AS us
  FROM eps WHERE start_k * {_su} + group_wait_s * {US} <= end_k * {_su})
SELECT alertname, severity, route, make_timestamp(start_k * {_su}) AS group_firing_at,
       row_number() OVER (PARTITION BY alertname, severity, route, start_k ORDER BY us) AS notice_no,
       make_timestamp(us) AS notify_at
FROM notes""")

# flush by flush: a group's next flush is one interval on while any member fires, else it starts anew
q("group_notices", f"""WITH RECURSIVE {ALERTS}, {ROUTED},
mem AS MATERIALIZED (
  SELECT alertname, severity, route, group_wait_s AS wait, repeat_interval_s AS rep, labels_key,
         epoch_us(firing_at) // {US} AS a, epoch_us(resolved_at) // {US} AS b
  FROM routed),
fl AS (
  SELECT alertname, severity, route, wait, rep, MIN(a) AS born, MIN(a) + wait AS tick, 0 AS n
  FROM mem GROUP BY alertname, severity, route, wait, rep
  UNION ALL
  SELECT * FROM (
    SELECT f.alertname, f.severity, f.route, f.wait, f.rep,
           CASE WHEN alive THEN born ELSE reborn END AS born,
           CASE WHEN alive THEN tick + 300 ELSE reborn + f.wait END AS tick,
           CASE WHEN alive THEN n + 1 ELSE 0 END AS n
    FROM (SELECT f.alertname, f.severity, f.route, f.wait, f.rep, f.born, f.tick, f.n,
                 bool_or(m.a <= f.tick AND m.b > f.tick) AS alive, MIN(m.a) FILTER (WHERE m.a > f.tick) AS reborn
          FROM fl f JOIN mem m ON m.alertname = f.alertname AND m.severity = f.severity AND m.route = f.route
          GROUP BY f.alertname, f.severity, f.route, f.wait, f.rep, f.born, f.tick, f.n) f) WHERE tick IS NOT NULL),
held AS MATERIALIZED (
  SELECT DISTINCT f.alertname, f.severity, f.route, f.born, f.n, labels_key
  FROM fl f JOIN mem m ON m.alertname = f.alertname AND m.severity = f.severity AND m.route = f.route AND m.a <= f.tick AND m.b > f.tick),
moved AS (
  SELECT alertname, severity, route, born, COALESCE(x.n, y.n + 1) AS n,
         COUNT(*) FILTER (WHERE y.n IS NULL) AS joined, COUNT(*) FILTER (WHERE x.n IS NULL) AS left_n
  FROM (SELECT *, n - 1 AS before FROM held) x FULL JOIN (SELECT *, n AS before FROM held) y
       USING (alertname, severity, route, born, labels_key, before)
  GROUP BY alertname, severity, route, born, COALESCE(x.n, y.n + 1)),
count_now AS (SELECT alertname, severity, route, born, n, COUNT(*) AS firing FROM held GROUP BY alertname, severity, route, born, n),
state AS (
  SELECT f.*, COALESCE(c.firing, 0) AS firing, COALESCE(m.joined, 0) AS joined, COALESCE(m.left_n, 0) AS left_n,
         COALESCE(m.joined, 0) + COALESCE(m.left_n, 0) > 0 AS changed
  FROM fl f LEFT JOIN moved m USING (alertname, severity, route, born, n)
            LEFT JOIN count_now c USING (alertname, severity, route, born, n)),
since AS (
  SELECT *, MAX(n) FILTER (WHERE changed) OVER (PARTITION BY alertname, severity, route, born ORDER BY n) AS told FROM state)
SELECT alertname, severity, route, make_timestamp(born * {US}) AS group_firing_at, make_timestamp(tick * {US}) AS notify_at,
       CASE WHEN NOT changed THEN 'repeat' WHEN firing > 0 THEN 'firing' ELSE 'resolved' END AS status,
       CAST(firing AS BIGINT) AS firing, CAST(joined AS BIGINT) AS joined, CAST(left_n AS BIGINT) AS "left"
FROM since WHERE changed OR (firing > 0 AND (n - told) % (rep // 300) = 0)""")

_RULES_VALUES = ", ".join(f"('{name}', '{severity}', '{component}')" for name, severity, component, *_ in RULES_AS_SQL)
q("firing_summary", f"""WITH {ALERTS},
rules(alertname, severity, component) AS (VALUES {_RULES_VALUES}),
per AS (SELECT alertname, COUNT(*) AS intervals, COUNT(DISTINCT labels_key) AS series,
               MIN(firing_at) AS first_firing_at FROM alerts GROUP BY alertname),
out AS (
  SELECT r.alertname, r.severity, r.component, COALESCE(p.intervals, 0) AS intervals,
         COALESCE(p.series, 0) AS series, p.first_firing_at,
         CASE WHEN p.intervals > 0 THEN 'FIRING' ELSE 'inactive' END AS state
  FROM rules r LEFT JOIN per p USING (alertname))
SELECT *, COUNT(*) FILTER (WHERE state = 'FIRING') OVER () AS rules_fired FROM out""")
