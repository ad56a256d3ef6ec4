"""Named metric and alert queries over samples derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts as A
from ..operators import metrics as M
from ..sources import fixtures as FX
from . import params as P
from ..session import materialize
from .catalog import register


def samples(spark, d, *metrics):
    """Derived samples of these metrics (none named: all), computed where they are used."""
    return M.with_series(FX.metric_samples(FX.load_table(spark, d, "events", spread=False), metrics or None))


def _vec_cols(df, value="value"):
    return df.select("metric", "labels_key", "eval_ts", value)


GAUGES = ("kafka_consumergroup_lag", "up", "flink_jobmanager_numRunningJobs")


@register("map_metric_names")
def _map_metric_names(spark, d):
    mapped = M.map_metric_names(FX.statsd_lines(FX.load_table(spark, d, "events")))
    return mapped.select("metric", M.labels_key(F.col("labels")).alias("labels_key"), "ts", "value")


@register("run_state_counts")
def _run_state_counts(spark, d):
    return M.run_state_counts(M.map_metric_names(FX.statsd_lines(FX.load_table(spark, d, "events"))))


@register("instant_last")
def _instant_last(spark, d):
    s = samples(spark, d, *GAUGES)
    return _vec_cols(M.instant_last(s, P.METRIC_STEP, "5m"))


@register("counter_increase")
def _counter_increase(spark, d):
    s = M.select_series(samples(spark, d, "airflow_task_finish_total"), "airflow_task_finish_total")
    return _vec_cols(M.counter_increase(s, P.INCREASE_RANGE, P.INCREASE_STEP), "increase")


@register("counter_rate")
def _counter_rate(spark, d):
    s = M.select_series(samples(spark, d, "airflow_task_finish_total"), "airflow_task_finish_total")
    return _vec_cols(M.counter_rate(s, P.RATE_RANGE, P.METRIC_STEP), "rate")


@register("restart_increase")
def _restart_increase(spark, d):
    """Counter with daily resets: increase(numRestarts[10m])."""
    s = M.select_series(samples(spark, d, "flink_jobmanager_job_numRestarts"), "flink_jobmanager_job_numRestarts")
    return _vec_cols(M.counter_increase(s, "10m", P.METRIC_STEP), "increase")


@register("restart_increase_extrapolated")
def _restart_increase_extrapolated(spark, d):
    """increase(numRestarts[10m]) scaled to the edges of the range."""
    s = samples(spark, d, "flink_jobmanager_job_numRestarts")
    return _vec_cols(M.counter_increase(s, "10m", P.METRIC_STEP, extrapolate=True), "increase")


@register("rate_5m")
def _rate_5m(spark, d):
    """rate(numRestarts[5m]), scaled to the range's edges, and the same per minute."""
    s = samples(spark, d, "flink_jobmanager_job_numRestarts")
    rate = M.counter_rate(s, "5m", P.METRIC_STEP, extrapolate=True)
    return rate.select("metric", "labels_key", "eval_ts", "rate", (F.col("rate") * 60).alias("per_minute"))


@register("fractional_increase")
def _fractional_increase(spark, d):
    """A counter of fractional seconds that resets (its restart at each full hundred)."""
    s = samples(spark, d, "airflow_task_duration_seconds_sum")
    s = s.withColumn("value", F.col("value") % 100)
    return _vec_cols(M.counter_increase(s, "2h", P.INCREASE_STEP), "increase")


@register("sum_by_labels")
def _sum_by_labels(spark, d):
    """sum by (state) (rate(airflow_task_finish_total[range]))"""
    s = M.select_series(samples(spark, d, "airflow_task_finish_total"), "airflow_task_finish_total")
    rate = M.counter_rate(s, P.RATE_RANGE, P.METRIC_STEP, keep=("state",)).withColumnRenamed("rate", "value")
    return M.sum_by(rate, ["state"], out="rate")


@register("avg_duration", exact=("avg_seconds",))
def _avg_duration(spark, d):
    return M.avg_duration(samples(spark, d, "airflow_task_duration_seconds_sum", "airflow_task_duration_seconds_count"), step=P.METRIC_STEP).select("labels_key", "eval_ts", "avg_seconds")


@register("series_reduce")
def _series_reduce(spark, d):
    s = samples(spark, d, *GAUGES)
    return M.series_reduce(M.instant_last(s, P.METRIC_STEP, "5m"))


@register("series_reduce_ranges")
def _series_reduce_ranges(spark, d):
    """The panel reducers over the last hour and the last three hours."""
    vec = M.instant_last(samples(spark, d, *GAUGES), P.METRIC_STEP, "5m")
    hour, three = (M.series_reduce(vec, start, P.PANEL_END).withColumn("panel_range", F.lit(name)) for name, start in P.PANEL_STARTS.items())
    return hour.unionByName(three)


@register("threshold_bands_jobs")
def _threshold_bands_jobs(spark, d):
    """Running jobs: red without one, and red below two."""
    vec = M.instant_last(samples(spark, d, "flink_jobmanager_numRunningJobs"), P.METRIC_STEP)
    return vec.select("labels_key", "eval_ts", "value", M.threshold_bands(F.col("value"), M.RUNNING_JOB_BANDS).alias("band"),
                      M.threshold_bands(F.col("value"), M.TWO_JOB_BANDS).alias("band_of_two"))


@register("threshold_bands_counts")
def _threshold_bands_counts(spark, d):
    """The bands of counts, bytes, restarts and failed checkpoints, each on the lag and on the restart counter."""
    vec = M.instant_last(samples(spark, d, "kafka_consumergroup_lag", "flink_jobmanager_job_numRestarts"), P.METRIC_STEP)
    bands = {"objects": M.OBJECT_BANDS, "small_objects": M.SMALL_OBJECT_BANDS, "bytes": M.BYTES_BANDS,
             "restarts": M.RESTART_BANDS, "checkpoints": M.FAILED_CHECKPOINT_BANDS}
    return vec.select("metric", "labels_key", "eval_ts", "value", *(M.threshold_bands(F.col("value"), b).alias(name) for name, b in bands.items()))


@register("threshold_bands")
def _threshold_bands(spark, d):
    vec = M.instant_last(M.select_series(samples(spark, d, "kafka_consumergroup_lag"), "kafka_consumergroup_lag"), P.METRIC_STEP)
    return vec.select("labels_key", "eval_ts", "value",
                      M.threshold_bands(F.col("value"), M.LAG_BANDS).alias("band"))


@register("consumer_lag")
def _consumer_lag(spark, d):
    return M.consumer_lag(samples(spark, d, "kafka_consumergroup_lag"), P.METRIC_STEP)


@register("consumer_lag_total")
def _consumer_lag_total(spark, d):
    return M.consumer_lag(samples(spark, d, "kafka_consumergroup_lag"), P.METRIC_STEP, by=None)


@register("consumer_lag_partition")
def _consumer_lag_partition(spark, d):
    """kafka_consumergroup_lag{topic="raw.trip.events"} per partition."""
    s = M.select_series(samples(spark, d, "kafka_consumergroup_lag"), "kafka_consumergroup_lag", {"topic": "raw.trip.events"})
    return M.instant_last(s, P.METRIC_STEP, keep=("partition",)).select("partition", "eval_ts", "value")


@register("target_status")
def _target_status(spark, d):
    return M.target_status(samples(spark, d, "up"), P.METRIC_STEP)


@register("threshold_state")
def _threshold_state(spark, d):
    vec = M.instant_last(M.select_series(samples(spark, d, "kafka_consumergroup_lag"), "kafka_consumergroup_lag"), P.METRIC_STEP)
    return _vec_cols(A.threshold_state(vec, ">", 10000))


@register("firing_intervals")
def _firing_intervals(spark, d):
    """increase(airflow_task_finish_total{state="success"}[2h]) > 1 for 30m."""
    s = M.select_series(samples(spark, d, "airflow_task_finish_total"), "airflow_task_finish_total", {"state": "success"})
    inc = M.counter_increase(s, P.FIRING_RANGE, P.INCREASE_STEP).withColumnRenamed("increase", "value")
    return A.firing_intervals(A.threshold_state(inc, ">", P.FIRING_THRESHOLD), P.INCREASE_STEP, P.FIRING_FOR)


def _alerts(spark, d):
    # seven rules read the samples, so they are written once
    used = materialize(samples(spark, d, *sorted({r.metric for r in A.ALERT_RULES})), "metric-samples")
    return A.alert_rules(used, A.ALERT_RULES, P.METRIC_STEP, materialize=True)


@register("alert_rules")
def _alert_rules(spark, d):
    return _alerts(spark, d)


@register("route_alerts")
def _route_alerts(spark, d):
    routed = A.route_alerts(_alerts(spark, d))
    return (routed.groupBy("alertname", "severity", "component", "route", "group_wait_s", "repeat_interval_s")
            .agg(F.count(F.lit(1)).alias("intervals"), F.countDistinct("labels_key").alias("series")))


@register("notification_schedule")
def _notification_schedule(spark, d):
    return A.notification_schedule(_alerts(spark, d), P.METRIC_STEP)


@register("group_notices")
def _group_notices(spark, d):
    return A.group_notices(_alerts(spark, d), P.METRIC_STEP)


@register("firing_summary")
def _firing_summary(spark, d):
    return A.firing_summary(_alerts(spark, d))
