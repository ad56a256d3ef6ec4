"""Deterministic test inputs derived from the driver's ``events`` table.

Everything is a column expression over ``events``; nothing is random and
nothing is clocked, so the rules can be restated in SQL for the oracle.
See FIXTURES.md for the table of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import CREATED_AT_RENDER


def load_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Scan one driver table; ``spread`` round-robins an under-split scan
    (only worth it when row-wise work follows before the first shuffle)."""
    from .tables import spread as _spread
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _spread(df) if spread else df


def _pad(col: Column, width: int) -> Column:
    # zero-pad without truncating wider numbers (lpad would cut them)
    return F.format_string(f"%0{width}d", col)


def trip_record(events: DataFrame) -> Column:
    """The nested raw record (as a struct) for each event row."""
    eid = F.col("event_id")
    val = F.col("value")
    null_str = F.lit(None).cast("string")
    n_seg = (eid % 4 + 1).cast("int")
    segments = F.transform(
        F.sequence(F.lit(1), n_seg),
        lambda i: F.struct(F.concat(F.lit("SEG-00"), i.cast("string")).alias("SEGMENT_ID"),
                           F.array(val, i.cast("double")).alias("_Metrics")))
    return F.struct(
        F.when(eid % 97 == 0, null_str)
         .otherwise(F.concat(F.lit("DRV-"), _pad(eid % 50 + 1, 5))).alias("driver_ID"),
        F.col("user_id").alias("customer_id"),
        F.struct(
            F.concat(F.lit("TXN-"), _pad(eid, 8)).alias("transaction_id"),
            F.struct(
                F.when(eid % 101 == 0, null_str)
                 .otherwise(F.concat(F.lit("TRIP-"), _pad(eid, 8))).alias("trip_id"),
                F.struct(
                    F.when(eid % 89 == 0, F.lit(None).cast("double"))
                     .when(eid % 20 == 0, -val).otherwise(val).alias("base_fare"),
                    F.struct(F.col("event_type").alias("route_name"),
                             segments.alias("segments")).alias("route_data"),
                ).alias("pricing"),
                F.when(eid % 83 == 0, F.lit("garbage"))
                 .otherwise(F.date_format(F.col("ts"), CREATED_AT_RENDER)).alias("createdAt"),
            ).alias("trip_info"),
        ).alias("transactionRecord"),
        F.array(F.array(F.array(val, F.lit(0.0)))).alias("COORDINATES"),
    )


def raw_trip_json(events: DataFrame) -> DataFrame:
    """``DataFrame[value STRING]`` shaped like the topic's message values.

    ``to_json`` leaves NULL fields out, which also exercises missing keys."""
    return events.select(F.to_json(trip_record(events)).alias("value"))


def raw_trip_json_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trip_json(load_table(spark, sf_dir, "events"))


# ---- metric series ----------------------------------------------------------
# Label values used by the derived series (the scheduler's DAG
# and task ids, the scrape jobs, the consumer group and topic).
DAG_IDS = ["gold_aggregation", "test_alert_scenarios", "test_dq_and_batch"]
TASK_IDS = ["dq_check_freshness", "dq_check_invalid_ratio",
            "dq_check_null_critical_fields", "insert_gold_trips_hourly"]
SCRAPE_JOBS = ["airflow", "flink-jobmanager", "flink-taskmanager", "kafka",
               "minio-cluster", "prometheus"]
CONSUMER_GROUP = "flink-etl-pipeline"
TOPIC = "raw.trip.events"


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _series_key(*pairs) -> Column:
    """Canonical series text (k="v" sorted by key, comma-joined) for labels
    this producer knows, so consumers need not derive it from the map."""
    parts = []
    for name, col in sorted(pairs, key=lambda p: p[0]):
        parts += [F.lit(("," if parts else "") + f'{name}="'), col, F.lit('"')]
    return F.concat(*parts)


def _hour_chunk() -> Column:
    return F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3_600_000_000))


# Metrics of the counter families and of the gauges, by the event type that feeds a gauge.
COUNTER_METRICS = {"finish": ("airflow_task_finish_total",),
                   "duration": ("airflow_task_duration_seconds_sum", "airflow_task_duration_seconds_count"),
                   "restarts": ("flink_jobmanager_job_numRestarts",)}
GAUGE_METRICS = {"click": "kafka_consumergroup_lag", "view": "up", "purchase": "flink_jobmanager_numRunningJobs"}


def metric_samples(events: DataFrame, metrics=None) -> DataFrame:
    """Labelled samples ``(metric, labels, ts, value, labels_key)`` derived
    from events (``labels_key`` is the canonical series text).

    Every event finishes one task (a counter per dag/task/state that resets
    at midnight) and adds one family-specific sample chosen by event_type
    (see FIXTURES.md §5). ``metrics`` names the metrics wanted (None: all):
    only their families are derived, gauges by one scan without a shuffle,
    counters by one scan that emits the rows of all wanted families.
    """
    wanted = set(metrics) if metrics is not None else {m for ms in COUNTER_METRICS.values() for m in ms} | set(GAUGE_METRICS.values())
    base = events.select("event_id", "ts", "event_type", "value")
    parts = []
    families = [f for f, ms in COUNTER_METRICS.items() if wanted & set(ms)]
    if families:
        parts.append(_counter_samples(base, families))
    types = [t for t, m in GAUGE_METRICS.items() if m in wanted]
    if types:
        parts.append(_gauge_samples(base, types))
    out = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    return out if metrics is None else out.filter(F.col("metric").isin(*sorted(wanted)))


def _counter_samples(base: DataFrame, families: list[str]) -> DataFrame:
    """All cumulative families go through one chunked running-sum pass (hour chunks), so a hot
    series is never ordered in a single task and the ordered work is planned once."""
    from ..functions.runs import running_sums

    eid = F.col("event_id")
    etype = F.col("event_type")
    no_reset = F.lit("1970-01-01").cast("date")

    def row(fam, k1, k2, k3, day, cents):
        return F.struct(F.lit(fam).alias("fam"), k1.alias("k1"), k2.alias("k2"), k3.alias("k3"), day.alias("day"), cents.alias("cents"))

    empty, zero = F.lit(""), F.lit(0).cast("long")
    of = {
        "finish": row("finish", _pick(DAG_IDS, eid % 3), _pick(TASK_IDS, eid % 4),
                      F.when(etype == "error", "failed").otherwise("success"), F.to_date("ts"), zero),
        # summed in whole cents so every engine gets the same exact total
        "duration": F.when(etype == "signup", row(
            "duration", F.when(eid % 2 == 0, "gold_aggregation").otherwise("test_dq_and_batch"),
            F.lit("insert_gold_trips_hourly"), empty, no_reset, F.round(F.col("value") * 100).cast("long"))),
        "restarts": F.when(etype == "error", row("restarts", empty, empty, empty, F.to_date("ts"), zero)),
    }
    each = base.select("event_id", "ts", F.explode(F.array(*(of[f] for f in families))).alias("r")).filter("r is not null")
    counters = running_sums(each.select("event_id", "ts", "r.*"),
                            ["fam", "k1", "k2", "k3", "day"], ["ts", "event_id"],
                            {"n": F.lit(1).cast("long"), "csum": F.col("cents")}, _hour_chunk())

    fam = F.col("fam")
    job_fm = F.create_map(F.lit("job"), F.lit("flink-jobmanager"))
    dur_labels = F.create_map(F.lit("dag_id"), "k1", F.lit("task_id"), "k2")
    fin_key = _series_key(("dag_id", F.col("k1")), ("state", F.col("k3")), ("task_id", F.col("k2")))
    dur_key = _series_key(("dag_id", F.col("k1")), ("task_id", F.col("k2")))
    job_key = _series_key(("job", F.lit("flink-jobmanager")))
    return counters.select("ts", F.explode(F.array(
        F.when(fam == "finish", F.struct(
            F.lit("airflow_task_finish_total").alias("metric"),
            F.create_map(F.lit("dag_id"), "k1", F.lit("state"), "k3", F.lit("task_id"), "k2").alias("labels"),
            fin_key.alias("labels_key"), F.col("n").cast("double").alias("value"))),
        F.when(fam == "duration", F.struct(
            F.lit("airflow_task_duration_seconds_sum").alias("metric"), dur_labels.alias("labels"),
            dur_key.alias("labels_key"), (F.col("csum") / 100.0).alias("value"))),
        F.when(fam == "duration", F.struct(
            F.lit("airflow_task_duration_seconds_count").alias("metric"), dur_labels.alias("labels"),
            dur_key.alias("labels_key"), F.col("n").cast("double").alias("value"))),
        F.when(fam == "restarts", F.struct(
            F.lit("flink_jobmanager_job_numRestarts").alias("metric"), job_fm.alias("labels"),
            job_key.alias("labels_key"), F.col("n").cast("double").alias("value"))),
    )).alias("s")).filter(F.col("s").isNotNull()).select("s.metric", "s.labels", "ts", "s.value",
                                                         "s.labels_key")


def _gauge_samples(base: DataFrame, types: list[str]) -> DataFrame:
    eid = F.col("event_id")
    etype = F.col("event_type")
    job_fm = F.create_map(F.lit("job"), F.lit("flink-jobmanager"))
    job_key = _series_key(("job", F.lit("flink-jobmanager")))
    lag_key = _series_key(("consumergroup", F.lit(CONSUMER_GROUP)), ("partition", (eid % 3).cast("string")),
                          ("topic", F.lit(TOPIC)))
    return base.filter(etype.isin(*types)).select(
        F.when(etype == "click", "kafka_consumergroup_lag")
         .when(etype == "view", "up")
         .otherwise("flink_jobmanager_numRunningJobs").alias("metric"),
        F.when(etype == "click", F.create_map(
            F.lit("consumergroup"), F.lit(CONSUMER_GROUP), F.lit("partition"), (eid % 3).cast("string"),
            F.lit("topic"), F.lit(TOPIC)))
         .when(etype == "view", F.create_map(F.lit("job"), _pick(SCRAPE_JOBS, eid % 6)))
         .otherwise(job_fm).alias("labels"),
        "ts",
        F.when(etype == "click", F.col("value") * 100)
         .when(etype == "view", F.when(F.col("value") < 1, 0.0).otherwise(1.0))
         .otherwise(F.when(F.col("value") < 5, 0.0).otherwise(1.0)).alias("value"),
        F.when(etype == "click", lag_key)
         .when(etype == "view", _series_key(("job", _pick(SCRAPE_JOBS, eid % 6))))
         .otherwise(job_key).alias("labels_key"))


def statsd_lines(events: DataFrame) -> DataFrame:
    """Raw StatsD metric names ``(name, ts, value)``, one per event, covering
    every mapping rule plus names that must fall through to the drop rule."""
    eid = F.col("event_id")
    dag = _pick(DAG_IDS, eid % 3)
    task = _pick(TASK_IDS, F.floor(eid / 8) % 4)
    state = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    kind = eid % 8
    name = (F.when(kind == 0, F.concat_ws(".", F.lit("airflow.ti.finish"), dag, task, state))
            .when(kind == 1, F.concat_ws(".", F.lit("airflow.ti.start"), dag, task))
            .when(kind == 2, F.concat_ws(".", F.lit("airflow.dag"), dag, task, F.lit("duration")))
            .when(kind == 3, F.concat_ws(".", F.lit("airflow.dagrun.duration"), state, dag))
            .when(kind == 4, F.lit("airflow.scheduler.tasks.running"))
            .when(kind == 5, F.lit("airflow.dag_processing.total_parse_time"))
            .when(kind == 6, F.concat_ws(".", F.lit("airflow.ti.finish"), dag, task, state, F.lit("extra")))
            .otherwise(F.concat_ws(".", F.lit("flink"), F.col("event_type"), F.lit("records"))))
    value = F.when(kind.isin(0, 1, 6), F.lit(1.0)).otherwise(F.col("value"))
    return events.select(name.alias("name"), "ts", value.alias("value"))
