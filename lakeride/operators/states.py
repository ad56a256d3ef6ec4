"""Mergeable states of a growing silver table: the gate and the gold run read them, not the trips.

A batch of new silver rows is absorbed once, under its number, into two small
tables: counts per minute for the checks, and trips and fares per (hour,
route, driver) for the rollup. Both only hold sums, so the states of all
batches add up to those of the whole table, late rows included, and distinct
drivers stay exact. A record written last publishes a batch: what a lost
attempt left is not read, and a rerun replaces it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import date_of, hour_floor, ts_lit
from ..sources.tables import path_exists
from .quality import CRITICAL_COLUMNS, FRESHNESS_HOURS, MAX_INVALID_RATIO, any_null, fresh_bound, verdicts

#: files that a batch writes per date at most
DATE_FILES = 8
_KEYS = "event_date date, batch bigint"
CHECKS = f"minute timestamp_ntz, n bigint, invalid bigint, nulls bigint, {_KEYS}"
ROLLUP = f"report_hour timestamp_ntz, route_name string, driver_id string, trips bigint, fare double, {_KEYS}"


def _minute(ts):
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def absorb(silver: DataFrame, batch_id: int, path: str, cols=CRITICAL_COLUMNS) -> bool:
    """Adds the new rows ``silver`` to the states under ``path``; False if the batch is there already.

    Rows without an event date take part in no check and no gold run and are left out."""
    spark = silver.sparkSession
    if path_exists(spark, f"{path}/published/batch={batch_id}/_SUCCESS"):
        return False
    # both states read these columns only, so no more is kept
    rows = silver.where("event_date is not null").select(
        "event_date", "created_at", "route_name", "driver_id", "base_fare", "is_valid",
        any_null(cols).alias("lacking")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        checks = rows.groupBy("event_date", _minute(F.col("created_at")).alias("minute")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_valid") == F.lit(False)).alias("invalid"),
            F.count_if("lacking").alias("nulls"))
        rollup = rows.where("is_valid").groupBy("event_date", hour_floor(F.col("created_at")).alias("report_hour"), "route_name", "driver_id").agg(
            F.count(F.lit(1)).alias("trips"), F.sum("base_fare").alias("fare"))
        # a date's counts are at most one row a minute; its drivers go to a few files
        files = {"checks": checks.repartition("event_date"),
                 "rollup": rollup.repartition("event_date", F.pmod(F.hash("report_hour", "route_name", "driver_id"), F.lit(DATE_FILES)))}
        for name, state in files.items():
            state.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/{name}/batch={batch_id}")
        spark.range(1).select(F.lit(batch_id).cast("long").alias("absorbed")).write.mode("overwrite").parquet(f"{path}/published/batch={batch_id}")
    finally:
        rows.unpersist()
    return True


def read_state(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The ``checks`` or ``rollup`` rows of all published batches; no rows where there is none."""
    schema = {"checks": CHECKS, "rollup": ROLLUP}[name]
    if not path_exists(spark, f"{path}/published"):
        return spark.createDataFrame([], schema)
    published = spark.read.schema("absorbed bigint").parquet(f"{path}/published").select(F.col("absorbed").alias("batch"))
    return spark.read.schema(schema).parquet(f"{path}/{name}").join(published, "batch", "left_semi")


def checks_from_states(spark: SparkSession, path: str, as_of=None, hours: int = FRESHNESS_HOURS,
                       max_ratio: float = MAX_INVALID_RATIO, silver: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`.quality.dq_checks`, from the states.

    A freshness bound inside a minute also needs that one minute's rows, which
    are counted in ``silver``; a bound on a full minute reads states only."""
    bound, today = fresh_bound(as_of, hours), date_of(as_of)
    state = read_state(spark, path, "checks").where(F.col("event_date") >= F.least(F.to_date(bound), today))
    is_today = F.col("event_date") >= today
    sums = state.agg(
        F.coalesce(F.sum(F.when(F.col("minute") >= bound, F.col("n"))), F.lit(0)).alias("fresh_n"),
        F.sum(F.when(is_today, F.col("invalid"))).alias("invalid"), F.sum(F.when(is_today, F.col("n"))).alias("n"),
        F.coalesce(F.sum(F.when(is_today, F.col("nulls"))), F.lit(0)).alias("null_n"))
    next_minute = _minute(bound) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    if not spark.range(1).select(_minute(bound) == bound).head()[0]:
        if silver is None:
            raise ValueError("a freshness bound inside a minute needs the silver rows of that minute")
        edge = silver.where((F.col("event_date") == F.to_date(bound)) & (F.col("created_at") >= bound) & (F.col("created_at") < next_minute))
        # two frames of one row each
        sums = sums.unionByName(edge.agg(F.count(F.lit(1)).alias("fresh_n")), allowMissingColumns=True).agg(
            *[F.sum(c).alias(c) for c in ("fresh_n", "invalid", "n", "null_n")])
    ratio = F.col("invalid").cast("double") / F.nullif(F.col("n"), F.lit(0))
    return verdicts(sums.select("fresh_n", ratio.alias("ratio"), "null_n"), as_of, max_ratio)


def gold_from_states(spark: SparkSession, path: str, now=None, dates=None, since=None) -> DataFrame:
    """The rows of :func:`.gold.hourly_rollup` for the given event ``dates``, or for those from ``since`` on (default: all)."""
    state = read_state(spark, path, "rollup")
    if dates is not None:
        state = state.where(F.col("event_date").isin(list(dates)))
    if since is not None:
        state = state.where(F.col("event_date") >= since)
    # a driver's rows of several batches become one, so counting them counts drivers
    per_driver = state.groupBy("report_hour", "route_name", "driver_id").agg(F.sum("trips").alias("trips"), F.sum("fare").alias("fare"))
    return (per_driver.groupBy("report_hour", "route_name")
            .agg(F.sum("trips").alias("trip_count"), F.sum("fare").alias("total_revenue"), F.count("driver_id").alias("unique_drivers"))
            .select("report_hour", "route_name", "trip_count", "total_revenue",
                    (F.col("total_revenue") / F.col("trip_count")).alias("avg_fare"), "unique_drivers",
                    ts_lit(now).alias("updated_at"), F.to_date("report_hour").alias("report_date")))
