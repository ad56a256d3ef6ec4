"""Hourly gold rollup, its writer and the current-row view of an append ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schemas import GOLD, GOLD_KEY
from ..functions.timecols import date_of, hour_floor, ts_lit
from ..session import materialize


def hourly_gold(silver: DataFrame, as_of=None, now=None, lookback_days: int = 1) -> DataFrame:
    """Valid trips of the dates ``>= as_of - lookback_days`` per (hour, route).

    avg_fare is SUM/COUNT(*): rows with a NULL fare count in the denominator.
    unique_drivers ignores NULL drivers and is not additive across hours.
    The date filter is on the partition column, so a partitioned silver
    table is pruned to the dates read.
    """
    return hourly_rollup(silver.filter(F.col("event_date") >= F.date_sub(date_of(as_of), lookback_days)), now)


def hourly_rollup(silver: DataFrame, now=None) -> DataFrame:
    """The rollup of all given rows (see :func:`hourly_gold`)."""
    rows = silver.filter(F.col("is_valid") == F.lit(True))
    hour = hour_floor(F.col("created_at"))
    return (rows.groupBy(hour.alias("report_hour"), F.col("route_name"))
            .agg(F.count(F.lit(1)).alias("trip_count"),
                 F.sum("base_fare").alias("total_revenue"),
                 (F.sum("base_fare") / F.count(F.lit(1))).alias("avg_fare"),
                 F.countDistinct("driver_id").alias("unique_drivers"))
            .select("report_hour", "route_name", "trip_count", "total_revenue", "avg_fare",
                    "unique_drivers", ts_lit(now).alias("updated_at"),
                    F.to_date("report_hour").alias("report_date")))


def write_gold(gold: DataFrame, path: str, mode: str = "replace", covered: Column | None = None) -> None:
    """``replace`` (default): dynamic partition overwrite by report_date, so
    re-running an hour rewrites the dates it covers and nothing else.
    ``covered`` is a condition on report_date that holds for the dates the
    run covers: dates of the table that meet it and that the run has no rows
    for (all their trips became invalid) lose their old rows. Without it only
    dates with rows are replaced. A replaced table keeps no history, which
    :func:`.maintenance.ledger` checks.
    ``append``: the faithful plain INSERT (duplicates per key accumulate).

    The shuffle before the write splits a large date (REBALANCE under AQE,
    a deterministic salt otherwise), so no date is written by one task.
    """
    from ..sources.tables import balanced_by, delete_path, mark_replaced, path_exists
    emptied = []
    if mode == "replace" and covered is not None:
        spark = gold.sparkSession
        gold = materialize(gold, "gold-run")
        if path_exists(spark, path):
            old = spark.read.schema(GOLD).parquet(path).filter(covered).select("report_date").distinct()
            # only dates meet here: the few that a run covers
            emptied = [r[0] for r in old.join(gold.select("report_date").distinct(), "report_date", "left_anti").collect()]
    out = balanced_by(gold, "report_date").write.partitionBy("report_date")
    if mode == "replace":
        mark_replaced(gold.sparkSession, path)
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        for date in emptied:
            delete_path(gold.sparkSession, f"{path}/report_date={date.isoformat()}")
    elif mode == "append":
        out.mode("append").parquet(path)
    else:
        raise ValueError(f"unknown gold write mode {mode!r}")


def covered_dates(as_of=None, lookback_days: int = 1) -> Column:
    """The report dates that :func:`hourly_gold` with these arguments covers."""
    return F.col("report_date") >= F.date_sub(date_of(as_of), lookback_days)


def newest_first(table: DataFrame, key, version_col: str) -> list[Column]:
    """Order of the versions of a key: newest, ties by the remaining columns, so the choice is
    the same in every run."""
    rest = [c for c in table.columns if c not in (*key, version_col)]
    return [F.col(version_col).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in rest)]


def latest_per_key(ledger: DataFrame, key=GOLD_KEY, version_col: str = "updated_at") -> DataFrame:
    """Current row per declared key of an append-only ledger.

    The window is partitioned by the full key (hour, route); every partition
    holds only the versions of one key, bounded by the number of reruns.
    """
    w = Window.partitionBy(*key).orderBy(*newest_first(ledger, key, version_col))
    return (ledger.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))
