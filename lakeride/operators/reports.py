"""Team reports over gold and silver, and the table audits.

Every time-windowed report also filters the partition column with the
bound it implies (report_date is the date of report_hour), so a date
partitioned gold table is pruned; Catalyst does not derive that itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import date_of, hour_floor, ts_lit

DROP_FACTOR = 0.8  # fixed value: alert when this hour < 80 % of the last


def daily_revenue_by_route(gold: DataFrame, as_of=None) -> DataFrame:
    """Yesterday per route; avg_fare is the unweighted mean of hourly averages."""
    day = F.date_sub(date_of(as_of), 1)
    return (gold.filter(F.col("report_date") == day)
            .groupBy("report_date", "route_name")
            .agg(F.sum("trip_count").alias("total_trips"),
                 F.sum("total_revenue").alias("total_revenue"),
                 F.avg("avg_fare").alias("avg_fare"))
            .orderBy(F.col("total_revenue").desc()))


def weekly_top_routes(gold: DataFrame, as_of=None) -> DataFrame:
    """All routes of the last 7 days (8 calendar dates), no LIMIT."""
    return (gold.filter(F.col("report_date") >= F.date_sub(date_of(as_of), 7))
            .groupBy("route_name")
            .agg(F.sum("trip_count").alias("total_trips"),
                 F.sum("total_revenue").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc()))


def _since_hour(gold: DataFrame, start) -> DataFrame:
    return gold.filter((F.col("report_date") >= F.to_date(start)) & (F.col("report_hour") >= start))


def current_hour_performance(gold: DataFrame, as_of=None) -> DataFrame:
    h = hour_floor(ts_lit(as_of))
    return (_since_hour(gold, h).groupBy("route_name")
            .agg(F.sum("trip_count").alias("trips_this_hour"),
                 F.sum("total_revenue").alias("revenue_this_hour"))
            .orderBy(F.col("revenue_this_hour").desc()))


def revenue_drop_alert(gold: DataFrame, as_of=None, factor: float = DROP_FACTOR,
                       method: str = "single_scan") -> DataFrame:
    """Routes whose revenue since the current hour began is below ``factor``
    times the previous full hour.

    One scan and one aggregate instead of two CTE scans and a join: the
    conditional sums reproduce the inner join (a route needs rows in both
    hours, NULL routes never match). The current hour is partial, and a
    route with no rows this hour is not reported (same blind spot).
    """
    h = hour_floor(ts_lit(as_of))
    h_prev = h - F.make_dt_interval(F.lit(0), F.lit(1))
    if method == "join":
        return _revenue_drop_join(gold, h, h_prev, factor)
    cur = F.col("report_hour") >= h
    agg = (_since_hour(gold, h_prev)
           .groupBy("route_name")
           .agg(F.sum(F.when(cur, F.col("total_revenue"))).alias("current_hour_revenue"),
                F.sum(F.when(~cur, F.col("total_revenue"))).alias("last_hour_revenue"),
                F.count_if(cur).alias("_n_cur"), F.count_if(~cur).alias("_n_last")))
    last = F.col("last_hour_revenue")
    return (agg.filter(F.col("route_name").isNotNull() & (F.col("_n_cur") > 0) & (F.col("_n_last") > 0)
                       & (F.col("current_hour_revenue") < last * F.lit(factor)))
            .select("route_name", "last_hour_revenue", "current_hour_revenue",
                    F.round((F.col("current_hour_revenue") - last) / F.nullif(last, F.lit(0)) * 100, 1)
                    .alias("pct_change"))
            .orderBy(F.col("pct_change").asc_nulls_last()))


def _revenue_drop_join(gold: DataFrame, h, h_prev, factor: float) -> DataFrame:
    """The two-aggregate inner-join form (both sides are one row per route;
    AQE picks the join strategy from their actual sizes)."""
    current = (_since_hour(gold, h).groupBy("route_name")
               .agg(F.sum("total_revenue").alias("current_hour_revenue")))
    last = (_since_hour(gold, h_prev).filter(F.col("report_hour") < h).groupBy("route_name")
            .agg(F.sum("total_revenue").alias("last_hour_revenue")))
    lr = F.col("last_hour_revenue")
    return (current.join(last, "route_name", "inner")
            .filter(F.col("current_hour_revenue") < lr * F.lit(factor))
            .select("route_name", "last_hour_revenue", "current_hour_revenue",
                    F.round((F.col("current_hour_revenue") - lr) / F.nullif(lr, F.lit(0)) * 100, 1)
                    .alias("pct_change"))
            .orderBy(F.col("pct_change").asc_nulls_last()))


def latest_hourly_revenue(gold: DataFrame, n: int = 20) -> DataFrame:
    """Newest n (hour, route) rows; route breaks ties so the cut is stable.
    A top-n: Spark plans it as TakeOrderedAndProject (per-task top-n)."""
    return (gold.select("report_hour", "route_name", "total_revenue", "trip_count")
            .orderBy(F.col("report_hour").desc(), F.col("route_name").asc_nulls_last())
            .limit(n))


def invalid_pct(silver: DataFrame, as_of=None) -> DataFrame:
    """Total, invalid and invalid percentage for one day; an empty day gives
    NULL instead of the division error ANSI mode would raise."""
    day = silver.filter(F.col("event_date") == date_of(as_of))
    invalid = F.count_if(F.col("is_valid") == F.lit(False))
    return day.agg(F.count(F.lit(1)).alias("total"), invalid.alias("invalid"),
                   F.round(F.try_divide(invalid.cast("double"), F.count(F.lit(1))) * 100, 2)
                   .alias("invalid_pct"))


def table_counts(table: DataFrame, key: str = "trip_id") -> DataFrame:
    """No-loss / no-duplicate audit: rows vs distinct keys."""
    return table.agg(F.count(F.lit(1)).alias("row_count"),
                     F.countDistinct(key).alias("distinct_keys"))
