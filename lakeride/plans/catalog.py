"""Named queries over the driver's tables: fixtures -> operators.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
work grows with the input tables. Double columns are rounded to 6 places in
the catalogue only (order of floating additions differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold as G
from ..operators import ingest as I
from ..operators import lenient as L
from ..operators import quality as Q
from ..operators import reports as R
from ..session import pin_session
from ..sources import fixtures as FX
from . import params as P

Builder = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Builder] = {}


def register(name: str, exact: tuple[str, ...] = ()):
    """``exact`` names double columns both engines compute bit-identically
    (no order-dependent sums); those are left unrounded because half-way
    rounding of a double differs between engines."""
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_session(spark)
            return round_doubles(fn(spark, sf_dir), keep=exact)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        CATALOG[name] = run
        return run
    return deco


def round_doubles(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) and f.name not in keep else F.col(f.name)
                       for f in df.schema.fields])


# ---- shared fixture chain -------------------------------------------------

def decoded(spark, d):
    return I.decode_trip_json(FX.raw_trip_json_from(spark, d))


def silver(spark, d):
    return I.flatten_silver(decoded(spark, d), now=P.INGEST_NOW)


def bronze(spark, d):
    return I.flatten_bronze(decoded(spark, d), now=P.INGEST_NOW)


def gold(spark, d, now=P.GOLD_NOW):
    return G.hourly_gold(silver(spark, d), as_of=P.GOLD_AS_OF, now=now)


# ---- ingest ---------------------------------------------------------------

@register("bronze_trips")
def _bronze_trips(spark, d):
    """Raw layer: both ids required, created_at as text."""
    return bronze(spark, d)


@register("bronze_trips_variant")
def _bronze_trips_variant(spark, d):
    """The same rows through one VARIANT parse and the layer's own paths."""
    return L.bronze_of(L.flat_trips(L.parse_trips(FX.raw_trip_json_from(spark, d))), now=P.INGEST_NOW)


@register("silver_trips_variant")
def _silver_trips_variant(spark, d):
    return L.silver_of(L.flat_trips(L.parse_trips(FX.raw_trip_json_from(spark, d))), now=P.INGEST_NOW)


@register("silver_trips")
def _silver_trips(spark, d):
    """Typed layer with is_valid, only trip_id required."""
    return silver(spark, d)


@register("bronze_filter")
def _bronze_filter(spark, d):
    return I.bronze_filter(decoded(spark, d)).select(
        F.col("transactionRecord.transaction_id").alias("transaction_id"),
        F.col("driver_ID").alias("driver_id"),
        F.col("transactionRecord.trip_info.trip_id").alias("trip_id"))


@register("silver_filter")
def _silver_filter(spark, d):
    return I.silver_filter(decoded(spark, d)).select(
        F.col("transactionRecord.transaction_id").alias("transaction_id"),
        F.col("driver_ID").alias("driver_id"),
        F.col("transactionRecord.trip_info.trip_id").alias("trip_id"))


@register("flag_validity")
def _flag_validity(spark, d):
    return I.flag_validity(silver(spark, d))


@register("segment_counts")
def _segment_counts(spark, d):
    return (silver(spark, d).groupBy("segment_count")
            .agg(F.count(F.lit(1)).alias("trips")))


# ---- quality --------------------------------------------------------------

@register("dq_freshness")
def _dq_freshness(spark, d):
    return Q.dq_freshness(silver(spark, d), P.GOLD_AS_OF)


@register("dq_freshness_future")
def _dq_freshness_future(spark, d):
    return Q.dq_freshness(silver(spark, d), P.FUTURE_AS_OF)


@register("dq_validity")
def _dq_validity(spark, d):
    return Q.dq_validity(silver(spark, d), P.GOLD_AS_OF)


@register("dq_validity_empty")
def _dq_validity_empty(spark, d):
    return Q.dq_validity(silver(spark, d), P.EMPTY_AS_OF)


@register("dq_nulls")
def _dq_nulls(spark, d):
    return Q.dq_nulls(silver(spark, d), P.GOLD_AS_OF)


@register("dq_nulls_empty")
def _dq_nulls_empty(spark, d):
    return Q.dq_nulls(silver(spark, d), P.EMPTY_AS_OF)


@register("dq_results")
def _dq_results(spark, d):
    return Q.dq_checks(silver(spark, d), P.GOLD_AS_OF)


@register("gate_task_states")
def _gate_task_states(spark, d):
    """Run states of the gate tasks (a failed check makes the insert
    upstream_failed, not failed)."""
    return Q.task_states(Q.dq_checks(silver(spark, d), P.GOLD_AS_OF))


@register("invalid_pct")
def _invalid_pct(spark, d):
    return R.invalid_pct(silver(spark, d), P.GOLD_AS_OF)


@register("invalid_pct_empty")
def _invalid_pct_empty(spark, d):
    return R.invalid_pct(silver(spark, d), P.EMPTY_AS_OF)


@register("table_counts")
def _table_counts(spark, d):
    return R.table_counts(silver(spark, d))


# ---- gold -----------------------------------------------------------------

@register("hourly_gold")
def _hourly_gold(spark, d):
    return gold(spark, d)


# ---- reports --------------------------------------------------------------

@register("daily_revenue_by_route")
def _daily(spark, d):
    return R.daily_revenue_by_route(gold(spark, d), P.DAILY_AS_OF)


@register("weekly_top_routes")
def _weekly(spark, d):
    return R.weekly_top_routes(gold(spark, d), P.WEEKLY_AS_OF)


@register("current_hour_performance")
def _current_hour(spark, d):
    return R.current_hour_performance(gold(spark, d), P.HOURLY_AS_OF)


@register("revenue_drop_alert")
def _revenue_drop(spark, d):
    return R.revenue_drop_alert(gold(spark, d), P.HOURLY_AS_OF)


@register("revenue_drop_alert_join")
def _revenue_drop_join(spark, d):
    """The same report in its two-aggregate inner-join form."""
    return R.revenue_drop_alert(gold(spark, d), P.HOURLY_AS_OF, method="join")


@register("latest_hourly_revenue")
def _latest(spark, d):
    return R.latest_hourly_revenue(gold(spark, d), 20)
