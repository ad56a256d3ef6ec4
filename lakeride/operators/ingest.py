"""Lenient JSON decode and the bronze / silver projections.

Both tables are derived from the decoded raw stream, not silver from bronze:
bronze needs driver and trip ids, silver only the trip id, so silver is not a
subset of bronze. Silver keeps invalid rows and flags them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schemas import raw_trip_schema
from ..functions.timecols import parse_created_at, ts_lit

_TRIP = "transactionRecord.trip_info"
_PRICING = f"{_TRIP}.pricing"


def decode_trip_json(raw: DataFrame, value_col: str = "value",
                     coerce_numeric_strings: bool = False,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse message values into the nested record.

    PERMISSIVE ``from_json``: a missing field is NULL, a field of the wrong
    type is NULL (siblings survive), an unreadable record is all-NULL and is
    later dropped by the trip_id filters. With ``coerce_numeric_strings``
    customer_id and base_fare are read as text and converted with try_cast,
    so quoted numbers are recovered instead of nulled.
    """
    schema = raw_trip_schema(numeric_as_string=coerce_numeric_strings)
    parsed = F.from_json(F.col(value_col).cast("string"), schema, {"mode": "PERMISSIVE"})
    # Parse inside a generator: predicates on the parsed fields (the trip_id
    # filters) cannot be pushed below it, so each message is parsed once
    # instead of once for the filter and again for the projection.
    out = raw.select(*keep, F.inline(F.array(parsed)))
    if coerce_numeric_strings:
        out = (out.withColumn("customer_id", F.col("customer_id").try_cast("bigint"))
                  .withColumn("transactionRecord", F.col("transactionRecord").withField(
                      "trip_info.pricing.base_fare",
                      F.col(f"{_PRICING}.base_fare").try_cast("double"))))
    return out


def _segment_count() -> Column:
    segs = F.col(f"{_PRICING}.route_data.segments")
    # CARDINALITY(NULL) is NULL whatever the legacy size-of-null setting says
    return F.when(segs.isNull(), F.lit(None).cast("int")).otherwise(F.size(segs))


def bronze_filter(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("driver_ID").isNotNull() & F.col(f"{_TRIP}.trip_id").isNotNull())


def silver_filter(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(f"{_TRIP}.trip_id").isNotNull())


def validity_flag() -> Column:
    """CASE of negatives: a NULL fare or customer compares unknown and falls
    through to TRUE. The trip_id arm is unreachable after the silver filter
    and kept for parity."""
    return (F.when(F.col(f"{_PRICING}.base_fare") <= 0, F.lit(False))
            .when(F.col("customer_id") <= 0, F.lit(False))
            .when(F.col(f"{_TRIP}.trip_id").isNull(), F.lit(False))
            .otherwise(F.lit(True)))


def _common() -> list[Column]:
    return [
        F.col("driver_ID").alias("driver_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("transactionRecord.transaction_id").alias("transaction_id"),
        F.col(f"{_TRIP}.trip_id").alias("trip_id"),
        F.col(f"{_PRICING}.base_fare").cast("double").alias("base_fare"),
        F.col(f"{_PRICING}.route_data.route_name").alias("route_name"),
        _segment_count().alias("segment_count"),
    ]


def flatten_bronze(decoded: DataFrame, now=None) -> DataFrame:
    """Raw-ish layer: created_at stays text, coordinates are rendered as text."""
    created = F.col(f"{_TRIP}.createdAt")
    return bronze_filter(decoded).select(
        *_common(),
        created.alias("created_at"),
        F.col("COORDINATES").cast("string").alias("coordinates_raw"),
        ts_lit(now).alias("ingested_at"),
        F.to_date(parse_created_at(created)).alias("event_date"),
    )


def flatten_silver(decoded: DataFrame, now=None) -> DataFrame:
    """Typed layer: created_at parsed (NULL if unparseable), is_valid flag."""
    created_ts = parse_created_at(F.col(f"{_TRIP}.createdAt"))
    return silver_filter(decoded).select(
        *_common(),
        created_ts.alias("created_at"),
        ts_lit(now).alias("updated_at"),
        F.to_date(created_ts).alias("event_date"),
        validity_flag().alias("is_valid"),
    )


def flag_validity(silver: DataFrame) -> DataFrame:
    """Validity counts per route, the flag's effect in one row per route."""
    return (silver.groupBy("route_name")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("is_valid")).alias("valid_rows"),
                 F.count_if(~F.col("is_valid")).alias("invalid_rows"),
                 F.count_if(F.col("base_fare").isNull()).alias("null_fare_rows")))
