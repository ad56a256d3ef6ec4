"""Declared schemas of the raw trip record and the three table layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw record on the topic. JSON keys are matched case-sensitively by
# ``from_json`` (driver_ID, COORDINATES, SEGMENT_ID, _Metrics keep their case).
SEGMENT = T.StructType([
    T.StructField("SEGMENT_ID", T.StringType()),
    T.StructField("_Metrics", T.ArrayType(T.DoubleType())),
])


def raw_trip_schema(numeric_as_string: bool = False) -> T.StructType:
    """Nested record type. ``numeric_as_string`` declares customer_id and
    base_fare as STRING so quoted numbers can be recovered with try_cast."""
    cust_t = T.StringType() if numeric_as_string else T.LongType()
    fare_t = T.StringType() if numeric_as_string else T.DoubleType()
    return T.StructType([
        T.StructField("driver_ID", T.StringType()),
        T.StructField("customer_id", cust_t),
        T.StructField("transactionRecord", T.StructType([
            T.StructField("transaction_id", T.StringType()),
            T.StructField("trip_info", T.StructType([
                T.StructField("trip_id", T.StringType()),
                T.StructField("pricing", T.StructType([
                    T.StructField("base_fare", fare_t),
                    T.StructField("route_data", T.StructType([
                        T.StructField("route_name", T.StringType()),
                        T.StructField("segments", T.ArrayType(SEGMENT)),
                    ])),
                ])),
                T.StructField("createdAt", T.StringType()),
            ])),
        ])),
        T.StructField("COORDINATES", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))),
    ])


RAW_TRIP = raw_trip_schema()

BRONZE = T.StructType([
    T.StructField("driver_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("base_fare", T.DoubleType()),
    T.StructField("route_name", T.StringType()),
    T.StructField("segment_count", T.IntegerType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("coordinates_raw", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
])

SILVER = T.StructType([
    T.StructField("driver_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("base_fare", T.DoubleType()),
    T.StructField("route_name", T.StringType()),
    T.StructField("segment_count", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("is_valid", T.BooleanType()),
])

GOLD = T.StructType([
    T.StructField("report_hour", T.TimestampNTZType()),
    T.StructField("route_name", T.StringType()),
    T.StructField("trip_count", T.LongType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("avg_fare", T.DoubleType()),
    T.StructField("unique_drivers", T.LongType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("report_date", T.DateType()),
])

# Key declared on the gold table (not enforced by the writer; see latest_per_key).
GOLD_KEY = ("report_hour", "route_name")

METRIC_SAMPLE = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
])

DQ_RESULT = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("observed", T.DoubleType()),
    T.StructField("as_of", T.TimestampNTZType()),
])

PARTITION_COLUMN = {"bronze": "event_date", "silver": "event_date", "gold": "report_date"}
