"""Lenient decode through VARIANT: one parse, and each layer takes only its paths.

A message is parsed once into a VARIANT. Every field is then taken by its own
path, so a layer that does not use COORDINATES never touches them, a number
in quotes is read as a number, and a value of the wrong type is NULL alone:
one bad coordinate leaves the others in place. An unreadable message, and one
that names a key twice, is NULL as a whole and falls to the trip filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import parse_created_at, ts_lit

_RECORD = "record"
_TRIP = "$.transactionRecord.trip_info"
#: flat column: (path, type)
PATHS = {
    "driver_id": ("$.driver_ID", "string"),
    "customer_id": ("$.customer_id", "bigint"),
    "transaction_id": ("$.transactionRecord.transaction_id", "string"),
    "trip_id": (f"{_TRIP}.trip_id", "string"),
    "base_fare": (f"{_TRIP}.pricing.base_fare", "double"),
    "route_name": (f"{_TRIP}.pricing.route_data.route_name", "string"),
    "created_text": (f"{_TRIP}.createdAt", "string"),
}


def parse_trips(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and the message as VARIANT ``record`` (NULL if unreadable).

    The generator keeps filters on parsed values above the parse, so a message is parsed once."""
    parsed = F.try_parse_json(F.col(value_col).cast("string"))
    return raw.select(*keep, F.inline(F.array(F.struct(parsed.alias(_RECORD)))))


def _get(value: Column | str, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def _coordinates() -> Column:
    """The nested array as text; a point that is no number is null in its place."""
    deep = lambda v, f: F.transform(_get(v, "$", "array<variant>"), f)
    return F.transform(_get(_RECORD, "$.COORDINATES", "array<variant>"),
                       lambda line: deep(line, lambda point: deep(point, lambda x: _get(x, "$", "double")))).cast("string")


def flat_trips(parsed: DataFrame, coordinates: bool = True) -> DataFrame:
    """The fields of both layers, one row per message that has a trip id; ``coordinates`` adds their text."""
    fields = [_get(_RECORD, path, kind).alias(name) for name, (path, kind) in PATHS.items()]
    segments = _get(_RECORD, f"{_TRIP}.pricing.route_data.segments", "array<variant>")
    fields.append(F.when(segments.isNotNull(), F.size(segments)).alias("segment_count"))
    if coordinates:
        fields.append(_coordinates().alias("coordinates_raw"))
    return parsed.where(_get(_RECORD, PATHS["trip_id"][0], "string").isNotNull()).select(*fields)


_COMMON = ("driver_id", "customer_id", "transaction_id", "trip_id", "base_fare", "route_name", "segment_count")


def bronze_of(trips: DataFrame, now=None) -> DataFrame:
    """Bronze rows of :func:`flat_trips`: those with a driver; the time stays text."""
    return trips.where("driver_id is not null").select(
        *_COMMON, F.col("created_text").alias("created_at"), "coordinates_raw", ts_lit(now).alias("ingested_at"),
        F.to_date(parse_created_at(F.col("created_text"))).alias("event_date"))


def silver_of(trips: DataFrame, now=None) -> DataFrame:
    """Silver rows of :func:`flat_trips`, with the validity flag (a NULL fare or customer is valid)."""
    created = parse_created_at(F.col("created_text"))
    valid = F.when(F.col("base_fare") <= 0, F.lit(False)).when(F.col("customer_id") <= 0, F.lit(False)).otherwise(F.lit(True))
    return trips.select(*_COMMON, created.alias("created_at"), ts_lit(now).alias("updated_at"),
                        F.to_date(created).alias("event_date"), valid.alias("is_valid"))
