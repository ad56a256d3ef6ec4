"""Decode and layer semantics (lenient JSON, filters, validity flag)."""

import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from lakeride.operators import ingest as I
from lakeride.operators import lenient as L


def _raw(spark, lines):
    return spark.createDataFrame([Row(value=v) for v in lines], "value string")


GOOD = {
    "driver_ID": "DRV-00001", "customer_id": 7,
    "transactionRecord": {
        "transaction_id": "TXN-1",
        "trip_info": {
            "trip_id": "TRIP-1",
            "pricing": {"base_fare": 12.5,
                        "route_data": {"route_name": "A-B",
                                       "segments": [{"SEGMENT_ID": "S1", "_Metrics": [1.0, 2.0]}]}},
            "createdAt": "2024-01-02T03:04:05.678Z"}},
    "COORDINATES": [[[13.75, 100.5, 0.0]]],
}


def _with(path, value, base=GOOD):
    rec = json.loads(json.dumps(base))
    cur = rec
    for k in path[:-1]:
        cur = cur[k]
    if value is KeyError:
        del cur[path[-1]]
    else:
        cur[path[-1]] = value
    return json.dumps(rec)


def silver_rows(spark, lines, **kw):
    return I.flatten_silver(I.decode_trip_json(_raw(spark, lines), **kw), now="2024-02-01").collect()


def bronze_rows(spark, lines):
    return I.flatten_bronze(I.decode_trip_json(_raw(spark, lines)), now="2024-02-01").collect()


def test_good_record_flattens(spark):
    (r,) = silver_rows(spark, [json.dumps(GOOD)])
    assert (r.driver_id, r.customer_id, r.trip_id, r.base_fare, r.route_name, r.segment_count) == \
        ("DRV-00001", 7, "TRIP-1", 12.5, "A-B", 1)
    assert str(r.created_at) == "2024-01-02 03:04:05.678000"
    assert str(r.event_date) == "2024-01-02" and r.is_valid is True
    (b,) = bronze_rows(spark, [json.dumps(GOOD)])
    assert b.created_at == "2024-01-02T03:04:05.678Z"
    assert b.coordinates_raw == "[[[13.75, 100.5, 0.0]]]"


def test_unreadable_records_are_dropped_by_both_filters(spark):
    bad = ["not json", "", "null", '{"driver_ID": "x", "transactionRecord": {', "[1, 2]"]
    assert silver_rows(spark, bad) == []
    assert bronze_rows(spark, bad) == []


def test_null_fare_is_valid_and_negative_fare_invalid(spark):
    rows = silver_rows(spark, [_with(["transactionRecord", "trip_info", "pricing", "base_fare"], None),
                               _with(["transactionRecord", "trip_info", "pricing", "base_fare"], -3.0),
                               _with(["customer_id"], 0)])
    assert [r.is_valid for r in rows] == [True, False, False]


def test_silver_is_not_subset_of_bronze(spark):
    no_driver = _with(["driver_ID"], KeyError)
    wrong_case = json.dumps({("DRIVER_id" if k == "driver_ID" else k): v for k, v in GOOD.items()})
    assert len(silver_rows(spark, [no_driver, wrong_case])) == 2
    assert bronze_rows(spark, [no_driver, wrong_case]) == []


def test_bad_field_nulls_only_itself(spark):
    (r,) = silver_rows(spark, [_with(["transactionRecord", "trip_info", "pricing", "base_fare"], "abc")])
    assert r.base_fare is None and r.route_name == "A-B" and r.is_valid is True
    (r,) = silver_rows(spark, [_with(["customer_id"], "12")])
    assert r.customer_id is None and r.trip_id == "TRIP-1"


def test_quoted_numbers_recovered_with_coercion(spark):
    line = _with(["customer_id"], "12")
    line = _with(["transactionRecord", "trip_info", "pricing", "base_fare"], "9.5", json.loads(line))
    (r,) = silver_rows(spark, [line], coerce_numeric_strings=True)
    assert r.customer_id == 12 and r.base_fare == 9.5


def test_number_in_driver_id_is_text(spark):
    (r,) = silver_rows(spark, [_with(["driver_ID"], 123)])
    assert r.driver_id == "123"


def test_segments_null_or_string_gives_null_count(spark):
    seg = ["transactionRecord", "trip_info", "pricing", "route_data", "segments"]
    rows = silver_rows(spark, [_with(seg, None), _with(seg, "oops")])
    assert [r.segment_count for r in rows] == [None, None]


def test_bad_time_keeps_row_with_null_date(spark):
    t = ["transactionRecord", "trip_info", "createdAt"]
    rows = silver_rows(spark, [_with(t, "garbage"), _with(t, "2024-01-02T03:04:05Z"), _with(t, KeyError)])
    assert len(rows) == 3
    assert all(r.created_at is None and r.event_date is None for r in rows)


def test_text_in_coordinates_nulls_whole_array(spark):
    (b,) = bronze_rows(spark, [_with(["COORDINATES"], [[["x", 1.0]]])])
    assert b.coordinates_raw is None


def test_trailing_junk_accepted(spark):
    assert len(silver_rows(spark, [json.dumps(GOOD) + " trailing"])) == 1


def test_decode_parses_json_once(spark):
    plan = I.flatten_silver(I.decode_trip_json(_raw(spark, [json.dumps(GOOD)])))._jdf \
        .queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_fixture_counts(spark, sf0001):
    from lakeride.plans import catalog as C
    sil = C.silver(spark, sf0001)
    assert sil.count() == 990  # 1000 events minus trip ids every 101st
    assert sil.filter(F.col("event_date").isNull()).count() > 0


# ---- VARIANT decode -----------------------------------------------------------

def lenient_rows(spark, lines, layer="silver"):
    trips = L.flat_trips(L.parse_trips(_raw(spark, lines)))
    return (L.silver_of if layer == "silver" else L.bronze_of)(trips, now="2024-02-01").collect()


def test_lenient_decode_agrees_with_the_declared_schema(spark):
    trip = ["transactionRecord", "trip_info"]
    seg = [*trip, "pricing", "route_data", "segments"]
    lines = [json.dumps(GOOD), "not json", "", "null", '{"driver_ID": "x", "transactionRecord": {', "[1, 2]", _with(["driver_ID"], KeyError),
             json.dumps({("DRIVER_id" if k == "driver_ID" else k): v for k, v in GOOD.items()}),
             _with([*trip, "pricing", "base_fare"], None), _with([*trip, "pricing", "base_fare"], -3.0), _with([*trip, "pricing", "base_fare"], "abc"),
             _with(["customer_id"], 0), _with(["driver_ID"], 123), _with(seg, None), _with(seg, "oops"), _with(seg, []), _with([*trip, "createdAt"], "garbage"),
             _with([*trip, "createdAt"], "2024-01-02T03:04:05Z"), _with([*trip, "createdAt"], KeyError), _with([*trip, "trip_id"], KeyError),
             _with(trip, "text"), _with(["COORDINATES"], None), _with(["COORDINATES"], "text"), json.dumps(GOOD) + " trailing"]
    assert lenient_rows(spark, lines) == silver_rows(spark, lines)
    assert lenient_rows(spark, lines, "bronze") == bronze_rows(spark, lines)


def test_lenient_decode_reads_quoted_numbers(spark):
    line = _with(["customer_id"], "12")
    line = _with(["transactionRecord", "trip_info", "pricing", "base_fare"], "9.5", json.loads(line))
    (r,) = lenient_rows(spark, [line])
    assert r.customer_id == 12 and r.base_fare == 9.5


def test_lenient_decode_loses_only_the_bad_coordinate(spark):
    (b,) = lenient_rows(spark, [_with(["COORDINATES"], [[["x", 1.0], [2, 3]], "no line"])], "bronze")
    assert b.coordinates_raw == "[[[null, 1.0], [2.0, 3.0]], null]"


def test_lenient_decode_drops_a_record_that_names_a_key_twice(spark):
    assert lenient_rows(spark, ['{"driver_ID": "a", ' + json.dumps(GOOD)[1:]]) == []


def test_silver_does_not_read_coordinates_and_parses_once(spark):
    parsed = L.parse_trips(_raw(spark, [json.dumps(GOOD)]))
    plan = L.silver_of(L.flat_trips(parsed))._jdf.queryExecution().optimizedPlan().toString()
    assert "$.COORDINATES" not in plan and plan.count("parseJson") == 1
    assert "$.COORDINATES" in L.bronze_of(L.flat_trips(parsed))._jdf.queryExecution().optimizedPlan().toString()
