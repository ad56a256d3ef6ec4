"""Mergeable states against the checks and the rollup over the whole table."""

import pytest
from pyspark.sql import functions as F

from lakeride.operators import gold as G
from lakeride.operators import quality as Q
from lakeride.operators import states as ST
from lakeride.plans import catalog as C
from lakeride.session import materialize, scratch_path

COLS = ["report_hour", "route_name", "trip_count", "round(total_revenue, 6) AS r", "round(avg_fare, 6) AS a",
        "unique_drivers", "updated_at", "report_date"]


@pytest.fixture(scope="module")
def silver(spark, sf0001):
    return materialize(C.silver(spark, sf0001), "t-silver")


@pytest.fixture(scope="module")
def absorbed(spark, silver):
    """Dealt out at random, so every batch brings late rows and drivers meet again in later batches."""
    path = scratch_path(spark, "t-states")
    for i in range(3):
        part = silver.where(F.pmod(F.xxhash64("trip_id"), F.lit(3)) == i)
        assert ST.absorb(part, i, path) and not ST.absorb(part, i, path)
    return path


@pytest.mark.parametrize("as_of", ["2024-01-15 00:00:00", "2024-01-15 13:37:21", "2024-01-03 01:30:00", "2030-01-15 00:00:00"])
def test_checks_equal_those_of_the_table(spark, silver, absorbed, as_of):
    got = ST.checks_from_states(spark, absorbed, as_of, silver=silver).collect()
    assert sorted(map(str, got)) == sorted(map(str, Q.dq_checks(silver, as_of).collect()))


def test_a_bound_inside_a_minute_needs_the_rows(spark, absorbed):
    with pytest.raises(ValueError):
        ST.checks_from_states(spark, absorbed, "2024-01-15 13:37:21")


def test_gold_equals_the_rollup(spark, silver, absorbed):
    now = "2024-02-01 00:00:00"
    dates = F.to_date(F.lit("2024-01-10"))
    got = ST.gold_from_states(spark, absorbed, now, since=dates).selectExpr(*COLS)
    want = G.hourly_rollup(silver.where(F.col("event_date") >= dates), now).selectExpr(*COLS)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_an_attempt_that_was_not_published_is_not_read(spark, silver):
    path = scratch_path(spark, "t-states-lost")
    assert ST.read_state(spark, path, "checks").count() == 0 and ST.gold_from_states(spark, path).count() == 0
    half = silver.limit(50)
    ST.absorb(half, 0, path)
    lost = spark.createDataFrame([("x", 1.0)], "route_name string, fare double").withColumn("trips", F.lit(9).cast("long"))
    lost.withColumn("event_date", F.to_date(F.lit("2024-01-15"))).write.partitionBy("event_date").parquet(f"{path}/rollup/batch=1")
    before = ST.read_state(spark, path, "rollup").agg(F.sum("trips")).head()[0]
    assert ST.absorb(silver, 1, path)  # the rerun replaces it
    after = ST.read_state(spark, path, "rollup").agg(F.sum("trips")).head()[0]
    assert before == ST.read_state(spark, path, "rollup").where("batch = 0").agg(F.sum("trips")).head()[0]
    assert after - before == silver.where("is_valid and event_date is not null").count()


def test_empty_batches(spark, silver):
    path = scratch_path(spark, "t-states-empty")
    ST.absorb(silver.where("false"), 0, path)
    assert ST.gold_from_states(spark, path).count() == 0
    got = {r.check: r.passed for r in ST.checks_from_states(spark, path, "2024-01-15 00:00:00").collect()}
    assert got == {Q.FRESHNESS: False, Q.VALIDITY: False, Q.NULLS: True}
