"""Gates, forced failures and gold rerun behaviour."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lakeride.functions.schemas import SILVER
from lakeride.operators import gold as G
from lakeride.operators import quality as Q
from lakeride.plans import catalog as C
from lakeride.session import scratch_path
from lakeride.sources.tables import write_layer

AS_OF = "2024-01-15 00:00:00"


@pytest.fixture(scope="module")
def raw_silver(spark, sf0001):
    return C.silver(spark, sf0001).cache()


@pytest.fixture(scope="module")
def silver(raw_silver):
    """The fixture without NULL fares and invalid rows (both trip gates)."""
    return raw_silver.filter(F.col("base_fare").isNotNull() & F.col("is_valid")).cache()


def test_gate_results_match_direct_counts(raw_silver):
    passed, results = Q.dq_gate(raw_silver, AS_OF)
    by = {r.check: r for r in results.collect()}
    today = raw_silver.filter(F.col("event_date") >= "2024-01-15")
    nulls = today.filter(F.col("base_fare").isNull()).count()
    ratio = today.filter(~F.col("is_valid")).count() / today.count()
    assert by[Q.NULLS].observed == nulls > 0 and not by[Q.NULLS].passed   # NULL fares trip it
    assert abs(by[Q.VALIDITY].observed - ratio) < 1e-12 and by[Q.VALIDITY].passed == (ratio < 0.1)
    assert by[Q.FRESHNESS].passed
    assert not passed


def test_checks_pass_on_clean_fixture(silver):
    passed, results = Q.dq_gate(silver, AS_OF)
    assert passed
    assert {r.check for r in results.collect()} == {Q.FRESHNESS, Q.VALIDITY, Q.NULLS}


def test_fused_checks_equal_single_checks(silver):
    fused = {r.check: (r.passed, r.observed) for r in Q.dq_checks(silver, AS_OF).collect()}
    f = Q.dq_freshness(silver, AS_OF).first()
    v = Q.dq_validity(silver, AS_OF).first()
    n = Q.dq_nulls(silver, AS_OF).first()
    assert fused[Q.FRESHNESS] == (f.passed, f.observed)
    assert fused[Q.VALIDITY][0] == v.passed and abs(fused[Q.VALIDITY][1] - v.observed) < 1e-12
    assert fused[Q.NULLS] == (n.passed, n.observed)


def test_forced_freshness_failure(silver):
    assert not Q.check_passes(Q.dq_freshness(silver, "2099-01-01 02:00:00").select("passed"))


def test_forced_validity_failure(spark):
    assert not Q.check_passes(spark.sql("SELECT 1.0 < 0.1"))


def test_empty_day_fails_validity_passes_nulls(silver):
    assert not Q.check_passes(Q.dq_validity(silver, "2030-01-15").select("passed"))
    assert Q.check_passes(Q.dq_nulls(silver, "2030-01-15").select("passed"))


def test_forced_null_failure(spark):
    sql = """SELECT COALESCE((SELECT COUNT(*) = 0 FROM (SELECT CAST(NULL AS STRING) AS trip_id) t
                             WHERE trip_id IS NULL), false)"""
    assert not Q.check_passes(spark.sql(sql))


def test_no_row_fails(spark):
    assert not Q.check_passes(spark.range(0).select(F.lit(True)))


def test_null_row_in_critical_column_fails_gate(spark, silver):
    bad = silver.limit(5).withColumn("route_name", F.lit(None).cast("string")) \
        .withColumn("event_date", F.lit("2024-01-20").cast("date"))
    passed, _ = Q.dq_gate(silver.unionByName(bad), AS_OF)
    assert not passed


def test_gate_blocks_write(spark, silver):
    path = scratch_path(spark, "gold-gate")
    out = Q.gated_gold(silver, path, as_of="2099-01-01 02:00:00")
    assert not out.passed and not out.written
    with pytest.raises(AnalysisException):
        spark.read.parquet(path).count()


def test_gate_writes_and_rerun_is_idempotent(spark, silver):
    path = scratch_path(spark, "gold-idem")
    res = scratch_path(spark, "dq-results")
    assert Q.gated_gold(silver, path, as_of=AS_OF, now="2024-02-01 01:00:00", results_path=res).written
    assert Q.gated_gold(silver, path, as_of=AS_OF, now="2024-02-01 02:00:00", results_path=res).written
    gold = spark.read.parquet(path)
    assert gold.count() == gold.select("report_hour", "route_name").distinct().count()
    assert spark.read.parquet(res).count() == 6


def test_append_mode_duplicates_then_latest_per_key(spark, silver):
    path = scratch_path(spark, "gold-append")
    one = G.hourly_gold(silver, AS_OF, now="2024-02-01 01:00:00")
    G.write_gold(one, path, mode="append")
    G.write_gold(G.hourly_gold(silver, AS_OF, now="2024-02-01 02:00:00"), path, mode="append")
    ledger = spark.read.parquet(path)
    n = one.count()
    assert ledger.count() == 2 * n
    latest = G.latest_per_key(ledger)
    assert latest.count() == n
    assert latest.filter(F.col("updated_at") != F.lit("2024-02-01 02:00:00").cast("timestamp_ntz")).count() == 0


def test_missing_source_fails_before_any_write(spark, silver):
    path = scratch_path(spark, "gold-missing")
    G.write_gold(G.hourly_gold(silver, AS_OF, now="2024-02-01 01:00:00"), path)
    before = spark.read.parquet(path).count()
    with pytest.raises(AnalysisException):
        src = spark.read.schema(SILVER).parquet(scratch_path(spark, "does-not-exist"))
        G.write_gold(G.hourly_gold(src, AS_OF), path)
    assert spark.read.parquet(path).count() == before


def test_avg_fare_counts_null_fares(spark):
    rows = [("d1", 1, "X1", "T1", 10.0, "R", 1, dt.datetime(2024, 1, 15, 10, 5), dt.datetime(2024, 2, 1),
             dt.date(2024, 1, 15), True),
            ("d2", 1, "X2", "T2", None, "R", 1, dt.datetime(2024, 1, 15, 10, 9), dt.datetime(2024, 2, 1),
             dt.date(2024, 1, 15), True)]
    df = spark.createDataFrame(rows, SILVER)
    (g,) = G.hourly_gold(df, AS_OF).collect()
    assert g.trip_count == 2 and g.total_revenue == 10.0 and g.avg_fare == 5.0 and g.unique_drivers == 2
    assert str(g.report_hour) == "2024-01-15 10:00:00"


def test_gold_reads_only_needed_partitions(spark, silver):
    path = scratch_path(spark, "silver-part")
    write_layer(silver, path, "silver")
    plan = G.hourly_gold(spark.read.parquet(path), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-14" in plan


def test_upstream_failed_insert_does_not_fire_gold_alert(spark, silver):
    """Forced failures: the insert task is upstream_failed, so only the three
    check alerts fire from the task-finish counter, never the insert one."""
    from lakeride.functions.schemas import METRIC_SAMPLE
    from lakeride.operators import alerts as A
    _, results = Q.dq_gate(silver, "2099-01-01 02:00:00")
    forced = results.select("check", F.lit(False).alias("passed"))
    states = {r.task_id: r.state for r in Q.task_states(forced).collect()}
    assert states[Q.INSERT_TASK] == "upstream_failed"
    assert all(states[c] == "failed" for c in (Q.FRESHNESS, Q.VALIDITY, Q.NULLS))
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i, (task, state) in enumerate(states.items()):
        labels = {"dag_id": "gold_aggregation", "task_id": task, "state": state}
        rows += [("airflow_task_finish_total", labels, t0, 0.0),
                 ("airflow_task_finish_total", labels, t0 + dt.timedelta(minutes=5), 1.0)]
    fired = {r.alertname for r in A.alert_rules(spark.createDataFrame(rows, METRIC_SAMPLE)).collect()}
    assert fired == {"DQGateFreshnessFailed", "DQGateValidityFailed", "DQGateNullCheckFailed"}
