"""Team reports: join semantics, ordering and partition pruning."""

import datetime as dt

from lakeride.functions.schemas import GOLD
from lakeride.operators import reports as R
from lakeride.session import scratch_path
from lakeride.sources.tables import write_layer

H = dt.datetime(2024, 1, 30, 23, 0)


def gold_rows(spark, rows):
    full = [(h, r, 1, rev, rev, 1, dt.datetime(2024, 2, 1), h.date()) for h, r, rev in rows]
    return spark.createDataFrame(full, GOLD)


def test_revenue_drop_inner_join_and_order(spark):
    prev = H - dt.timedelta(hours=1)
    g = gold_rows(spark, [(prev, "A", 100.0), (H, "A", 50.0),     # -50 %
                          (prev, "B", 100.0), (H, "B", 90.0),     # -10 %: no alert
                          (prev, "C", 100.0),                     # no rows this hour: hidden
                          (H, "D", 10.0),                         # no last hour: no match
                          (prev, None, 100.0), (H, None, 1.0),    # NULL routes never match
                          (prev, "E", 0.0), (H, "E", -1.0)])      # pct NULL -> sorted last
    out = R.revenue_drop_alert(g, "2024-01-30 23:30:00").collect()
    assert [r.route_name for r in out] == ["A", "E"]
    assert out[0].pct_change == -50.0 and out[1].pct_change is None


def test_latest_is_top_n_with_tie_break(spark):
    g = gold_rows(spark, [(H, r, 1.0) for r in "DCBA"] + [(H - dt.timedelta(hours=1), "Z", 1.0)])
    out = R.latest_hourly_revenue(g, 3).collect()
    assert [r.route_name for r in out] == ["A", "B", "C"]
    assert "TakeOrderedAndProject" in R.latest_hourly_revenue(g, 3)._jdf.queryExecution().executedPlan().toString()


def test_invalid_pct_empty_day_is_null(spark, sf0001):
    from lakeride.plans import catalog as C
    (r,) = R.invalid_pct(C.silver(spark, sf0001), "2030-01-15").collect()
    assert r.total == 0 and r.invalid == 0 and r.invalid_pct is None


def test_hour_reports_prune_date_partitions(spark):
    path = scratch_path(spark, "t-gold")
    write_layer(gold_rows(spark, [(H, "A", 1.0), (H - dt.timedelta(days=3), "A", 1.0)]), path, "gold")
    g = spark.read.parquet(path)
    for df in (R.current_hour_performance(g, "2024-01-30 23:30:00"),
               R.revenue_drop_alert(g, "2024-01-30 23:30:00")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(report_date" in plan


def test_revenue_drop_join_form_agrees(spark, sf0001):
    from lakeride.plans import catalog as C
    g = C.gold(spark, sf0001)
    for as_of in ("2024-01-30 23:30:00", "2024-01-20 12:10:00", "2024-01-16 05:00:00"):
        a = R.revenue_drop_alert(g, as_of)
        b = R.revenue_drop_alert(g, as_of, method="join")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
