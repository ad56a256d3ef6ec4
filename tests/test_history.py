"""Runs with validity intervals and columns known by number."""

import pytest
from pyspark.sql import functions as F

from lakeride.operators import columns as CM
from lakeride.operators import gold as G
from lakeride.operators import history as H
from lakeride.operators import maintenance as MT
from lakeride.plans import catalog as C
from lakeride.plans import params as P
from lakeride.session import scratch_path
from lakeride.sources import tables
from lakeride.sources.tables import write_layer


def _runs(spark, sf0001):
    silver = C.silver(spark, sf0001)
    return G.hourly_gold(silver, P.GOLD_AS_OF, P.GOLD_NOW), G.hourly_gold(silver, P.GOLD_AS_OF_2, P.GOLD_NOW_2)


def _same(a, b):
    return a.select(b.columns).exceptAll(b).count() == 0 and b.exceptAll(a.select(b.columns)).count() == 0


def test_as_of_after_two_replaces_equals_the_first_run(spark, sf0001):
    first, second = _runs(spark, sf0001)
    path = scratch_path(spark, "t-history")
    assert H.as_of(spark, path).count() == 0 and H.intervals(spark, path).count() == 0
    assert H.write_run(first, path, P.GOLD_NOW, G.covered_dates(P.GOLD_AS_OF)) == 1
    assert H.write_run(second, path, P.GOLD_NOW_2, G.covered_dates(P.GOLD_AS_OF_2)) == 2
    emptied = second.where(F.col("report_date") != P.EMPTIED_DATE)
    assert H.write_run(emptied, path, "2024-02-01 02:30:00", G.covered_dates(P.GOLD_AS_OF_2)) == 3
    assert _same(H.as_of(spark, path, P.GOLD_NOW), first)
    assert H.as_of(spark, path, "2024-02-01 00:59:59").count() == 0  # before the first run
    old = first.where(~G.covered_dates(P.GOLD_AS_OF_2))
    assert _same(H.as_of(spark, path, P.GOLD_NOW_2), second.unionAll(old))
    assert _same(H.as_of(spark, path), emptied.unionAll(old))
    # going back copies nothing and can itself be undone
    files = len(spark.read.parquet(f"{path}/data").inputFiles())
    H.roll_back(spark, path, P.GOLD_NOW, P.GOLD_NOW_3)
    assert _same(H.as_of(spark, path), first) and len(spark.read.parquet(f"{path}/data").inputFiles()) == files
    H.roll_back(spark, path, P.GOLD_NOW_2, "2024-02-01 04:00:00")
    assert _same(H.as_of(spark, path), second.unionAll(old)) and _same(H.as_of(spark, path, P.GOLD_NOW_3), first)
    per_date = H.intervals(spark, path).groupBy("report_date").agg(F.sum((F.col("valid_to").isNull()).cast("int")).alias("open")).collect()
    assert all(r.open == 1 for r in per_date)
    with pytest.raises(ValueError, match="later"):
        H.write_run(first, path, P.GOLD_NOW)


def test_a_run_without_a_record_is_not_seen(spark, sf0001, monkeypatch):
    first, second = _runs(spark, sf0001)
    path = scratch_path(spark, "t-history-lost")
    H.write_run(first, path, P.GOLD_NOW)
    monkeypatch.setattr(H, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        H.write_run(second, path, P.GOLD_NOW_2)
    monkeypatch.undo()
    assert _same(H.as_of(spark, path), first)
    assert H.write_run(second, path, P.GOLD_NOW_2) == 2
    dates = [r[0] for r in second.select("report_date").distinct().collect()]
    assert _same(H.as_of(spark, path), second.unionAll(first.where(~F.col("report_date").isin(dates))))


def test_as_of_prunes_the_partitions_it_does_not_need(spark, sf0001):
    first, second = _runs(spark, sf0001)
    path = scratch_path(spark, "t-history-plan")
    H.write_run(first, path, P.GOLD_NOW)
    H.write_run(second, path, P.GOLD_NOW_2)
    plan = H.as_of(spark, path, P.GOLD_NOW).where("report_date = '2024-01-16'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan


def test_a_replaced_layer_is_no_ledger(spark, sf0001):
    silver = C.silver(spark, sf0001)
    path = scratch_path(spark, "t-replaced")
    write_layer(silver, path, "silver")
    assert MT.ledger(spark, path, silver.schema).count() == silver.count()
    write_layer(silver, path, "silver", mode="replace")
    assert tables.path_exists(spark, f"{path}/{tables.REPLACED}")
    with pytest.raises(ValueError, match="replace mode"):
        MT.ledger(spark, path, silver.schema)


def test_rename_chain_drop_and_reuse_of_names(spark):
    path = scratch_path(spark, "t-columns")
    a = CM.Columns.of(spark.createDataFrame([], "k long, x string, y double").schema)
    a.write(spark.createDataFrame([(1, "one", 1.5)], "k long, x string, y double"), path)
    b = a.rename("x", "z").rename("y", "x")  # x is another column now
    b.write(spark.createDataFrame([(2, "two", 2.5)], "k long, z string, x double"), path)
    c = b.drop("z").add("z", "int").rename("x", "value")
    c.write(spark.createDataFrame([(3, 33, 3.5)], "k long, z int, value double"), path)
    CM.save(spark, path, [a, b, c])
    versions = CM.load(spark, path)
    assert versions == [a, b, c]
    assert sorted(map(tuple, c.read(spark, path).select("k", "value", "z").collect())) == [(1, 1.5, None), (2, 2.5, None), (3, 3.5, 33)]
    assert sorted(map(tuple, b.read(spark, path).collect())) == [(1, "one", 1.5), (2, "two", 2.5), (3, None, 3.5)]
    assert c.add("w", "string").read(spark, path).where("w is not null").count() == 0
    for bad in (lambda: c.add("Z", "int"), lambda: c.rename("k", "value"), lambda: c.drop("x"), lambda: c.rename("nope", "n")):
        with pytest.raises(ValueError):
            bad()


def test_partition_column_is_pruned_under_its_new_name(spark, sf0001):
    silver = C.silver(spark, sf0001).select("trip_id", "event_date")
    path = scratch_path(spark, "t-columns-part")
    a = CM.Columns.of(silver.schema)
    a.write(silver, path, "event_date")
    b = a.rename("event_date", "day")
    got = b.read(spark, path).where("day = '2024-01-05'")
    assert "PartitionFilters: [isnotnull(c2" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == silver.where("event_date = '2024-01-05'").count()
