"""Compaction, versions, retention and schema evolution."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from lakeride.operators import gold as G
from lakeride.operators import maintenance as MT
from lakeride.plans import catalog as C
from lakeride.session import local_dir, scratch_path
from lakeride.sources import sizing
from lakeride.sources.tables import write_layer


def _files(path):
    return len(glob.glob(os.path.join(local_dir(path), "**", "*.parquet"), recursive=True))


def test_compact_fewer_files_same_rows(spark, sf0001):
    silver = C.silver(spark, sf0001)
    src = scratch_path(spark, "t-small")
    for part in silver.randomSplit([1.0] * 6, seed=1):
        part.repartition(4).write.mode("append").partitionBy("event_date").parquet(src)
    out = MT.compact(spark, src, scratch_path(spark, "t-compact"), "event_date")
    assert _files(src) > _files(out.inputFiles()[0].rsplit("/event_date", 1)[0])
    assert out.count() == silver.count()
    assert out.exceptAll(spark.read.parquet(src).select(*out.columns)).count() == 0


def test_versions_as_of_and_expire(spark, sf0001):
    silver = C.silver(spark, sf0001)
    path = scratch_path(spark, "t-ledger")
    G.write_gold(G.hourly_gold(silver, "2024-01-15", now="2024-02-01 01:00:00"), path, "append")
    G.write_gold(G.hourly_gold(silver, "2024-01-20", now="2024-02-01 02:00:00"), path, "append")
    ledger = spark.read.parquet(path)
    log = MT.snapshot_log(ledger).collect()
    assert [r.snapshot_id for r in log] == [2, 1]
    first = MT.as_of_read(ledger, "2024-02-01 01:00:00")
    assert first.count() == log[1].rows
    kept = MT.expire_versions(ledger, "2024-02-01 02:30:00", "1h")
    assert kept.count() == G.latest_per_key(ledger).count()
    # every key survives retention
    assert kept.select("report_hour", "route_name").distinct().count() == \
        ledger.select("report_hour", "route_name").distinct().count()
    rb = scratch_path(spark, "t-rollback")
    MT.rollback(ledger, "2024-02-01 01:00:00", rb)
    assert spark.read.parquet(rb).count() == first.count()


def test_evolve_schema_add_rename_drop(spark, sf0001):
    silver = C.silver(spark, sf0001)
    path = scratch_path(spark, "t-evolve")
    write_layer(silver.filter(F.col("event_date") < "2024-01-16"), path, "silver")
    write_layer(silver.filter(F.col("event_date") >= "2024-01-16").withColumn("extra", F.lit(1)), path, "silver")
    df = MT.evolve_schema(spark, path, rename={"route": "route_name"}, drop=("updated_at",))
    assert "route" in df.columns and "route_name" not in df.columns and "updated_at" not in df.columns
    assert df.filter(F.col("extra").isNull()).count() == silver.filter(F.col("event_date") < "2024-01-16").count()


def test_create_tables_registers_layers(spark, sf0001):
    from lakeride.sources.tables import create_tables, scan_table
    root = scratch_path(spark, "t-catalog")
    silver = C.silver(spark, sf0001)
    write_layer(silver, f"{root}/silver", "silver")
    create_tables(spark, {"silver": f"{root}/silver"}, drop_existing=True)
    spark.sql("MSCK REPAIR TABLE silver_trips")
    assert spark.table("silver_trips").count() == silver.count()
    assert scan_table(spark, f"{root}/silver", "silver").count() == silver.count()
    spark.sql("DROP TABLE IF EXISTS silver_trips")


def test_balanced_write_without_aqe_spreads_a_date(spark, sf0001):
    from lakeride.sources.tables import balanced_by
    silver = C.silver(spark, sf0001)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = balanced_by(silver, "event_date", salt_buckets=4)
        per_task = df.groupBy(F.spark_partition_id().alias("p"), "event_date").count()
        tasks_per_date = per_task.groupBy("event_date").count().agg(F.max("count")).first()[0]
        assert tasks_per_date > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_batches_keep_dates_outside_any_bound(spark, sf0001):
    from lakeride.plans import params as P
    from lakeride.plans.catalog_tables import write_in_batches
    rows = C.silver(spark, sf0001)
    dates = F.when(F.col("trip_id").endswith("1"), F.lit("2023-06-01")).when(F.col("trip_id").endswith("2"), F.lit("2101-01-01"))
    rows = rows.withColumn("event_date", F.coalesce(dates.cast("date"), "event_date"))
    path = scratch_path(spark, "t-batches")
    write_in_batches(rows, path, P.SILVER_BATCHES)
    out = MT.compact(spark, path, scratch_path(spark, "t-batches-compact"), "event_date").select(*rows.columns)
    assert out.count() == rows.count() and rows.exceptAll(out).count() == 0


def test_replace_clears_a_date_that_lost_all_rows(spark, sf0001):
    silver = C.silver(spark, sf0001)
    path = scratch_path(spark, "t-emptied")
    G.write_gold(G.hourly_gold(silver, "2024-01-15"), path, covered=G.covered_dates("2024-01-15"))
    without = silver.filter(F.col("event_date") != "2024-01-14")
    G.write_gold(G.hourly_gold(without, "2024-01-15"), path, covered=G.covered_dates("2024-01-15"))
    got = spark.read.parquet(path)
    assert got.filter("report_date = '2024-01-14'").count() == 0 and got.count() > 0
    with pytest.raises(ValueError, match="replace mode"):
        MT.ledger(spark, path)


def test_rename_reads_files_from_before_and_after(spark):
    path = scratch_path(spark, "t-rename")
    spark.createDataFrame([(1, "a")], "id long, route_name string").write.parquet(path)
    spark.createDataFrame([(2, "b")], "id long, route string").write.mode("append").parquet(path)
    for schema in (None, "id long, route_name string, route string"):
        out = MT.evolve_schema(spark, path, rename={"route": "route_name"}, schema=schema)
        assert out.columns == ["id", "route"] and sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b")]


def test_ties_in_the_ledger_are_decided(spark):
    rows = [("2024-01-01 00:00:00", "r", i, "2024-02-01 00:00:00") for i in (3, 9, 5)]
    df = spark.createDataFrame(rows, "report_hour string, route_name string, trip_count long, updated_at string")
    assert {G.latest_per_key(df.repartition(n)).head().trip_count for n in (1, 2, 3)} == {9}


def _write_parts(spark, silver, path, parts):
    """A batch-written table: dates before the 10th in one file each, later ones in ``parts`` small files."""
    early = silver.where("event_date < '2024-01-10'")
    early.repartition(4, "event_date").write.mode("append").partitionBy("event_date").parquet(path)
    rest = silver.where("event_date >= '2024-01-10' or event_date is null")
    for part in rest.randomSplit([1.0] * parts, seed=2):
        part.repartition(2).write.mode("append").partitionBy("event_date").parquet(path)


def test_compaction_leaves_dates_without_small_files_alone(spark, sf0001):
    silver = C.silver(spark, sf0001)
    path = scratch_path(spark, "t-compact-dates")
    _write_parts(spark, silver, path, 4)
    before = sizing.files_by(spark, path, "event_date")
    names = {r.event_date: r.f for r in spark.read.parquet(path).groupBy("event_date").agg(F.sort_array(F.collect_set("_metadata.file_path")).alias("f")).collect()}
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    conf = spark.conf.get(key)
    done = sizing.compact_dates(spark, path, "event_date")
    assert spark.conf.get(key) == conf
    assert set(done) == {v for v, f in before.items() if f.files > 1} and None in done
    after = sizing.files_by(spark, path, "event_date")
    assert {v: f.rows for v, f in after.items()} == {v: f.rows for v, f in before.items()}
    assert all(f.files == 1 for f in after.values())
    now = {r.event_date: r.f for r in spark.read.parquet(path).groupBy("event_date").agg(F.sort_array(F.collect_set("_metadata.file_path")).alias("f")).collect()}
    assert all(now[d] == names[d] for d in names if d not in done) and all(now[d] != names[d] for d in done)
    cols = silver.columns
    assert spark.read.parquet(path).select(cols).exceptAll(silver).count() == 0
    assert sizing.compact_dates(spark, path, "event_date") == []  # nothing is small any more


def test_compacted_files_come_close_to_the_target(spark):
    path, out = scratch_path(spark, "t-target"), scratch_path(spark, "t-target-out")
    rows = spark.range(400_000).select(F.xxhash64("id").alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b"),
                                       F.when(F.col("id") % 8 > 0, F.lit("2024-01-01")).when(F.col("id") % 16 > 0, F.lit("2024-01-02")).cast("date").alias("d"))
    rows.repartition(40).write.partitionBy("d").parquet(path)
    total = sizing.files_by(spark, path, "d")
    target = total[max(k for k in total if k is not None)].bytes // 2  # some 28 files of the large date
    MT.compact(spark, path, out, "d", target_file_bytes=target)
    got = spark.read.parquet(out).groupBy("d", "_metadata.file_path").agg(F.max("_metadata.file_size").alias("size")).collect()
    large = [r["size"] for r in got if str(r["d"]) == "2024-01-01"]
    assert len(large) > 5 and all(0.75 * target <= s <= 1.25 * target for s in large)
    assert spark.read.parquet(out).count() == 400_000
    assert sizing.bytes_per_row({}) is None and sizing.small_dates({}) == []


def test_a_sized_write_of_nothing_and_without_history(spark, sf0001):
    silver = C.silver(spark, sf0001)
    a, b = scratch_path(spark, "t-none"), scratch_path(spark, "t-first")
    assert sizing.write_sized(silver.limit(0), a, "event_date", 50.0) == {}
    assert sizing.write_sized(silver, b, "event_date", None) == {}
    assert spark.read.schema(silver.schema).parquet(a).count() == 0 and spark.read.parquet(b).count() == silver.count()
