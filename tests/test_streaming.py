"""Structured Streaming medallion over a text-file source."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakeride.plans import catalog as C
from lakeride.session import scratch_path
from lakeride.sources import fixtures as FX
from lakeride.streaming import medallion as SM


def test_medallion_equals_batch_and_restart_is_exactly_once(spark, sf0001):
    ev = FX.load_table(spark, sf0001, "events")
    src = scratch_path(spark, "t-raw")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    FX.raw_trip_json(ev.filter(early)).write.text(src)
    root = scratch_path(spark, "t-medallion")
    paths = SM.MedallionPaths.under(root)

    def run():
        qb, qs = SM.run_medallion(lambda: SM.read_trip_stream(spark, "text", src), paths, "availableNow")
        SM.await_all(qb, qs)

    run()
    first = spark.read.parquet(paths.silver).count()
    FX.raw_trip_json(ev.filter(~early)).write.mode("append").text(src)
    run()
    run()  # nothing new: no rows added
    silver = spark.read.parquet(paths.silver)
    batch = C.silver(spark, sf0001)
    assert 0 < first < silver.count() == batch.count()
    assert silver.select("trip_id").distinct().count() == silver.count()
    cols = [c for c in batch.columns if c != "updated_at"]
    assert silver.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    bronze = spark.read.parquet(paths.bronze)
    assert bronze.count() == C.bronze(spark, sf0001).count()
    # unparseable times land in the NULL partition and read back
    assert silver.filter(F.col("event_date").isNull()).count() == batch.filter(F.col("event_date").isNull()).count()


def test_rebuild_uses_new_paths(spark, sf0001):
    src = scratch_path(spark, "t-raw2")
    FX.raw_trip_json(FX.load_table(spark, sf0001, "events")).write.text(src)
    p1, qs1 = SM.rebuild(spark, lambda: SM.read_trip_stream(spark, "text", src), trigger="availableNow")
    SM.await_all(*qs1)
    p2, qs2 = SM.rebuild(spark, lambda: SM.read_trip_stream(spark, "text", src), trigger="availableNow")
    SM.await_all(*qs2)
    assert p1.silver != p2.silver
    assert spark.read.parquet(p1.silver).count() == spark.read.parquet(p2.silver).count()


@pytest.mark.parametrize("mergeable", [False, True])
def test_streaming_gold_equals_batch_with_late_rows_and_reruns(spark, sf0001, mergeable):
    state_path = scratch_path(spark, "t-states") if mergeable else None
    from lakeride.functions.schemas import GOLD
    from lakeride.operators import gold as G
    src = scratch_path(spark, "t-raw3")
    ev = FX.load_table(spark, sf0001, "events")
    paths = SM.MedallionPaths.under(scratch_path(spark, "t-gold-silver"))
    out, ckpt = scratch_path(spark, "t-gold-stream"), scratch_path(spark, "t-gold-ckpt")
    # the second part holds rows of every date of the first
    for part in (ev.filter("event_id % 3 = 0"), ev.filter("event_id % 3 <> 0")):
        FX.raw_trip_json(part).write.mode("append").text(src)
        SM.await_all(SM.start_layer(SM.silver_stream(SM.read_trip_stream(spark, "text", src)),
                                    paths.silver, paths.silver_checkpoint, "availableNow"))
        for _ in range(2):
            SM.await_all(SM.hourly_gold_stream(spark, paths.silver, out, ckpt, "availableNow", state_path=state_path))
    cols = ["report_hour", "route_name", "trip_count", "unique_drivers", F.round("total_revenue", 6).alias("r")]
    stream = spark.read.schema(GOLD).parquet(out).select(*cols)
    batch = G.hourly_gold(C.silver(spark, sf0001), as_of="2000-01-01").select(*cols)  # every date
    assert stream.count() == batch.count() > 0
    assert batch.exceptAll(stream).count() == 0


def test_stop_mid_stream_and_resume_exactly_once(spark, sf0001):
    import time
    src = scratch_path(spark, "t-raw4")
    FX.raw_trip_json(FX.load_table(spark, sf0001, "events")).repartition(4).write.text(src)
    paths = SM.MedallionPaths.under(scratch_path(spark, "t-drill"))
    raw = SM.read_trip_stream(spark, "text", src, max_per_trigger=1)
    q = SM.start_layer(SM.silver_stream(raw), paths.silver, paths.silver_checkpoint, "1 second")
    deadline = time.time() + 120
    while time.time() < deadline and not (q.recentProgress and q.recentProgress[-1]["numInputRows"] > 0):
        time.sleep(0.5)
    q.stop()  # stopped after the first batch(es), before the whole input
    partial = spark.read.parquet(paths.silver).count()
    q2 = SM.start_layer(SM.silver_stream(SM.read_trip_stream(spark, "text", src)), paths.silver,
                        paths.silver_checkpoint, "availableNow")
    SM.await_all(q2)
    silver = spark.read.parquet(paths.silver)
    total = C.silver(spark, sf0001).count()
    assert 0 < partial < total
    assert silver.count() == total == silver.select("trip_id").distinct().count()


def _messages(spark, sf0001, name, early=True):
    src = scratch_path(spark, name)
    ev = FX.load_table(spark, sf0001, "events")
    cond = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    FX.raw_trip_json(ev.filter(cond if early else F.lit(True))).write.text(src)
    return src, ev.filter(~cond)


def test_both_layers_come_from_one_read(spark, sf0001):
    src, _ = _messages(spark, sf0001, "t-one-read", early=False)
    paths = SM.MedallionPaths.under(scratch_path(spark, "t-one-read-out"))
    q, same = SM.run_medallion(lambda: SM.read_trip_stream(spark, "text", src), paths, "availableNow")
    SM.await_all(q)
    assert q is same
    assert sum(p["numInputRows"] for p in q.recentProgress) == spark.read.text(src).count()
    assert SM.read_layer(spark, paths, "silver").count() == C.silver(spark, sf0001).count()
    assert SM.read_layer(spark, paths, "bronze").count() == C.bronze(spark, sf0001).count()


@pytest.mark.parametrize("dies", ["between", "before_commit"])
def test_a_crash_while_a_batch_is_written_loses_and_doubles_nothing(spark, sf0001, monkeypatch, dies):
    src, rest = _messages(spark, sf0001, f"t-crash-{dies}")
    paths = SM.MedallionPaths.under(scratch_path(spark, f"t-crash-out-{dies}"))

    def run():
        SM.await_all(SM.run_medallion(lambda: SM.read_trip_stream(spark, "text", src), paths, "availableNow")[0])

    run()
    first = SM.read_layer(spark, paths, "silver").count()
    FX.raw_trip_json(rest).write.mode("append").text(src)
    real = SM.sizing.write_sized
    calls = []

    def dying(df, path, *a, **k):
        calls.append(path)
        if dies == "between" and len(calls) == 2:
            raise RuntimeError("lost")
        out = real(df, path, *a, **k)
        if dies == "before_commit" and len(calls) == 2:
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(SM.sizing, "write_sized", dying)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.undo()
    # what the dead writer left is not published in either table
    assert SM.read_layer(spark, paths, "silver").count() == first
    assert spark.read.parquet(paths.bronze).count() > SM.read_layer(spark, paths, "bronze").count()
    run()
    silver, bronze = (SM.read_layer(spark, paths, layer) for layer in ("silver", "bronze"))
    assert silver.count() == silver.select("trip_id").distinct().count() == C.silver(spark, sf0001).count()
    assert bronze.count() == C.bronze(spark, sf0001).count()
    run()
    assert SM.read_layer(spark, paths, "silver").count() == silver.count()


def test_a_published_batch_is_left_alone(spark, sf0001):
    src, _ = _messages(spark, sf0001, "t-again")
    paths = SM.MedallionPaths.under(scratch_path(spark, "t-again-out"))
    SM.write_batch(spark.read.text(src), 0, paths)
    before = sorted(spark.read.parquet(paths.silver).inputFiles())
    SM.write_batch(spark.read.text(src), 0, paths)
    assert sorted(spark.read.parquet(paths.silver).inputFiles()) == before
    SM.write_batch(spark.read.text(src).limit(0), 1, paths)  # nothing new: published, no rows
    rows = {(r.batch, r.layer): r for r in SM.commits(spark, paths).collect()}
    assert rows[1, "silver"].rows == 0 and rows[1, "silver"].row_bytes == rows[0, "silver"].row_bytes
    assert rows[0, "silver"].rows == SM.read_layer(spark, paths, "silver").count()


def test_file_sizes_follow_the_bytes_per_row_of_the_batch_before(spark, sf0001):
    paths = SM.MedallionPaths.under(scratch_path(spark, "t-sizes"))
    line = FX.raw_trip_json(FX.load_table(spark, sf0001, "events").where("event_id % 101 > 0 and event_id % 83 > 0 and event_id < 900"))
    hot = line.withColumn("value", F.regexp_replace("value", '"createdAt":"[^"]*"', '"createdAt":"2024-05-01T00:00:00.000Z"'))
    SM.write_batch(line, 0, paths)
    row_bytes = SM.commits(spark, paths).where("layer = 'silver'").head().row_bytes
    target = int(row_bytes * 100)
    SM.write_batch(hot.unionAll(line), 1, paths, target)
    n = hot.count()
    own = spark.read.parquet(f"{paths.silver}/batch=1")
    files = own.where("event_date = '2024-05-01'").groupBy(F.input_file_name().alias("f")).count().collect()
    assert -(-n // 100) <= len(files) <= -(-n // 100) + 2
    assert max(r["count"] for r in files) <= 111 and own.where("event_date = '2024-05-01'").count() == n
    small = own.where("event_date = '2024-01-02'")
    assert small.select(F.input_file_name()).distinct().count() == 1
