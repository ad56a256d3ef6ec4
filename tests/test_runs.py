"""Chunked ordered aggregates equal their single-window definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeride.functions.runs import islands, merged_intervals, running_count, running_sum


def test_running_sum_equals_plain_window(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"),
                                     (F.col("id") % 7).cast("double").alias("v"))
    got = running_sum(df, ["k"], ["t"], F.col("v"), F.floor(F.col("t") / 97), "rs")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("rs", F.sum("v").over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    rc = running_count(df, ["k"], ["t"], F.floor(F.col("t") / 50), "n")
    assert rc.filter(F.col("n") != F.floor(F.col("t") / 3) + 1).count() == 0


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.integers(0, 300), max_size=80))
def test_islands_brute_force(spark, ks):
    df = spark.createDataFrame([("a", k) for k in sorted(ks)], "key string, k long")
    got = sorted((r.start_k, r.end_k) for r in islands(df, ["key"], "k", chunk_steps=7).collect())
    want, cur = [], None
    for k in sorted(ks):
        if cur and k == cur[1] + 1:
            cur = (cur[0], k)
        else:
            if cur:
                want.append(cur)
            cur = (k, k)
    if cur:
        want.append(cur)
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 200), st.integers(0, 40)), max_size=40))
def test_merged_intervals_equal_islands_of_their_steps(spark, items):
    df = spark.createDataFrame([(k, s, s + n) for k, s, n in items], "key string, s long, e long")
    steps = df.select("key", F.explode(F.sequence("s", "e")).alias("k"))
    want = sorted(map(tuple, islands(steps, ["key"], "k", chunk_steps=7).collect()))
    assert sorted(map(tuple, merged_intervals(df, ["key"], F.col("s"), F.col("e"), chunk_steps=7).collect())) == want
