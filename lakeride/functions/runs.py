"""Ordered per-key aggregates that stay balanced when one key is huge.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task. Here each key is additionally split by a coarse, order-compatible
``chunk`` (an hour, a day, a block of step indices):

1. the ordered work runs inside ``(key, chunk)`` partitions;
2. one summary row per ``(key, chunk)`` (map-side combined) carries what
   the next chunk needs (totals, last value);
3. a window over the small summary table turns those into offsets;
4. the offsets are joined back on ``(key, chunk)``.

The only per-key window runs over the summary, whose size is the number of
chunks a key spans, not the number of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "_chunk"


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 values: dict[str, Column], chunk: Column) -> DataFrame:
    """Inclusive running sums of several ``values`` per ``keys`` in ``order``.

    ``chunk`` must be non-decreasing along ``order`` within a key (e.g. the
    hour or date of the ordering timestamp). Ties in ``order`` must be broken
    by the caller for a deterministic result. Keys must be non-NULL (they
    are equi-joined).
    """
    keys = list(keys)
    names = list(values)
    d = df.withColumn(_CHUNK, chunk)
    for n in names:
        d = d.withColumn(f"_v_{n}", values[n])
    w_local = (Window.partitionBy(*keys, _CHUNK).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d.select("*", *[F.sum(f"_v_{n}").over(w_local).alias(f"_l_{n}") for n in names])
    totals = d.groupBy(*keys, _CHUNK).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    w_chunks = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, _CHUNK, *[
        F.coalesce(F.sum(f"_t_{n}").over(w_chunks), F.lit(0)).alias(f"_o_{n}") for n in names])
    joined = local.join(offsets, [*keys, _CHUNK], "inner")
    return joined.select(
        *[c for c in df.columns],
        *[(F.col(f"_o_{n}") + F.col(f"_l_{n}")).alias(n) for n in names])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                value: Column, chunk: Column, out: str) -> DataFrame:
    """Inclusive running sum of one value (see :func:`running_sums`)."""
    return running_sums(df, keys, order, {out: value}, chunk)


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  chunk: Column, out: str) -> DataFrame:
    """1-based position of each row within its key (chunked row_number)."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), chunk, out)


def islands(df: DataFrame, keys: Sequence[str], k: str, chunk_steps: int = 1440,
            start: str = "start_k", end: str = "end_k", distinct: bool = True) -> DataFrame:
    """Maximal runs of consecutive integers ``k`` per key -> (keys, start, end).

    Gaps-and-islands in two levels. Inside each ``(key, k div chunk_steps)``
    partition (at most ``chunk_steps`` distinct values) ``k - row_number`` is
    constant along a run, giving local runs. A local run that touches neither
    edge of its chunk is final; only runs touching an edge (at most two per
    chunk) are stitched across chunks with a small per-key window, so no
    window partition grows with a key's history. ``distinct=False`` skips
    the de-duplicating shuffle when the caller's (key, k) pairs are unique.
    """
    keys = list(keys)
    pts = df.select(*keys, F.col(k).cast("long").alias("_k"))
    if distinct:
        pts = pts.distinct()
    pts = pts.withColumn(_CHUNK, F.coalesce(F.floor(F.col("_k") / F.lit(chunk_steps)), F.lit(0)).cast("long"))
    w = Window.partitionBy(*keys, _CHUNK).orderBy("_k")
    local = (pts.select(*keys, _CHUNK, "_k", (F.col("_k") - F.row_number().over(w)).alias("_g"))
             .groupBy(*keys, _CHUNK, "_g").agg(F.min("_k").alias("_s"), F.max("_k").alias("_e")))
    return _stitched(local, keys, chunk_steps, start, end)


def merged_intervals(df: DataFrame, keys: Sequence[str], first: Column, last: Column, chunk_steps: int = 1440,
                     start: str = "start_k", end: str = "end_k") -> DataFrame:
    """Union of the integer intervals [first, last] per key -> (keys, start, end), neighbours joined.

    The same result as :func:`islands` over every step of every interval, but
    an interval makes one row per chunk it touches, not one per step. Inside a
    chunk intervals with one start are combined first, so at most
    ``chunk_steps`` rows per (key, chunk) are ordered.
    """
    keys = list(keys)
    ends = df.select(*keys, first.cast("long").alias("_s"), last.cast("long").alias("_e")).filter("_s <= _e")
    cut = ends.withColumn(_CHUNK, F.explode(F.sequence(F.floor(F.col("_s") / F.lit(chunk_steps)).cast("long"),
                                                       F.floor(F.col("_e") / F.lit(chunk_steps)).cast("long"))))
    lo = F.col(_CHUNK) * F.lit(chunk_steps)
    cut = (cut.select(*keys, _CHUNK, F.greatest("_s", lo).alias("_s"), F.least(F.col("_e"), lo + F.lit(chunk_steps - 1)).alias("_e"))
           .groupBy(*keys, _CHUNK, "_s").agg(F.max("_e").alias("_e")))
    w = Window.partitionBy(*keys, _CHUNK).orderBy("_s")
    reached = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    local = (cut.withColumn("_new", F.when(F.col("_s") <= reached + 1, 0).otherwise(1))
             .withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*keys, _CHUNK, "_g").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")))
    return _stitched(local, keys, chunk_steps, start, end)


def _stitched(local: DataFrame, keys: Sequence[str], chunk_steps: int, start: str, end: str) -> DataFrame:
    """Joins runs of neighbouring chunks: only those that touch an edge of their chunk."""
    lo_edge = F.col(_CHUNK) * F.lit(chunk_steps)
    touches = (F.col("_s") == lo_edge) | (F.col("_e") == lo_edge + F.lit(chunk_steps - 1))
    interior = local.filter(~touches).select(*keys, F.col("_s").alias(start), F.col("_e").alias(end))
    wb = Window.partitionBy(*keys).orderBy("_s")
    prev_e = F.lag("_e").over(wb)
    border = local.filter(touches).select(
        *keys, "_s", "_e", F.when(prev_e.isNotNull() & (F.col("_s") == prev_e + 1), 0).otherwise(1).alias("_new"))
    merged = (border.withColumn("_grp", F.sum("_new").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*keys, "_grp").agg(F.min("_s").alias(start), F.max("_e").alias(end))
              .drop("_grp"))
    return interior.unionByName(merged)
