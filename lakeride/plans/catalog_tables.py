"""Named queries that write and read tables: the gold ledger, maintenance
operations and the streaming medallion. Every write goes to a fresh folder
under the session's shared checkpoint directory."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.schemas import GOLD, SILVER
from ..operators import columns as CM
from ..operators import gold as G
from ..operators import history as H
from ..operators import maintenance as MT
from ..operators import quality as Q
from ..operators import reports as R
from ..operators import states as ST
from ..session import materialize, scratch_path
from ..sources import fixtures as FX
from ..sources import sizing
from ..sources.tables import write_layer
from ..streaming import medallion as SM
from . import params as P
from .catalog import register, silver


def gold_second(spark, d):
    return G.hourly_gold(silver(spark, d), as_of=P.GOLD_AS_OF_2, now=P.GOLD_NOW_2)


def gold_first(spark, d):
    return G.hourly_gold(silver(spark, d), as_of=P.GOLD_AS_OF, now=P.GOLD_NOW)


def ledger(spark, d):
    """Two plain appends (the faithful INSERT) of overlapping hourly runs."""
    path = scratch_path(spark, "gold-ledger")
    G.write_gold(gold_first(spark, d), path, mode="append")
    G.write_gold(gold_second(spark, d), path, mode="append")
    return MT.ledger(spark, path), path


def _gold_cols(df):
    return df.select(*[f.name for f in GOLD.fields])


@register("gold_append_ledger")
def _gold_append_ledger(spark, d):
    return _gold_cols(ledger(spark, d)[0])


@register("gold_replace_twice")
def _gold_replace_twice(spark, d):
    """Dynamic partition overwrite twice: dates of the second run are
    replaced, older dates keep the first run -> one row per key."""
    path = scratch_path(spark, "gold-replace")
    G.write_gold(gold_first(spark, d), path, mode="replace")
    G.write_gold(gold_second(spark, d), path, mode="replace")
    return _gold_cols(spark.read.schema(GOLD).parquet(path))


@register("gold_replace_emptied_date")
def _gold_replace_emptied_date(spark, d):
    """The second run finds every trip of one of its dates invalid: that date must leave the table."""
    path = scratch_path(spark, "gold-emptied")
    G.write_gold(gold_first(spark, d), path, covered=G.covered_dates(P.GOLD_AS_OF))
    rows = silver(spark, d)
    rows = rows.withColumn("is_valid", F.col("is_valid") & F.coalesce(F.col("event_date") != P.EMPTIED_DATE, F.lit(True)))
    G.write_gold(G.hourly_gold(rows, as_of=P.GOLD_AS_OF_2, now=P.GOLD_NOW_2), path, covered=G.covered_dates(P.GOLD_AS_OF_2))
    return _gold_cols(spark.read.schema(GOLD).parquet(path))


@register("rollback_read")
def _rollback_read(spark, d):
    """The ledger rolled back to its first commit, read from the new path."""
    path = scratch_path(spark, "gold-rolled-back")
    MT.rollback(ledger(spark, d)[0], P.GOLD_NOW, path)
    return _gold_cols(spark.read.schema(GOLD).parquet(path))


def _three_runs(spark, d):
    """Two gold runs that replace what they cover, the second one without one date's rows, then a return to the first."""
    path = scratch_path(spark, "gold-history")
    H.write_run(gold_first(spark, d), path, P.GOLD_NOW, covered=G.covered_dates(P.GOLD_AS_OF))
    second = gold_second(spark, d).filter(F.col("report_date") != P.EMPTIED_DATE)
    H.write_run(second, path, P.GOLD_NOW_2, covered=G.covered_dates(P.GOLD_AS_OF_2))
    H.roll_back(spark, path, P.GOLD_NOW, P.GOLD_NOW_3)
    return path


@register("as_of_after_replace")
def _as_of_after_replace(spark, d):
    """The gold table as of the first run, read after a second run has replaced most of its dates."""
    return _gold_cols(H.as_of(spark, _three_runs(spark, d), P.GOLD_NOW))


@register("as_of_second_run")
def _as_of_second_run(spark, d):
    """Between the second run and the return: its dates, the older ones of the first run, and not the emptied date."""
    return _gold_cols(H.as_of(spark, _three_runs(spark, d), P.GOLD_NOW_2))


@register("as_of_rolled_back")
def _as_of_rolled_back(spark, d):
    return _gold_cols(H.as_of(spark, _three_runs(spark, d)))


@register("run_intervals")
def _run_intervals(spark, d):
    return H.intervals(spark, _three_runs(spark, d))


@register("evolve_reused_name")
def _evolve_reused_name(spark, d):
    """A column renamed, its old name dropped and used again for something else: old files keep their values under
    the new name and have none under the reused one."""
    path = scratch_path(spark, "silver-columns")
    s = silver(spark, d).select("trip_id", "route_name", "base_fare", "event_date")
    early = F.coalesce(F.col("event_date") < P.EVOLVE_SPLIT, F.lit(False))
    first = CM.Columns.of(s.schema)
    first.write(s.filter(early), path, "event_date")
    then = first.rename("route_name", "route").drop("base_fare").add("base_fare", "bigint").add("route_name", "string")
    later = s.filter(~early).select("trip_id", F.col("route_name").alias("route"), F.floor("base_fare").cast("long").alias("base_fare"),
                                    F.upper("route_name").alias("route_name"), "event_date")
    then.write(later, path, "event_date")
    CM.save(spark, path, [first, then])
    return CM.load(spark, path)[-1].read(spark, path)


@register("silver_as_of")
def _silver_as_of(spark, d):
    """Silver written by two commits, read as it was after the first."""
    path = scratch_path(spark, "silver-as-of")
    s = silver(spark, d)
    early = F.coalesce(F.col("event_date") < P.EVOLVE_SPLIT, F.lit(False))
    write_layer(s.filter(early), path, "silver")
    write_layer(s.filter(~early).withColumn("updated_at", F.lit(P.GOLD_NOW_2).cast("timestamp_ntz")), path, "silver")
    return MT.as_of_read(MT.ledger(spark, path, SILVER), P.INGEST_NOW).select(*s.columns)


# ---- gated gold ----------------------------------------------------------------

def _complete(rows):
    """All rows, with values that pass the checks whatever the scale: no NULL fare, and of the
    invalid rows only those whose trip ends in 7 stay flagged."""
    return (rows.withColumn("base_fare", F.coalesce("base_fare", F.lit(0.0).cast(rows.schema["base_fare"].dataType)))
            .withColumn("is_valid", F.col("is_valid") | ~F.col("trip_id").endswith("7")))


@register("gated_gold_pass")
def _gated_gold_pass(spark, d):
    """Checks pass, so the rollup is written; read back from its path."""
    path = scratch_path(spark, "gated-pass")
    Q.gated_gold(_complete(silver(spark, d)), path, P.GOLD_AS_OF, P.GOLD_NOW)
    return _gold_cols(spark.read.schema(GOLD).parquet(path))


@register("gated_gold_blocked")
def _gated_gold_blocked(spark, d):
    """A passing run, then one that the null check blocks: the table keeps the first run's rows."""
    path = scratch_path(spark, "gated-blocked")
    Q.gated_gold(_complete(silver(spark, d)), path, P.GOLD_AS_OF, P.GOLD_NOW)
    without_fares = silver(spark, d).withColumn("base_fare", F.when(~F.col("trip_id").endswith("7"), F.col("base_fare")))
    Q.gated_gold(without_fares, path, P.GOLD_AS_OF_2, P.GOLD_NOW_2)
    return _gold_cols(spark.read.schema(GOLD).parquet(path))


@register("gated_gold_rerun")
def _gated_gold_rerun(spark, d):
    """The same run twice: its dates are replaced, one row per key."""
    path = scratch_path(spark, "gated-rerun")
    for now in (P.GOLD_NOW, P.GOLD_NOW_2):
        Q.gated_gold(_complete(silver(spark, d)), path, P.GOLD_AS_OF, now)
    return _gold_cols(spark.read.schema(GOLD).parquet(path))


@register("evolve_rename")
def _evolve_rename(spark, d):
    """Files from before a rename and from after it, read under the new name."""
    path = scratch_path(spark, "silver-rename")
    s = silver(spark, d)
    early = F.coalesce(F.col("event_date") < P.EVOLVE_SPLIT, F.lit(False))
    write_layer(s.filter(early), path, "silver")
    write_layer(s.filter(~early).withColumnRenamed("route_name", "route"), path, "silver")
    both = s.withColumn("route", F.col("route_name")).schema
    return MT.evolve_schema(spark, path, rename={"route": "route_name"}, schema=both).select(
        "trip_id", "route", "base_fare", "event_date")


@register("latest_per_key")
def _latest_per_key(spark, d):
    return _gold_cols(G.latest_per_key(ledger(spark, d)[0]))


@register("snapshot_log")
def _snapshot_log(spark, d):
    return MT.snapshot_log(ledger(spark, d)[0])


@register("as_of_read")
def _as_of_read(spark, d):
    return _gold_cols(MT.as_of_read(ledger(spark, d)[0], P.GOLD_NOW))


@register("expire_versions")
def _expire_versions(spark, d):
    return _gold_cols(MT.expire_versions(ledger(spark, d)[0], P.RETENTION_AS_OF, P.RETENTION))


def silver_once(spark, d):
    """Silver for a query that takes it part by part: the messages are decoded once and not again for every part."""
    return materialize(silver(spark, d), "silver-rows")


def write_in_batches(silver_rows, path, batches):
    """One append per (from, to) of event_date, None being open, and one for rows without a date."""
    for lo, hi in batches:
        inside = F.col("event_date").isNotNull()
        if lo is not None:
            inside &= F.col("event_date") >= lo
        if hi is not None:
            inside &= F.col("event_date") < hi
        write_layer(silver_rows.filter(inside), path, "silver")
    write_layer(silver_rows.filter(F.col("event_date").isNull()), path, "silver")


@register("compact_dates")
def _compact_dates(spark, d):
    """Early dates written at once, late ones by two runs: only the late ones are rewritten, in place."""
    path = scratch_path(spark, "silver-dates")
    s = silver_once(spark, d)
    late = F.coalesce(F.col("event_date") >= P.EVOLVE_SPLIT, F.lit(False))
    even = F.substring("trip_id", -1, 1).isin("0", "2", "4", "6", "8")
    for part in (~late, late & even, late & ~even):
        write_layer(s.filter(part), path, "silver")
    sizing.compact_dates(spark, path, "event_date", schema=SILVER)
    return spark.read.schema(SILVER).parquet(path)


@register("compact")
def _compact(spark, d):
    """Silver written in many small appends, compacted to a new path."""
    src = scratch_path(spark, "silver-small")
    s = silver_once(spark, d)
    write_in_batches(s, src, P.SILVER_BATCHES)
    return MT.compact(spark, src, scratch_path(spark, "silver-compact"), "event_date",
                      schema=None).select(*s.columns)


@register("evolve_schema")
def _evolve_schema(spark, d):
    """Second batch adds a column; the merged read has it NULL for the first."""
    path = scratch_path(spark, "silver-evolve")
    s = silver(spark, d)
    write_layer(s.filter(F.col("event_date") < P.EVOLVE_SPLIT), path, "silver")
    later = s.filter((F.col("event_date") >= P.EVOLVE_SPLIT) | F.col("event_date").isNull())
    write_layer(later.withColumn("fare_cents", F.round(F.col("base_fare") * 100).cast("long")), path, "silver")
    return MT.evolve_schema(spark, path, rename={"route": "route_name"}, drop=("updated_at",))


# ---- streaming ---------------------------------------------------------------

def _stage_raw(spark, d, batches):
    """Write the raw messages as text files (one message per line) in
    ``batches`` (filters over event time, together covering every event)."""
    src = scratch_path(spark, "raw-stream")
    ev = FX.load_table(spark, d, "events")
    for i, cond in enumerate(batches):
        FX.raw_trip_json(ev.filter(cond)).write.mode("append").text(src)
    return src


def _run(spark, src, name, target=None):
    """Both layers from one read of the messages."""
    paths = SM.MedallionPaths.under(scratch_path(spark, name))
    more = {} if target is None else {"target": target}
    SM.await_all(SM.run_medallion(lambda: SM.read_trip_stream(spark, "text", src), paths, "availableNow", **more)[0])
    return paths


@register("stream_bronze")
def _stream_bronze(spark, d):
    paths = _run(spark, _stage_raw(spark, d, [F.lit(True)]), "stream-bronze")
    return SM.read_layer(spark, paths, "bronze").drop("ingested_at")


@register("stream_silver")
def _stream_silver(spark, d):
    paths = _run(spark, _stage_raw(spark, d, [F.lit(True)]), "stream-silver")
    return SM.read_layer(spark, paths, "silver").drop("updated_at")


@register("stream_restart")
def _stream_restart(spark, d):
    """Stop after the first files, add the rest, restart on the same
    checkpoint, rerun once more with nothing new: the audit must show every
    trip exactly once."""
    split = F.coalesce(F.col("ts") < F.lit(P.STREAM_SPLIT).cast("timestamp_ntz"), F.lit(False))
    src = _stage_raw(spark, d, [split])
    paths = SM.MedallionPaths.under(scratch_path(spark, "stream-restart"))

    def once():
        SM.await_all(SM.run_medallion(lambda: SM.read_trip_stream(spark, "text", src), paths, "availableNow")[0])

    once()
    ev = FX.load_table(spark, d, "events")
    FX.raw_trip_json(ev.filter(~split)).write.mode("append").text(src)
    once()
    once()
    return R.table_counts(SM.read_layer(spark, paths, "silver"))


@register("hourly_gold_stream")
def _hourly_gold_stream(spark, d):
    """Gold kept up to date from a silver table that grows in two steps, over all dates."""
    split = F.coalesce(F.col("ts") < F.lit(P.STREAM_SPLIT).cast("timestamp_ntz"), F.lit(False))
    ev = FX.load_table(spark, d, "events")
    src = _stage_raw(spark, d, [split])
    paths = SM.MedallionPaths.under(scratch_path(spark, "gold-stream"))
    out, ckpt = scratch_path(spark, "gold-stream-out"), scratch_path(spark, "gold-stream-ckpt")

    def once():
        SM.await_all(SM.start_layer(SM.silver_stream(SM.read_trip_stream(spark, "text", src)),
                                    paths.silver, paths.silver_checkpoint, "availableNow"))
        SM.await_all(SM.hourly_gold_stream(spark, paths.silver, out, ckpt, "availableNow"))

    once()
    FX.raw_trip_json(ev.filter(~split)).write.mode("append").text(src)
    once()
    return _gold_cols(spark.read.schema(GOLD).parquet(out)).drop("updated_at")


def _absorbed(spark, d):
    """States of silver taken in by batches, the third one twice; the last batch also brings late rows."""
    path = scratch_path(spark, "silver-states")
    rows = silver_once(spark, d)
    late = F.coalesce(F.pmod(F.xxhash64("trip_id"), F.lit(50)) == 0, F.lit(False))
    for i, (low, high) in enumerate(P.SILVER_BATCHES):
        inside = F.lit(True) if low is None else F.col("event_date") >= low
        inside = inside if high is None else inside & (F.col("event_date") < high)
        part = rows.filter((inside & ~late) | (late if high is None else F.lit(False)))
        for _ in range(2 if i == 2 else 1):
            ST.absorb(part, i, path)
    return path


@register("dq_results_from_states")
def _dq_results_from_states(spark, d):
    return ST.checks_from_states(spark, _absorbed(spark, d), P.GOLD_AS_OF)


@register("hourly_gold_from_states")
def _hourly_gold_from_states(spark, d):
    return _gold_cols(ST.gold_from_states(spark, _absorbed(spark, d), P.GOLD_NOW, since=F.date_sub(F.lit(P.GOLD_AS_OF).cast("date"), 1)))
