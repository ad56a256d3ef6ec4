"""Replacing runs that keep history: a run ledger with validity intervals.

A run writes its rows into a folder of its own and then publishes one record:
for every date it covers, which run's rows are valid from now on (none for a
date that it leaves empty). Nothing is overwritten, so the interval of the
run before ends where the next record of that date begins. An as-of read
joins the intervals valid at that time with the data's (run, date)
partitions; going back to an earlier state is one more record and copies
no rows. A run that dies before its record is not seen, and its number is
used again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schemas import GOLD
from ..functions.timecols import ts_lit
from ..sources.tables import balanced_by, path_exists

RECORD = T.StructType([T.StructField("report_date", T.DateType()), T.StructField("data_run", T.LongType()),
                       T.StructField("valid_from", T.TimestampNTZType())])
_LEDGER = T.StructType([*RECORD.fields, T.StructField("run", T.LongType())])


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(report_date, data_run, valid_from, run): one row per run and date that it covers."""
    if not path_exists(spark, f"{path}/runs"):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{path}/runs")


def intervals(spark: SparkSession, path: str) -> DataFrame:
    """(report_date, run, data_run, valid_from, valid_to): when the rows of ``data_run`` were those of a date;
    valid_to is null while they are. Ordered per date, so as many rows meet as a date has runs."""
    after = Window.partitionBy("report_date").orderBy("run")
    return ledger(spark, path).select("report_date", "run", "data_run", "valid_from", F.lead("valid_from").over(after).alias("valid_to"))


def _valid(spark: SparkSession, path: str, at=None) -> DataFrame:
    rows = intervals(spark, path)
    if at is None:
        return rows.where("valid_to is null")
    return rows.where((F.col("valid_from") <= ts_lit(at)) & (F.col("valid_to").isNull() | (F.col("valid_to") > ts_lit(at))))


def _publish(spark: SparkSession, path: str, run: int, record: DataFrame) -> None:
    # as many rows as the run covers dates, in one file, so it is there as a whole or not at all
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/run={run}")


def _next_run(spark: SparkSession, path: str, at) -> int:
    last = ledger(spark, path).agg(F.max("run").alias("run"), F.max("valid_from").alias("at"), ts_lit(at).alias("now")).head()
    if last["run"] is None:
        return 1
    if last["now"] < last["at"]:
        raise ValueError(f"run at {last['now']}: the last one was later, at {last['at']}")
    return last["run"] + 1


def write_run(rows: DataFrame, path: str, at, covered: Column | None = None, schema=GOLD) -> int:
    """Writes a run that replaces the dates it has rows for and, with ``covered`` (a condition on report_date), all
    dates it covers; returns its number. One writer at a time."""
    spark = rows.sparkSession
    run = _next_run(spark, path, at)
    own = f"{path}/data/run={run}"
    names = [f.name for f in schema.fields]
    balanced_by(rows.select(names), "report_date").write.mode("overwrite").partitionBy("report_date").parquet(own)
    dates = spark.read.schema(schema).parquet(own).select("report_date").distinct()
    record = dates.select("report_date", F.lit(run).cast("long").alias("data_run"))
    if covered is not None:
        held = _valid(spark, path).where("data_run is not null").where(covered).select("report_date")
        record = record.unionByName(held.join(dates, held["report_date"].eqNullSafe(dates["report_date"]), "left_anti").select("report_date", F.lit(None).cast("long").alias("data_run")))
    _publish(spark, path, run, record.withColumn("valid_from", ts_lit(at)))
    return run


def roll_back(spark: SparkSession, path: str, to, at) -> int:
    """The state that was valid at ``to`` becomes valid again at ``at``; no rows are copied."""
    run = _next_run(spark, path, at)
    then = _valid(spark, path, to).select(F.col("report_date").alias("date"), F.col("data_run").alias("then"))
    now = _valid(spark, path).select("report_date", F.col("data_run").alias("now"))
    changed = now.join(then, now["report_date"].eqNullSafe(then["date"]), "left").where("not now <=> then")
    _publish(spark, path, run, changed.select("report_date", F.col("then").alias("data_run"), ts_lit(at).alias("valid_from")))
    return run


def as_of(spark: SparkSession, path: str, at=None, schema=GOLD) -> DataFrame:
    """The rows valid at a time (now if not given). The intervals, one row per date, are the small side of the
    join, which prunes the (run, date) partitions that it reads."""
    full = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
    pairs = _valid(spark, path, at).where("data_run is not null").select(F.col("data_run").alias("valid_run"), F.col("report_date").alias("valid_date"))
    names = [f.name for f in schema.fields]
    if not path_exists(spark, f"{path}/data"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(full).parquet(f"{path}/data")
    return rows.join(pairs, (rows["run"] == pairs["valid_run"]) & rows["report_date"].eqNullSafe(pairs["valid_date"]), "left_semi").select(names)
