"""Table maintenance on path-based Parquet tables.

Version operations are expressed over the write-time column of an
append-only table (``updated_at`` in gold): every append carries one
``current_timestamp`` value, so the distinct values are the commits.
Compaction and rollback always write a *new* path: files under a streaming
file-sink path are named by its commit log and must not be rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.schemas import GOLD, GOLD_KEY
from ..functions.timecols import seconds, ts_lit
from .gold import newest_first

TARGET_FILE_BYTES = 134_217_728  # fixed value: target data-file size


def ledger(spark: SparkSession, path: str, schema=GOLD) -> DataFrame:
    """An append-only table, the input of the version operations. A table that a replace has
    overwritten lacks the rows of earlier commits and is refused."""
    from ..sources.tables import REPLACED, path_exists
    if path_exists(spark, f"{path}/{REPLACED}"):
        raise ValueError(f"{path} was written in replace mode: earlier commits cannot be read back; append, "
                         "and read the current rows with latest_per_key")
    return spark.read.schema(schema).parquet(path)


def snapshot_log(table: DataFrame, version_col: str = "updated_at") -> DataFrame:
    """One row per commit, newest first: snapshot_id (1 = oldest),
    committed_at, operation, rows. The table is reduced to one row per
    commit by a partial aggregate before the (tiny) numbering window."""
    commits = table.groupBy(F.col(version_col).alias("committed_at")).agg(
        F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy("committed_at")  # one row per commit: small by construction
    return (commits.select(F.row_number().over(w).cast("long").alias("snapshot_id"), "committed_at",
                           F.lit("append").alias("operation"), "rows")
            .orderBy(F.col("committed_at").desc()))


def as_of_read(table: DataFrame, commit_ts, version_col: str = "updated_at") -> DataFrame:
    """The table as it was right after the commit at ``commit_ts``: an append-only table
    (:func:`ledger`, or silver with its ``updated_at``)."""
    return table.filter(F.col(version_col) <= ts_lit(commit_ts))


def rollback(table: DataFrame, commit_ts, path: str, partition_col: str = "report_date",
             version_col: str = "updated_at") -> None:
    """Write the as-of view to a new path (the old path stays untouched)."""
    from ..sources.tables import balanced_by
    (balanced_by(as_of_read(table, commit_ts, version_col), partition_col)
     .write.mode("errorifexists").partitionBy(partition_col).parquet(path))


def expire_versions(table: DataFrame, as_of=None, retention: str = "7d", key=GOLD_KEY,
                    version_col: str = "updated_at") -> DataFrame:
    """Drop versions older than the retention unless they are still the
    current row of their key; the current state is never lost."""
    bound = ts_lit(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds(retention)))
    w = Window.partitionBy(*key).orderBy(*newest_first(table, key, version_col))
    return (table.withColumn("_rn", F.row_number().over(w))
            .filter((F.col(version_col) >= bound) | (F.col("_rn") == 1)).drop("_rn"))


def compact(spark: SparkSession, src: str, dst: str, partition_col: str,
            target_file_bytes: int = TARGET_FILE_BYTES, schema=None) -> DataFrame:
    """Rewrite ``src`` into the new path ``dst`` with files close to the target size.

    The number of files of each date is planned from the bytes a row takes in
    the files of ``src`` (read from file metadata), so a large date is split
    into several target-sized files and a date of small files becomes one. No
    session setting changes. For a batch-written table,
    :func:`..sources.sizing.compact_dates` rewrites only the dates that need it.
    Returns the compacted table."""
    from ..sources import sizing
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(src)
    files = sizing.files_by(spark, src, partition_col, schema)
    sizing.write_sized(df, dst, partition_col, sizing.bytes_per_row(files), {v: f.rows for v, f in files.items()},
                       target_file_bytes, mode="errorifexists")
    return spark.read.parquet(dst)


def evolve_schema(spark: SparkSession, path: str, rename: dict[str, str] | None = None,
                  drop: tuple[str, ...] = (), schema=None) -> DataFrame:
    """Read a table whose files carry different column sets (added columns
    are NULL where absent), then apply renames ``{new: old}`` and drops as
    a projection; no data file is rewritten. Files from before and after a
    rename may both be there: the new name is read first, else the old one.

    ``schema`` is the declared union of all columns, old and new names; with
    it no file footer is opened to find them (without, every footer is)."""
    df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.option("mergeSchema", "true").parquet(path)
    rename = rename or {}
    here = set(df.columns)
    old_to_new = {old: new for new, old in rename.items()}
    cols = []
    for c in df.columns:
        if c in drop or (c in old_to_new and old_to_new[c] in here):
            continue
        old = rename.get(c)
        cols.append(F.coalesce(c, old).alias(c) if old in here else F.col(c).alias(old_to_new.get(c, c)))
    return df.select(*cols)
