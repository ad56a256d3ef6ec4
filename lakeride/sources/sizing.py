"""Files of a chosen size: writes planned from bytes per row, compaction planned from file sizes.

How many bytes a row takes in a file is learned from files that are there
already. A write counts its rows per date, gives every date as many files as
its rows need and sends each file's rows to a task of its own, so a hot date
is split and a small one is one file. No session setting is changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import balanced_by

TARGET_FILE_BYTES = 134_217_728  # fixed value: target data-file size
#: a date is compacted if its mean file is smaller than this share of the target
SMALL = 0.75
#: a file may have so many times its planned rows before it is split
SLACK = 1.1


@dataclass(frozen=True)
class Files:
    """What one partition value holds."""

    rows: int
    files: int
    bytes: int


def files_by(spark: SparkSession, path: str, part_col: str, schema=None) -> dict:
    """Rows, files and bytes per partition value, from file metadata: no data column is read.

    One row per partition value reaches the driver."""
    table = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    each = (table.groupBy(part_col, F.col("_metadata.file_path").alias("file"))
            .agg(F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes")))
    total = each.groupBy(part_col).agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    return {r[part_col]: Files(r["rows"], r["files"], r["bytes"]) for r in total.collect()}


def bytes_per_row(files: dict) -> float | None:
    rows = sum(f.rows for f in files.values())
    return sum(f.bytes for f in files.values()) / rows if rows else None


def rows_by(df: DataFrame, part_col: str) -> dict:
    """Rows of each partition value; one row per value reaches the driver."""
    return {r[part_col]: r["n"] for r in df.groupBy(part_col).agg(F.count("*").alias("n")).collect()}


def _key(part_col: str) -> Column:
    return F.coalesce(F.col(part_col).cast("string"), F.lit(""))


def write_sized(df: DataFrame, path: str, part_col: str, row_bytes: float | None, counts: dict | None = None,
                target: int = TARGET_FILE_BYTES, mode: str = "append", dynamic: bool = False) -> dict[object, int]:
    """Writes ``df`` by ``part_col`` in files of about ``target`` bytes; returns the files planned per value.

    ``row_bytes``: bytes of a row in a file, learned from earlier files; None (nothing written yet) leaves the
    sizes to the rebalancing shuffle. ``counts``: rows per value, if known.
    """
    writer_of = lambda d: d.write.partitionBy(part_col).option("compression", "snappy").mode(mode)
    if row_bytes is None:
        out, plan = writer_of(balanced_by(df, part_col)), {}
    else:
        per_file = max(1, int(target / row_bytes))
        counts = rows_by(df, part_col) if counts is None else counts
        plan = {v: -(-n // per_file) for v, n in counts.items()}
        if not plan:
            out = writer_of(df)
        else:
            at, lookup = 0, []
            for v, n in plan.items():
                lookup += [F.lit("" if v is None else str(v)), F.struct(F.lit(at).alias("first"), F.lit(n).alias("n"))]
                at += n
            own = F.element_at(F.create_map(*lookup), _key(part_col))
            # the rest of the row decides its file, so a task that is run again writes the same files
            slot = own["first"] + F.pmod(F.xxhash64(*df.columns), own["n"]).cast("int")
            out = writer_of(df.repartitionById(at, slot)).option("maxRecordsPerFile", int(per_file * SLACK) + 1)
    if dynamic:
        out = out.option("partitionOverwriteMode", "dynamic")
    out.parquet(path)
    return plan


def small_dates(files: dict, target: int = TARGET_FILE_BYTES) -> list:
    """Partition values with several files whose mean size is well below the target."""
    return [v for v, f in files.items() if f.files > 1 and f.bytes / f.files < SMALL * target]


def compact_dates(spark: SparkSession, path: str, part_col: str, target: int = TARGET_FILE_BYTES, schema=None) -> list:
    """Rewrites in place the partition values of a batch-written table that have small files; returns them.

    All other values keep their files. The new files are written beside the
    table first and then replace the old ones value by value, so a failure
    before that leaves the table as it was; a rerun after one in between finds
    what is still small. Tables under a streaming file sink name their files in a log
    and must be compacted into a new path (:func:`..operators.maintenance.compact`).
    """
    from ..session import materialize

    files = files_by(spark, path, part_col, schema)
    small = small_dates(files, target)
    if small:
        table = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
        chosen = F.col(part_col).isin([v for v in small if v is not None])
        rows = materialize(table.where(chosen | F.col(part_col).isNull() if None in small else chosen), "compact")
        write_sized(rows, path, part_col, bytes_per_row({v: files[v] for v in small}), {v: files[v].rows for v in small},
                    target, mode="overwrite", dynamic=True)
    return small
