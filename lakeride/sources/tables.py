"""Batch table I/O: scans, layer writers, table creation.

Tables are path-based Parquet partitioned by date (bronze/silver by
event_date, gold by report_date). Streaming file sinks keep a commit log
(``_spark_metadata``) that batch reads honour, so only committed files are
seen; files under such a path must never be rewritten in place (compaction
writes a new path, see operators.maintenance).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import BRONZE, GOLD, PARTITION_COLUMN, SILVER

LAYER_SCHEMA = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the cluster has cores.

    Decided at planning time from the file splits (no job runs): a large
    input already has thousands of splits and is returned unchanged, a
    single-row-group file is spread so row-wise work (JSON, regex) uses all
    cores. No key is involved, so no skew can arise.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def balanced_by(df: DataFrame, col: str, salt_buckets: int = 16) -> DataFrame:
    """Shuffle for a write partitioned by ``col`` without funnelling a hot
    value through one task.

    With AQE on (the default) the REBALANCE hint lets Spark split large
    partitions and merge small ones at run time. Without AQE the hint would
    be a plain hash shuffle on ``col``, so a deterministic salt (a hash of
    the whole row, stable across task retries) spreads each value over up
    to ``salt_buckets`` tasks instead.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", col)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    return df.repartition(col, salt)


def scan_table(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """Read a layer; raises AnalysisException if the table does not exist,
    before anything is written downstream."""
    reader = spark.read
    if layer in LAYER_SCHEMA:
        reader = reader.schema(LAYER_SCHEMA[layer])
    return reader.parquet(path)


REPLACED = "_REPLACED"  # readers skip names that start with an underscore


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a folder in any file system that Spark can write to."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def mark_replaced(spark: SparkSession, path: str) -> None:
    """Notes in the table's folder that rows were overwritten, so it holds no full history."""
    fs, p = _hadoop(spark, f"{path}/{REPLACED}")
    fs.create(p, True).close()


def write_layer(df: DataFrame, path: str, layer: str, mode: str = "append",
                max_records_per_file: int | None = None) -> None:
    """Batch write of bronze/silver/gold partitioned by its date column.

    ``mode='replace'`` overwrites only the dates present (dynamic partition
    overwrite). REBALANCE on the partition column lets AQE size the files
    (split a hot date, merge small ones) without a fixed partition count.
    """
    part = PARTITION_COLUMN[layer]
    w = balanced_by(df, part).write.partitionBy(part).option("compression", "snappy")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if mode == "replace":
        mark_replaced(df.sparkSession, path)  # it holds no full history from now on
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        w.mode(mode).parquet(path)


def create_tables(spark: SparkSession, paths: dict[str, str], drop_existing: bool = False) -> None:
    """CREATE TABLE ... USING parquet PARTITIONED BY for each layer path.

    ``drop_existing`` mirrors the drop-then-recreate of a full rebuild:
    the catalog entry goes, the files stay (external tables)."""
    for layer, path in paths.items():
        name = f"{layer}_trips" if layer != "gold" else "gold_trips_hourly"
        if drop_existing:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LAYER_SCHEMA[layer].fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                  f"PARTITIONED BY ({PARTITION_COLUMN[layer]}) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {name}")  # dates that are there already
