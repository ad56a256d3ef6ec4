"""Structured Streaming ingest: raw JSON stream -> bronze and silver.

:func:`run_medallion` is one streaming query that reads and parses the source
once and feeds both tables: each micro-batch is written under its own number
in both and published by one commit record, so it is there in both or in
none, and once. :func:`start_layer` runs a single layer as an append-only file
sink (exactly-once through its own log). Restarting a query on its checkpoint
resumes from the stored offsets; :func:`rebuild` starts over from the
earliest offset into a new path with a new checkpoint.

A Kafka topic is the production source (the connector is not bundled here);
a directory of text files with one JSON message per line drives the same
functions in tests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.schemas import BRONZE, SILVER
from ..operators import lenient, states
from ..operators.gold import hourly_rollup, write_gold
from ..operators.ingest import decode_trip_json, flatten_bronze, flatten_silver
from ..session import scratch_path
from ..sources import sizing
from ..sources.tables import delete_path, path_exists

# Topic and consumer settings of the stream job.
TOPIC = "raw.trip.events"
STARTING_OFFSETS = "earliest"
CHECKPOINT_INTERVAL = "60 seconds"


def read_trip_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                     bootstrap_servers: str | None = None, topic: str = TOPIC,
                     starting_offsets: str = STARTING_OFFSETS,
                     max_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Streaming ``DataFrame[value STRING]`` of raw messages.

    ``source='kafka'`` subscribes to the topic (offsets live in the query
    checkpoint, so a restart resumes where it stopped). Offsets that the topic
    no longer holds stop the query; ``fail_on_data_loss=False`` skips them
    and loses those messages. ``source='text'`` reads new files of ``path``
    (one message per line).
    """
    if source == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers or "")
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if source == "text":
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.load(path)
    raise ValueError(f"unknown stream source {source!r}")


def bronze_stream(raw: DataFrame) -> DataFrame:
    """ingested_at is the micro-batch time (current_timestamp per batch)."""
    return flatten_bronze(decode_trip_json(raw))


def silver_stream(raw: DataFrame) -> DataFrame:
    return flatten_silver(decode_trip_json(raw))


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_layer(df: DataFrame, path: str, checkpoint: str, trigger: str | None = CHECKPOINT_INTERVAL,
                name: str | None = None, partition_col: str = "event_date") -> StreamingQuery:
    """Append ``df`` to a date-partitioned Parquet path (snappy)."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .option("compression", "snappy").partitionBy(partition_col))
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


@dataclass
class MedallionPaths:
    bronze: str
    silver: str
    bronze_checkpoint: str
    silver_checkpoint: str
    checkpoint: str
    commits: str

    @classmethod
    def under(cls, root: str) -> MedallionPaths:
        root = root.rstrip("/")
        return cls(f"{root}/bronze/trips", f"{root}/silver/trips",
                   f"{root}/_checkpoints/bronze", f"{root}/_checkpoints/silver",
                   f"{root}/_checkpoints/medallion", f"{root}/commits")


COMMITS = T.StructType([T.StructField("layer", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("files", T.LongType()),
                        T.StructField("bytes", T.LongType()), T.StructField("row_bytes", T.DoubleType()), T.StructField("batch", T.LongType())])


def commits(spark: SparkSession, paths: MedallionPaths) -> DataFrame:
    """One row per layer and published batch: rows, files and bytes."""
    if not path_exists(spark, paths.commits):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).parquet(paths.commits)


def read_layer(spark: SparkSession, paths: MedallionPaths, layer: str) -> DataFrame:
    """The published rows of a layer. A batch begins only after the one before it was published, so the
    highest published number tells which partitions count; a batch whose writer died between the two tables is
    left out without opening its files."""
    path, schema = {"bronze": (paths.bronze, BRONZE), "silver": (paths.silver, SILVER)}[layer]
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    last = commits(spark, paths).agg(F.max("batch")).head()[0]
    if last is None or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(full).parquet(path).where(F.col("batch") <= last).drop("batch")


def write_batch(messages: DataFrame, batch_id: int, paths: MedallionPaths, target: int = sizing.TARGET_FILE_BYTES) -> None:
    """Writes one micro-batch of raw messages into both layers and publishes it.

    The messages are read and parsed once and held while both layers are
    written, each under the batch's own partition, which a rerun replaces. The
    commit record comes last: it publishes both at once, and a batch that has
    one is left alone. File sizes follow the bytes per row of the batch published last.
    """
    spark = messages.sparkSession
    if path_exists(spark, f"{paths.commits}/batch={batch_id}/_SUCCESS"):
        return
    row_bytes = {}
    if path_exists(spark, f"{paths.commits}/batch={batch_id - 1}/_SUCCESS"):  # one record, however long the history
        row_bytes = {r["layer"]: r["row_bytes"] for r in spark.read.schema(COMMITS).parquet(f"{paths.commits}/batch={batch_id - 1}").collect()}
    trips = lenient.flat_trips(lenient.parse_trips(messages)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        record = []
        for layer, path, rows in (("bronze", paths.bronze, lenient.bronze_of(trips)), ("silver", paths.silver, lenient.silver_of(trips))):
            own = f"{path}/batch={batch_id}"
            counts = sizing.rows_by(rows, "event_date")
            if counts:
                sizing.write_sized(rows, own, "event_date", row_bytes.get(layer), counts, target, mode="overwrite")
                written = sizing.files_by(spark, own, "event_date", BRONZE if layer == "bronze" else SILVER)
                record.append((layer, sum(f.rows for f in written.values()), sum(f.files for f in written.values()),
                               sum(f.bytes for f in written.values()), sizing.bytes_per_row(written)))
            else:
                delete_path(spark, own)  # what a lost attempt may have left
                record.append((layer, 0, 0, 0, row_bytes.get(layer)))
        schema = T.StructType(COMMITS.fields[:-1])
        spark.createDataFrame(record, schema).coalesce(1).write.mode("overwrite").parquet(f"{paths.commits}/batch={batch_id}")
    finally:
        trips.unpersist()


def run_medallion(raw_factory, paths: MedallionPaths, trigger: str | None = CHECKPOINT_INTERVAL,
                  target: int = sizing.TARGET_FILE_BYTES) -> tuple[StreamingQuery, StreamingQuery]:
    """Starts the one query that feeds both layers from one read of ``raw_factory()`` (returned for either layer).

    Restarted on its checkpoint it goes on where it stopped; a batch that was
    cut off is run again under the same number and published once."""
    def both(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, paths, target)

    writer = raw_factory().writeStream.queryName("medallion_trips").option("checkpointLocation", paths.checkpoint).foreachBatch(both)
    query = _trigger(writer, trigger).start()
    return query, query


def rebuild(spark: SparkSession, raw_factory, root: str | None = None,
            trigger: str | None = CHECKPOINT_INTERVAL) -> tuple[MedallionPaths, tuple[StreamingQuery, StreamingQuery]]:
    """Full replay: new output paths and new checkpoints (the source factory
    should start from the earliest offset). Old paths are left untouched."""
    paths = MedallionPaths.under(root or scratch_path(spark, "medallion"))
    return paths, run_medallion(raw_factory, paths, trigger)


def await_all(*queries: StreamingQuery, timeout_s: float | None = None) -> None:
    for q in queries:
        q.awaitTermination(timeout_s)
        if q.exception():
            raise q.exception()


def hourly_gold_stream(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str,
                       trigger: str | None = CHECKPOINT_INTERVAL, now=None, state_path: str | None = None) -> StreamingQuery:
    """Keeps gold up to date with a growing silver table.

    Each micro-batch only tells which dates got new rows; these dates are
    rolled up again from the silver table and replaced in gold. So late rows
    count however late they are, distinct drivers are exact, every hour is
    there, and a batch that is run twice leaves the same rows. What reaches
    the driver is the dates of one batch.

    With ``state_path`` a batch is absorbed into mergeable states
    (:mod:`..operators.states`) and its dates come from these: silver rows are
    read once, in their own batch.
    """
    new_rows = spark.readStream.schema(SILVER).parquet(silver_path)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        dates = [r[0] for r in batch.select("event_date").where("event_date is not null").distinct().collect()]
        if dates and state_path:
            states.absorb(batch, batch_id, state_path)
            gold = states.gold_from_states(batch.sparkSession, state_path, now, dates)
            write_gold(gold, gold_path, covered=F.col("report_date").isin(dates))
        elif dates:
            rows = batch.sparkSession.read.schema(SILVER).parquet(silver_path).filter(F.col("event_date").isin(dates))
            write_gold(hourly_rollup(rows, now), gold_path, covered=F.col("report_date").isin(dates))

    return _trigger(new_rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(refresh), trigger).start()
