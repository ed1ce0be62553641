"""Event ingest as Structured Streaming over landed JSON lines.

Every micro-batch goes through the same functions as a batch run. State lives in
Parquet partitions named by the micro-batch, so a repeated batch replaces its
own partition and nothing is applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemill.operators.events import explode_batches, new_batches, new_events, packed_rows, parse_envelope
from lakemill.streaming.ids import append_ids, compact_ids, seen_ids
from lakemill.streaming.summaries import SUMMARY, histogram_of, merged, sketch_size, summarise

BATCH = "_batch_id"


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files landed below a folder, each file once.

    The checkpoint of the query takes the place of consumer group offsets.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def topic_stream(spark: SparkSession, servers: str, topic: str, max_messages: int | None = None) -> DataFrame:
    """Message bodies of a Kafka topic; needs the Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "earliest")
    if max_messages:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_state(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """State rows of earlier batches; an absent state is empty."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = f"{schema}, {BATCH} bigint"
    if not fs.exists(hadoop):
        return spark.createDataFrame([], full)
    state = spark.read.schema(full).parquet(path)
    return state if before is None else state.filter(F.col(BATCH) < before)


def append_state(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch partition; writing it again replaces it."""
    rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(BATCH).parquet(path)


def replace_state(rows: DataFrame, path: str) -> None:
    """File mode: the file becomes the whole state."""
    rows.withColumn(BATCH, F.lit(0).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(BATCH).parquet(path)


ROW_STATE = "event_id string, trip_id string, fare_amount double, event_time string, event_type string, extra string"
#: Of the message around a row; no part of the row itself.
ENVELOPE_FIELDS = ("message_type", "batch_id")


def state_rows(rows: DataFrame) -> DataFrame:
    """Rows as the state keeps them, whole."""
    kinds = [f.split() for f in ROW_STATE.split(", ")]
    return packed_rows(rows.drop(*ENVELOPE_FIELDS)).select(*[F.col(c).cast(t).alias(c) for c, t in kinds])


def apply_batch(rows: DataFrame, batch_id: int, path: str, missing: str = "drop", order=()) -> DataFrame:
    """Apply the new rows of one batch to the row state and return them.

    Ids are compared with an index beside the rows: of it, a batch reads only
    the buckets its own ids fall into.
    """
    spark, index = rows.sparkSession, f"{path}-ids"
    compact_ids(spark, index, batch_id)
    seen = seen_ids(rows, index, batch_id)
    append_state(state_rows(new_events(rows, seen, order, missing)), path, batch_id)
    applied = batch_rows(spark, path, ROW_STATE, batch_id)
    append_ids(applied, index, batch_id)
    return applied


def batch_rows(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """What one batch wrote; nothing if it had no rows."""
    if batch_id not in batches_of(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch_id}")


def apply_event(
    rows: DataFrame, mode: str, path: str, batch_id: int | None = None, missing: str = "drop", order=()
) -> DataFrame:
    """File messages replace their state, row messages add to theirs.

    A row message given twice under one ``batch_id`` replaces itself; it needs one.
    """
    if mode == "file":
        replace_state(state_rows(rows), f"{path}/file")
        return read_state(rows.sparkSession, f"{path}/file", ROW_STATE).drop(BATCH)
    if mode == "row":
        if batch_id is None:
            raise ValueError("a row message needs a batch id")
        return apply_batch(rows, batch_id, f"{path}/row", missing, order)
    raise ValueError(f"Unsupported mode: {mode}")


def ingest_lines(lines: DataFrame, batch_id: int, path: str) -> DataFrame:
    """One micro-batch: parse, skip known batches, explode, apply new rows."""
    spark = lines.sparkSession
    messages = parse_envelope(lines, ("batch", "row")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        named = messages.filter("message_type = 'batch' AND length(batch_id) > 0")
        named = named.select(F.col("batch_id").alias("event_id")).distinct()
        compact_ids(spark, f"{path}/batches", batch_id)
        seen = seen_ids(named, f"{path}/batches", batch_id)
        fresh = new_batches(messages, seen.select(F.col("event_id").alias("batch_id")))
        applied = apply_batch(explode_batches(fresh), batch_id, f"{path}/rows")
        append_ids(named, f"{path}/batches", batch_id)
    finally:
        messages.unpersist()
    return applied


SNAPSHOT = (
    "bucket int, left_edge double, right_edge double, bin_width double, upper_bound double, max_edge double, cnt bigint"
)


def snapshot(spark: SparkSession, path: str, batch_id: int, applied: DataFrame, relative_error: float = 0.02) -> DataFrame:
    """Histogram of the state after a batch, from mergeable summaries.

    The rows of the batch are summarised and added to the summary of the batch
    before; rows of the state are not read again. Up to 65,535 values bound and
    counts are exact; beyond, ``relative_error`` holds for the ranks of the
    bound, and 0 asks for the largest sketch.
    """
    size = sketch_size(relative_error)
    before = last_of(spark, f"{path}/summaries", SUMMARY, batch_id)
    own = summarise(applied, "fare_amount", size)
    append_state(merged(before.unionByName(own), size).coalesce(1), f"{path}/summaries", batch_id)
    drop_older(spark, f"{path}/summaries", batch_id)
    made = histogram_of(last_of(spark, f"{path}/summaries", SUMMARY, batch_id + 1))
    append_state(made.coalesce(1), f"{path}/snapshots", batch_id)
    return last_snapshot(spark, path, batch_id + 1)


def last_of(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """What the latest of the earlier batches wrote; folder names alone tell which."""
    known = [b for b in batches_of(spark, path) if b < before]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={max(known)}")


def batches_of(spark: SparkSession, path: str) -> list[int]:
    """Micro-batches with a folder below ``path``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    return [int(n.partition("=")[2]) for n in names if n.startswith(f"{BATCH}=")]


def drop_older(spark: SparkSession, path: str, batch_id: int, keep: int = 2) -> None:
    """Remove folders that neither this batch nor a repeat of it needs."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for old in sorted(b for b in batches_of(spark, path) if b < batch_id)[:-keep]:
        folder = fs_path(f"{path}/{BATCH}={old}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def last_snapshot(spark: SparkSession, path: str, before: int) -> DataFrame:
    """The latest snapshot written before a batch."""
    return last_of(spark, f"{path}/snapshots", SNAPSHOT, before)


def stream_histogram(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    relative_error: float = 0.02,
    on_snapshot: Callable[[int, DataFrame], None] | None = None,
) -> StreamingQuery:
    """Ingest landed messages until none is left, with a histogram after each
    micro-batch that changed the state."""

    def handle(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        applied = ingest_lines(lines, batch_id, path)
        if not applied.isEmpty():
            made = snapshot(spark, path, batch_id, applied, relative_error)
            if on_snapshot:
                on_snapshot(batch_id, made)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedupe_stream(rows: DataFrame, time: str = "event_time", horizon: str = "1 day") -> DataFrame:
    """Bounded-state variant: an id is remembered for the horizon only."""
    stamped = rows.withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, horizon).dropDuplicatesWithinWatermark(["event_id"])

