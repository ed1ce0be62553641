"""One broker message → state → histogram, when the histogram is due."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from lakemill.operators.events import ROW_FIELDS, ROW_SCHEMA, STREAM_EVENT, normalize_rows, packed_rows
from lakemill.operators.histograms import ceil_histogram, histogram_document
from lakemill.sources.inbox import load_manifest
from lakemill.streaming.events import BATCH, ROW_STATE, append_state, apply_batch, read_state

FILE_STATE = "file_event_id string, source_path string, content_sha256 string"
FEATURE = "fare_amount"


@dataclass(frozen=True)
class Summary:
    """What a message changed."""

    mode: str
    event_id: str | None
    duplicate: bool
    applied_row_count: int
    total_row_count_after: int | None
    should_calculate: bool
    source_path: str | None = None


def store_path(path: str) -> str:
    """An address as Spark's readers know it."""
    return f"s3a://{path[len('s3://') :]}" if path.startswith("s3://") else path


def next_batch(spark: SparkSession, path: str, schema: str) -> int:
    last = read_state(spark, path, schema).agg(F.max(BATCH)).first()[0]
    return 0 if last is None else last + 1


def ingest_file_message(spark: SparkSession, message: Row, path: str, outputs_ready: bool) -> Summary:
    """Remember the file behind a message; a known content hash is a duplicate."""
    meta = message.metadata
    if not meta.source_path:
        raise ValueError("a file message needs metadata.source_path")
    file_id = meta.file_event_id or message.event_id
    state = f"{path}/files"
    known = read_state(spark, state, FILE_STATE).filter(F.col("file_event_id") == file_id)
    duplicate = not known.isEmpty()
    if not duplicate:
        row = spark.createDataFrame([(file_id, meta.source_path, meta.content_sha256)], FILE_STATE)
        append_state(row, state, next_batch(spark, state, FILE_STATE))
    return Summary(
        "file", message.event_id, duplicate, 0, None, not duplicate or not outputs_ready, store_path(meta.source_path)
    )


def message_rows(spark: SparkSession, message: Row) -> DataFrame:
    """Normalised rows a message stands for: its own row, or a chunked file."""
    meta = message.metadata
    if message.message_type == "row":
        source = (meta.source_name or meta.source_basename if meta else None) or "source"
        rows = spark.createDataFrame([tuple(message.row or (None,) * 6)], f"{ROW_SCHEMA}, extra string").withColumn("i", F.lit(1).cast("bigint"))
    elif message.message_type == "row_batch":
        source = meta.source_name or "source"
        folder, _, replay = meta.chunk_prefix.rstrip("/").rpartition("/")
        found = load_manifest(spark, folder, replay).drop("chunk_index").withColumnRenamed("source_row_index", "i")
        texts = found.withColumns({c: F.col(c).cast("string") for c in ROW_FIELDS if c in found.columns})
        rows = packed_rows(texts, keep=("i",))
    else:
        raise ValueError(f"Unsupported message_type: {message.message_type}")
    named = normalize_rows(rows, F.lit(source), "i", STREAM_EVENT).drop("i")
    return named.withColumn(FEATURE, F.col(FEATURE).try_cast("double"))


def ingest_row_message(spark: SparkSession, message: Row, path: str, outputs_ready: bool) -> Summary:
    """Add the rows of a message that the state does not hold yet."""
    state = f"{path}/rows"
    batch = next_batch(spark, state, ROW_STATE)
    applied = apply_batch(message_rows(spark, message), batch, state, missing="keep").count()
    total = read_state(spark, state, ROW_STATE).count()
    return Summary("row", message.event_id, applied == 0, applied, total, applied > 0 or not outputs_ready)


def calculate(spark: SparkSession, summary: Summary, path: str, relative_error: float = 0.02) -> DataFrame:
    """Histogram document of the file or the state a summary belongs to."""
    if summary.mode == "file":
        values = spark.read.parquet(summary.source_path).select(F.col(FEATURE).try_cast("double").alias(FEATURE))
    else:
        values = read_state(spark, f"{path}/rows", ROW_STATE).select(FEATURE)
    values = values.filter(F.col(FEATURE).isNotNull())
    buckets = ceil_histogram(values, FEATURE, relative_error=relative_error)
    return histogram_document(buckets, values.count(), FEATURE, summary.mode)


def process_message(
    spark: SparkSession, message: Row, path: str, outputs_ready: bool = False, relative_error: float = 0.02
) -> tuple[Summary, DataFrame | None]:
    """Ingest one parsed message and, when due, make the histogram.

    Messages are control records handled one after another; the data they point
    to is read, compared and counted by Spark.
    """
    ingest = ingest_file_message if message.message_type == "file" else ingest_row_message
    summary = ingest(spark, message, path, outputs_ready)
    return summary, calculate(spark, summary, path, relative_error) if summary.should_calculate else None
