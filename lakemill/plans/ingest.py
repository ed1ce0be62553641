"""Raw → bronze: read each landed file, keep going when one fails."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from hashlib import sha256
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession

from lakemill.config import Registry
from lakemill.operators.ledger import BRONZE_LEDGER, RAW_LEDGER, resolve
from lakemill.sinks.files import copy_file
from lakemill.sinks.tables import to_bronze
from lakemill.sources.readers import read_any

LEDGER_BLOCK = 1_000


def bronze_key(prefix: str, row: Row) -> str:
    """Folder of a file below its domain, topic and source.

    The extension stays, so a.csv and a.json differ; a hash of the address tells
    files of one name and source apart.
    """
    address = sha256(f"{row.source_uri}\n{row.bucket}\n{row.object_key}".encode()).hexdigest()[:16]
    return f"{prefix}/{row.domain}/{row.topic}/{row.source_name}/{address}/{row.file_name}.parquet"


def land_file(spark: SparkSession, row: Row, root: str) -> tuple:
    """Copy the bytes of one request to its place; a failure becomes its ledger row."""
    status, message = row.status, row.error_message
    if status == "landed":
        try:
            copy_file(spark, row.source_uri, f"{root}/{row.bucket}/{row.object_key}")
        except Exception as error:  # any file system error is a fact about the file
            status, message = "error", str(error)
    return (*row[:-2], status, message)


def land_requests(
    spark: SparkSession, requests: DataFrame, registry: Registry, root: str, ledger_path: str, parallel: int = 8
) -> None:
    """Land every request whose address a Hadoop file system reads, then note it in the raw ledger.

    A ledger row says ``landed`` only after its bytes are in place; web
    addresses and other failures are noted as errors and tried again later.
    """
    rows = resolve(requests, registry).toLocalIterator()
    with ThreadPoolExecutor(parallel) as pool:
        for block in blocks(rows, LEDGER_BLOCK):
            done = list(pool.map(lambda r: land_file(spark, r, root), block))
            spark.createDataFrame(done, RAW_LEDGER).write.mode("append").parquet(ledger_path)


def ingest_file(spark: SparkSession, row: Row, root: str, bronze_prefix: str, error_prefix: str) -> tuple:
    """Read and write one file; a failure becomes its ledger row."""
    raw = f"{root}/{row.bucket}/{row.object_key}"
    key = bronze_key(bronze_prefix, row)
    status, message = "success", None
    try:
        to_bronze(read_any(spark, raw, row.file_type, require_rows=True), f"{root}/bronze/{key}")
    except Exception as error:  # any reader error is a fact about the file
        status, message = "error", str(error)
        try:
            copy_file(spark, raw, f"{root}/{error_prefix}/{bronze_key('', row).strip('/').removesuffix('.parquet')}")
        except Exception as second:
            message = f"{message} | copy failed: {second}"
    return (
        row.job_id, row.domain, row.topic, row.source_name, row.source_uri, row.bucket, row.object_key, "bronze", key,
        row.file_name, row.file_type, "parquet", status, message, datetime.now(timezone.utc),
    )


def blocks(rows: Iterable[Row], size: int) -> Iterator[list[Row]]:
    rows = iter(rows)
    while block := list(islice(rows, size)):
        yield block


def ingest_files(
    spark: SparkSession,
    candidates: DataFrame,
    root: str,
    ledger_path: str,
    bronze_prefix: str = "lakehouse",
    error_prefix: str = "error",
    parallel: int = 8,
) -> None:
    """Bring every candidate file to bronze and append the outcome to the ledger.

    A file is the unit of failure, so each one is its own distributed read and
    write; several run at once. The list is streamed to the driver in blocks and
    the ledger is appended after each, so a lost driver repeats one block only.
    """
    with ThreadPoolExecutor(parallel) as pool:
        for block in blocks(candidates.toLocalIterator(), LEDGER_BLOCK):
            done = pool.map(lambda r: ingest_file(spark, r, root, bronze_prefix, error_prefix), block)
            spark.createDataFrame(list(done), BRONZE_LEDGER).write.mode("append").parquet(ledger_path)
