"""File requests and the ledgers that make ingest repeatable."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemill.config import Registry
from lakemill.functions.values import file_extension, file_name, url_file_name
from lakemill.operators.dedupe import dedupe, not_in

# Ledger columns, file types and status words.
RAW_LEDGER = (
    "job_id string, domain string, topic string, source_type string, source_name string, source_uri string, "
    "bucket string, object_key string, file_name string, file_type string, file_size_bytes bigint, "
    "ingest_ts timestamp, status string, error_message string"
)
BRONZE_LEDGER = (
    "job_id string, domain string, topic string, source_name string, source_uri string, raw_bucket string, "
    "raw_object_key string, bronze_bucket string, bronze_object_key string, file_name string, file_type string, "
    "bronze_format string, status string, error_message string, processed_ts timestamp"
)
FILE_TYPES = ("json", "csv", "xml", "parquet")
REQUEST_EVENT = "raw_ingest_request"
REQUEST_KEY = ("domain", "topic", "source_name", "source_uri", "file_name")
# Raw ledger column → bronze ledger column of the same file.
FILE_KEY = {
    "domain": "domain",
    "topic": "topic",
    "source_name": "source_name",
    "source_uri": "source_uri",
    "bucket": "raw_bucket",
    "object_key": "raw_object_key",
    "file_name": "file_name",
}


def _filled(column: str, default: str):
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))


def plan_requests(sources: DataFrame, registry: Registry, strict: bool = True) -> DataFrame:
    """One ingest request per source file.

    An unregistered domain stops the job when ``strict``; otherwise the request
    is kept and fails when it is resolved.
    """
    spark = sources.sparkSession
    name = file_name(F.col("source_uri"))
    requests = sources.select(
        F.lit(REQUEST_EVENT).alias("event_type"),
        F.uuid().alias("job_id"),
        "source_type",
        "source_uri",
        "source_name",
        _filled("domain", registry.default_domain).alias("domain"),
        _filled("topic", registry.default_topic).alias("topic"),
        name.alias("file_name"),
        file_extension(name).alias("file_type"),
        F.current_timestamp().alias("requested_at"),
        F.lit("requested").alias("status"),
    )
    if not strict:
        return requests
    known = registry.frame(spark).select("domain", F.lit(True).alias("_known"))
    unknown = F.raise_error(F.concat(F.lit("Domain '"), F.col("domain"), F.lit("' is not registered")))
    checked = F.when(F.col("_known"), F.col("status")).otherwise(unknown.cast("string"))
    return requests.join(known, "domain", "left").select(
        *[checked.alias(c) if c == "status" else F.col(c) for c in requests.columns]
    )


def new_requests(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """First request of each file that has not landed yet."""
    known = ledger.filter(F.col("status") == "landed")
    return not_in(dedupe(requests, REQUEST_KEY), known, {c: c for c in REQUEST_KEY}, distinct=True)


def fill_request(requests: DataFrame, registry: Registry) -> DataFrame:
    """Defaults of a request message that leaves fields out."""
    name = F.coalesce(F.nullif(F.col("file_name"), F.lit("")), url_file_name(F.col("source_uri")))
    filled = requests.withColumns(
        {
            "source_name": _filled("source_name", "unknown_source"),
            "domain": _filled("domain", registry.default_domain),
            "topic": _filled("topic", registry.default_topic),
            "file_name": name,
        }
    )
    kind = F.coalesce(F.nullif(F.col("file_type"), F.lit("")), file_extension(F.col("file_name")))
    return filled.withColumn("file_type", kind)


def resolve(requests: DataFrame, registry: Registry) -> DataFrame:
    """Raw ledger rows of requests: place in the raw layer, or the error."""
    settings = registry.frame(requests.sparkSession)
    known = F.col("raw_bucket").isNotNull()
    message = F.concat(F.lit("Domain '"), F.col("domain"), F.lit("' is not registered"))
    size = F.col("file_size_bytes") if "file_size_bytes" in requests.columns else F.lit(None)
    return (
        fill_request(requests, registry)
        .join(settings, "domain", "left")
        .select(
            "job_id",
            "domain",
            "topic",
            "source_type",
            "source_name",
            "source_uri",
            F.col("raw_bucket").alias("bucket"),
            F.concat("raw_prefix", F.lit("/"), "file_name").alias("object_key"),
            "file_name",
            "file_type",
            F.when(known, size).cast("bigint").alias("file_size_bytes"),
            F.current_timestamp().alias("ingest_ts"),
            F.when(known, "landed").otherwise("error").alias("status"),
            F.when(~known, message).alias("error_message"),
        )
    )


def landed(ledger: DataFrame) -> DataFrame:
    """Files in the raw layer of a type that can be read."""
    return ledger.filter((F.col("status") == "landed") & F.col("file_type").isin(*FILE_TYPES))


def succeeded(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status") == "success")


def unprocessed(raw: DataFrame, bronze: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Landed files without a bronze success; failed ones are tried again.

    With ``max_attempts`` a file that failed that often is given up.
    """
    open_files = not_in(landed(raw), succeeded(bronze), FILE_KEY)
    if max_attempts is None:
        return open_files
    spent = (
        bronze.filter(F.col("status") == "error")
        .groupBy(*FILE_KEY.values())
        .agg(F.count(F.lit(1)).alias("attempts"))
        .filter(F.col("attempts") >= max_attempts)
    )
    return not_in(open_files, spent, FILE_KEY)


def step_metrics(raw: DataFrame, candidates: DataFrame, results: DataFrame) -> DataFrame:
    """Counts of one bronze step in one row: input, candidates, outcomes, skipped."""
    parts = [
        raw.select(F.lit("input").alias("kind")),
        candidates.select(F.lit("candidate").alias("kind")),
        results.select(F.col("status").alias("kind")),
    ]
    kinds = parts[0].union(parts[1]).union(parts[2])
    count = lambda kind: F.count_if(F.col("kind") == kind)
    return kinds.agg(
        count("input").alias("input_count"),
        count("candidate").alias("candidate_count"),
        (count("success") + count("error")).alias("processed_count"),
        count("success").alias("success_count"),
        count("error").alias("error_count"),
        (count("input") - count("candidate")).alias("skipped_count"),
    )
