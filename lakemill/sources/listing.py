"""File listings, families, schemas and the file catalog."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.config import FAMILY_PREFIXES
from lakemill.functions.values import file_extension, file_name
from lakemill.operators.dedupe import not_in

# Media class of each file extension.
MEDIA_CLASSES = {
    "structured": ("csv", "json", "jsonl", "xml", "parquet", "avro", "orc", "tsv", "xlsx"),
    "images": ("jpg", "jpeg", "png", "gif", "bmp", "tif", "tiff", "webp", "svg"),
    "audio": ("mp3", "wav", "flac", "aac", "ogg", "m4a"),
    "video": ("mp4", "avi", "mov", "mkv", "webm", "mpeg"),
}
# MIME types of structured data beside the image/, audio/ and video/ trees.
STRUCTURED_MIME = r"^(text/csv|text/xml|application/(json|xml|x-ndjson|vnd\.apache\.parquet|avro))\b"

CATALOG_SCHEMA = (
    "dataset_id string, file_name string, source string, format string, ingestion_time timestamp, "
    "domain string, storage_path string, schema_json string, size bigint"
)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Path, size and time of the files matching a glob; no match gives no rows.

    Only the listing is used; file contents are not read.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.globStatus(hadoop):
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    return found.select("path", "length", "modificationTime")


def sorted_paths(files: DataFrame) -> DataFrame:
    return files.orderBy("path")


def classify_family(name: Column, prefixes: Mapping[str, str] = FAMILY_PREFIXES) -> Column:
    """Dataset family of a file name; the longest matching prefix wins."""
    family = F.lit("other")
    for key, prefix in sorted(prefixes.items(), key=lambda item: len(item[1])):
        family = F.when(F.lower(name).startswith(prefix), key).otherwise(family)
    return family


def classify_mime(mime: Column, name: Column) -> Column:
    """structured / images / audio / video / other, by MIME type, else extension."""
    kind = F.lower(mime)
    by_mime = (
        F.when(kind.startswith("image/"), "images")
        .when(kind.startswith("audio/"), "audio")
        .when(kind.startswith("video/"), "video")
        .when(kind.rlike(STRUCTURED_MIME), "structured")
    )
    extension = file_extension(name)
    by_name = F.lit("other")
    for media, extensions in MEDIA_CLASSES.items():
        by_name = F.when(extension.isin(*extensions), media).otherwise(by_name)
    return F.coalesce(by_mime, by_name)


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Schema of each Parquet file from its footer; a bad file gives its error."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        schemas, errors = [], []
        for path in batch["path"]:
            try:
                system, location = fs.FileSystem.from_uri(path)
                schema = pq.read_schema(location, filesystem=system)
                schemas.append(json.dumps([{"name": f.name, "type": str(f.type)} for f in schema]))
                errors.append(None)
            except Exception as error:  # one unreadable file must not stop the job
                schemas.append(None)
                errors.append(str(error))
        yield batch.assign(schema_json=schemas, read_error=errors)


def file_schemas(files: DataFrame) -> DataFrame:
    """Add schema and read error to a listing; footers are read on the executors."""
    # Opening footers is slow per file, so small listings are spread out too.
    spread = files.select("path", "length", "modificationTime").repartition("path")
    schema = "path string, length bigint, modificationTime timestamp, schema_json string, read_error string"
    return spread.mapInPandas(_footers, schema)


def schema_inventory(files: DataFrame) -> DataFrame:
    """Per family: distinct schemas, how many files have each, one example."""
    found = file_schemas(files).withColumn("family", classify_family(file_name(F.col("path"))))
    body = F.coalesce("schema_json", F.to_json(F.struct("read_error")))
    return (
        found.withColumn("signature", F.sha2(body, 256))
        .groupBy("family", "signature")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.min("path").alias("sample_file"),
            F.min("schema_json").alias("schema_json"),
            F.min("read_error").alias("read_error"),
        )
    )


def unreadable_files(files: DataFrame) -> DataFrame:
    """(path, read_error) of the listed files without a readable footer, for the ledger."""
    return file_schemas(files).filter(F.col("schema_json").isNull()).select("path", "read_error")


def frames_by_schema(spark: SparkSession, pattern: str, skip_unreadable: bool = False) -> list[DataFrame]:
    """Bronze files of a glob as one frame per distinct schema."""
    return frames_of(list_files(spark, pattern), skip_unreadable)


def frames_of(files: DataFrame, skip_unreadable: bool = False) -> list[DataFrame]:
    """Listed Parquet files as one frame per distinct schema.

    Files are grouped by the schema in their footers first, so ten thousand
    files of two layouts make two reads, not ten thousand. A file that can't be
    read stops the run with its error; with ``skip_unreadable`` the caller has
    recorded such files (``unreadable_files``) and goes on without them.
    """
    spark = files.sparkSession
    found = file_schemas(files).select("schema_json", "path", "read_error")
    groups: dict[str, list[str]] = {}
    broken = []
    # Spark keeps the list of input files on the driver in any case; it comes in sorted blocks.
    for row in found.orderBy("schema_json", "path").toLocalIterator():
        if row.schema_json is None:
            broken.append(f"{row.path}: {row.read_error}")
        else:
            groups.setdefault(row.schema_json, []).append(row.path)
    if broken and not skip_unreadable:
        raise ValueError(f"{len(broken)} unreadable file(s): " + "; ".join(broken))
    return [spark.read.parquet(*paths) for paths in groups.values()]


def sample_schema(spark: SparkSession, pattern: str, files: int = 2, rows: int = 5) -> DataFrame:
    """Schema and first rows of the first files of a pattern, as JSON rows."""
    first = [r.path for r in list_files(spark, pattern).orderBy("path").limit(files).collect()]
    parts = []
    for path in first:
        df = spark.read.parquet(path)
        parts.append(
            df.limit(rows).select(
                F.lit(path).alias("path"), F.lit(df.schema.json()).alias("schema_json"), F.to_json(F.struct("*")).alias("row")
            )
        )
    if not parts:
        return spark.createDataFrame([], "path string, schema_json string, row string")
    return reduce(DataFrame.union, parts)


def catalog_files(files: DataFrame, existing: DataFrame | None = None, source: str = "files") -> DataFrame:
    """One catalog row per file; files already in the catalog are left out."""
    path = F.col("path")
    rows = file_schemas(files).select(
        F.sha2(path, 256).alias("dataset_id"),
        file_name(path).alias("file_name"),
        F.lit(source).alias("source"),
        file_extension(file_name(path)).alias("format"),
        F.col("modificationTime").alias("ingestion_time"),
        F.lit(None).cast("string").alias("domain"),
        path.alias("storage_path"),
        "schema_json",
        F.col("length").alias("size"),
    )
    return rows if existing is None else not_in(rows, existing, {"dataset_id": "dataset_id"}, distinct=True)


def assign_domain(
    files: DataFrame, rules: Sequence[tuple[int, str, str]], default: str = "unassigned"
) -> DataFrame:
    """Give every file without a domain exactly one, by the first matching rule.

    ``rules`` are (priority, pattern of the lower-case name, domain). They become
    one expression, so no join multiplies the files.
    """
    chosen = F.lit(default)
    for _, pattern, domain in sorted(rules, reverse=True):
        chosen = F.when(F.lower("file_name").rlike(pattern), domain).otherwise(chosen)
    return files.withColumn("domain", F.coalesce("domain", chosen))
