"""Readers of landed files and layer tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

ROW_TAG = "order"
CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, schema: StructType | str | None):
    return spark.read.schema(schema) if schema is not None else spark.read


FORMATS: dict[str, Callable[..., DataFrame]] = {
    "json": lambda r, path, tag: r.option("multiLine", True).json(path),
    "csv": lambda r, path, tag: r.option("header", True).csv(path),
    "xml": lambda r, path, tag: r.format("xml").option("rowTag", tag).load(path),
    "parquet": lambda r, path, tag: r.parquet(*([path] if isinstance(path, str) else path)),
}


def read_any(
    spark: SparkSession,
    path: str | list[str],
    file_type: str,
    row_tag: str = ROW_TAG,
    schema: StructType | str | None = None,
    require_rows: bool = False,
) -> DataFrame:
    """Read JSON documents, CSV with a header (all strings), XML rows or Parquet.

    Give ``schema`` for JSON and XML at scale: without it Spark reads the files
    once more to infer one.
    """
    if file_type not in FORMATS:
        raise ValueError(f"Unsupported file_type: {file_type}")
    df = FORMATS[file_type](_reader(spark, schema), path, row_tag)
    if require_rows and df.isEmpty():
        raise ValueError("Parsed DataFrame is empty")
    return df


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """JSON-lines chunks as one table."""
    return _reader(spark, schema).json(paths if isinstance(paths, str) else list(paths))


def split_corrupt(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Row-level quarantine of JSON lines: parsed rows, and the text of the rest."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.withColumn("p", F.from_json("value", wide, options))
    failed = F.col(f"p.{CORRUPT}").isNotNull()
    return parsed.filter(~failed).select(*[f"p.{f.name}" for f in schema.fields]), parsed.filter(failed).select(
        "value", "file_path"
    )


def table_name(layer: str, namespace: str, name: str) -> str:
    """Layer and namespace form the database of the session catalog."""
    return f"{layer}_{namespace}.{name}"


def read_table(spark: SparkSession, layer: str, namespace: str, name: str) -> DataFrame:
    return spark.read.table(table_name(layer, namespace, name))


def run_if_exists(spark: SparkSession, name: str, job: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Run a job on a table, or skip it when the table is missing."""
    return job(spark.read.table(name)) if spark.catalog.tableExists(name) else None
