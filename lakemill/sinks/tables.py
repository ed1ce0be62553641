"""Writers of layer tables and folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def ensure_table(spark: SparkSession, name: str, schema: StructType | str, path: str | None = None) -> None:
    """Create the database and an empty Parquet table unless they exist."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if not spark.catalog.tableExists(name):
        columns = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        place = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def write_layer(
    df: DataFrame, name: str, mode: str = "replace", path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Replace a whole table with its schema, or append rows to it.

    With ``partition_by`` rows are rebalanced on those columns first: a task
    writes few folders, and a value with many rows is split over several tasks.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode {mode}")
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    if mode == "replace":
        writer.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)
    else:
        writer.mode("append").saveAsTable(name)


def to_bronze(df: DataFrame, path: str) -> None:
    """One folder per raw file; a rerun replaces it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
