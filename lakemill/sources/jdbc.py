"""Database extracts. Connection settings come from the caller, never from code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakemill.config import SourceConfig
from lakemill.operators.conform import require
from lakemill.operators.lineage import with_extract_lineage

FETCH_SIZE = 1000


def jdbc_options(
    url: str,
    query: str | None = None,
    dbtable: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    **options: str | None,
) -> dict[str, str]:
    """Reader options. ``partition`` = (column, lower, upper, parts) reads in
    parallel; Spark allows it with a table, so a query becomes a subquery."""
    if not query and not dbtable:
        raise ValueError("give a query or a table")
    settings = {"url": url, "fetchsize": str(FETCH_SIZE)}
    settings |= {k: v for k, v in options.items() if v}
    if partition:
        column, lower, upper, parts = partition
        settings["dbtable"] = f"({query}) extract" if query else str(dbtable)
        settings |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    elif query:
        settings["query"] = query
    else:
        settings["dbtable"] = str(dbtable)
    return settings


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    dbtable: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    options: Mapping[str, str | None] | None = None,
) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, dbtable, partition, **(options or {}))).load()


def extract_source(df: DataFrame, source: SourceConfig) -> DataFrame:
    """Raw rows of a source with their lineage; its key column must be there."""
    require(df, [source.primary_key], f"extract of {source.name}")
    return with_extract_lineage(df, source.schema, source.name)


def load_source(spark: SparkSession, url: str, source: SourceConfig, **settings) -> DataFrame:
    table = None if source.query else source.table
    return extract_source(read_jdbc(spark, url, source.query, table, **settings), source)
