"""Columns that say where a row came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Metadata columns of a database extract.
EXTRACT_COLUMNS = ("_source_schema", "_source_table", "_ingested_at")


def with_lineage(df: DataFrame, domain: str, dataset: str) -> DataFrame:
    return df.withColumns(
        {"domain": F.lit(domain), "dataset": F.lit(dataset), "silver_processed_ts": F.current_timestamp()}
    )


def with_extract_lineage(df: DataFrame, schema: str, table: str) -> DataFrame:
    values = (F.lit(schema), F.lit(table), F.current_timestamp())
    return df.withColumns(dict(zip(EXTRACT_COLUMNS, values)))


def metadata_last(df: DataFrame, metadata: tuple[str, ...] = EXTRACT_COLUMNS) -> DataFrame:
    """Source columns first, then the metadata columns that exist."""
    own = [c for c in df.columns if c not in metadata]
    return df.select(*own, *[c for c in metadata if c in df.columns])
