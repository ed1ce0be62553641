"""Domains, datasets and database sources a run works on."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# File name prefixes of the trip datasets and their tables.
FAMILY_PREFIXES = {
    "yellow": "yellow_tripdata",
    "green": "green_tripdata",
    "fhv": "fhv_tripdata",
    "fhvhv": "fhvhv_tripdata",
}
SILVER_TABLES = {"yellow": "yellow_taxi", "green": "green_taxi", "fhv": "fhv_trip", "fhvhv": "fhvhv_trip"}


@dataclass(frozen=True)
class Domain:
    """Where the layers of one business domain live."""

    name: str
    enabled: bool = True
    raw_bucket: str = "raw"
    bronze_bucket: str = "bronze"
    prefix: str | None = None
    topics: Mapping[str, tuple[str, str]] = field(default_factory=dict)  # topic → silver, gold table

    @property
    def path(self) -> str:
        return self.prefix or f"lakehouse/{self.name}"


@dataclass(frozen=True)
class Registry:
    domains: tuple[Domain, ...]
    default_domain: str = "default"
    default_topic: str = "general"

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(d.name, d.raw_bucket, d.path, d.bronze_bucket, d.path) for d in self.domains if d.enabled]
        return spark.createDataFrame(
            rows, "domain string, raw_bucket string, raw_prefix string, bronze_bucket string, bronze_prefix string"
        )

    @classmethod
    def from_json(cls, text: str) -> Registry:
        """Read the registry document: default names and one entry per domain."""
        doc = json.loads(text)
        domains = []
        for name, entry in doc.get("domains", {}).items():
            topics = {
                t: (c.get("silver_table", f"{t}_silver"), c.get("gold_table", f"{t}_summary"))
                for t, c in entry.get("topics", {}).items()
            }
            domains.append(
                Domain(
                    name,
                    entry.get("enabled", True),
                    entry.get("raw_bucket", "raw"),
                    entry.get("bronze_bucket", "bronze"),
                    entry.get("raw_prefix"),
                    topics,
                )
            )
        return cls(tuple(domains), doc.get("default_domain", "default"), doc.get("default_topic", "general"))


@dataclass(frozen=True)
class SourceConfig:
    """One table of a database extract."""

    name: str
    schema: str
    primary_key: str
    query: str | None = None

    @property
    def table(self) -> str:
        return f"{self.schema}.{self.name}"


def children_query(child: str, parent: str, key: str, n: int, columns: str = "*") -> str:
    """Source-side extract of the children of the first ``n`` parents by key."""
    picked = ", ".join(f"c.{c.strip()}" for c in columns.split(","))
    return (
        f"SELECT {picked} FROM {child} c "
        f"JOIN (SELECT DISTINCT {key} FROM {parent} ORDER BY {key} LIMIT {n}) p ON c.{key} = p.{key}"
    )
