"""Whole runs: bronze files or extracts to gold tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.config import SILVER_TABLES, Domain, SourceConfig
from lakemill.operators import conform as C
from lakemill.operators import marts, quality, trips
from lakemill.operators.enrich import silver_source
from lakemill.operators.lineage import metadata_last, with_lineage
from lakemill.sinks.tables import write_layer
from lakemill.sources.jdbc import load_source
from lakemill.sources.listing import classify_family, frames_of, list_files
from lakemill.sources.readers import read_table, run_if_exists, table_name

TRIP_SPECS = {
    "green": (C.GREEN, quality.TRIP_RULES),
    "fhv": (C.FHV, quality.FHV_RULES),
    "fhvhv": (C.FHVHV, quality.FHVHV_RULES),
}
HOSPITAL_MARTS = {
    "dashboard_daily_encounter_activity": (marts.encounter_activity, ("tb_patientrecord",)),
    "dashboard_daily_finance_classification": (marts.finance_classification, ("tb_invoice",)),
    "dashboard_daily_inpatient_summary": (marts.inpatient_summary, ("tb_patientrecord",)),
    "dashboard_department_bed_occupancy": (marts.bed_occupancy, ("tb_bed", "tb_department")),
    "dashboard_clinical_pathway_summary": (
        marts.clinical_pathway,
        ("tb_phacdodieutri", "tb_phacdodieutri_phieudieutri"),
    ),
}
SAMPLE_MARTS = {
    "daily_financial_summary": marts.daily_financial,
    "daily_diagnosis_summary": marts.daily_diagnosis,
    "daily_coverage_summary": marts.daily_coverage,
    "daily_discharge_summary": marts.daily_discharge,
}


def silver_trips(family: str, frames: Iterable[DataFrame], domain: str) -> DataFrame:
    """Silver rows of one trip family from the frames of its bronze files."""
    frames = list(frames)
    if family == "yellow":
        shaped, rules = C.conform_yellow(frames), quality.TRIP_RULES
    else:
        fields, rules = TRIP_SPECS[family]
        shaped = C.conform(C.merge_schemas(frames), fields, family)
    return with_lineage(quality.apply_rules(trips.with_duration(shaped), rules), domain, family)


def silver_domain(frames: Iterable[DataFrame], domain: str, topic: str) -> DataFrame:
    """Silver rows of one topic; rows that name another one are ``stray_rows``."""
    merged = C.merge_schemas(list(frames))
    if "topic" in merged.columns:
        merged = merged.filter(F.col("topic").isNull() | (F.col("topic") == topic))
    shaped = C.conform_domain(merged, domain)
    if domain in quality.DOMAIN_RULES:
        shaped = quality.apply_rules(shaped, quality.DOMAIN_RULES[domain])
    return with_lineage(shaped, domain, topic)


def stray_rows(frames: Iterable[DataFrame], topic: str) -> DataFrame | None:
    """Rows of a topic's files that name another topic, as (topic, row); None if the files have no topics."""
    merged = C.merge_schemas(list(frames))
    if "topic" not in merged.columns:
        return None
    return merged.filter(F.col("topic") != topic).select("topic", F.to_json(F.struct("*")).alias("row"))


def write_trip_silver(family: str, frames: Iterable[DataFrame], domain: str) -> str:
    name = table_name("silver", domain, SILVER_TABLES[family])
    write_layer(silver_trips(family, frames, domain), name)
    return name


def write_trip_gold(spark: SparkSession, domain: str) -> list[str]:
    """Gold tables of the trip families whose silver table exists."""
    written = []
    for family, silver in SILVER_TABLES.items():

        def build(df: DataFrame, family: str = family, silver: str = silver) -> DataFrame:
            if family in trips.FEE_COLUMNS:
                made = {f"{silver}_{suffix}": t for suffix, t in trips.gold_trip_tables(df, family).items()}
            else:
                summary = marts.fhv_summary if family == "fhv" else marts.fhvhv_summary
                made = {f"{silver}_summary": summary(df)}
            for name, table in made.items():
                write_layer(table, table_name("gold", domain, name))
                written.append(table_name("gold", domain, name))
            return df

        run_if_exists(spark, table_name("silver", domain, silver), build)
    return written


def trips_from_files(spark: SparkSession, bronze: str, domain: str) -> list[str]:
    """Bronze files below a folder → silver and gold tables of every trip family that has files.

    Families are told apart by the names of the folders that raw files became;
    files of a family are read once for each schema their footers show.
    """
    folder = F.element_at(F.split("path", "/"), -2)
    files = list_files(spark, bronze).filter(F.col("path").endswith(".parquet"))
    files = files.withColumn("family", classify_family(folder)).persist()
    try:
        here = {r.family for r in files.select("family").distinct().collect()}  # one row a family
        frames = {f: frames_of(files.filter(F.col("family") == f)) for f in SILVER_TABLES if f in here}
    finally:
        files.unpersist()
    written = [write_trip_silver(family, parts, domain) for family, parts in frames.items()]
    return written + write_trip_gold(spark, domain)


def write_domain(frames: Mapping[str, Iterable[DataFrame]], domain: Domain) -> list[str]:
    """Silver and gold table of each topic of a business domain, by name.

    Rows that name another topic than their files go to the bronze table
    ``<silver>_quarantine``, which is no result and not among the names.
    """
    written = []
    for topic, (silver, gold) in domain.topics.items():
        if topic not in frames:
            continue
        parts = list(frames[topic])
        strays = stray_rows(parts, topic)
        if strays is not None and not strays.isEmpty():
            write_layer(strays, table_name("bronze", domain.name, f"{silver}_quarantine"))
        rows = silver_domain(parts, domain.name, topic)
        write_layer(rows, table_name("silver", domain.name, silver))
        spark = rows.sparkSession
        summary = marts.domain_summary(read_table(spark, "silver", domain.name, silver), domain.name)
        write_layer(summary, table_name("gold", domain.name, gold))
        written += [table_name("silver", domain.name, silver), table_name("gold", domain.name, gold)]
    return written


def load_hospital(spark: SparkSession, url: str, sources: Iterable[SourceConfig], namespace: str, **settings) -> list[str]:
    """Extract the configured tables of a database and build every layer from them.

    ``settings`` go to the JDBC reader; bounds of a source split its read.
    """
    raw = {s.name: load_source(spark, url, s, **settings) for s in sources}
    return write_hospital(spark, raw, namespace)


def write_sample_marts(spark: SparkSession, silver: str, namespace: str) -> list[str]:
    """The daily marts of the encounter extract, from its silver table."""
    written = []
    for mart, build in SAMPLE_MARTS.items():
        write_layer(build(spark.read.table(silver)), table_name("gold", namespace, mart))
        written.append(table_name("gold", namespace, mart))
    return written


def write_hospital(spark: SparkSession, raw: Mapping[str, DataFrame], namespace: str) -> list[str]:
    """Raw extracts → bronze → silver → the five dashboard marts."""
    for source, df in raw.items():
        write_layer(metadata_last(df), table_name("bronze", namespace, f"{source}_bronze"))
        bronze = read_table(spark, "bronze", namespace, f"{source}_bronze")
        write_layer(silver_source(source, bronze), table_name("silver", namespace, f"{source}_silver"))
    written = []
    for mart, (build, sources) in HOSPITAL_MARTS.items():
        if all(s in raw for s in sources):
            inputs = [read_table(spark, "silver", namespace, f"{s}_silver") for s in sources]
            write_layer(build(*inputs), table_name("gold", namespace, mart))
            written.append(table_name("gold", namespace, mart))
    return written
