"""Silver columns of the hospital sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemill.functions.values import as_date
from lakemill.operators.conform import clean_strings, require
from lakemill.operators.dedupe import dedupe
from lakemill.operators.quality import drop_null_key

# Source tables, their columns and their keys.
PRIMARY_KEYS = {
    "tb_patientrecord": "patientrecordid",
    "tb_invoice": "invoiceid",
    "tb_treatment": "treatmentid",
    "tb_bed": "bedid",
    "tb_department": "departmentid",
    "tb_phacdodieutri": "phacdodieutriid",
    "tb_phacdodieutri_phieudieutri": "phacdodieutri_phieudieutriid",
}
ENCOUNTER_DATES = ("patientrecorddate", "receptiondate", "medicalrecorddate_in", "medicalrecorddate_out")
PRIMARY_DIAGNOSES = ("chandoan_kb_main_icd10", "chandoan_in_icd10", "chandoan_out_main_icd10")
SECONDARY_DIAGNOSES = ("chandoan_kb_ex_icd10", "chandoan_in_icd10_kemtheo", "chandoan_out_ex_icd10")


def amount(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0.0))


def is_one(column: str) -> Column:
    return F.coalesce(F.col(column) == 1, F.lit(False))


def enrich_encounters(df: DataFrame) -> DataFrame:
    with_dates = df.withColumns(
        {
            "encounter_date": F.coalesce(*[as_date(c) for c in ENCOUNTER_DATES]),
            "reception_date": as_date("receptiondate"),
            "admission_date": as_date("medicalrecorddate_in"),
            "discharge_date": as_date("medicalrecorddate_out"),
            "primary_diagnosis_icd10": F.coalesce(*PRIMARY_DIAGNOSES),
            "secondary_diagnosis_icd10": F.coalesce(*SECONDARY_DIAGNOSES),
            "has_insurance_code": F.col("insurancecode").isNotNull(),
            "is_bhyt_covered": amount("tongbhyt") > 0,
        }
    )
    inpatient = F.col("admission_date").isNotNull()
    if "medicalrecordid_in" in df.columns:
        inpatient = inpatient | F.col("medicalrecordid_in").isNotNull()
    return with_dates.withColumns({"is_inpatient": inpatient, "is_discharged": F.col("discharge_date").isNotNull()})


def enrich_insurance_period(df: DataFrame) -> DataFrame:
    """The sample extract also carries the validity of the insurance card."""
    return df.withColumns({"insurance_start_date": as_date("fromdate"), "insurance_end_date": as_date("todate")})


def enrich_invoices(df: DataFrame) -> DataFrame:
    kind = F.col("dm_invoice_typeid").cast("string")
    return df.withColumns(
        {
            "invoice_date": as_date("invoicedate"),
            "invoice_amount": amount("sotienphieu"),
            "discount_amount": amount("sotienmiengiam"),
            "finance_bucket": F.coalesce(F.concat(F.lit("invoice_type_"), kind), F.lit("unknown")),
        }
    )


def enrich_treatments(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "treatment_date_only": as_date("treatmentdate"),
            "checkin_date": as_date("checkin_time"),
            "end_date": as_date("end_treatmentdate"),
            "is_emergency_treatment": is_one("iscapcuu"),
            "has_alert_text": F.col("thongtincanhbaoxn").isNotNull(),
        }
    )


def enrich_beds(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_disabled_bed": is_one("beddisable"),
            "is_occupied_bed": F.col("listmedicalrecordid").isNotNull(),
            "occupied_record_ids": F.col("listmedicalrecordid"),
        }
    )


def enrich_pathways(df: DataFrame) -> DataFrame:
    return df.withColumn("pathway_version_date", as_date("version"))


def enrich_pathway_sheets(df: DataFrame) -> DataFrame:
    return df.withColumn("pathway_sheet_date", as_date("version"))


ENRICHERS = {
    "tb_patientrecord": enrich_encounters,
    "tb_invoice": enrich_invoices,
    "tb_treatment": enrich_treatments,
    "tb_bed": enrich_beds,
    "tb_phacdodieutri": enrich_pathways,
    "tb_phacdodieutri_phieudieutri": enrich_pathway_sheets,
}


def enrich(source: str, df: DataFrame) -> DataFrame:
    """Derived columns of a source; a source without any passes through."""
    return ENRICHERS.get(source, lambda same: same)(df)


def silver_source(source: str, bronze: DataFrame, key: str | None = None) -> DataFrame:
    """Bronze → silver of one source: clean, drop keyless rows, dedupe, enrich."""
    key = key or PRIMARY_KEYS[source]
    require(bronze, [key], f"bronze {source}")
    return enrich(source, dedupe(drop_null_key(clean_strings(bronze), key), [key]))
