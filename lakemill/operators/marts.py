"""Gold marts: one aggregation each, keys shuffled after partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemill.functions.values import flag_count, money_sum, ratio
from lakemill.operators.dedupe import not_in
from lakemill.operators.quality import with_date


def rows() -> Column:
    return F.count(F.lit(1))


def distinct(column: str) -> Column:
    return F.countDistinct(column)


# --- business domains -------------------------------------------------------


def hr_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("domain", "department", "attendance_status").agg(
        rows().alias("record_count"), money_sum("hours_worked").alias("total_hours_worked")
    )


def finance_summary(df: DataFrame) -> DataFrame:
    totals = [money_sum(c).alias(f"total_{c}") for c in ("money_input", "money_output", "profit")]
    return df.groupBy("domain", "cost_center").agg(rows().alias("record_count"), *totals)


def marketing_summary(df: DataFrame) -> DataFrame:
    summed = df.groupBy("domain", "channel").agg(
        rows().alias("record_count"),
        money_sum("spend_usd").alias("total_spend_usd"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("conversions").alias("total_conversions"),
    )
    return summed.withColumn("conversion_rate", ratio("total_conversions", "total_clicks", 4))


def domain_count(df: DataFrame) -> DataFrame:
    return df.groupBy("domain").agg(rows().alias("record_count"))


DOMAIN_MARTS = {"hr": hr_summary, "finance": finance_summary, "marketing": marketing_summary}


def domain_summary(df: DataFrame, domain: str) -> DataFrame:
    return DOMAIN_MARTS.get(domain, domain_count)(df)


def fhv_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("domain", "dispatching_base_num").agg(
        rows().alias("trip_count"),
        money_sum("trip_duration_minutes").alias("total_trip_minutes"),
        flag_count(F.col("sr_flag").isNotNull()).alias("sr_flag_trip_count"),
    )


def fhvhv_summary(df: DataFrame) -> DataFrame:
    totals = {
        "trip_miles": "total_trip_miles",
        "base_passenger_fare": "total_base_passenger_fare",
        "tips": "total_tips",
        "driver_pay": "total_driver_pay",
    }
    return df.groupBy("domain", "hvfhs_license_num").agg(
        rows().alias("trip_count"), *[money_sum(c).alias(name) for c, name in totals.items()]
    )


# --- hospital dashboard -----------------------------------------------------


def _encounter_counts(*flags: tuple[str, str]) -> list[Column]:
    return [
        rows().alias("encounter_count"),
        distinct("patientid").alias("distinct_patient_count"),
        *[flag_count(F.col(flag)).alias(name) for flag, name in flags],
    ]


INPATIENT = ("is_inpatient", "inpatient_encounter_count")
DISCHARGED = ("is_discharged", "discharged_encounter_count")
INSURED = ("has_insurance_code", "insured_encounter_count")
COVERED = ("is_bhyt_covered", "bhyt_covered_encounter_count")


def encounter_activity(encounters: DataFrame) -> DataFrame:
    return (
        with_date(encounters, "encounter_date")
        .groupBy("encounter_date", "departmentid", "roomid")
        .agg(*_encounter_counts(INPATIENT, DISCHARGED, INSURED))
    )


def finance_classification(invoices: DataFrame) -> DataFrame:
    return (
        with_date(invoices, "invoice_date")
        .groupBy(
            "invoice_date",
            "departmentid",
            "roomid",
            "finance_bucket",
            "dm_invoice_typeid",
            "dm_invoice_hinhthucid",
            "dm_invoice_typedetailid",
            "dm_nhomthanhtoanid",
            "dm_vienphi_nguonthanhtoanid",
        )
        .agg(
            rows().alias("invoice_count"),
            distinct("patientrecordid").alias("distinct_encounter_count"),
            _total("invoice_amount").alias("total_invoice_amount"),
            _total("discount_amount").alias("total_discount_amount"),
        )
    )


def _total(column: str) -> Column:
    """Sum with NULL as zero, unrounded up to six places."""
    return money_sum(F.coalesce(F.col(column), F.lit(0.0)), 6)


def inpatient_summary(encounters: DataFrame) -> DataFrame:
    return (
        with_date(encounters, "encounter_date")
        .groupBy(
            "encounter_date",
            "departmentid",
            "dm_patientrecordtypeid",
            "dm_patientrecordstatusid",
            "dm_medicalrecordstatusid_out",
        )
        .agg(*_encounter_counts(INPATIENT, DISCHARGED))
    )


DEPARTMENT_COLUMNS = {
    "departmentcode": "departmentcode",
    "departmentname": "departmentname",
    "sogiuongkehoach": "planned_bed_count",
    "sogiuongthucke": "actual_bed_count",
}


def beds_with_department(beds: DataFrame, departments: DataFrame) -> DataFrame:
    """Beds with the attributes of their department; unknown ones keep NULL."""
    named = departments.select("departmentid", *[F.col(c).alias(n) for c, n in DEPARTMENT_COLUMNS.items()])
    return beds.join(named, "departmentid", "left")


def bed_occupancy(beds: DataFrame, departments: DataFrame, snapshot_date: Column | None = None) -> DataFrame:
    """Beds are counted per department before the join, so the join is tiny.

    A department id listed more than once multiplies its beds, as a plain join
    would; ``_copies`` carries that factor.
    """
    counted = beds.groupBy("departmentid").agg(
        rows().alias("configured"),
        flag_count(F.col("is_disabled_bed")).alias("disabled"),
        flag_count(F.col("is_occupied_bed")).alias("occupied"),
    )
    names = list(DEPARTMENT_COLUMNS.values())
    named = (
        departments.select("departmentid", *[F.col(c).alias(n) for c, n in DEPARTMENT_COLUMNS.items()])
        .groupBy("departmentid", *names)
        .agg(rows().alias("_copies"))
    )
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    counts = {f"{c}_bed_count": F.col(c) * copies for c in ("configured", "disabled", "occupied")}
    joined = counted.join(named, "departmentid", "left").withColumns(counts)
    available = F.col("configured_bed_count") - F.col("disabled_bed_count")
    ratio_ = F.round(F.try_divide(F.col("occupied_bed_count"), F.col("available_bed_count")), 4)
    return (
        joined.withColumn("available_bed_count", available)
        .withColumn("occupancy_ratio", ratio_)
        .select(
            (F.current_date() if snapshot_date is None else snapshot_date).alias("snapshot_date"),
            "departmentid",
            *names,
            "configured_bed_count",
            "disabled_bed_count",
            "available_bed_count",
            "occupied_bed_count",
            "occupancy_ratio",
        )
    )


def pathways_with_sheets(pathways: DataFrame, sheets: DataFrame) -> DataFrame:
    """Every pathway with its sheets; a pathway without any has one NULL row.

    An outer join cannot split a pathway that holds a third of the sheets, an
    inner join can (skew join). So matches are an inner join, and pathways
    without a match are added by an anti join against the distinct ids.
    """
    key, own = "phacdodieutriid", ["phacdodieutri_phieudieutriid", "ngaydieutriphacdo"]
    matched = sheets.select(key, *own).join(pathways, key).select(*pathways.columns, *own)
    alone = not_in(pathways, sheets, {key: key})
    return matched.unionByName(alone, allowMissingColumns=True)


def clinical_pathway(pathways: DataFrame, sheets: DataFrame) -> DataFrame:
    """Sheets are counted per pathway before the join, so no pathway is hot."""
    keys = ["phacdodieutriid", "maphacdo", "tenphacdo", "listmabenhicd10", "dm_phacdogroupid", "configured_treatment_days"]
    named = (
        pathways.withColumnRenamed("songaydieutri", "configured_treatment_days").groupBy(*keys).agg(rows().alias("_copies"))
    )
    counted = sheets.groupBy("phacdodieutriid").agg(
        F.count("phacdodieutri_phieudieutriid").alias("_sheets"), distinct("ngaydieutriphacdo").alias("_days")
    )
    sheet_count = F.coalesce(F.col("_sheets") * F.col("_copies"), F.lit(0))
    return named.join(counted, "phacdodieutriid", "left").select(
        *keys,
        sheet_count.alias("pathway_sheet_count"),
        F.coalesce(F.col("_days"), F.lit(0)).alias("distinct_protocol_day_count"),
    )


# --- hospital sample --------------------------------------------------------


def daily_financial(encounters: DataFrame) -> DataFrame:
    return (
        with_date(encounters, "encounter_date")
        .groupBy("encounter_date", "departmentid", "roomid", "dm_receptionobjectid", "dm_patientobjectid")
        .agg(
            *_encounter_counts(),
            _total("tongchiphi").alias("total_cost_amount"),
            _total("tongbhyt").alias("total_bhyt_amount"),
            _total("tongbenhnhan").alias("total_patient_paid_amount"),
            _total("tongdathu").alias("total_collected_amount"),
            flag_count(F.col(INSURED[0])).alias(INSURED[1]),
            flag_count(F.col(COVERED[0])).alias(COVERED[1]),
        )
    )


def daily_diagnosis(encounters: DataFrame) -> DataFrame:
    diagnosed = with_date(encounters, "encounter_date").withColumn(
        "diagnosis_icd10", F.coalesce("primary_diagnosis_icd10", "secondary_diagnosis_icd10")
    )
    return (
        diagnosed.filter(F.col("diagnosis_icd10").isNotNull())
        .groupBy("encounter_date", "departmentid", "diagnosis_icd10")
        .agg(
            *_encounter_counts(),
            _total("tongchiphi").alias("total_cost_amount"),
            _total("tongbhyt").alias("total_bhyt_amount"),
        )
    )


def daily_coverage(encounters: DataFrame) -> DataFrame:
    return (
        with_date(encounters, "encounter_date")
        .groupBy(
            "encounter_date",
            "departmentid",
            "dm_patientobjectid",
            "dm_bhyt_loaiid",
            "has_insurance_code",
            "is_bhyt_covered",
        )
        .agg(
            *_encounter_counts(),
            _total("tongchiphi").alias("total_cost_amount"),
            _total("tongbhyt").alias("total_bhyt_amount"),
            _total("tongbenhnhan").alias("total_patient_paid_amount"),
        )
    )


def daily_discharge(encounters: DataFrame) -> DataFrame:
    return (
        with_date(encounters, "encounter_date")
        .groupBy(
            "encounter_date", "departmentid", "dm_ketquadieutriid", "dm_hinhthucravienid", "dm_medicalrecordstatusid_out"
        )
        .agg(
            *_encounter_counts(),
            flag_count(F.col("discharge_date").isNotNull()).alias(DISCHARGED[1]),
        )
    )


def login_activity(logins: DataFrame) -> DataFrame:
    """Logins per day, domain and client version with three distinct counts."""
    return logins.groupBy("login_date", "domain", "softversion").agg(
        rows().alias("login_count"),
        distinct("employee_id").alias("distinct_employee_count"),
        distinct("computer").alias("distinct_computer_count"),
        distinct("ip").alias("distinct_ip_count"),
    )


# --- reading a mart ---------------------------------------------------------


def latest_totals(df: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """Sums over the rows of the last date, always one row.

    The mart is read once: rows are added up per date, and the sums of the
    greatest date are picked from those few rows. A summed distinct count is not a distinct count of the whole, so such
    columns are named ``sum_…``.
    """
    kinds = dict(df.dtypes)
    name = lambda c: f"sum_{c}" if "distinct" in c else c
    sums = [(money_sum(c, 6) if kinds[c] in ("double", "float") else F.sum(c)).alias(name(c)) for c in columns]
    per_date = df.filter(F.col(date).isNotNull()).groupBy(date).agg(*sums)
    return per_date.agg(*[F.max_by(name(c), date).alias(name(c)) for c in columns])


def latest_buckets(df: DataFrame) -> DataFrame:
    """Amount of each bucket that occurs on the last date.

    Sums per date and bucket shrink to the last date of each bucket, and only
    those rows, one per bucket, are ranked by date.
    """
    amount = money_sum("total_invoice_amount", 6).alias("amount")
    per_date = df.filter(F.col("invoice_date").isNotNull()).groupBy("invoice_date", "finance_bucket").agg(amount)
    per_bucket = per_date.groupBy("finance_bucket").agg(
        F.max("invoice_date").alias("last"), F.max_by("amount", "invoice_date").alias("bucket_amount")
    )
    newest = F.rank().over(Window.orderBy(F.desc("last"))) == 1
    return (
        per_bucket.withColumn("newest", newest)
        .filter("newest")
        .select("finance_bucket", "bucket_amount")
        .orderBy(*bucket_order())
    )


def sorted_mart(df: DataFrame, date: str, measure: str) -> DataFrame:
    """Reading order of a mart: newest first, largest first, then all columns."""
    rest = [c for c in df.columns if c not in (date, measure)]
    return df.orderBy(F.desc(date), F.desc(measure), *rest)


def sorted_nulls_last(df: DataFrame, descending: Sequence[str], ascending: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*[F.desc_nulls_last(c) for c in descending], *[F.asc_nulls_last(c) for c in ascending])


def department_order() -> list[Column]:
    return [F.desc_nulls_last("occupancy_ratio"), F.desc("occupied_bed_count"), F.asc_nulls_last("departmentid")]


def pathway_order() -> list[Column]:
    return [F.desc("pathway_sheet_count"), F.asc_nulls_last("tenphacdo"), F.asc("phacdodieutriid")]


def bucket_order() -> list[Column]:
    return [F.desc("bucket_amount"), F.asc("finance_bucket")]


def top_departments(beds: DataFrame, n: int = 10) -> DataFrame:
    """Fullest departments of the last snapshot; the id breaks ties.

    Rows of the last snapshot sort first, so the first ``n`` rows hold all that
    are wanted and only they are compared by date.
    """
    first = beds.orderBy(F.desc("snapshot_date"), *department_order()).limit(n)
    last = F.max("snapshot_date").over(Window.partitionBy(F.lit(1)))
    return first.withColumn("_last", last).filter(F.col("snapshot_date") == F.col("_last")).drop("_last")


def top_pathways(pathways: DataFrame, n: int = 8) -> DataFrame:
    return pathways.orderBy(*pathway_order()).limit(n)
