"""Hospital silver columns, marts and dashboard rows."""

from pyspark.sql import functions as F

from lakemill.checks.registry import job
from lakemill.checks.sqltext import cents, flags, half_up
from lakemill.operators import enrich as E
from lakemill.operators import marts, payload, quality
from lakemill.operators.conform import clean_strings
from lakemill.operators.dedupe import children_of, dedupe

CODE = "nullif(trim(insurancecode), '')"
DATE = "coalesce(patientrecorddate, receptiondate, medicalrecorddate_in, medicalrecorddate_out)::date"
# Silver encounters and invoices as queries.
ENC = f"""enc AS (
  SELECT *, {DATE} AS encounter_date, medicalrecorddate_in::date AS admission_date,
    medicalrecorddate_out::date AS discharge_date,
    coalesce(chandoan_kb_main_icd10, chandoan_in_icd10, chandoan_out_main_icd10) AS primary_diagnosis_icd10,
    coalesce(chandoan_kb_ex_icd10, chandoan_in_icd10_kemtheo, chandoan_out_ex_icd10) AS secondary_diagnosis_icd10,
    {CODE} IS NOT NULL AS has_insurance_code, coalesce(tongbhyt, 0) > 0 AS is_bhyt_covered,
    medicalrecorddate_in IS NOT NULL AS is_inpatient, medicalrecorddate_out IS NOT NULL AS is_discharged
  FROM encounters)"""
INV = """inv AS (
  SELECT *, invoicedate::date AS invoice_date, coalesce(sotienphieu, 0) AS invoice_amount,
    coalesce(sotienmiengiam, 0) AS discount_amount,
    CASE WHEN dm_invoice_typeid IS NULL THEN 'unknown' ELSE 'invoice_type_' || dm_invoice_typeid END AS finance_bucket
  FROM invoices)"""
COUNTS = "count(*) AS encounter_count, count(DISTINCT patientid) AS distinct_patient_count"
INPATIENT = f"{flags('is_inpatient')} AS inpatient_encounter_count"
DISCHARGED = f"{flags('is_discharged')} AS discharged_encounter_count"
INSURED = f"{flags('has_insurance_code')} AS insured_encounter_count"


def total(column, name):
    return f"{cents(f'coalesce({column}, 0)', 6)} AS {name}"


ACTIVITY = f"""activity AS (SELECT encounter_date, departmentid, roomid, {COUNTS}, {INPATIENT}, {DISCHARGED}, {INSURED}
  FROM enc WHERE encounter_date IS NOT NULL GROUP BY ALL)"""
FINANCE_KEYS = """invoice_date, departmentid, roomid, finance_bucket, dm_invoice_typeid, dm_invoice_hinhthucid,
    dm_invoice_typedetailid, dm_nhomthanhtoanid, dm_vienphi_nguonthanhtoanid"""
FINANCE = f"""classified AS (SELECT {FINANCE_KEYS}, count(*) AS invoice_count,
    count(DISTINCT patientrecordid) AS distinct_encounter_count, {total("invoice_amount", "total_invoice_amount")},
    {total("discount_amount", "total_discount_amount")}
  FROM inv WHERE invoice_date IS NOT NULL GROUP BY ALL)"""
STAYS = f"""stays AS (SELECT encounter_date, departmentid, dm_patientrecordtypeid, dm_patientrecordstatusid,
    dm_medicalrecordstatusid_out, {COUNTS}, {INPATIENT}, {DISCHARGED}
  FROM enc WHERE encounter_date IS NOT NULL GROUP BY ALL)"""
BED_COUNTS = f"""occupancy AS (SELECT *, CASE WHEN available_bed_count <> 0
      THEN {half_up("occupied_bed_count / available_bed_count", 4)} END AS occupancy_ratio
  FROM (SELECT *, configured_bed_count - disabled_bed_count AS available_bed_count FROM (
    SELECT b.departmentid, departmentcode, departmentname, sogiuongkehoach AS planned_bed_count,
      sogiuongthucke AS actual_bed_count, count(*) AS configured_bed_count,
      {flags("beddisable = 1")} AS disabled_bed_count, {flags("listmedicalrecordid IS NOT NULL")} AS occupied_bed_count
    FROM beds b LEFT JOIN departments d ON b.departmentid = d.departmentid GROUP BY ALL) c) a)"""
PATHS = """paths AS (SELECT p.phacdodieutriid, maphacdo, tenphacdo, listmabenhicd10, dm_phacdogroupid,
    songaydieutri AS configured_treatment_days, count(phacdodieutri_phieudieutriid) AS pathway_sheet_count,
    count(DISTINCT ngaydieutriphacdo) AS distinct_protocol_day_count
  FROM pathways p LEFT JOIN sheets s ON p.phacdodieutriid = s.phacdodieutriid GROUP BY ALL)"""


def encounters(d):
    return E.enrich("tb_patientrecord", clean_strings(d.view("encounters")))


def invoices(d):
    return E.enrich("tb_invoice", clean_strings(d.view("invoices")))


def beds(d):
    return E.enrich("tb_bed", clean_strings(d.view("beds")))


def occupancy(d):
    return marts.bed_occupancy(beds(d), d.view("departments"), F.to_date(F.lit("2024-01-31")))


def pathways(d):
    return marts.clinical_pathway(d.view("pathways"), d.view("sheets"))


def gold(d):
    enc = encounters(d)
    return {
        "encounter": marts.encounter_activity(enc),
        "finance": marts.finance_classification(invoices(d)),
        "inpatient": marts.inpatient_summary(enc),
        "bed": occupancy(d),
        "pathway": pathways(d),
    }


@job(
    "encounter_enrich",
    f"""WITH {ENC} SELECT patientrecordid, {CODE} AS insurancecode, encounter_date, receptiondate::date AS reception_date,
          admission_date, discharge_date, primary_diagnosis_icd10, secondary_diagnosis_icd10, has_insurance_code,
          is_bhyt_covered, is_inpatient, is_discharged, fromdate::date AS insurance_start_date,
          todate::date AS insurance_end_date FROM enc""",
)
def _(d):
    return E.enrich_insurance_period(encounters(d)).select(
        "patientrecordid", "insurancecode", "encounter_date", "reception_date", "admission_date", "discharge_date",
        "primary_diagnosis_icd10", "secondary_diagnosis_icd10", "has_insurance_code", "is_bhyt_covered", "is_inpatient",
        "is_discharged", "insurance_start_date", "insurance_end_date",
    )


@job(
    "invoice_enrich",
    f"WITH {INV} SELECT invoiceid, invoice_date, invoice_amount::double AS invoice_amount, discount_amount::double + 0e0 AS discount_amount, finance_bucket FROM inv",
)
def _(d):
    return invoices(d).select("invoiceid", "invoice_date", "invoice_amount", "discount_amount", "finance_bucket")


@job(
    "treatment_enrich",
    """SELECT treatmentid, treatmentdate::date AS treatment_date_only, checkin_time::date AS checkin_date,
         end_treatmentdate::date AS end_date, coalesce(iscapcuu, 0) = 1 AS is_emergency_treatment,
         thongtincanhbaoxn IS NOT NULL AS has_alert_text FROM treatments""",
)
def _(d):
    return E.enrich("tb_treatment", d.view("treatments")).select(
        "treatmentid", "treatment_date_only", "checkin_date", "end_date", "is_emergency_treatment", "has_alert_text"
    )


@job(
    "bed_enrich",
    """SELECT bedid, departmentid, coalesce(beddisable, 0) = 1 AS is_disabled_bed,
         listmedicalrecordid IS NOT NULL AS is_occupied_bed, listmedicalrecordid AS occupied_record_ids FROM beds""",
)
def _(d):
    return beds(d).select("bedid", "departmentid", "is_disabled_bed", "is_occupied_bed", "occupied_record_ids")


@job("pathway_enrich", "SELECT phacdodieutriid, tenphacdo, version::date AS pathway_version_date FROM pathways")
def _(d):
    return E.enrich("tb_phacdodieutri", d.view("pathways")).select("phacdodieutriid", "tenphacdo", "pathway_version_date")


@job("key_not_null", f"SELECT patientrecordid, {CODE} AS insurancecode FROM encounters WHERE {CODE} IS NOT NULL")
def _(d):
    return quality.drop_null_key(clean_strings(d.view("encounters")), "insurancecode").select("patientrecordid", "insurancecode")


@job("date_not_null", f"WITH {ENC} SELECT patientrecordid, encounter_date FROM enc WHERE encounter_date IS NOT NULL")
def _(d):
    return quality.with_date(encounters(d), "encounter_date").select("patientrecordid", "encounter_date")


@job(
    "dedupe_by_key",
    """SELECT invoiceid, patientrecordid, invoicedate, sotienphieu FROM (
         SELECT *, row_number() OVER (PARTITION BY invoiceid ORDER BY invoicedate DESC, sotienphieu, patientrecordid) AS rn
         FROM invoices) x WHERE rn = 1""",
)
def _(d):
    rows = d.view("invoices").select("invoiceid", "patientrecordid", "invoicedate", "sotienphieu")
    return dedupe(rows, ["invoiceid"], [F.desc("invoicedate"), "sotienphieu", "patientrecordid"])


@job(
    "left_join_bed_department",
    """SELECT bedid, b.departmentid, departmentcode, departmentname, sogiuongkehoach AS planned_bed_count,
         sogiuongthucke AS actual_bed_count
       FROM beds b LEFT JOIN departments d ON b.departmentid = d.departmentid""",
)
def _(d):
    joined = marts.beds_with_department(d.view("beds"), d.view("departments"))
    return joined.select("bedid", "departmentid", *marts.DEPARTMENT_COLUMNS.values())


@job(
    "left_join_pathway_sheet",
    """SELECT p.phacdodieutriid, tenphacdo, phacdodieutri_phieudieutriid, ngaydieutriphacdo
       FROM pathways p LEFT JOIN sheets s ON p.phacdodieutriid = s.phacdodieutriid""",
)
def _(d):
    joined = marts.pathways_with_sheets(d.view("pathways"), d.view("sheets"))
    return joined.select("phacdodieutriid", "tenphacdo", "phacdodieutri_phieudieutriid", "ngaydieutriphacdo")


# The extract of the first 1000 parents is itself the feature of the source.
FIRST = "SELECT DISTINCT patientrecordid FROM encounters ORDER BY patientrecordid LIMIT 1000"


@job(
    "semi_join_sampled_parents",
    f"SELECT invoiceid, patientrecordid, sotienphieu FROM invoices WHERE patientrecordid IN ({FIRST})",
)
def _(d):
    kids = d.view("invoices").select("invoiceid", "patientrecordid", "sotienphieu")
    return children_of(kids, d.view("encounters"), "patientrecordid", 1000)


@job(
    "jdbc_pushdown_subquery_join",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem ORDER BY l_orderkey LIMIT 1000)""",
)
def _(d):
    from lakemill.config import children_query

    query = children_query("{lineitem}", "{lineitem}", "l_orderkey", 1000, "l_orderkey, l_linenumber, l_extendedprice")
    return d.spark.sql(query, lineitem=d.table("lineitem"))


@job("mart_encounter_activity", f"WITH {ENC}, {ACTIVITY} SELECT * FROM activity")
def _(d):
    return marts.encounter_activity(encounters(d))


@job("mart_finance_classification", f"WITH {INV}, {FINANCE} SELECT * FROM classified")
def _(d):
    return marts.finance_classification(invoices(d))


@job("mart_inpatient_summary", f"WITH {ENC}, {STAYS} SELECT * FROM stays")
def _(d):
    return marts.inpatient_summary(encounters(d))


@job("mart_bed_occupancy", f"WITH {BED_COUNTS} SELECT DATE '2024-01-31' AS snapshot_date, * FROM occupancy")
def _(d):
    return occupancy(d)


@job("mart_clinical_pathway", f"WITH {PATHS} SELECT * FROM paths")
def _(d):
    return pathways(d)


@job(
    "mart_daily_financial",
    f"""WITH {ENC} SELECT encounter_date, departmentid, roomid, dm_receptionobjectid, dm_patientobjectid, {COUNTS},
          {total("tongchiphi", "total_cost_amount")}, {total("tongbhyt", "total_bhyt_amount")},
          {total("tongbenhnhan", "total_patient_paid_amount")}, {total("tongdathu", "total_collected_amount")},
          {INSURED}, {flags("is_bhyt_covered")} AS bhyt_covered_encounter_count
        FROM enc WHERE encounter_date IS NOT NULL GROUP BY ALL""",
)
def _(d):
    return marts.daily_financial(encounters(d))


@job(
    "mart_daily_diagnosis",
    f"""WITH {ENC} SELECT encounter_date, departmentid,
          coalesce(primary_diagnosis_icd10, secondary_diagnosis_icd10) AS diagnosis_icd10, {COUNTS},
          {total("tongchiphi", "total_cost_amount")}, {total("tongbhyt", "total_bhyt_amount")}
        FROM enc WHERE encounter_date IS NOT NULL AND coalesce(primary_diagnosis_icd10, secondary_diagnosis_icd10) IS NOT NULL
        GROUP BY ALL""",
)
def _(d):
    return marts.daily_diagnosis(encounters(d))


@job(
    "mart_daily_coverage",
    f"""WITH {ENC} SELECT encounter_date, departmentid, dm_patientobjectid, dm_bhyt_loaiid, has_insurance_code,
          is_bhyt_covered, {COUNTS}, {total("tongchiphi", "total_cost_amount")}, {total("tongbhyt", "total_bhyt_amount")},
          {total("tongbenhnhan", "total_patient_paid_amount")}
        FROM enc WHERE encounter_date IS NOT NULL GROUP BY ALL""",
)
def _(d):
    return marts.daily_coverage(encounters(d))


@job(
    "mart_daily_discharge",
    f"""WITH {ENC} SELECT encounter_date, departmentid, dm_ketquadieutriid, dm_hinhthucravienid,
          dm_medicalrecordstatusid_out, {COUNTS}, {DISCHARGED}
        FROM enc WHERE encounter_date IS NOT NULL GROUP BY ALL""",
)
def _(d):
    return marts.daily_discharge(encounters(d))


LOGINS = """SELECT cast(ts AS date) AS login_date, event_type AS domain, props AS softversion, user_id AS employee_id,
    event_id AS computer, cast(value AS int) AS ip FROM events"""


@job(
    "mart_login_activity",
    """SELECT ts::date AS login_date, event_type AS domain, props AS softversion, count(*) AS login_count,
         count(DISTINCT user_id) AS distinct_employee_count, count(DISTINCT event_id) AS distinct_computer_count,
         count(DISTINCT trunc(value)) AS distinct_ip_count FROM events GROUP BY ALL""",
)
def _(d):
    return marts.login_activity(d.sql(LOGINS))


TOTALS = ("encounter_count", "distinct_patient_count", "insured_encounter_count")


@job(
    "latest_partition_totals",
    f"""WITH {ENC}, {ACTIVITY} SELECT sum(encounter_count)::bigint AS encounter_count,
          sum(distinct_patient_count)::bigint AS sum_distinct_patient_count,
          sum(insured_encounter_count)::bigint AS insured_encounter_count
        FROM activity WHERE encounter_date = (SELECT max(encounter_date) FROM activity)""",
)
def _(d):
    return marts.latest_totals(marts.encounter_activity(encounters(d)), "encounter_date", TOTALS)


BUCKETS = f"""buckets AS (SELECT finance_bucket, {cents("total_invoice_amount", 6)} AS bucket_amount FROM classified
  WHERE invoice_date = (SELECT max(invoice_date) FROM classified) GROUP BY ALL)"""


@job("latest_bucket_amounts", f"WITH {INV}, {FINANCE}, {BUCKETS} SELECT * FROM buckets")
def _(d):
    return marts.latest_buckets(marts.finance_classification(invoices(d)))


@job("sort_mart_desc", f"WITH {ENC}, {ACTIVITY} SELECT * FROM activity ORDER BY encounter_date DESC, encounter_count DESC, departmentid, roomid")
def _(d):
    return marts.sorted_mart(marts.encounter_activity(encounters(d)), "encounter_date", "encounter_count")


@job(
    "sort_nulls_last",
    f"""WITH {BED_COUNTS} SELECT departmentid, departmentname, occupancy_ratio FROM occupancy
        ORDER BY occupancy_ratio DESC NULLS LAST, departmentname ASC NULLS LAST""",
)
def _(d):
    rows = occupancy(d).select("departmentid", "departmentname", "occupancy_ratio")
    return marts.sorted_nulls_last(rows, ["occupancy_ratio"], ["departmentname"])


TOP10 = "ORDER BY occupancy_ratio DESC NULLS LAST, occupied_bed_count DESC, departmentid NULLS LAST LIMIT 10"
TOP8 = "ORDER BY pathway_sheet_count DESC, tenphacdo NULLS LAST, phacdodieutriid LIMIT 8"


@job("topk_departments", f"WITH {BED_COUNTS} SELECT departmentid, occupied_bed_count, occupancy_ratio FROM occupancy {TOP10}")
def _(d):
    return marts.top_departments(occupancy(d), 10).select("departmentid", "occupied_bed_count", "occupancy_ratio")


@job("topk_pathways", f"WITH {PATHS} SELECT phacdodieutriid, tenphacdo, pathway_sheet_count FROM paths {TOP8}")
def _(d):
    return marts.top_pathways(pathways(d), 8).select("phacdodieutriid", "tenphacdo", "pathway_sheet_count")


def currency(x):
    scaled = lambda unit: f"round(({x}::decimal(28,6)::decimal(38,6) / {unit})::decimal(38,12), 2)::decimal(28,2)::varchar"
    whole = f"replace(format('{{:,}}', trunc({x})::bigint), ',', '.')"
    return f"""CASE WHEN abs({x}) >= 1000000000 THEN {scaled(1000000000)} || ' tỷ'
      WHEN abs({x}) >= 1000000 THEN {scaled(1000000)} || ' triệu' ELSE {whole} || ' VND' END"""


def color(p):
    return f"CASE WHEN {p} >= 85 THEN '#ff4d4f' WHEN {p} >= 70 THEN '#fa8c16' ELSE '#52c41a' END"


@job(
    "kpi_cards",
    f"""WITH {ENC}, {INV}, {ACTIVITY}, {FINANCE}, {STAYS}, {BED_COUNTS},
    v AS (SELECT sum(encounter_count)::bigint AS n, sum(distinct_patient_count)::bigint AS p FROM activity
          WHERE encounter_date = (SELECT max(encounter_date) FROM activity)),
    f AS (SELECT {cents("total_invoice_amount", 6)} AS amount, {cents("total_discount_amount", 6)} AS discount FROM classified
          WHERE invoice_date = (SELECT max(invoice_date) FROM classified)),
    i AS (SELECT sum(inpatient_encounter_count)::bigint AS n, sum(discharged_encounter_count)::bigint AS o FROM stays
          WHERE encounter_date = (SELECT max(encounter_date) FROM stays)),
    b AS (SELECT sum(available_bed_count)::bigint AS av, sum(occupied_bed_count)::bigint AS oc FROM occupancy),
    q AS (SELECT av, oc, CASE WHEN av = 0 THEN 0.0::decimal(18,1) ELSE round((oc * 100 / av)::decimal(28,12), 1)::decimal(18,1) END AS pct FROM b)
    SELECT 1 AS position, 'LƯỢT KHÁM HÔM NAY' AS title, n::varchar AS value, '#1677ff' AS accent,
      p || ' bệnh nhân' AS hint, '#1677ff' AS hint_color FROM v
    UNION ALL SELECT 2, 'DOANH THU', {currency("amount")}, '#52c41a', 'Giảm trừ ' || {currency("discount")}, '#8c8c8c' FROM f
    UNION ALL SELECT 3, 'BN NỘI TRÚ', n::varchar, '#722ed1', 'Ra viện ' || o, '#8c8c8c' FROM i
    UNION ALL SELECT 4, 'BOR TOÀN VIỆN', pct || '%', '#fa8c16', oc || '/' || av || ' giường sử dụng', {color("pct")} FROM q""",
)
def _(d):
    return payload.kpi_cards(gold(d))


@job(
    "progress_departments",
    f"""WITH {BED_COUNTS}, best AS (SELECT *, (row_number() OVER ({TOP10.removesuffix(" LIMIT 10")}))::int AS position,
          round(coalesce(occupancy_ratio, 0)::varchar::decimal(18,6) * 100, 1)::decimal(18,1) AS pct FROM occupancy)
        SELECT position, coalesce(nullif(departmentname, ''), nullif(departmentcode, ''), 'Khoa ' || departmentid) AS label,
          pct::double AS value, 100 AS secondary_value, {color("pct")} AS color FROM best WHERE position <= 10""",
)
def _(d):
    return payload.dept_progress(occupancy(d))


@job(
    "pie_finance",
    f"""WITH {INV}, {FINANCE}, {BUCKETS} SELECT
          (row_number() OVER (ORDER BY bucket_amount DESC, finance_bucket))::int AS position,
          CASE WHEN finance_bucket IS NULL THEN 'Không xác định'
          WHEN trim(finance_bucket) LIKE 'invoice_type_%' THEN 'Nhóm hóa đơn ' || replace(trim(finance_bucket), 'invoice_type_', '')
          ELSE trim(finance_bucket) END AS label, round(bucket_amount::decimal(28,6), 2)::double AS value FROM buckets""",
)
def _(d):
    return payload.finance_pie(marts.finance_classification(invoices(d)))


@job(
    "flow_stages",
    f"""WITH {ENC}, {ACTIVITY}, t AS (SELECT sum(encounter_count)::bigint AS a, sum(inpatient_encounter_count)::bigint AS b,
          sum(discharged_encounter_count)::bigint AS c, sum(insured_encounter_count)::bigint AS e FROM activity
          WHERE encounter_date = (SELECT max(encounter_date) FROM activity))
        SELECT 1 AS position, 'Tổng lượt' AS label, a AS value, '#1677ff' AS color FROM t
        UNION ALL SELECT 2, 'Nội trú', b, '#722ed1' FROM t UNION ALL SELECT 3, 'Ra viện', c, '#52c41a' FROM t
        UNION ALL SELECT 4, 'Có BHYT', e, '#fa8c16' FROM t""",
)
def _(d):
    return payload.flow_stages(marts.encounter_activity(encounters(d)))


@job(
    "progress_pathways",
    f"""WITH {PATHS}, best AS (SELECT *, (row_number() OVER ({TOP8.removesuffix(" LIMIT 8")}))::int AS position FROM paths)
        SELECT position, coalesce(nullif(tenphacdo, ''), nullif(maphacdo, ''), 'Phác đồ ' || phacdodieutriid) AS label,
          pathway_sheet_count::double AS value, coalesce(configured_treatment_days, 0)::double AS secondary_value,
          '#722ed1' AS color, CASE WHEN max(pathway_sheet_count) OVER () > 0
            THEN max(pathway_sheet_count) OVER () ELSE 1 END::double AS max_value
        FROM best WHERE position <= 8""",
)
def _(d):
    return payload.pathway_progress(pathways(d))


@job("screen_payload")
def _(d):
    return payload.screen_payload(gold(d))
