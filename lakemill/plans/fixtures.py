"""Views that give the test tables the shapes the jobs work on.

The SQL text is the same for Spark and for the comparison engine. Each view
covers its whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_TRIP_TIMES = (
    "o_orderdate + (l_partkey % 24) * INTERVAL '1' HOUR AS pickup_datetime, l_shipdate AS dropoff_datetime"
)

VIEWS = {
    "trips": f"""
        SELECT cast(l_orderkey * 10 + l_linenumber AS bigint) AS trip_key, cast(l_suppkey AS string) AS vendor_id,
          {_TRIP_TIMES},
          l_linenumber AS passenger_count, l_quantity AS trip_distance,
          CASE l_returnflag WHEN 'A' THEN 'CRD' WHEN 'N' THEN '1' ELSE '2' END AS payment_type,
          l_extendedprice AS fare_amount, l_extendedprice * l_discount + 0e0 AS tip_amount,
          CASE WHEN l_tax >= 8e-2 THEN NULL ELSE l_extendedprice * l_tax + 0e0 END AS tolls_amount,
          l_extendedprice * (1e0 + l_tax) AS total_amount, 5e-1 AS mta_tax,
          CASE WHEN l_linestatus = 'F' THEN 1e0 END AS surcharge, CASE WHEN l_linestatus = 'F' THEN 1e0 END AS extra,
          3e-1 AS improvement_surcharge, cast(l_partkey % 25 AS int) AS pu_location_id,
          cast(l_suppkey % 30 AS int) AS do_location_id, l_returnflag AS store_and_fwd_flag,
          cast(l_linenumber AS string) AS rate_code
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "silver_trips": """
        SELECT * FROM (
          SELECT trips.*, (epoch_seconds(dropoff_datetime) - epoch_seconds(pickup_datetime)) / 60e0 AS trip_duration_minutes,
            'taxi' AS domain
          FROM trips) timed
        WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND trip_distance >= 0 AND fare_amount >= 0
          AND tip_amount >= 0 AND total_amount >= 0 AND tolls_amount >= 0 AND trip_duration_minutes > 0""",
    "fhv": f"""
        SELECT concat('B', cast(l_suppkey AS string)) AS dispatching_base_num, {_TRIP_TIMES},
          cast(l_partkey % 25 AS int) AS pu_location_id, cast(l_suppkey % 30 AS int) AS do_location_id,
          CASE WHEN l_returnflag = 'R' THEN '1' END AS sr_flag, concat('B', cast(l_partkey % 90 AS string)) AS affiliated
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "hv": f"""
        SELECT concat('HV000', cast(l_linenumber AS string)) AS hvfhs_license_num,
          concat('B', cast(l_suppkey AS string)) AS dispatching_base_num, {_TRIP_TIMES},
          l_quantity AS trip_miles, l_extendedprice AS base_passenger_fare,
          l_extendedprice * l_discount + 0e0 AS tips, l_extendedprice * 7e-1 AS driver_pay,
          cast(l_partkey % 25 AS int) AS pu_location_id, cast(l_suppkey % 30 AS int) AS do_location_id,
          l_linestatus AS shared_request_flag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "zones": """
        SELECT n_nationkey AS zone_id, n_name AS zone, r_name AS borough FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "encounters": """
        SELECT o_orderkey AS patientrecordid, o_custkey AS patientid,
          CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS patientrecorddate,
          CASE WHEN o_orderkey % 49 = 0 THEN NULL ELSE o_orderdate END AS receptiondate,
          cast(NULL AS bigint) AS medicalrecordid_in,
          CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS medicalrecorddate_in,
          CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '3' DAY END AS medicalrecorddate_out,
          c_nationkey AS departmentid, cast(o_custkey % 10 AS int) AS roomid,
          cast(o_custkey % 5 AS int) AS dm_receptionobjectid, cast(o_custkey % 3 AS int) AS dm_patientobjectid,
          o_orderstatus AS dm_patientrecordtypeid, cast(o_custkey % 4 AS int) AS dm_patientrecordstatusid,
          CASE WHEN o_orderstatus = 'F' THEN 1 END AS dm_medicalrecordstatusid_out,
          cast(o_custkey % 2 AS int) AS dm_bhyt_loaiid, cast(o_custkey % 6 AS int) AS dm_ketquadieutriid,
          cast(o_custkey % 7 AS int) AS dm_hinhthucravienid,
          CASE WHEN o_orderpriority LIKE '1%' THEN '  ' WHEN o_orderpriority LIKE '2%' THEN NULL
            ELSE concat(' ', o_orderpriority, ' ') END AS insurancecode,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('A', cast(o_orderkey % 11 AS string)) END AS chandoan_kb_main_icd10,
          CASE WHEN o_orderkey % 6 = 0 THEN concat('I', cast(o_orderkey % 5 AS string)) END AS chandoan_in_icd10,
          cast(NULL AS string) AS chandoan_out_main_icd10,
          CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE concat('B', cast(o_orderkey % 13 AS string)) END AS chandoan_kb_ex_icd10,
          cast(NULL AS string) AS chandoan_in_icd10_kemtheo, cast(NULL AS string) AS chandoan_out_ex_icd10,
          CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS fromdate,
          CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '365' DAY END AS todate,
          o_totalprice AS tongchiphi, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS tongbhyt,
          c_acctbal AS tongbenhnhan, o_totalprice AS tongdathu
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "invoices": """
        SELECT cast(l_orderkey * 10 + l_linenumber AS bigint) AS invoiceid, l_orderkey AS patientrecordid,
          l_shipdate AS invoicedate, cast(l_suppkey % 25 AS int) AS departmentid, cast(l_partkey % 10 AS int) AS roomid,
          CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS dm_invoice_typeid,
          cast(l_partkey % 3 AS int) AS dm_invoice_hinhthucid, cast(l_partkey % 2 AS int) AS dm_invoice_typedetailid,
          l_linestatus AS dm_nhomthanhtoanid, cast(l_suppkey % 2 AS int) AS dm_vienphi_nguonthanhtoanid,
          l_extendedprice AS sotienphieu, CASE WHEN l_discount > 5e-2 THEN l_extendedprice * l_discount END AS sotienmiengiam
        FROM lineitem""",
    "treatments": """
        SELECT event_id AS treatmentid, user_id AS patientid, ts AS treatmentdate,
          CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN NULL ELSE 0 END AS iscapcuu,
          CASE WHEN event_type = 'view' THEN ts END AS checkin_time,
          CASE WHEN event_type = 'purchase' THEN ts + INTERVAL '2' DAY END AS end_treatmentdate,
          CASE WHEN event_type = 'error' THEN props END AS thongtincanhbaoxn
        FROM events""",
    "beds": """
        SELECT s_suppkey AS bedid, CASE WHEN s_suppkey % 20 = 0 THEN 999 ELSE s_nationkey END AS departmentid,
          CASE WHEN s_suppkey % 10 = 0 THEN 1 END AS beddisable,
          CASE WHEN s_acctbal > 0 THEN concat('P', cast(s_suppkey AS string)) END AS listmedicalrecordid
        FROM supplier""",
    "departments": """
        SELECT n_nationkey AS departmentid, concat('D', cast(n_nationkey AS string)) AS departmentcode,
          CASE WHEN r_name = 'ASIA' THEN NULL ELSE n_name END AS departmentname,
          n_nationkey + 10 AS sogiuongkehoach, n_nationkey + 12 AS sogiuongthucke
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "pathways": """
        SELECT p_partkey AS phacdodieutriid, p_brand AS maphacdo, p_name AS tenphacdo, p_type AS listmabenhicd10,
          p_size % 5 AS dm_phacdogroupid, p_size AS songaydieutri, '2024-01-15' AS version
        FROM part""",
    "sheets": """
        SELECT cast(l_orderkey * 10 + l_linenumber AS bigint) AS phacdodieutri_phieudieutriid,
          l_partkey + l_partkey % 2 AS phacdodieutriid, l_linenumber AS ngaydieutriphacdo
        FROM lineitem""",
    "hr": """
        SELECT cast(c_custkey AS string) AS employee_id, TIMESTAMP '2024-01-01 00:00:00' AS day_worked,
          c_mktsegment AS department, c_acctbal AS hours_worked,
          CASE c_nationkey % 3 WHEN 0 THEN 'present' WHEN 1 THEN 'late' ELSE 'absent' END AS attendance_status, 'hr' AS topic
        FROM customer""",
    "finance": """
        SELECT cast(o_orderkey AS string) AS finance_id, o_orderdate AS report_date, o_totalprice AS money_input,
          o_totalprice * 6e-1 AS money_output, o_totalprice - o_totalprice * 6e-1 AS profit, o_orderpriority AS cost_center,
          'finance' AS topic
        FROM orders""",
    "marketing": """
        SELECT cast(user_id AS string) AS campaign_id, cast(event_id AS string) AS lead_id, event_type AS channel,
          value AS spend_usd, cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS clicks,
          cast(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS bigint) AS conversions, ts AS event_time,
          'marketing' AS topic
        FROM events""",
    # Events of type error arrive twice.
    "rt_events": """
        SELECT cast(event_id AS string) AS event_id, cast(user_id AS string) AS trip_id, value AS fare_amount,
          ts AS event_time, event_type FROM events
        UNION ALL
        SELECT cast(event_id AS string), cast(user_id AS string), value, ts, event_type FROM events WHERE event_type = 'error'""",
    # Documents as files: a file name per document, its source as the domain.
    "files": """
        SELECT doc_id, concat(CASE lang WHEN 'en' THEN 'yellow_tripdata_' WHEN 'fr' THEN 'green_tripdata_'
            WHEN 'de' THEN 'fhvhv_tripdata_' ELSE 'fhv_tripdata_' END, cast(doc_id AS string),
            CASE WHEN source IN ('src0', 'src1') THEN '.parquet' WHEN source = 'src2' THEN '.csv'
              WHEN source = 'src3' THEN '.PNG' ELSE '' END) AS file_name,
          source AS domain, lang AS topic, n_chars AS size
        FROM documents""",
}
# How the two engines spell what differs.
_SPARK = {
    r"epoch_seconds\((\w+)\)": r"unix_timestamp(\1)",
    r"TIMESTAMP '": "TIMESTAMP_NTZ '",
}
_DUCKDB = {r"epoch_seconds\((\w+)\)": r"epoch(\1)::bigint"}


def _spelled(sql: str, rules: dict[str, str]) -> str:
    for pattern, text in rules.items():
        sql = re.sub(pattern, text, sql)
    return sql


def _needed(sql: str) -> list[str]:
    """Views a query mentions, in an order in which each finds those it needs."""
    found: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE):
            for inner in _needed(VIEWS[name]) + [name]:
                if inner not in found:
                    found.append(inner)
    return found


def with_views(sql: str) -> str:
    """Comparison query with the views it mentions defined in front."""
    definitions = [f"{name} AS ({_spelled(VIEWS[name], _DUCKDB).strip()})" for name in _needed(sql)]
    body = sql.strip()
    if not definitions:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(definitions) + ",\n" + body[5:]
    return "WITH " + ",\n".join(definitions) + "\n" + body


class Data:
    """The test tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a query over tables and views, without registering any of them."""
        text = _spelled(text, _SPARK)
        names = {n for n in (*TABLES, *VIEWS) if re.search(rf"\b(FROM|JOIN)\s+{n}\b", text, re.IGNORECASE)}
        for name in names:
            text = re.sub(rf"\b(FROM|JOIN)\s+{name}\b", rf"\1 {{{name}}} AS {name}", text, flags=re.IGNORECASE)
        frames = {n: self.view(n) if n in VIEWS else self.table(n) for n in names}
        return self.spark.sql(text, **frames)

    def view(self, name: str) -> DataFrame:
        return self.sql(VIEWS[name])
