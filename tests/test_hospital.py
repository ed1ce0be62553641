import json

from pyspark.sql import functions as F

from conftest import rows
from lakemill.functions import labels as L
from lakemill.operators import enrich, marts, payload


def test_short_currency(spark):
    data = [(None,), (999_999.9,), (1_000_000.0,), (1_234_567.0,), (2_345_678_901.0,), (-12_345.0,), (1_005_000.0,)]
    got = [r.t for r in spark.createDataFrame(data, "x double").select(L.short_currency(F.col("x")).alias("t")).collect()]
    assert got == ["0 VND", "999.999 VND", "1.00 triệu", "1.23 triệu", "2.35 tỷ", "-12.345 VND", "1.01 triệu"]


def test_labels(spark):
    df = spark.createDataFrame([(None,), ("invoice_type_7",), (" other ",)], "b string")
    assert [r.t for r in df.select(L.finance_bucket_label(F.col("b")).alias("t")).collect()] == [
        "Không xác định", "Nhóm hóa đơn 7", "other"
    ]
    units = spark.createDataFrame([("bcf",), ("wait_minutes",), ("x_seconds",), ("toll_x",), ("zzz",)], "f string")
    assert [r.u for r in units.select(L.feature_unit(F.col("f")).alias("u")).collect()] == [
        "USD", "minutes", "seconds", "USD", "value"
    ]
    assert spark.range(1).select(L.load_color(F.lit(85.0)).alias("c")).first().c == L.COLOR_CRITICAL


BED = "bedid int, departmentid int, is_disabled_bed boolean, is_occupied_bed boolean"
DEPT = "departmentid int, departmentcode string, departmentname string, sogiuongkehoach int, sogiuongthucke int"


def test_occupancy_edges(spark):
    beds = spark.createDataFrame([(1, 1, False, True), (2, 1, False, True), (3, 1, True, True), (4, 2, True, True), (5, None, False, False)], BED)
    depts = spark.createDataFrame([(1, "A", "a", 5, 6), (2, "B", "b", 1, 1)], DEPT)
    got = {r.departmentid: r for r in marts.bed_occupancy(beds, depts).collect()}
    assert got[1].occupancy_ratio == 1.5 and got[1].available_bed_count == 2  # above one is kept
    assert got[2].occupancy_ratio is None and got[None].departmentname is None
    twice = marts.bed_occupancy(beds, depts.union(depts.filter("departmentid = 1")))
    plain = beds.join(depts.union(depts.filter("departmentid = 1")), "departmentid", "left").groupBy("departmentid").count()
    assert {r.departmentid: r["count"] for r in plain.collect()} == {
        r.departmentid: r.configured_bed_count for r in twice.collect()
    }


def test_pathway_without_sheets(spark):
    paths = spark.createDataFrame([(1, "m", "n", "l", 1, 5), (2, "m", "o", "l", 1, 5)], "phacdodieutriid int, maphacdo string, tenphacdo string, listmabenhicd10 string, dm_phacdogroupid int, songaydieutri int")
    sheets = spark.createDataFrame([(10, 1, 1), (11, 1, 1), (None, 1, 2)], "phacdodieutri_phieudieutriid int, phacdodieutriid int, ngaydieutriphacdo int")
    got = rows(marts.clinical_pathway(paths, sheets).select("phacdodieutriid", "pathway_sheet_count", "distinct_protocol_day_count"))
    assert got == [(1, 2, 2), (2, 0, 0)]


def test_silver_source_cleans_and_dedupes(spark):
    raw = spark.createDataFrame([(1, " x "), (1, "x"), (None, "y"), (2, " ")], "bedid int, listmedicalrecordid string").withColumn("beddisable", F.lit(1))
    got = rows(enrich.silver_source("tb_bed", raw).select("bedid", "is_disabled_bed", "is_occupied_bed"))
    assert got == [(1, True, True), (2, True, False)]


def test_dates_in_text_that_do_not_parse(spark):
    df = spark.createDataFrame([("bad", "2024-02-03 10:00:00")], "treatmentdate string, checkin_time string").withColumns(
        {"end_treatmentdate": F.lit(None).cast("string"), "iscapcuu": F.lit(None).cast("int"), "thongtincanhbaoxn": F.lit("!")}
    )
    got = enrich.enrich("tb_treatment", df).first()
    assert got.treatment_date_only is None and str(got.checkin_date) == "2024-02-03"
    assert got.is_emergency_treatment is False and got.has_alert_text is True


def test_empty_latest_totals(spark):
    empty = spark.createDataFrame([], "d date, n bigint")
    assert marts.latest_totals(empty, "d", ["n"]).first().n is None


def test_screen_document(spark):
    from lakemill.checks.hospital import gold
    from lakemill.plans.fixtures import Data

    doc = json.loads(payload.screen_payload(gold(Data(spark, "/root/testdata/sf0.001"))).first().payload)
    kinds = [[c["type"] for c in r["components"]] for r in doc["rows"]]
    assert kinds == [["KpiCard"] * 4, ["ProgressList", "ChartPie"], ["FlowPipeline", "ProgressList"]]
    beds = doc["rows"][1]["components"][0]["props"]
    assert len(beds["items"]) <= 10 and beds["maxValue"] == 100
    values = [i["value"] for i in beds["items"]]
    assert values == sorted(values, reverse=True)
    assert doc["rows"][2]["components"][1]["props"]["maxValue"] == doc["rows"][2]["components"][1]["props"]["items"][0]["value"]
