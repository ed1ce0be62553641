"""Whole runs on the test tables, and the registered jobs beside DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakemill.checks import trips as T
from lakemill.config import Domain
from lakemill.plans import medallion
from lakemill.plans.fixtures import TABLES, Data

FOLDER = "/root/testdata/sf0.001"


def test_trip_run(spark):
    d = Data(spark, FOLDER)
    frames = {"yellow": [d.sql(T.LEGACY), d.sql(T.MODERN), d.sql(T.INTERMEDIATE)], "green": [d.sql(T.GREEN)],
              "fhv": [d.sql(T.FHV)], "fhvhv": [d.sql(T.FHVHV)]}
    for family, parts in frames.items():
        medallion.write_trip_silver(family, parts, "taxi")
    written = medallion.write_trip_gold(spark, "taxi")
    assert len(written) == 10 and "gold_taxi.yellow_taxi_tips" in written and "gold_taxi.fhv_trip_summary" in written
    assert spark.read.table("gold_taxi.yellow_taxi_tips").count() == spark.read.table("silver_taxi.yellow_taxi").count() > 0


def test_domain_run_keeps_topics_apart(spark):
    d = Data(spark, FOLDER)
    domain = Domain("finance", topics={"finance": ("finance_silver", "finance_summary")})
    other = d.view("finance").withColumn("topic", T.F.lit("another"))
    written = medallion.write_domain({"finance": [d.view("finance"), other]}, domain)
    assert written == ["silver_finance.finance_silver", "gold_finance.finance_summary"]
    assert spark.read.table(written[0]).count() == d.table("orders").count()
    strays = spark.read.table("bronze_finance.finance_silver_quarantine")
    assert strays.count() == other.count() and strays.select("topic").distinct().collect() == [("another",)]


def test_hospital_run(spark):
    d = Data(spark, FOLDER)
    raw = {"tb_patientrecord": d.view("encounters"), "tb_invoice": d.view("invoices"), "tb_bed": d.view("beds"),
           "tb_department": d.view("departments")}
    written = medallion.write_hospital(spark, raw, "clinic")
    assert len(written) == 4
    assert spark.read.table("silver_clinic.tb_invoice_silver").count() == d.view("invoices").select("invoiceid").distinct().count()


def test_entry(spark):
    got = entry(spark)
    assert got.count() > 0 and got.columns == ["domain", "vendor_id", "trip_count", "total_fees", "total_amount"]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


@pytest.mark.parametrize(
    "name", ["conform_yellow", "gold_trip_financials", "mart_daily_diagnosis", "kpi_cards", "dq_rule_metrics", "relay_envelope"]
)
def test_jobs_beside_duckdb(spark, db, name):
    got = queries()[name](spark, FOLDER)
    truth = db.execute(oracle_sql()[name])
    names = [c[0] for c in truth.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    left = sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr)
    right = sorted((tuple(r[names.index(c)] for c in order) for r in truth.fetchall()), key=repr)
    assert left == right


def test_every_oracle_has_a_job():
    assert set(oracle_sql()) <= set(queries()) and len(queries()) >= 140
