import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows
from lakemill.operators import conform as C
from lakemill.operators.lineage import metadata_last, with_extract_lineage


def test_variant_depends_on_names_only():
    assert C.detect_variant(["Trip_Pickup_DateTime", "tpep_pickup_datetime"]) == "legacy"
    assert C.detect_variant(["tpep_pickup_datetime"]) == "modern"
    assert C.detect_variant(["anything"]) == "intermediate"


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("x", "2024-13-01"), ("2.5", "2024-01-02 03:04:05")], "a string, b string")
    fields = C.layout("n double a 7\nt timestamp b\nnone double -")
    got = C.conform(df, fields).collect()
    assert got[0].n == 7.0 and got[0].t is None and got[0].none is None
    assert got[1].n == 2.5 and got[1].t.hour == 3


def test_missing_source_columns_are_named(spark):
    with pytest.raises(ValueError, match="Fare_Amt"):
        C.conform(spark.range(1), C.YELLOW_LEGACY)


def test_layout_sizes():
    sizes = [len(f) for f in (C.YELLOW_LEGACY, C.YELLOW_MODERN, C.YELLOW_INTERMEDIATE, C.GREEN, C.FHV, C.FHVHV)]
    assert sizes == [18, 18, 18, 18, 7, 24]


def test_type_rules_follow_file_order(spark):
    as_int = spark.createDataFrame([(1, 2)], "k int, v int")
    as_long = spark.createDataFrame([(2, 3)], "k int, v bigint")
    as_text = spark.createDataFrame([(3, "x")], "K int, v string")
    short = spark.createDataFrame([(4,)], "k int")
    assert dict(C.merge_schemas([as_int, as_long]).dtypes)["v"] == "double"
    merged = C.merge_schemas([as_int, as_long, as_text, short])
    assert merged.columns == ["k", "v"] and dict(merged.dtypes)["v"] == "string"
    assert rows(merged) == [(1, "2"), (2, "3"), (3, "x"), (4, None)]


def test_same_schemas_share_one_projection(spark):
    frames = [spark.createDataFrame([(i,)], "a int") for i in range(20)]
    merged = C.merge_schemas(frames)
    assert merged.count() == 20
    assert merged._jdf.queryExecution().analyzed().toString().count("Project") == 1


def test_strict_union_refuses_other_columns(spark):
    a, b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.union_all([a, b]).columns == ["a", "b"]
    with pytest.raises(Exception):
        C.union_all([a, b], strict=True).collect()


def test_clean_strings_keeps_other_types_and_tabs(spark):
    df = spark.createDataFrame([("  a ", 1), ("   ", 2), ("\t", 3), (None, 4)], "s string, n int")
    assert rows(C.clean_strings(df)) == sorted([("a", 1), (None, 2), ("\t", 3), (None, 4)], key=repr)


def test_normalize_renames_adds_and_casts(spark):
    df = spark.createDataFrame([("12", "x", 1)], "old string, bad string, extra int")
    out = C.normalize_to(df, StructType.fromDDL("new int, bad double, more string"), {"old": "new"})
    assert out.dtypes == [("new", "int"), ("bad", "double"), ("more", "string")]
    assert rows(out) == [(12, None, None)]


def test_metadata_goes_last(spark):
    marked = with_extract_lineage(spark.range(1), "public", "t").select("_source_table", "id", "_ingested_at", "_source_schema")
    assert metadata_last(marked).columns == ["id", "_source_schema", "_source_table", "_ingested_at"]
    assert metadata_last(spark.range(1).withColumn("x", F.lit(1))).columns == ["id", "x"]
