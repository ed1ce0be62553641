"""Reconciliation of whole rows."""

from pyspark.sql import functions as F

from lakemill.operators.reconcile import reconcile, reconcile_bins
from tests.conftest import rows

SCHEMA = "k string, a double, b string, `c.d` int"


def test_every_kind_of_difference(spark):
    truth = [("same", 1.0, "x", 1), ("zero", 0.0, None, 1), ("gone", 1.0, "x", 1), ("twice", 2.0, "y", 1), ("less", 1.0, "x", 1),
             ("less", 2.0, "x", 1), ("value", 1.0, "x", 1), ("null", None, "x", 1), (None, 1.0, "x", 1), ("swap", 1.0, "p", 1),
             ("swap", 2.0, "q", 1), ("nan", float("nan"), "x", 1), ("dotted", 1.0, "x", 5)]
    built = [("same", 1.0, "x", 1), ("zero", -0.0, None, 1), ("new", 1.0, "x", 1), ("twice", 2.0, "y", 1), ("twice", 2.0, "y", 1),
             ("less", 1.0, "x", 1), ("value", 1.5, "z", 1), ("null", 0.0, "x", 1), (None, 1.0, "w", 1), ("swap", 1.0, "q", 1),
             ("swap", 2.0, "p", 1), ("nan", float("nan"), "x", 1), ("dotted", 1.0, "x", 6)]
    got = reconcile(spark.createDataFrame(truth, SCHEMA), spark.createDataFrame(built, SCHEMA), "k")
    assert {r.key: (r.truth_rows, r.built_rows, r.status, r.changed) for r in got.collect()} == {
        "gone": (1, 0, "missing", None), "new": (0, 1, "extra", None), "twice": (1, 2, "duplicate", None),
        "less": (2, 1, "short", None), "value": (1, 1, "changed", "a,b"), "null": (1, 1, "changed", "a"),
        None: (1, 1, "changed", "b"), "swap": (2, 2, "changed", ""), "dotted": (1, 1, "changed", "c.d"),
    }
    only = reconcile(spark.createDataFrame(truth, SCHEMA), spark.createDataFrame(built, SCHEMA), "k", ["b"])
    assert {r.key for r in only.collect() if r.status == "changed"} == {"value", None}


def test_equal_tables_meet_in_fingerprints_only(spark):
    one = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 1.5).alias("a"))
    two = one.repartition(7, "a")
    found = reconcile(one, two, "k")
    assert found.count() == 0
    changed = two.withColumn("a", F.when(F.col("k") == "777", 0.0).otherwise(F.col("a")))
    assert rows(reconcile(one, changed, "k").select("key", "status", "changed")) == [("777", "changed", "a")]
    assert reconcile(one.limit(0), two.limit(0), "k").count() == 0
    assert reconcile(one, two.limit(0), "k").where("status = 'missing'").count() == 20_000


def test_other_types_and_bins(spark):
    one = spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert reconcile(one, spark.createDataFrame([("1", "2.0")], "k string, v string"), "k").count() == 0
    assert reconcile(one, spark.createDataFrame([("1", "two")], "k string, v string"), "k").first().changed == "v"
    bins = lambda *c: spark.createDataFrame(list(enumerate(c)), "bucket int, cnt bigint")
    assert rows(reconcile_bins(bins(1, 2, 3), bins(1, 5))) == [(1, 2, 5), (2, 3, 0)]
