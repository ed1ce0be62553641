from pyspark.sql import functions as F

from conftest import rows
from lakemill.operators import dedupe as D
from lakemill.operators.numbering import with_row_index


def test_numbers_are_consecutive_over_partitions(spark):
    df = spark.range(0, 5000, 1, 13).withColumn("key", (F.col("id") * 7919) % 5000)
    got = with_row_index(df, ["key"]).collect()
    assert sorted(r.row_index for r in got) == list(range(1, 5001))
    assert all(r.row_index == r.key + 1 for r in got)


def test_numbers_restart_for_groups_even_a_hot_or_null_one(spark):
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id") % 50))
    df = spark.range(0, 6000, 1, 9).withColumn("g", group)
    got = with_row_index(df, ["id"], ["g"])
    check = got.groupBy("g").agg(F.count("*").alias("n"), F.min("row_index").alias("a"), F.max("row_index").alias("b"),
                                 F.countDistinct("row_index").alias("d"))
    assert check.filter("a <> 1 or b <> n or d <> n").count() == 0
    assert rows(got.filter("g = 'hot'").orderBy("row_index").limit(2).select("id", "row_index")) == [(0, 1), (3, 2)]


def test_dedupe_order_decides(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 9)], "k int, v string, o int")
    assert rows(D.dedupe(df, ["k"], ["o"])) == [(1, "b", 1), (2, "c", 9)]
    assert rows(D.dedupe(df, ["k"], [F.desc("o")])) == [(1, "a", 2), (2, "c", 9)]


def test_dedupe_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    plan = D.dedupe(df, ["k"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_null_key_parts_match_nothing(spark):
    left = spark.createDataFrame([(1, "a"), (None, "a"), (2, "b")], "k int, s string")
    known = spark.createDataFrame([(1, "a"), (None, "a")], "k int, s string")
    assert rows(D.not_in(left, known, {"k": "k", "s": "s"})) == sorted([(None, "a"), (2, "b")], key=repr)


def test_new_events_reuse_the_partitioning(spark):
    from lakemill.operators.events import new_events

    df = spark.range(100).select(F.col("id").cast("string").alias("event_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = new_events(df, df.filter("event_id < '5'"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.split("LeftAnti")[1].count("Exchange hashpartitioning") <= 2  # one per side


def test_children_of_first_parents(spark):
    child = spark.createDataFrame([(1, 10), (1, 20), (2, 30), (3, 40)], "x int, k int")
    parent = spark.createDataFrame([(20,), (10,), (30,)], "k int")
    assert rows(D.children_of(child, parent, "k", 2).select("k")) == [(10,), (20,)]


def test_equal_rows_are_spread(spark):
    """A third of the rows are copies; numbering must not put them in one task."""
    from lakemill.operators.numbering import spread

    copies = spark.range(3000).select((F.col("id") % 3 == 0).alias("hot"), "id").select(F.when(~F.col("hot"), F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = spread(copies, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.filter("k is null").select("_part").distinct().count() > 1
    got = with_row_index(copies, ["k"])
    assert got.agg(F.countDistinct("row_index").alias("n"), F.max("row_index").alias("m")).first() == (3000, 3000)


def test_null_keys_are_spread_over_the_join(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    known = spark.range(0, 4000, 4).select(F.col("id").alias("k"))
    assert D.not_in(df, known, {"k": "k"}).count() == 3000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = D.not_in(df, known, {"k": "k"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_spread" in plan.split("hashpartitioning", 1)[1].split(")")[0]
