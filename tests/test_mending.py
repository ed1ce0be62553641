"""Cases the fixtures of the other tests never reach."""

import json
import math
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakemill.functions.labels import dataset_title, feature_title
from lakemill.functions.values import money_sum
from lakemill.operators import events as E
from lakemill.operators import histograms, sampling
from lakemill.plans import medallion
from lakemill.plans.ingest import bronze_key
from lakemill.plans.realtime import process_message, store_path
from lakemill.sinks.files import write_chunks
from lakemill.sources import inbox, listing
from lakemill.streaming import events as S


def total(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double").agg(money_sum("x").alias("t")).first().t


def test_money_sums_drop_nothing(spark):
    assert total(spark, 0.1, 0.2, None, -1.005) == -0.71
    assert total(spark, 8e18, 8e18) == 1.6e19
    assert total(spark, 1.0, 1e19) == 1e19 + 1
    assert math.isnan(total(spark, 1.0, float("nan"), 1e19, float("inf")))
    assert total(spark, 1.0, float("inf")) == float("inf")
    assert total(spark, None, None) is None and total(spark, float("-inf")) == float("-inf")


def test_listings_lose_no_file(spark, tmp_path):
    for i in range(4):
        spark.range(i, i + 3, 1, 1).write.parquet(f"{tmp_path}/f{i}.parquet")
    sample = listing.sample_schema(spark, f"{tmp_path}/*.parquet", files=4)
    assert sample.select("path").distinct().count() == 4
    (tmp_path / "bad.parquet").write_text("junk")
    with pytest.raises(ValueError, match="bad.parquet"):
        listing.frames_by_schema(spark, f"{tmp_path}/*.parquet")
    listed = listing.list_files(spark, f"{tmp_path}/*.parquet")
    assert [r.path.rsplit("/", 1)[1] for r in listing.unreadable_files(listed).collect()] == ["bad.parquet"]
    frames = listing.frames_by_schema(spark, f"{tmp_path}/*.parquet", skip_unreadable=True)
    assert sum(f.count() for f in frames) == 12


def lines(spark, *messages):
    return spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")


def test_rows_keep_unlisted_fields(spark, tmp_path):
    row = {"event_id": "a", "fare_amount": 2.5, "pickup_zone": "x", "tags": [1, 2]}
    message = {"message_type": "batch", "batch_id": "b", "rows": [row, {"event_id": "c"}]}
    applied = S.ingest_lines(lines(spark, message, {"message_type": "row", "row": dict(row, event_id="d")}), 0, str(tmp_path / "s"))
    extra = {r.event_id: r.extra and json.loads(r.extra) for r in applied.collect()}
    assert extra == {"a": {"pickup_zone": "x", "tags": "[1,2]"}, "c": None, "d": {"pickup_zone": "x", "tags": "[1,2]"}}
    parsed = E.parse_envelope(lines(spark, {"message_type": "row", "event_id": "e", "row": dict(row, event_id="e")})).first()
    process_message(spark, parsed, str(tmp_path / "m"))
    state = S.read_state(spark, f"{tmp_path}/m/rows", S.ROW_STATE).first()
    assert (state.event_id, state.fare_amount, json.loads(state.extra)["pickup_zone"]) == ("e", 2.5, "x")


def test_manifest_and_chunks_must_agree(spark, tmp_path):
    df = spark.range(0, 20, 1, 4).select(F.col("id").cast("string").alias("event_id"))
    write_chunks(df, str(tmp_path), "r", [F.col("event_id").cast("int")], 5)
    assert inbox.load_manifest(spark, str(tmp_path), "r").count() == 20
    (tmp_path / "r" / "chunk_index=3").rename(tmp_path / "elsewhere")
    with pytest.raises(ValueError, match="chunk 3 has 0 rows"):
        inbox.load_manifest(spark, str(tmp_path), "r", "event_id string")


def test_bronze_folders_of_two_domains_differ():
    file = lambda **more: SimpleNamespace(
        **{"domain": "d", "topic": "t", "source_name": "s", "source_uri": "u", "bucket": "b", "object_key": "k", "file_name": "x.csv"} | more
    )
    keys = [bronze_key("p", f) for f in (file(), file(domain="e"), file(topic="o"), file(source_name="z"), file(source_uri="v"), file(file_name="x.json"))]
    assert len(set(keys)) == 6


def test_generated_ids_follow_the_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("event_id,fare_amount\n" + "".join(f",{i}\n" for i in range(30)))
    got = {r.event_id: float(r.fare_amount) for r in inbox.inbox_rows(spark, str(tmp_path)).collect()}
    assert got == {f"a-row-{i + 1:04d}": float(i) for i in range(30)}


def test_a_repeated_file_message_charts_its_own_file(spark, tmp_path):
    files = {}
    for name, n in (("a", 3), ("b", 7)):
        spark.range(n).select(F.col("id").cast("double").alias("fare_amount")).write.parquet(f"{tmp_path}/{name}.parquet")
        meta = {"file_event_id": name, "source_path": f"{tmp_path}/{name}.parquet"}
        files[name] = E.parse_envelope(lines(spark, {"message_type": "file", "event_id": name, "metadata": meta})).first()
    state = str(tmp_path / "state")
    counts = [process_message(spark, files[n], state)[1].first().row_count for n in ("a", "b", "a")]
    assert counts == [3, 7, 3]
    assert store_path("s3://b/k") == "s3a://b/k" and store_path("file:/x") == "file:/x"


def test_cumulative_counts_agree_on_ties(spark):
    df = spark.range(130).select((F.col("id") % 3 * 10).cast("double").alias("v"), F.lit(1).alias("t"))
    built = E.cumulative_hist(df, "v", ["t"], 40.0)
    seen = {}
    for r in built.orderBy("row_count").collect():
        seen[r.bucket] = seen.get(r.bucket, 0) + 1
        assert r.bucket_count == seen[r.bucket]


def test_batches_are_deduplicated_with_equal_copies(spark):
    message = {"message_type": "batch", "batch_id": "b", "rows": [{"event_id": "a"}]}
    parsed = E.parse_envelope(lines(spark, message, message, dict(message, rows=[]), {"message_type": "row"}))
    state = spark.createDataFrame([], "batch_id string")
    assert sorted(r.message_type for r in E.new_batches(parsed, state).collect()) == ["batch", "row"]


def test_a_sample_never_is_the_whole_table(spark):
    df = spark.range(2000).select(F.when(F.col("id") == 7, F.repeat(F.lit("x"), 100_000)).otherwise(F.lit("y")).alias("c"))
    size = sampling.json_bytes(df)
    assert sampling.sample_to_bytes(df, size // 2, 42).count() < 2000


def test_rows_of_other_topics_are_kept_apart(spark):
    df = spark.createDataFrame([("t", 1), ("o", 2), (None, 3)], "topic string, v int")
    assert [(r.topic, json.loads(r.row)["v"]) for r in medallion.stray_rows([df], "t").collect()] == [("o", 2)]
    assert medallion.stray_rows([df.drop("topic")], "t") is None


def test_nan_in_fixed_histograms(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (5.0,)], "v double")
    assert histograms.fixed_histogram(df, "v").agg(F.sum("cnt")).first()[0] == 3  # NaN in the open bucket
    assert histograms.compare_histograms(df, df, "v").agg(F.sum("before_cnt")).first()[0] == 3


def test_titles(spark):
    df = spark.createDataFrame([("mta_tax",), ("tolls_amount",), ("fare_amount",)], "f string")
    assert rows(df.select(feature_title(F.col("f")))) == [("Fare Amount",), ("MTA Tax",), ("Toll Charges",)]
    assert df.select(dataset_title(F.lit("fhv_trip"))).first()[0] == "For-Hired Vehicle (FHV) Trips"


def test_the_profiling_run_makes_each_chart_once(spark, tmp_path):
    from lakemill.plans.charts import profile_dataset

    df = spark.range(2000).select((F.col("id") % 50).cast("double").alias("trip_duration_minutes"), F.lit("x").alias("other"))
    df = df.union(spark.createDataFrame([*[(100.0, "tail")] * 300, (900.0, "far"), (float("nan"), "bad")], df.schema))
    root = f"{tmp_path}/charts"
    assert profile_dataset(df, "fhv_trip", root, relative_error=0.0, mode="hard_cap") == ["inrange/trip_duration_minutes", "peak/trip_duration_minutes"]
    assert profile_dataset(df, "fhv_trip", root, mode="hard_cap") == []
    chart = spark.read.parquet(f"{root}/latest/fhv_trip/inrange")
    first = chart.first()
    assert chart.agg(F.sum("cnt")).first()[0] >= 1990 and first.feature_title == "Trip Duration" and first.raw_max == 900.0
    assert profile_dataset(df, "fhv_trip", root, overwrite=True) != []


def test_requests_land_before_the_ledger_says_so(spark, tmp_path):
    from lakemill.config import Domain, Registry
    from lakemill.plans.ingest import land_requests

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x\n1\n")
    fields = "job_id string, source_type string, source_uri string, source_name string, domain string, topic string, file_name string, file_type string"
    asked = [("j", "file", f"file://{tmp_path}/in/{n}", "s", d, "t", n, "csv") for n, d in (("a.csv", "d"), ("gone.csv", "d"), ("b.csv", "none"))]
    land_requests(spark, spark.createDataFrame(asked, fields), Registry((Domain("d"),)), f"file://{tmp_path}/lake", f"{tmp_path}/ledger")
    done = {r.file_name: r for r in spark.read.parquet(f"{tmp_path}/ledger").collect()}
    assert {n: r.status for n, r in done.items()} == {"a.csv": "landed", "gone.csv": "error", "b.csv": "error"}
    assert (tmp_path / "lake" / done["a.csv"].bucket / done["a.csv"].object_key).read_text() == "x\n1\n"


def test_trip_files_become_tables(spark, tmp_path):
    from lakemill.checks import trips as T
    from lakemill.plans.fixtures import Data

    d = Data(spark, "/root/testdata/sf0.001")
    d.sql(T.LEGACY).coalesce(1).write.parquet(f"{tmp_path}/yellow_tripdata_2009-01.parquet")
    d.sql(T.MODERN).coalesce(1).write.parquet(f"{tmp_path}/yellow_tripdata_2024-01.parquet")
    d.sql(T.FHV).coalesce(1).write.parquet(f"{tmp_path}/fhv_tripdata_2024-01.parquet")
    written = medallion.trips_from_files(spark, str(tmp_path), "filed")
    assert {"silver_filed.yellow_taxi", "silver_filed.fhv_trip", "gold_filed.yellow_taxi_tips"} <= set(written)
    assert spark.read.table("silver_filed.yellow_taxi").count() > 0


def test_sample_marts(spark):
    from lakemill.checks.hospital import encounters
    from lakemill.plans.fixtures import Data

    d = Data(spark, "/root/testdata/sf0.001")
    encounters(d).write.mode("overwrite").saveAsTable("encounter_extract")
    written = medallion.write_sample_marts(spark, "encounter_extract", "extract")
    assert len(written) == 4 and all(spark.read.table(t).count() for t in written)
