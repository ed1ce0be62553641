import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows
from lakemill.config import Domain, Registry, SourceConfig, children_query
from lakemill.functions.values import file_extension, file_name, file_stem, url_file_name
from lakemill.operators import ledger
from lakemill.plans.ingest import ingest_files
from lakemill.sinks.files import write_chunks, write_single, write_snapshot
from lakemill.sinks.tables import ensure_table, write_layer
from lakemill.sources import inbox, jdbc, listing, readers


def test_names(spark):
    names = ["a/b.CSV", "x.tar.gz", "plain", ".hidden", "dir/"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, p string")
    name = file_name(F.col("p"))
    got = df.select(name.alias("n"), file_extension(name).alias("e"), file_stem(name).alias("s"), "i").orderBy("i").collect()
    assert [(r.n, r.e, r.s) for r in got] == [
        ("b.CSV", "csv", "b"), ("x.tar.gz", "gz", "x.tar"), ("plain", "unknown", "plain"), (".hidden", "unknown", ".hidden"),
        ("", "unknown", ""),
    ]
    url = spark.range(1).select(url_file_name(F.lit("https://h/a/f.json?x=1#top")).alias("u")).first().u
    assert url == "f.json"


def test_family_takes_the_longest_prefix(spark):
    names = ["fhv_tripdata_1.parquet", "FHVHV_tripdata_1.parquet", "yellow_tripdata_x", "zones.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.f for r in df.select("n", listing.classify_family(F.col("n")).alias("f")).collect()}
    assert list(got.values()) == ["fhv", "fhvhv", "yellow", "other"]


def test_csv_is_all_text_and_types_are_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,d\n1,2024-01-01\n")
    (tmp_path / "empty.csv").write_text("n,d\n")
    assert {t for _, t in readers.read_any(spark, str(tmp_path / "a.csv"), "csv").dtypes} == {"string"}
    with pytest.raises(ValueError, match="Unsupported"):
        readers.read_any(spark, "x", "avro")
    with pytest.raises(ValueError, match="empty"):
        readers.read_any(spark, str(tmp_path / "empty.csv"), "csv", require_rows=True)


def test_rows_that_do_not_parse_are_split_off(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    good, bad = readers.split_corrupt(spark, str(tmp_path / "a.json"), StructType.fromDDL("a int"))
    assert rows(good) == [(1,), (3,)] and bad.count() == 1 and bad.first().value == '{"a": '


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", query="select 1", user="u", password="")
    assert plain == {"url": "jdbc:x", "fetchsize": "1000", "user": "u", "query": "select 1"}
    split = jdbc.jdbc_options("jdbc:x", query="select 1", partition=("id", 0, 100, 4))
    assert split["dbtable"] == "(select 1) extract" and split["numPartitions"] == "4" and "query" not in split
    assert jdbc.jdbc_options("jdbc:x", dbtable="s.t")["dbtable"] == "s.t"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x")


def test_extract_needs_its_key(spark):
    source = SourceConfig("t", "public", "id")
    assert jdbc.extract_source(spark.range(1), source).first()._source_schema == "public"
    with pytest.raises(ValueError, match="id"):
        jdbc.extract_source(spark.range(1).withColumnRenamed("id", "x"), source)
    assert "ORDER BY k LIMIT 5" in children_query("c", "p", "k", 5)


def test_registry_document(spark):
    text = json.dumps({"default_domain": "taxi", "domains": {"hr": {"raw_prefix": "in/hr", "topics": {"hr": {"gold_table": "g"}}},
                                                             "off": {"enabled": False}}})
    registry = Registry.from_json(text)
    assert registry.default_domain == "taxi" and registry.domains[0].topics == {"hr": ("hr_silver", "g")}
    assert [r.domain for r in registry.frame(spark).collect()] == ["hr"]


SOURCES = "source_type string, source_uri string, source_name string, domain string, topic string"


def test_requests_defaults_and_unknown_domains(spark):
    registry = Registry((Domain("taxi"),), "taxi", "general")
    df = spark.createDataFrame([("url", "s3a://x/a.PARQUET", "n", None, "")], SOURCES)
    got = ledger.plan_requests(df, registry).first()
    assert (got.domain, got.topic, got.file_name, got.file_type) == ("taxi", "general", "a.PARQUET", "parquet")
    wrong = spark.createDataFrame([("url", "s3a://x/a", "n", "nope", "t")], SOURCES)
    with pytest.raises(Exception, match="not registered"):
        ledger.plan_requests(wrong, registry).collect()
    resolved = ledger.resolve(ledger.plan_requests(wrong, registry, strict=False), registry).first()
    assert resolved.status == "error" and resolved.bucket is None and "nope" in resolved.error_message


KEYS = dict(domain="d", topic="t", source_name="s", source_uri="u", bucket="raw", object_key="k")
RAW = "job_id string, domain string, topic string, source_name string, source_uri string, bucket string, object_key string, file_name string, file_type string, status string"


def landed(spark, *names):
    data = [("j", *KEYS.values(), n, n.rsplit(".", 1)[1], "landed") for n in names]
    return spark.createDataFrame(data, RAW)


def test_failed_files_are_retried_until_the_limit(spark):
    raw = landed(spark, "a.csv", "b.csv", "c.txt")
    done = raw.withColumnsRenamed({"bucket": "raw_bucket", "object_key": "raw_object_key"})
    tried = done.filter("file_name = 'a.csv'").withColumn("status", F.lit("error"))
    assert ledger.unprocessed(raw, tried).count() == 2
    assert [r.file_name for r in ledger.unprocessed(raw, tried.union(tried), 2).collect()] == ["b.csv"]
    ok = done.filter("file_name = 'b.csv'").withColumn("status", F.lit("success"))
    assert [r.file_name for r in ledger.unprocessed(raw, ok).collect()] == ["a.csv"]


def test_a_bad_file_does_not_stop_the_run(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "good.csv").write_text("a\n1\n")
    (raw / "good.json").write_text('[{"a": 1}, {"a": 2}]')
    (raw / "bad.parquet").write_text("not parquet")
    names = ["good.csv", "good.json", "bad.parquet", "gone.csv"]
    files = landed(spark, *names).withColumn("object_key", F.col("file_name"))
    ingest_files(spark, files, f"file://{tmp_path}", f"{tmp_path}/ledger", parallel=2)
    done = {r.file_name: r for r in spark.read.parquet(f"{tmp_path}/ledger").collect()}
    assert {n: r.status for n, r in done.items()} == {
        "good.csv": "success", "good.json": "success", "bad.parquet": "error", "gone.csv": "error"
    }
    assert done["bad.parquet"].error_message
    assert len(list((tmp_path / "error" / "d" / "t").glob("*/*/bad.parquet"))) == 1
    # Same stem, other extension: two folders.
    assert spark.read.parquet(f"{tmp_path}/bronze/lakehouse/d/t/*/*/good.json.parquet").count() == 2
    ledger_df = spark.read.parquet(f"{tmp_path}/ledger")
    assert sorted(r.file_name for r in ledger.unprocessed(files, ledger_df).collect()) == ["bad.parquet", "gone.csv"]


def test_catalog_rerun_adds_nothing_and_keeps_bad_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    (tmp_path / "yellow_tripdata_bad.parquet").write_text("junk")
    files = listing.list_files(spark, f"{tmp_path}/*.parquet")
    rows_ = listing.catalog_files(files)
    assert rows_.count() == files.count() and rows_.filter("schema_json is null").count() == 1
    assert listing.catalog_files(files, rows_).count() == 0
    found = {r.family: r for r in listing.schema_inventory(files).collect()}
    assert found["yellow"].read_error and found["other"].schema_json
    assert listing.list_files(spark, f"{tmp_path}/none*").count() == 0


def test_files_are_read_once_per_schema(spark, tmp_path):
    for i in range(3):
        spark.range(2).coalesce(1).write.parquet(f"{tmp_path}/a{i}")
    spark.range(2).withColumn("x", F.lit("t")).coalesce(1).write.parquet(f"{tmp_path}/b")
    frames = listing.frames_by_schema(spark, f"{tmp_path}/*/*.parquet")
    assert sorted(f.count() for f in frames) == [2, 6]


def test_domain_rules_by_priority(spark):
    rules = [(2, "a", "second"), (1, "ab", "first")]
    files = spark.createDataFrame([("ab", None), ("a", None), ("zz", None), ("ab", "own")], "file_name string, domain string")
    got = [r.domain for r in listing.assign_domain(files, rules).collect()]
    assert got == ["first", "second", "unassigned", "own"]


def test_mime_and_extension(spark):
    data = [("image/png", "x.csv"), (None, "x.MP3"), ("text/plain", "x.mkv"), ("application/json; q=1", "x"), ("", "x.doc")]
    df = spark.createDataFrame(data, "m string, n string")
    got = [r.k for r in df.select(listing.classify_mime(F.col("m"), F.col("n")).alias("k")).collect()]
    assert got == ["images", "audio", "video", "structured", "other"]


def test_chunks_manifest_and_load(spark, tmp_path):
    df = spark.range(0, 25, 1, 4).select(F.col("id").cast("string").alias("event_id"))
    manifest = write_chunks(df, str(tmp_path), "r1", [F.col("event_id").cast("int")], 10)
    assert rows(manifest) == [(1, "r1/chunk_index=1", 10), (2, "r1/chunk_index=2", 10), (3, "r1/chunk_index=3", 5)]
    loaded = inbox.load_manifest(spark, str(tmp_path), "r1", "event_id string, source_row_index bigint")
    assert loaded.filter("source_row_index = cast(event_id as int) + 1").count() == 25
    spark.createDataFrame([], "chunk_index int").write.json(f"{tmp_path}/r2.manifest")
    with pytest.raises(ValueError, match="chunk"):
        inbox.load_manifest(spark, str(tmp_path), "r2", "event_id string")


def test_single_file_and_snapshot_are_replaced(spark, tmp_path):
    target = f"{tmp_path}/out/one.parquet"
    for n in (5, 7):
        write_single(spark.range(0, n, 1, 3), target)
    assert (tmp_path / "out" / "one.parquet").is_file() and spark.read.parquet(target).count() == 7
    write_snapshot(spark.range(1).select(F.lit("é").alias("a"), F.lit(None).cast("int").alias("b")), f"{tmp_path}/s.json")
    assert (tmp_path / "s.json").read_text("utf-8") == '{"a":"é","b":null}\n'


def test_tables(spark):
    ensure_table(spark, "layer_t.x", "id bigint")
    ensure_table(spark, "layer_t.x", "id bigint")
    write_layer(spark.range(2), "layer_t.x", "append")
    write_layer(spark.range(3), "layer_t.x", "append")
    assert readers.read_table(spark, "layer", "t", "x").count() == 5
    write_layer(spark.range(1).withColumn("y", F.lit(1)), "layer_t.x")
    assert spark.read.table("layer_t.x").columns == ["id", "y"]
    assert readers.run_if_exists(spark, "layer_t.none", lambda df: df) is None
    assert readers.run_if_exists(spark, "layer_t.x", lambda df: df).count() == 1
    with pytest.raises(ValueError):
        write_layer(spark.range(1), "layer_t.x", "merge")


def test_inbox_documents(spark, tmp_path):
    (tmp_path / "seed.json").write_text(json.dumps({"event_type": "x", "rows": [{"event_id": "a", "fare_amount": 1.5}, {"trip_id": "t2"}, {"fare_amount": 3}]}))
    (tmp_path / "more.csv").write_text("event_id,fare_amount\nc,2.5\n")
    got = inbox.inbox_rows(spark, str(tmp_path), ["event_id", "trip_id"])
    ids = {(r.source_file_name, r.event_id, r.event_type) for r in got.collect()}
    assert ("more.csv", "c", "batch_seed") in ids and ("seed.json", "a", "batch_seed") in ids and ("seed.json", "t2", "batch_seed") in ids
    made = [e for f, e, _ in ids if f == "seed.json" and e not in ("a", "t2")]
    assert len(made) == 1 and made[0].startswith("seed-row-000")
    with pytest.raises(ValueError):
        inbox.inbox_rows(spark, str(tmp_path / "none"))
