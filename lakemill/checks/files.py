"""Sources, sinks, ledgers and the file catalog."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.checks.hospital import gold
from lakemill.checks.registry import job
from lakemill.checks.trips import LEGACY, VENDOR_SQL, vendor_summary
from lakemill.config import Domain, Registry
from lakemill.operators import ledger, payload
from lakemill.operators.conform import detect_variant
from lakemill.operators.dedupe import distinct_keys
from lakemill.plans.ingest import ingest_files
from lakemill.session import scratch_path
from lakemill.sinks import files as sink_files
from lakemill.sinks import tables as sink_tables
from lakemill.sources import listing, readers

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ORDERS_SQL = f"SELECT {ORDERS} FROM orders"
EVENTS_SQL = "SELECT event_id, user_id, event_type, value FROM events"
EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"
DOMAINS = tuple(f"src{i}" for i in range(10))
REGISTRY = Registry(tuple(Domain(n) for n in DOMAINS), default_domain="src0")
REGISTERED = "(" + ", ".join(f"'{n}'" for n in DOMAINS) + ")"
EXTENSION = r"coalesce(nullif(lower(regexp_extract({}, '[^.].*\.([^.]+)$', 1)), ''), 'unknown')"
KIND = EXTENSION.format("file_name")


def events(d):
    return d.sql(EVENTS_SQL)


def typed_orders(df):
    kinds = ("bigint", "bigint", "string", "double", "timestamp_ntz", "string")
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in zip(ORDERS.split(", "), kinds)])


def raw_ledger(d):
    """Landed files: every document, those of src3 failed to land."""
    return d.view("files").select(
        F.col("doc_id").cast("string").alias("job_id"),
        "domain",
        "topic",
        F.lit("docs").alias("source_name"),
        F.concat(F.lit("s3a://in/"), "file_name").alias("source_uri"),
        F.lit("raw").alias("bucket"),
        F.concat(F.lit("lakehouse/"), "domain", F.lit("/"), "file_name").alias("object_key"),
        "file_name",
        listing.file_extension(F.col("file_name")).alias("file_type"),
        F.when(F.col("domain") == "src3", "error").otherwise("landed").alias("status"),
    )


def bronze_ledger(d):
    """Files that have been tried: labelled documents, good ones with success."""
    tried = d.table("labels").select(F.col("doc_id").cast("string").alias("job_id"), "quality")
    done = raw_ledger(d).drop("status").join(tried, "job_id")
    return done.withColumnsRenamed({"bucket": "raw_bucket", "object_key": "raw_object_key"}).withColumn(
        "status", F.when(F.col("quality") == 1, "success").otherwise("error")
    )


LEDGER_SQL = f"""ledger AS (SELECT *, {KIND} AS file_type, CASE WHEN domain = 'src3' THEN 'error' ELSE 'landed' END AS status
  FROM files)"""
OPEN = """status = 'landed' AND file_type IN ('json', 'csv', 'xml', 'parquet')
  AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"""


@job("scan_parquet", ORDERS_SQL)
def _(d):
    path = scratch_path(d.spark, "scan-parquet")
    sink_tables.to_bronze(d.sql(ORDERS_SQL), path)
    return readers.read_any(d.spark, path, "parquet")


def write_documents(df: DataFrame, path: str, order, size=50_000, wrap=False) -> None:
    """JSON documents of at most ``size`` rows, one per file."""
    chunked = sink_files.with_chunks(df, order, size, unique=True)
    columns = [c for c in df.columns]
    documents = chunked.groupBy("chunk_index").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    text = F.to_json(F.struct("rows")) if wrap else F.to_json("rows")
    documents.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


@job("scan_json_multiline", EVENTS_SQL)
def _(d):
    path = scratch_path(d.spark, "scan-json")
    write_documents(events(d), path, ["event_id"])
    return readers.read_any(d.spark, path, "json", schema=EVENT_SCHEMA)


@job("scan_jsonl_paths", EVENTS_SQL)
def _(d):
    path = scratch_path(d.spark, "scan-jsonl")
    events(d).write.partitionBy("event_type").option("ignoreNullFields", False).json(path)
    return readers.read_jsonl(d.spark, path, EVENT_SCHEMA).select("event_id", "user_id", "event_type", "value")


@job("scan_csv_header", ORDERS_SQL)
def _(d):
    path = scratch_path(d.spark, "scan-csv")
    d.sql(ORDERS_SQL).write.option("header", True).csv(path)
    return typed_orders(readers.read_any(d.spark, path, "csv"))


@job("scan_xml_rowtag", ORDERS_SQL)
def _(d):
    path = scratch_path(d.spark, "scan-xml")
    d.sql(ORDERS_SQL).write.format("xml").option("rowTag", "order").option("rootTag", "orders").save(path)
    text = ", ".join(f"{c} string" for c in ORDERS.split(", "))
    return typed_orders(readers.read_any(d.spark, path, "xml", "order", text))


@job("read_by_file_type", "SELECT kind, event_id, value FROM (VALUES ('csv'), ('json'), ('parquet'), ('xml')) k(kind), events")
def _(d):
    schema = "event_id bigint, value double"
    rows = d.sql("SELECT event_id, value FROM events")
    parts = []
    for kind in ("csv", "json", "parquet", "xml"):
        path = scratch_path(d.spark, f"by-type-{kind}")
        if kind == "json":
            write_documents(rows, path, ["event_id"])
        elif kind == "xml":
            rows.write.format("xml").option("rowTag", "order").option("rootTag", "orders").save(path)
        else:
            rows.write.format(kind).option("header", True).save(path)
        read = readers.read_any(d.spark, path, kind, schema=schema if kind in ("json", "xml") else None, require_rows=True)
        parts.append(read.select(F.lit(kind).alias("kind"), F.col("event_id").try_cast("bigint").alias("event_id"),
                                 F.col("value").try_cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def layer_table(d, name):
    path = scratch_path(d.spark, name)
    return f"check_{name}.t_{path.rsplit('-', 1)[1]}", path


@job("scan_table", "SELECT * FROM customer")
def _(d):
    name, path = layer_table(d, "scan")
    sink_tables.write_layer(d.table("customer"), name, "replace", path)
    database, table = name.split(".")
    layer, namespace = database.split("_")
    return readers.read_table(d.spark, layer, namespace, table)


@job("write_table_replace", ORDERS_SQL)
def _(d):
    name, path = layer_table(d, "replace")
    sink_tables.write_layer(d.table("nation"), name, "replace", path)
    sink_tables.write_layer(d.sql(ORDERS_SQL), name, "replace", path)
    return d.spark.read.table(name)


@job("write_table_append", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(d):
    name, path = layer_table(d, "append")
    sink_tables.ensure_table(d.spark, name, "c_custkey bigint, c_name string", path)
    sink_tables.write_layer(d.sql("SELECT c_custkey, c_name FROM customer"), name, "append", path)
    sink_tables.write_layer(d.sql("SELECT s_suppkey AS c_custkey, s_name AS c_name FROM supplier"), name, "append", path)
    return d.spark.read.table(name)


@job("write_parquet_overwrite", "SELECT * FROM customer")
def _(d):
    path = scratch_path(d.spark, "overwrite")
    sink_tables.to_bronze(d.table("supplier"), path)
    sink_tables.to_bronze(d.table("customer"), path)
    return d.spark.read.parquet(path)


@job("write_single_file", VENDOR_SQL)
def _(d):
    target = f"{scratch_path(d.spark, 'single')}/vendor_summary.parquet"
    sink_files.write_single(vendor_summary(d), target)
    return d.spark.read.parquet(target)


@job(
    "write_single_file_summary",
    """SELECT 'legacy' AS schema_kind, (SELECT count(*) FROM trips) AS input_row_count,
         count(*) AS output_row_count FROM silver_trips""",
)
def _(d):
    from lakemill.plans.medallion import silver_trips

    raw = d.sql(LEGACY.rsplit(" WHERE ", 1)[0])
    return sink_files.single_summary(raw, silver_trips("yellow", [raw], "validation"), detect_variant(raw.columns))


@job(
    "write_jsonl_chunks",
    """SELECT chunk_index::int AS chunk_index, 'replay/chunk_index=' || chunk_index::int AS chunk_key, count(*) AS row_count
       FROM (SELECT ceil(row_number() OVER (ORDER BY event_id) / 5000.0) AS chunk_index FROM events) c GROUP BY ALL""",
)
def _(d):
    return sink_files.write_chunks(events(d), scratch_path(d.spark, "replay"), "replay", ["event_id"], unique=True)


@job("write_json_snapshot")
def _(d):
    target = f"{scratch_path(d.spark, 'screen')}/dashboard.json"
    document = payload.screen_payload(gold(d)).select(F.parse_json("payload").alias("screen"))
    sink_files.write_snapshot(document, target)
    return d.spark.read.text(target)


def land_files(d, root):
    """Files derived from the events: one Parquet folder per type, and beside
    each a text file that claims to be Parquet."""
    kinds = [r.event_type for r in d.table("events").select("event_type").distinct().orderBy("event_type").collect()]
    requests = []
    for kind in kinds:
        part = events(d).filter(F.col("event_type") == kind)
        part.write.parquet(f"{root}/raw/lakehouse/{kind}.parquet")
        part.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/raw/lakehouse/{kind}_broken.parquet")
        requests += [(kind, f"{kind}.parquet"), (kind, f"{kind}_broken.parquet")]
    frame = d.spark.createDataFrame(requests, "topic string, file_name string")
    return frame.select(
        F.col("file_name").alias("job_id"), F.lit("events").alias("domain"), "topic", F.lit("inbox").alias("source_name"),
        F.concat(F.lit("file:/in/"), "file_name").alias("source_uri"), F.lit("raw").alias("bucket"),
        F.concat(F.lit("lakehouse/"), "file_name").alias("object_key"), "file_name", F.lit("parquet").alias("file_type"),
        F.lit("landed").alias("status"),
    )


@job(
    "quarantine_failed_file",
    """SELECT event_type AS topic, event_type || suffix AS file_name,
         CASE suffix WHEN '.parquet' THEN 'success' ELSE 'error' END AS status, n AS bronze_rows
       FROM (SELECT event_type, '.parquet' AS suffix, count(*) AS n FROM events GROUP BY ALL
             UNION ALL SELECT DISTINCT event_type, '_broken.parquet', NULL::bigint FROM events) f""",
)
def _(d):
    root = scratch_path(d.spark, "ingest")
    ingest_files(d.spark, land_files(d, root), root, f"{root}/ledger")
    done = d.spark.read.parquet(f"{root}/ledger")
    written = d.spark.read.parquet(f"{root}/bronze/lakehouse/*/*/*/*/*.parquet")
    counts = written.groupBy(F.col("event_type").alias("topic")).agg(F.count(F.lit(1)).alias("bronze_rows"))
    counted = done.select("topic", "file_name", "status").join(counts, "topic", "left")
    return counted.withColumn("bronze_rows", F.when(F.col("status") == "success", F.col("bronze_rows")))


@job("registry_status_filter", f"WITH {LEDGER_SQL} SELECT file_name, domain, file_type FROM ledger WHERE status = 'landed' AND file_type IN ('json', 'csv', 'xml', 'parquet')")
def _(d):
    return ledger.landed(raw_ledger(d)).select("file_name", "domain", "file_type")


@job("anti_join_unprocessed", f"WITH {LEDGER_SQL} SELECT file_name, domain, topic, file_type FROM ledger WHERE {OPEN}")
def _(d):
    return ledger.unprocessed(raw_ledger(d), bronze_ledger(d)).select("file_name", "domain", "topic", "file_type")


REQUESTS = """SELECT cast(doc_id AS string) AS job_id, 'url' AS source_type, domain, topic, 'docs' AS source_name,
    concat('s3a://in/', file_name) AS source_uri, file_name, size AS file_size_bytes FROM files"""


def requests(d):
    """Requests for all documents; those in English are asked for twice."""
    kind = listing.file_extension(F.col("file_name")).alias("file_type")
    rows = d.sql(f"{REQUESTS} UNION ALL {REQUESTS} WHERE topic = 'en'")
    return rows.select("*", kind, F.lit("requested").alias("status"))


@job("anti_join_landed", "SELECT domain, topic, file_name FROM files WHERE domain = 'src3' OR doc_id NOT IN (SELECT doc_id FROM labels)")
def _(d):
    known = bronze_ledger(d).withColumn("status", F.when(F.col("domain") == "src3", "error").otherwise("landed"))
    return ledger.new_requests(requests(d), known).select("domain", "topic", "file_name")


@job(
    "resolve_ingest_requests",
    f"""SELECT doc_id::varchar AS job_id, domain, topic, file_name, {KIND} AS file_type,
          CASE WHEN domain IN {REGISTERED} THEN 'raw' END AS bucket,
          CASE WHEN domain IN {REGISTERED} THEN 'lakehouse/' || domain || '/' || file_name END AS object_key,
          CASE WHEN domain IN {REGISTERED} THEN size END AS file_size_bytes,
          CASE WHEN domain IN {REGISTERED} THEN 'landed' ELSE 'error' END AS status,
          CASE WHEN domain NOT IN {REGISTERED} THEN 'Domain ''' || domain || ''' is not registered' END AS error_message
        FROM (SELECT * FROM files UNION ALL SELECT * FROM files WHERE topic = 'en') f""",
)
def _(d):
    return ledger.resolve(requests(d), REGISTRY).select(
        "job_id", "domain", "topic", "file_name", "file_type", "bucket", "object_key", "file_size_bytes", "status",
        "error_message",
    )


@job(
    "ingest_request_plan",
    f"""SELECT 'raw_ingest_request' AS event_type, 'url' AS source_type, url AS source_uri, 'src0' AS domain,
          'pages' AS topic, split_part(url, '/', -1) AS file_name,
          {EXTENSION.format("split_part(url, '/', -1)")} AS file_type, 'requested' AS status FROM pages""",
)
def _(d):
    sources = d.table("pages").select(
        F.lit("url").alias("source_type"), F.col("url").alias("source_uri"), F.lit("web").alias("source_name"),
        F.lit(None).cast("string").alias("domain"), F.lit("pages").alias("topic"),
    )
    planned = ledger.plan_requests(sources, REGISTRY)
    return planned.drop("job_id", "requested_at", "source_name")


@job("distinct_keys", "SELECT DISTINCT domain, topic, file_type FROM (SELECT *, " + KIND + " AS file_type FROM files) f")
def _(d):
    return distinct_keys(raw_ledger(d), ["domain", "topic", "file_type"])


@job(
    "step_metrics",
    f"""WITH {LEDGER_SQL}, tried AS (SELECT count(*) FILTER (WHERE quality = 1) AS ok,
          count(*) FILTER (WHERE quality <> 1) AS bad FROM labels JOIN files USING (doc_id))
        SELECT (SELECT count(*) FROM ledger) AS input_count, (SELECT count(*) FROM ledger WHERE {OPEN}) AS candidate_count,
          ok + bad AS processed_count, ok AS success_count, bad AS error_count,
          (SELECT count(*) FROM ledger) - (SELECT count(*) FROM ledger WHERE {OPEN}) AS skipped_count FROM tried""",
)
def _(d):
    raw, bronze = raw_ledger(d), bronze_ledger(d)
    return ledger.step_metrics(raw, ledger.unprocessed(raw, bronze), bronze)


@job("glob_file_listing")
def _(d):
    return listing.sorted_paths(listing.list_files(d.spark, f"{d.folder}/*.parquet"))


@job(
    "classify_file_family",
    """SELECT file_name, CASE WHEN file_name LIKE 'yellow%' THEN 'yellow' WHEN file_name LIKE 'green%' THEN 'green'
         WHEN file_name LIKE 'fhvhv%' THEN 'fhvhv' WHEN file_name LIKE 'fhv%' THEN 'fhv' ELSE 'other' END AS family
       FROM files""",
)
def _(d):
    return d.view("files").select("file_name", listing.classify_family(F.col("file_name")).alias("family"))


@job("schema_inventory")
def _(d):
    return listing.schema_inventory(listing.list_files(d.spark, f"{d.folder}/*.parquet"))


@job("bronze_schema_sample")
def _(d):
    return listing.sample_schema(d.spark, f"{d.folder}/*.parquet")


@job("file_catalog")
def _(d):
    files = listing.list_files(d.spark, f"{d.folder}/*.parquet")
    path = scratch_path(d.spark, "catalog")
    listing.catalog_files(files.limit(0)).write.parquet(path)
    for _ in range(2):  # the second run adds nothing
        listing.catalog_files(files, d.spark.read.schema(listing.CATALOG_SCHEMA).parquet(path)).write.mode("append").parquet(path)
    return d.spark.read.schema(listing.CATALOG_SCHEMA).parquet(path)


MIME = """CASE topic WHEN 'en' THEN 'text/csv; charset=utf-8' WHEN 'fr' THEN 'image/png' WHEN 'de' THEN 'text/plain' END"""


@job(
    "classify_mime",
    f"""SELECT file_name, CASE WHEN topic = 'en' THEN 'structured' WHEN topic = 'fr' THEN 'images'
          WHEN {KIND} IN ('parquet', 'csv') THEN 'structured' WHEN {KIND} = 'png' THEN 'images' ELSE 'other' END AS media
        FROM files""",
)
def _(d):
    rows = d.sql(f"SELECT file_name, {MIME} AS mime FROM files")
    return rows.select("file_name", listing.classify_mime(F.col("mime"), F.col("file_name")).alias("media"))


@job(
    "compact_csv_json",
    """SELECT event_id::varchar AS event_id, CASE WHEN event_type <> 'view' THEN user_id::varchar END AS user_id,
         CASE WHEN event_type = 'view' THEN value END AS value, DATE '2024-02-01' AS ingestion_time FROM events""",
)
def _(d):
    base = scratch_path(d.spark, "compact")
    rows = events(d)
    rows.filter("event_type <> 'view'").select("event_id", "user_id").write.option("header", True).csv(f"{base}-csv")
    rows.filter("event_type = 'view'").select(F.col("event_id").cast("string").alias("event_id"), "value").write.json(f"{base}-json")
    csv = readers.read_any(d.spark, f"{base}-csv", "csv")
    lines = readers.read_jsonl(d.spark, f"{base}-json", "event_id string, value double")
    sink_files.compact_csv_json(csv, lines, base, F.to_date(F.lit("2024-02-01")))
    return d.spark.read.parquet(base)


RULES = ((1, "^yellow", "taxi"), (2, "\\.csv$", "tables"), (3, "tripdata", "transport"))


@job(
    "assign_domain",
    """SELECT file_name, CASE WHEN topic = 'fr' THEN 'src0' WHEN file_name LIKE 'yellow%' THEN 'taxi'
         WHEN file_name LIKE '%.csv' THEN 'tables' ELSE 'transport' END AS domain FROM files""",
)
def _(d):
    untagged = d.sql("SELECT file_name, CASE WHEN topic = 'fr' THEN 'src0' END AS domain FROM files")
    return listing.assign_domain(untagged, RULES)
