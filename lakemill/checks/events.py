"""Event messages, state and streaming."""

from pyspark.sql import functions as F

from lakemill.checks.files import write_documents
from lakemill.checks.profiling import CEIL
from lakemill.checks.registry import job
from lakemill.operators import events as E
from lakemill.operators.numbering import with_row_index
from lakemill.operators.reconcile import reconcile
from lakemill.plans.realtime import process_message
from lakemill.session import scratch_path
from lakemill.sinks.files import with_chunks, write_chunks
from lakemill.sources.inbox import inbox_rows, load_manifest
from lakemill.streaming import events as S
from lakemill.streaming.once import first_of_ids

ROWS = "SELECT event_id, trip_id, fare_amount, event_time, event_type FROM rt_events"
ONCE = """SELECT cast(event_id AS string) AS event_id, cast(user_id AS string) AS trip_id, value AS fare_amount,
    ts AS event_time, event_type FROM events"""
ORDER = ["event_time", "event_id"]


def rows(d):
    return d.sql(ROWS)


def state_rows(df):
    """Rows in the shape of the event state: times as text."""
    return df.withColumn("event_time", F.date_format("event_time", E.MICROS))


def timed(df):
    """Rows with their times as such; these inputs have no unlisted fields."""
    return df.drop("extra").withColumn("event_time", F.col("event_time").try_cast("timestamp_ntz"))


def row_lines(d):
    return E.to_lines(E.row_events(rows(d), "file:/in/rows.json"))


def batch_lines(d):
    """All events in batch messages of up to 500 rows."""
    return E.to_lines(E.batch_events(with_chunks(d.sql(ONCE), ["event_time", "event_id"], 500, True), "seed"))


@job("build_row_event", """SELECT 'row' AS message_type, event_id, 'fare_amount' AS dataset, 'local_path' AS source_type,
    fare_amount, 'rows.json' AS source_name, 'rows' AS source_basename, '.json' AS file_extension FROM rt_events""")
def _(d):
    built = E.row_events(rows(d), "file:/in/rows.json")
    meta = [F.col(f"metadata.{c}").alias(c) for c in ("source_name", "source_basename", "file_extension")]
    return built.select("message_type", "event_id", "dataset", "source_type", F.col("row.fare_amount").alias("fare_amount"), *meta)


@job("parse_envelope", f"SELECT 'row' AS message_type, event_id, trip_id, fare_amount, event_time, event_type FROM ({ROWS}) r")
def _(d):
    broken = d.table("events").select(F.concat(F.lit("{broken "), "event_type").alias("value"))
    other = d.table("events").select(F.to_json(F.struct(F.lit("ping").alias("message_type"), "event_id")).alias("value"))
    parsed = E.parse_envelope(row_lines(d).union(broken).union(other))
    r = [F.col(f"row.{c}").alias(c) for c in ("trip_id", "event_time", "event_type")]
    fare = F.col("row.fare_amount").try_cast("double").alias("fare_amount")
    return timed(parsed.select("message_type", "event_id", fare, *r))


def document_files(d):
    return d.sql("""SELECT concat('file:/in/', file_name) AS path, text AS content FROM files JOIN documents
        ON files.doc_id = documents.doc_id""").withColumn("content", F.col("content").cast("binary"))


@job(
    "build_file_event",
    """SELECT 'file' AS message_type, 'file-' || sha256(text)[1:16] AS event_id, sha256(text) AS content_sha256,
         strlen(text)::bigint AS size_bytes, 'file:/in/' || file_name AS original_source_path, file_name AS source_name
       FROM files JOIN documents ON files.doc_id = documents.doc_id""",
)
def _(d):
    built = E.file_events(document_files(d), "s3://stage")
    meta = [F.col(f"metadata.{c}").alias(c) for c in ("content_sha256", "size_bytes", "original_source_path", "source_name")]
    return built.select("message_type", "event_id", *meta)


@job(
    "dedupe_file_event",
    """SELECT DISTINCT 'file-' || sha256(text)[1:16] AS file_event_id FROM documents
       WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'fr')""",
)
def _(d):
    built = E.file_events(document_files(d), "s3://stage")
    old = d.sql("SELECT text FROM documents WHERE lang = 'fr'").select(
        F.concat(F.lit("file-"), F.substring(F.sha2("text", 256), 1, 16)).alias("file_event_id")
    )
    return E.new_files(built, old).select("file_event_id")


@job("explode_batches_and_rows", f"SELECT 'batch' AS message_type, * FROM ({ONCE}) a UNION ALL SELECT 'row', * FROM ({ROWS}) b")
def _(d):
    messages = E.parse_envelope(batch_lines(d).union(row_lines(d)))
    return timed(E.explode_batches(messages).drop("batch_id"))


@job("explode_batch_messages", f"SELECT 'batch' AS message_type, 'seed-' || printf('%05d', chunk::int) AS batch_id, * EXCLUDE (chunk) FROM (SELECT *, ceil(row_number() OVER (ORDER BY event_time, event_id) / 500.0) AS chunk FROM ({ONCE}) a) b")
def _(d):
    return timed(E.explode_batches(E.parse_envelope(batch_lines(d))))


SPARSE = """SELECT CASE WHEN event_type <> 'click' THEN event_id END AS event_id,
    CASE WHEN event_type NOT IN ('click', 'view') THEN trip_id ELSE '' END AS trip_id,
    fare_amount, event_time, event_type, event_id AS original_id FROM ({}) r"""


@job(
    "normalize_event_row",
    f"""SELECT original_id, coalesce(nullif(event_id, ''), nullif(trip_id, ''), 'day-row-' || printf('%04d', n)) AS event_id,
          coalesce(nullif(trip_id, ''), 'day-trip-' || printf('%04d', n)) AS trip_id, event_type
        FROM (SELECT *, row_number() OVER (ORDER BY event_time, original_id)::int AS n FROM ({SPARSE.format(ONCE)}) s) t""",
)
def _(d):
    indexed = with_row_index(d.sql(SPARSE.format(ONCE)), ["event_time", "original_id"], name="n", unique=True)
    named = E.normalize_rows(indexed, F.lit("day"), "n")
    return named.select("original_id", "event_id", "trip_id", "event_type")


@job(
    "stable_event_id",
    f"""SELECT original_id, CASE WHEN coalesce(event_id, '') <> '' THEN event_id
          ELSE 'row-rows-' || printf('%08d', n) || '-' END AS id_start, 16 AS hash_length
        FROM (SELECT *, row_number() OVER (ORDER BY event_time, original_id)::int AS n FROM ({SPARSE.format(ONCE)}) s) t""",
)
def _(d):
    indexed = with_row_index(d.sql(SPARSE.format(ONCE)), ["event_time", "original_id"], name="source_row_index", unique=True)
    built = E.with_event_id(indexed, "rows", "source_row_index")
    start = F.regexp_replace("event_id", "^(row-rows-[0-9]{8}-)[0-9a-f]{16}$", "$1")
    return built.select("original_id", start.alias("id_start"), F.lit(16).alias("hash_length"))


KNOWN = "SELECT cast(event_id AS string) AS event_id FROM events WHERE event_type = 'view'"


@job("dedupe_event_id", f"SELECT DISTINCT * FROM ({ROWS}) r WHERE event_id NOT IN ({KNOWN})")
def _(d):
    return E.new_events(rows(d), d.sql(KNOWN), ORDER)


@job(
    "dedupe_event_id_keep_missing",
    f"""SELECT DISTINCT event_id, original_id FROM ({SPARSE.format(ROWS)}) r WHERE event_id NOT IN ({KNOWN})
        UNION ALL SELECT NULL, original_id FROM ({SPARSE.format(ROWS)}) r WHERE event_id IS NULL""",
)
def _(d):
    sparse = d.sql(SPARSE.format(ROWS)).select("event_id", "original_id")
    return E.new_events(sparse, d.sql(KNOWN), missing="keep")


@job(
    "dedupe_batch_id",
    """SELECT DISTINCT 'batch' AS message_type, file_name AS batch_id FROM files WHERE domain <> 'src1'
       UNION ALL SELECT 'row', NULL FROM files WHERE topic = 'fr'""",
)
def _(d):
    messages = d.sql("""SELECT 'batch' AS message_type, file_name AS batch_id FROM files
        UNION ALL SELECT 'batch', file_name FROM files WHERE topic = 'en'
        UNION ALL SELECT 'batch', '' FROM files WHERE topic = 'de'
        UNION ALL SELECT 'row', cast(NULL AS string) FROM files WHERE topic = 'fr'""")
    return E.new_batches(messages, d.sql("SELECT file_name AS batch_id FROM files WHERE domain = 'src1'"))


@job("apply_rows_to_state", f"SELECT * FROM ({ONCE}) e")
def _(d):
    path = scratch_path(d.spark, "state")
    incoming = state_rows(rows(d))
    S.apply_batch(incoming.filter("event_type = 'error'"), 0, path)
    S.apply_batch(incoming, 1, path)
    S.apply_batch(incoming, 1, path)  # a repeated batch replaces itself
    return timed(S.read_state(d.spark, path, S.ROW_STATE).drop(S.BATCH))


@job(
    "file_replace_state",
    """SELECT 'file' AS mode, count(*) AS n, count(DISTINCT event_id) AS ids FROM rt_events WHERE event_type = 'error'
       UNION ALL SELECT 'row', count(*), count(*) FROM events""",
)
def _(d):
    path = scratch_path(d.spark, "modes")
    incoming = state_rows(rows(d))
    S.apply_event(incoming, "file", path)
    S.apply_event(incoming.filter("event_type = 'error'"), "file", path)
    S.apply_event(incoming.filter("event_type = 'view'"), "row", path, 0)
    S.apply_event(incoming, "row", path, 1)
    count = lambda mode: S.read_state(d.spark, f"{path}/{mode}", S.ROW_STATE).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids")
    ).select(F.lit(mode).alias("mode"), "n", "ids")
    return count("file").union(count("row"))


CHANGED = """SELECT event_id, CASE WHEN event_type = 'view' THEN trip_id || 'x' ELSE trip_id END AS trip_id,
    CASE WHEN fare_amount > 40 THEN fare_amount + 1 ELSE fare_amount END AS fare_amount, event_time, event_type
    FROM ({}) r WHERE event_type <> 'error'"""


@job(
    "parity_whole_rows",
    f"""SELECT a.event_id AS key, 1::bigint AS truth_rows, count(b.event_id) AS built_rows,
          CASE WHEN count(b.event_id) = 0 THEN 'missing' ELSE 'changed' END AS status,
          CASE WHEN count(b.event_id) > 0 THEN concat_ws(',',
            CASE WHEN any_value(a.trip_id) <> any_value(b.trip_id) THEN 'trip_id' END,
            CASE WHEN any_value(a.fare_amount) <> any_value(b.fare_amount) THEN 'fare_amount' END) END AS changed
        FROM ({ONCE}) a LEFT JOIN ({CHANGED.format(ONCE)}) b USING (event_id)
        WHERE b.event_id IS NULL OR a.trip_id <> b.trip_id OR a.fare_amount <> b.fare_amount GROUP BY a.event_id""",
)
def _(d):
    return reconcile(d.sql(ONCE), d.sql(CHANGED.format(ONCE)), "event_id")


@job("row_batch_manifest_load", f"SELECT *, row_number() OVER (ORDER BY event_time, event_id) AS source_row_index FROM ({ONCE}) e")
def _(d):
    path = scratch_path(d.spark, "manifest")
    write_chunks(state_rows(d.sql(ONCE)), path, "replay", ORDER, 1_000, True)
    loaded = load_manifest(d.spark, path, "replay", f"{S.ROW_STATE}, source_row_index bigint")
    return timed(loaded.drop("chunk_index"))


SUMMARY = f"""SELECT 'row' AS mode, (SELECT count(*) FROM rt_events) AS input_row_count, a AS applied_row_count,
    a + k AS total_row_count_after, a = 0 AS duplicate, a > 0 AS should_calculate
  FROM (SELECT count(DISTINCT event_id) AS a, (SELECT count(*) FROM ({KNOWN}) v) AS k FROM rt_events
        WHERE event_id NOT IN ({KNOWN})) s"""


def summary(d):
    known = d.sql(KNOWN)
    return E.ingest_summary(rows(d), E.new_events(rows(d), known, ORDER), known.count(), "row", True)


@job("ingest_summary", SUMMARY)
def _(d):
    return summary(d)


@job(
    "gate_new_data",
    f"""SELECT gate, CASE gate WHEN 'file_ready' THEN NOT duplicate WHEN 'file_missing' THEN true
          WHEN 'row_ready' THEN applied_row_count > 0 WHEN 'row_missing' THEN applied_row_count > 0 OR duplicate
          ELSE applied_row_count > 0 OR total_row_count_after > 1000000000 END AS due
        FROM ({SUMMARY}) s, (VALUES ('file_ready'), ('file_missing'), ('row_ready'), ('row_missing'), ('topic')) g(gate)""",
)
def _(d):
    yes, no = F.lit(True), F.lit(False)
    gates = {
        "file_ready": E.should_calculate("file", yes),
        "file_missing": E.should_calculate("file", no),
        "row_ready": E.should_calculate("row", yes),
        "row_missing": E.should_calculate("row", no),
        "topic": E.should_calculate("topic", yes, F.lit(1_000_000_000)),
    }
    items = [F.struct(F.lit(name).alias("gate"), due.alias("due")) for name, due in gates.items()]
    return summary(d).select(F.inline(F.array(*items)))


@job(
    "cumulative_snapshots",
    f"""SELECT event_id, 'row_day' || row_count AS snapshot, row_count, bucket,
          row_number() OVER (PARTITION BY bucket ORDER BY event_time, event_id) AS bucket_count
        FROM (SELECT *, CASE WHEN fare_amount >= 100 THEN 39 WHEN fare_amount >= 0 THEN floor(fare_amount / 3)::int END AS bucket,
          row_number() OVER (ORDER BY event_time, event_id) AS row_count FROM ({ONCE}) e) p""",
)
def _(d):
    built = E.cumulative_hist(d.sql(ONCE), "fare_amount", ORDER, 100.0, unique=True)
    return built.select("event_id", "snapshot", "row_count", "bucket", "bucket_count")


PARITY_BUILT = "SELECT event_id FROM rt_events WHERE event_type <> 'view' UNION ALL SELECT concat('x', event_id) FROM rt_events WHERE event_type = 'view'"


@job(
    "parity_file_vs_rows",
    f"""WITH a AS (SELECT event_id::varchar AS key, count(*) AS truth_rows FROM events GROUP BY ALL),
          b AS (SELECT event_id AS key, count(*) AS built_rows FROM ({PARITY_BUILT}) p GROUP BY ALL)
        SELECT * FROM (SELECT key, coalesce(truth_rows, 0) AS truth_rows, coalesce(built_rows, 0) AS built_rows,
          CASE WHEN built_rows IS NULL THEN 'missing' WHEN truth_rows IS NULL THEN 'extra'
            WHEN built_rows > truth_rows THEN 'duplicate' ELSE 'short' END AS status
          FROM a FULL JOIN b USING (key)) c WHERE truth_rows <> built_rows""",
)
def _(d):
    return E.parity(d.sql(ONCE), d.sql(PARITY_BUILT), "event_id")


@job(
    "parity_summary",
    f"""WITH a AS (SELECT event_id::varchar AS key, count(*) AS t FROM events GROUP BY ALL),
          b AS (SELECT event_id AS key, count(*) AS u FROM ({PARITY_BUILT}) p GROUP BY ALL)
        SELECT sum(t)::bigint AS truth_rows, sum(u)::bigint AS built_rows, count(t) AS truth_keys, count(u) AS built_keys,
          count(*) FILTER (WHERE u IS NULL) AS missing_keys, count(*) FILTER (WHERE t IS NULL) AS extra_keys,
          count(*) FILTER (WHERE u > t) AS duplicate_keys FROM a FULL JOIN b USING (key)""",
)
def _(d):
    return E.parity_summary(d.sql(ONCE), d.sql(PARITY_BUILT), "event_id")


@job(
    "relay_envelope",
    """SELECT n AS sequence, count(*) OVER () AS total,
         CASE event_type WHEN 'click' THEN 'object' WHEN 'view' THEN 'value' ELSE 'raw' END AS payload_kind,
         CASE event_type WHEN 'click' THEN replace(props, ' ', '')
           WHEN 'view' THEN '{"message":' || user_id || ',"sequence":' || n || '}'
           ELSE '{"raw_body":"' || event_type || '!"}' END AS payload
       FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events) e""",
)
def _(d):
    bodies = d.sql("""SELECT event_id, CASE event_type WHEN 'click' THEN props WHEN 'view' THEN cast(user_id AS string)
        ELSE concat(event_type, '!') END AS body FROM events""")
    return E.relay(bodies, ["event_id"], unique=True)


@job(
    "snapshot_ready_event",
    """SELECT 'screen_snapshot_ready' AS event_type, '1' AS version, 'exec' AS screen_id, 'dashboard' AS object_id,
         'dashboard' AS format, 's3a://gold/serving/screen/dashboard.json' AS artifact_uri, 'gold' AS bucket,
         'serving/screen/dashboard.json' AS object_key, '{"trips":' || count(*) || '}' AS payload FROM trips""",
)
def _(d):
    payload = d.view("trips").agg(F.count(F.lit(1)).alias("trips")).select(F.to_json(F.struct("trips")).alias("payload"))
    return E.snapshot_event(payload, "s3a://gold/serving/", "exec", "dashboard").drop("event_id", "generated_at")


@job("normalize_inbox_files", """SELECT event_id::varchar AS event_id,
    CASE WHEN event_type = 'click' THEN user_id::varchar ELSE user_id::varchar END AS trip_id,
    event_type, value AS fare_amount FROM events""")
def _(d):
    folder = scratch_path(d.spark, "inbox")
    raw = d.sql("SELECT event_id, user_id AS trip_id, event_type, value AS fare_amount FROM events")
    write_documents(raw.filter("event_type = 'click'"), f"{folder}/clicks.json", ["event_id"], 1_000, wrap=True)
    raw.filter("event_type = 'view'").write.parquet(f"{folder}/views.parquet")
    raw.filter("event_type = 'purchase'").write.option("header", True).csv(f"{folder}/purchases.csv")
    raw.filter("event_type NOT IN ('click', 'view', 'purchase')").write.format("xml").option("rowTag", "row").option(
        "rootTag", "rows"
    ).save(f"{folder}/others.xml")
    found = inbox_rows(d.spark, folder, ["event_id"])
    return found.select("event_id", "trip_id", "event_type", F.col("fare_amount").try_cast("double").alias("fare_amount"))


def land(d, path):
    row_lines(d).repartition(4).write.text(path)
    batch_lines(d).repartition(2).write.mode("append").text(path)


@job("stream_source_events", f"SELECT 'row' AS message_type, event_id FROM ({ROWS}) r")
def _(d):
    path = scratch_path(d.spark, "stream")
    row_lines(d).repartition(4).write.text(f"{path}/in")
    stream = E.parse_envelope(S.event_stream(d.spark, f"{path}/in", 2)).select("message_type", "event_id")
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/offsets").trigger(availableNow=True)
    query.start(f"{path}/out").awaitTermination(1800)
    return d.spark.read.parquet(f"{path}/out")


@job("stream_events_once", f"SELECT DISTINCT event_id FROM ({ROWS}) r WHERE event_id <> ''")
def _(d):
    """Messages sent twice, in micro-batches, with the ids of earlier ones in the state store."""
    path = scratch_path(d.spark, "once")
    row_lines(d).repartition(2).write.text(f"{path}/in")
    row_lines(d).repartition(2).write.mode("append").text(f"{path}/in")
    events = E.explode_batches(E.parse_envelope(S.event_stream(d.spark, f"{path}/in", 2))).select("event_id", "trip_id")
    query = first_of_ids(events).writeStream.format("parquet").option("checkpointLocation", f"{path}/offsets")
    query.outputMode("append").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return d.spark.read.parquet(f"{path}/out").select("event_id")


ONCE_BOUND = """vals AS (SELECT value AS x FROM events WHERE value IS NOT NULL),
q AS (SELECT quantile_disc(x, 0.25) AS q25, quantile_disc(x, 0.75) AS q75, quantile_disc(x, 0.99) AS q99 FROM vals),
h AS (SELECT CASE WHEN q75 - q25 <= 0 THEN q99 ELSE least(q99, q75 + 3 * (q75 - q25)) END AS hi1 FROM q),
t AS (SELECT quantile_disc(x, 0.25) AS t25, quantile_disc(x, 0.75) AS t75, quantile_disc(x, 0.99) AS t99
  FROM vals WHERE x > (SELECT hi1 FROM h)),
ub AS (SELECT greatest(10, hi1, coalesce(CASE WHEN t75 - t25 > 0 THEN least(t99, t75 + 3 * (t75 - t25)) ELSE t99 END, hi1))::double
  AS bound FROM h, t)"""


@job(
    "process_row_batch",
    f"""WITH {ONCE_BOUND}, {CEIL.split("SELECT bucket, bucket * width")[0].rstrip().rstrip(",")}
        SELECT 'row' AS mode, (SELECT count(*) FROM vals) AS row_count, any_value(width) AS bin_width,
          any_value(bound) AS upper_bound, string_agg(coalesce(n, 0)::varchar, ',' ORDER BY bucket) AS counts
        FROM frame CROSS JOIN w LEFT JOIN counted USING (bucket)""",
)
def _(d):
    """A chunked replay of all events, then its histogram document."""
    path = scratch_path(d.spark, "replay")
    write_chunks(state_rows(d.sql(ONCE)), f"{path}/chunks", "r1", ORDER, unique=True)
    meta = f"named_struct('source_name', 'events.parquet', 'chunk_prefix', '{path}/chunks/r1')"
    line = d.spark.range(1).select(
        F.to_json(F.struct(F.lit("row_batch").alias("message_type"), F.lit("r1").alias("event_id"), F.expr(meta).alias("metadata"))).alias("value")
    )
    message = E.parse_envelope(line).first()
    _, document = process_message(d.spark, message, f"{path}/state", relative_error=0.0)
    return document.select("mode", "row_count", "bin_width", "upper_bound", F.array_join("counts", ",").alias("counts"))


@job("incremental_histogram", f"WITH {ONCE_BOUND}, {CEIL}")
def _(d):
    path = scratch_path(d.spark, "incremental")
    land(d, f"{path}/in")
    query = S.stream_histogram(S.event_stream(d.spark, f"{path}/in", 3), f"{path}/state", f"{path}/offsets", 0.0)
    query.awaitTermination(1800)
    return S.last_snapshot(d.spark, f"{path}/state", 1 << 40)
