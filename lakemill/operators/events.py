"""Event messages: envelopes, exact de-duplication, state and parity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemill.functions.labels import first_text
from lakemill.functions.values import file_extension, file_name, file_stem, lineage_id
from lakemill.operators.dedupe import dedupe, not_in
from lakemill.operators.histograms import EVENT_BINS, ceil_bucket
from lakemill.operators.numbering import with_row_index

# Fields and types of the messages.
ROW_SCHEMA = "event_id string, trip_id string, fare_amount string, event_time string, event_type string"
METADATA_SCHEMA = (
    "source_path string, original_source_path string, source_name string, source_basename string, "
    "file_extension string, file_event_id string, content_sha256 string, size_bytes bigint, replay_id string, "
    "source_sha256 string, chunk_prefix string, chunk_manifest_key string, chunk_count bigint, total_row_count bigint"
)
ROW_FIELDS = tuple(f.split()[0] for f in ROW_SCHEMA.split(", "))
ENVELOPE_SCHEMA = (
    "message_type string, event_type string, event_id string, event_ts string, dataset string, source_type string, "
    "batch_id string, source_file string, published_at string, row string, rows array<string>, "
    f"metadata struct<{METADATA_SCHEMA.replace(' string', ':string').replace(' bigint', ':bigint')}>"
)
MESSAGE_TYPES = ("file", "row", "row_batch", "batch", "text")
STREAM_EVENT, BATCH_EVENT = "stream_ingest", "batch_seed"
DATASET = "fare_amount"


def whole_rows(texts: Column) -> Column:
    """Of an array of rows as JSON: the known fields and, as JSON in ``extra``, all others; NULL for a missing row.

    Each row is parsed once, into a map that both come from.
    """
    maps = F.transform(texts, lambda text: F.from_json(text, "map<string,string>"))

    def fields(text: Column, found: Column) -> Column:
        others = F.map_filter(found, lambda k, _: ~k.isin(*ROW_FIELDS))
        extra = F.when(F.size(others) > 0, F.to_json(others)).alias("extra")
        return F.when(text.isNotNull(), F.struct(*[F.try_element_at(found, F.lit(f)).alias(f) for f in ROW_FIELDS], extra))

    return F.zip_with(texts, maps, fields)


def parse_envelope(lines: DataFrame, types: Sequence[str] = MESSAGE_TYPES) -> DataFrame:
    """Messages from JSON lines (column ``value``).

    A line that is no JSON object, or of an unknown type, is left out. Rows keep
    fields that are not listed in ``extra``.
    """
    parsed = F.from_json("value", ENVELOPE_SCHEMA, {"mode": "PERMISSIVE"})
    # inline instead of m.*: the type filter would otherwise parse each line again.
    found = lines.select(F.inline(F.array(parsed))).filter(F.col("message_type").isin(*types))
    return found.withColumns({"row": whole_rows(F.array("row"))[0], "rows": whole_rows(F.col("rows"))})


def packed_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with the known fields, ``keep`` and ``extra``; unlisted columns go into ``extra`` as JSON."""
    others = [c for c in df.columns if c not in (*ROW_FIELDS, *keep, "extra")]
    known = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ROW_FIELDS]
    own = F.col("extra") if "extra" in df.columns else F.lit(None).cast("string")
    rest = F.to_json(F.struct(*others)) if others else F.lit(None).cast("string")
    return df.select(*known, *keep, F.coalesce(own, F.nullif(rest, F.lit("{}"))).alias("extra"))


def row_events(rows: DataFrame, source_path: str = "", dataset: str = DATASET) -> DataFrame:
    """One envelope per row; a row without an id gets a generated one."""
    path = F.lit(source_path)
    name = file_name(path)
    own = F.struct(*[F.col(c) for c in rows.columns])
    event_id = first_text(F.col("event_id").cast("string"))
    return rows.select(
        F.lit("row").alias("message_type"),
        F.coalesce(event_id, F.concat(F.lit("row-"), F.uuid())).alias("event_id"),
        F.current_timestamp().alias("event_ts"),
        F.lit(dataset).alias("dataset"),
        F.lit("local_path").alias("source_type"),
        own.alias("row"),
        F.struct(
            path.alias("source_path"),
            name.alias("source_name"),
            file_stem(name).alias("source_basename"),
            F.concat(F.lit("."), file_extension(name)).alias("file_extension"),
        ).alias("metadata"),
    )


def file_events(files: DataFrame, stage_prefix: str, dataset: str = DATASET) -> DataFrame:
    """One envelope per file (path, content), named by its content hash."""
    name = file_name(F.col("path"))
    suffix = F.concat(F.lit("."), file_extension(name))
    hashed = files.withColumn("sha", F.sha2("content", 256)).withColumn(
        "id", F.concat(F.lit("file-"), F.substring("sha", 1, 16))
    )
    staged = F.concat(F.lit(stage_prefix.rstrip("/")), F.lit("/"), F.substring("sha", 1, 2), F.lit("/"), F.col("sha"), suffix)
    return hashed.select(
        F.lit("file").alias("message_type"),
        F.col("id").alias("event_id"),
        F.current_timestamp().alias("event_ts"),
        F.lit(dataset).alias("dataset"),
        F.lit("s3").alias("source_type"),
        F.struct(
            F.col("id").alias("file_event_id"),
            staged.alias("source_path"),
            F.col("path").alias("original_source_path"),
            name.alias("source_name"),
            file_stem(name).alias("source_basename"),
            suffix.alias("file_extension"),
            F.col("sha").alias("content_sha256"),
            F.length("content").cast("bigint").alias("size_bytes"),
        ).alias("metadata"),
    )


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": f"{MICROS}XXX", "timestampNTZFormat": MICROS}


def to_lines(events: DataFrame) -> DataFrame:
    """Envelopes as JSON lines, ready to be landed or sent."""
    return events.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


def batch_events(chunked: DataFrame, source: str, event_type: str = BATCH_EVENT) -> DataFrame:
    """One ``batch`` message per chunk (column ``chunk_index``) of an input.

    A message holds as many rows as a chunk has, which the chunk size limits.
    """
    rows = [c for c in chunked.columns if c not in ("chunk_index", "source_row_index")]
    return chunked.groupBy("chunk_index").agg(F.collect_list(F.struct(*rows)).alias("rows")).select(
        F.lit("batch").alias("message_type"),
        F.lit(event_type).alias("event_type"),
        F.format_string(f"{source}-%05d", "chunk_index").alias("batch_id"),
        F.lit(source).alias("source_file"),
        F.current_timestamp().alias("published_at"),
        "rows",
    )


def explode_batches(messages: DataFrame) -> DataFrame:
    """One line per row: the elements of ``batch`` messages, and ``row`` messages.

    The id of a batch row is its event id or trip id; a row message may carry
    its own id, which comes first.
    """
    is_batch = F.col("message_type") == "batch"
    items = F.when(is_batch, F.col("rows")).when(F.col("message_type") == "row", F.array("row"))
    own = F.when(~is_batch, first_text(F.col("message_event_id")))
    exploded = messages.withColumnRenamed("event_id", "message_event_id").select(
        "message_type", "batch_id", "message_event_id", F.explode(items).alias("r")
    )
    return exploded.select(
        "message_type",
        "batch_id",
        F.coalesce(own, first_text(F.col("r.event_id"), F.col("r.trip_id"))).alias("event_id"),
        F.col("r.trip_id").alias("trip_id"),
        F.col("r.fare_amount").try_cast("double").alias("fare_amount"),
        F.col("r.event_time").alias("event_time"),
        F.col("r.event_type").alias("event_type"),
        F.col("r.extra").alias("extra"),
    )


def normalize_rows(df: DataFrame, source: Column | str, index: str, event_type: str = STREAM_EVENT) -> DataFrame:
    """Fill ids and type of rows; ``index`` is the position in their source.

    Values that are not scalars become text.
    """
    source = F.col(source) if isinstance(source, str) else source
    have = set(df.columns)
    text = lambda c: first_text(F.col(c).cast("string")) if c in have else F.lit(None).cast("string")
    numbered = lambda kind: F.format_string(f"%s-{kind}-%04d", source, F.col(index))
    kind = F.coalesce("event_type", F.lit(event_type)) if "event_type" in have else F.lit(event_type)
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    return flat.withColumns(
        {
            "event_id": F.coalesce(text("event_id"), text("trip_id"), numbered("row")),
            "trip_id": F.coalesce(text("trip_id"), numbered("trip")),
            "event_type": kind,
        }
    )


def with_event_id(df: DataFrame, stem: str, index: str) -> DataFrame:
    """Keep an existing id; else build one from the position and content hash."""
    others = [c for c in df.columns if c != "event_id"]
    built = F.concat(
        F.format_string(f"row-{stem}-%08d-", F.col(index)), F.substring(lineage_id(*others), 1, 16)
    )
    own = first_text(F.col("event_id").cast("string")) if "event_id" in df.columns else F.lit(None)
    return df.withColumn("event_id", F.coalesce(own, built))


def has_text(column: str) -> Column:
    return F.coalesce(F.length(F.col(column)) > 0, F.lit(False))


def new_events(
    rows: DataFrame, state: DataFrame, order: Sequence[Column | str] = (), missing: str = "drop"
) -> DataFrame:
    """Rows whose event id is new, once per id, within the batch and against state.

    Rows without an id are dropped, or with ``missing="keep"`` always applied.
    They never reach the shuffle, where they would share one task.
    """
    if missing not in ("drop", "keep"):
        raise ValueError(f"unknown choice {missing}")
    known = rows.filter(has_text("event_id"))
    fresh = not_in(dedupe(known, ["event_id"], order), state, {"event_id": "event_id"}, distinct=True)
    return fresh if missing == "drop" else fresh.unionByName(rows.filter(~has_text("event_id")))


def new_batches(messages: DataFrame, state: DataFrame, order: Sequence[Column | str] = ()) -> DataFrame:
    """Batch messages with a new, non-empty batch id; other messages pass."""
    is_batch = F.col("message_type") == "batch"
    batches = messages.filter(is_batch & has_text("batch_id"))
    # The rank is a minimum over ids and marks; the row arrays take part in the join back only.
    marked = batches.withColumn("_tie", F.xxhash64(F.to_json(F.struct("*")))).withColumn(
        "_copy", F.monotonically_increasing_id()
    )
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(columns)], F.col("_tie"), F.col("_copy"))
    chosen = marked.groupBy("batch_id").agg(F.min(rank).alias("_first")).select("batch_id", "_first._tie", "_first._copy")
    first = marked.join(chosen, ["batch_id", "_tie", "_copy"], "left_semi").drop("_tie", "_copy")
    fresh = not_in(first, state, {"batch_id": "batch_id"}, distinct=True)
    return fresh.unionByName(messages.filter(~is_batch))


def dedupe_light(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key by the given order only (it must be total)."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*columns))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def new_files(events: DataFrame, state: DataFrame) -> DataFrame:
    """File messages whose content id has not been processed."""
    files = events.filter(F.col("message_type") == "file").withColumn(
        "file_event_id", F.coalesce(first_text(F.col("metadata.file_event_id")), F.col("event_id"))
    )
    first = dedupe_light(files, ["file_event_id"], ["event_id", F.xxhash64(F.to_json("metadata"))])
    return not_in(first, state, {"file_event_id": "file_event_id"}, distinct=True)


def ingest_summary(incoming: DataFrame, applied: DataFrame, state_rows: int, mode: str, outputs_ready: bool) -> DataFrame:
    """One row on what a batch changed and whether the histogram is due."""
    sides = incoming.select(F.lit(0).alias("s")).unionAll(applied.select(F.lit(1).alias("s")))
    n = F.count_if(F.col("s") == 1)
    counted = sides.agg(F.count_if(F.col("s") == 0).alias("input_row_count"), n.alias("applied_row_count"))
    summary = counted.select(
        F.lit(mode).alias("mode"),
        "input_row_count",
        "applied_row_count",
        (F.lit(state_rows) + F.col("applied_row_count")).cast("bigint").alias("total_row_count_after"),
        (F.col("applied_row_count") == 0).alias("duplicate"),
    )
    return summary.withColumn("should_calculate", should_calculate(mode, F.lit(outputs_ready)))


def should_calculate(mode: str, outputs_ready: Column, generated_rows: Column | None = None) -> Column:
    """Gate over the columns of a summary.

    ``file``: new, or its outputs are missing. ``row``: rows were applied, or a
    repeat finds its outputs missing. ``topic``: rows were applied, or the state
    holds more rows than the last output was made from.
    """
    applied, repeat = F.col("applied_row_count") > 0, F.col("duplicate")
    if mode == "file":
        return ~repeat | ~outputs_ready
    if mode == "row":
        return applied | (repeat & ~outputs_ready)
    if mode == "topic":
        done = F.lit(0) if generated_rows is None else generated_rows
        return applied | (F.col("total_row_count_after") > done)
    raise ValueError(f"Unsupported mode: {mode}")


def cumulative_hist(
    df: DataFrame,
    value: str,
    order: Sequence[Column | str],
    bound: float,
    bins: int = EVENT_BINS,
    unique: bool = False,
) -> DataFrame:
    """One line per accepted row: how many rows so far, and the new count of the
    bucket it fell into. All other buckets keep their last count."""
    placed = df.withColumn("bucket", ceil_bucket(F.col(value), bound, bins))
    # Places among ties are drawn once: the count within a bucket follows the numbers already given.
    numbered = with_row_index(placed, order, name="row_count", unique=unique)
    counted = with_row_index(numbered, ["row_count"], ["bucket"], "bucket_count", unique=True)
    return counted.withColumn("snapshot", F.concat(F.lit("row_day"), F.col("row_count").cast("string")))


def snapshot_at(cumulative: DataFrame, n: int) -> DataFrame:
    """Bucket counts after the first ``n`` accepted rows."""
    return cumulative.filter(F.col("row_count") <= n).groupBy("bucket").agg(F.max("bucket_count").alias("cnt"))


def parity(truth: DataFrame, built: DataFrame, key: str) -> DataFrame:
    """Keys that differ between a batch truth and an incremental result.

    Both sides are counted per key in one aggregation instead of being joined,
    so a repeated key costs one counter.
    """
    sides = truth.select(F.col(key).alias("key"), F.lit(0).alias("s")).unionAll(
        built.select(F.col(key).alias("key"), F.lit(1).alias("s"))
    )
    counts = sides.groupBy("key").agg(
        F.count_if(F.col("s") == 0).alias("truth_rows"), F.count_if(F.col("s") == 1).alias("built_rows")
    )
    status = (
        F.when(F.col("built_rows") == 0, "missing")
        .when(F.col("truth_rows") == 0, "extra")
        .when(F.col("built_rows") > F.col("truth_rows"), "duplicate")
        .otherwise("short")
    )
    return counts.filter(F.col("truth_rows") != F.col("built_rows")).withColumn("status", status)


def parity_summary(truth: DataFrame, built: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and differing keys of both sides in one row."""
    sides = truth.select(F.col(key).alias("key"), F.lit(0).alias("s")).unionAll(
        built.select(F.col(key).alias("key"), F.lit(1).alias("s"))
    )
    a, b = F.col("a"), F.col("b")
    return (
        sides.groupBy("key")
        .agg(F.count_if(F.col("s") == 0).alias("a"), F.count_if(F.col("s") == 1).alias("b"))
        .agg(
            F.sum("a").alias("truth_rows"),
            F.sum("b").alias("built_rows"),
            F.count_if(a > 0).alias("truth_keys"),
            F.count_if(b > 0).alias("built_keys"),
            F.count_if((a > 0) & (b == 0)).alias("missing_keys"),
            F.count_if((a == 0) & (b > 0)).alias("extra_keys"),
            F.count_if((a > 0) & (b > a)).alias("duplicate_keys"),
        )
    )


def relay(df: DataFrame, order: Sequence[Column | str], unique: bool = False) -> DataFrame:
    """Wrap message bodies with their place in the run.

    A JSON object is passed on; any other JSON value becomes ``{message,
    sequence}`` and text that is no JSON ``{raw_body}``.
    """
    numbered = with_row_index(df, order, name="sequence", unique=unique)
    total = df.select(F.count(F.lit(1))).scalar()
    value = F.try_parse_json("body")
    is_object = F.ltrim("body").startswith("{")
    payload = (
        F.when(value.isNull(), F.to_json(F.struct(F.col("body").alias("raw_body"))))
        .when(is_object, F.to_json(value))
        .otherwise(F.to_json(F.struct(value.alias("message"), F.col("sequence"))))
    )
    kind = F.when(value.isNull(), "raw").when(is_object, "object").otherwise("value")
    return numbered.select(
        "sequence", total.alias("total"), kind.alias("payload_kind"), payload.alias("payload")
    )


def snapshot_event(payload: DataFrame, base_uri: str, screen_id: str, object_id: str) -> DataFrame:
    """Message that a screen document (column ``payload``) is ready."""
    scheme, _, rest = base_uri.partition("://")
    bucket, _, prefix = rest.partition("/")
    if not scheme or not bucket:
        raise ValueError(f"invalid base uri: {base_uri}")
    key = "/".join(p for p in (prefix.strip("/"), "screen", f"{object_id}.json") if p)
    fixed = {
        "event_type": "screen_snapshot_ready",
        "version": "1",
        "screen_id": screen_id,
        "object_id": object_id,
        "format": object_id,
        "artifact_uri": f"{scheme}://{bucket}/{key}",
        "bucket": bucket,
        "object_key": key,
    }
    return payload.select(
        F.uuid().alias("event_id"),
        F.current_timestamp().alias("generated_at"),
        *[F.lit(v).alias(k) for k, v in fixed.items()],
        "payload",
    )
