"""Writers of exports: single files, chunks, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.operators.numbering import with_row_index

CHUNK_ROWS = 5000


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy one object through the Hadoop file system."""
    src, src_fs = _fs(spark, source)
    dst, dst_fs = _fs(spark, target)
    util = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil
    util.copy(src_fs, src, dst_fs, dst, False, spark.sparkContext._jsc.hadoopConfiguration())


def _publish_single(df: DataFrame, target: str, suffix: str, write) -> None:
    """Write one part file next to the target and move it to the fixed key."""
    spark = df.sparkSession
    staging = f"{target}.staging"
    write(df.repartition(1).write.mode("overwrite"), staging)
    folder, fs = _fs(spark, staging)
    parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one {suffix} part file, found {len(parts)}")
    final, _ = _fs(spark, target)
    fs.mkdirs(final.getParent())
    # The old file goes only after the new one lies beside it, and comes back if the move fails.
    old, _ = _fs(spark, f"{target}.old")
    fs.delete(old, False)
    replaced = fs.exists(final) and fs.rename(final, old)
    if not fs.rename(parts[0], final):
        if replaced:
            fs.rename(old, final)
        raise RuntimeError(f"could not move the part file to {target}")
    fs.delete(old, False)
    fs.delete(folder, True)


def write_single(df: DataFrame, target: str) -> None:
    """Exactly one Parquet file at a fixed key; for exports of limited size.

    The rows are computed in parallel; only the last step writes with one task.
    """
    _publish_single(df, target, "parquet", lambda w, path: w.parquet(path))


def single_summary(raw: DataFrame, written: DataFrame, schema_kind: str) -> DataFrame:
    """Schema kind and rows in and out of a single-file export, in one row."""
    rows = lambda df: df.select(F.count(F.lit(1))).scalar()
    one = raw.sparkSession.range(1)
    return one.select(
        F.lit(schema_kind).alias("schema_kind"),
        rows(raw).alias("input_row_count"),
        rows(written).alias("output_row_count"),
    )


def write_snapshot(df: DataFrame, target: str) -> None:
    """One compact UTF-8 JSON document from a one-row frame."""
    document = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    _publish_single(document, target, "text", lambda w, path: w.text(path))


def with_chunks(
    df: DataFrame, order: Sequence[Column | str], size: int = CHUNK_ROWS, unique: bool = False
) -> DataFrame:
    """Row number over the whole input and the chunk it belongs to, both from 1."""
    numbered = with_row_index(df, order, name="source_row_index", unique=unique)
    return numbered.withColumn("chunk_index", F.ceil(F.col("source_row_index") / size).cast("int"))


def chunk_manifest(chunked: DataFrame, replay_id: str) -> DataFrame:
    """One row per chunk with its key and number of rows."""
    key = F.format_string(f"{replay_id}/chunk_index=%d", F.col("chunk_index"))
    return (
        chunked.groupBy("chunk_index")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("chunk_index", key.alias("chunk_key"), "row_count")
    )


def write_chunks(
    df: DataFrame,
    path: str,
    replay_id: str,
    order: Sequence[Column | str],
    size: int = CHUNK_ROWS,
    unique: bool = False,
) -> DataFrame:
    """Write JSON-lines chunks below ``path/replay_id`` and return the manifest.

    The manifest is itself written beside the chunks, one line per chunk.
    """
    spark = df.sparkSession
    chunked = with_chunks(df, order, size, unique)  # numbers are fixed in a checkpoint
    chunked.write.mode("overwrite").partitionBy("chunk_index").json(f"{path}/{replay_id}")
    chunk_manifest(chunked, replay_id).write.mode("overwrite").json(f"{path}/{replay_id}.manifest")
    return spark.read.schema("chunk_index int, chunk_key string, row_count bigint").json(f"{path}/{replay_id}.manifest")


def compact_csv_json(csv: DataFrame, json_rows: DataFrame, path: str, ingestion_time: Column) -> None:
    """Append CSV and JSON rows, joined by column name, to a partitioned table."""
    together = csv.unionByName(json_rows, allowMissingColumns=True).withColumn("ingestion_time", ingestion_time)
    together.write.mode("append").partitionBy("ingestion_time").parquet(path)
