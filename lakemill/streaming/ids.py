"""An index of event ids that are known: hash buckets, in levels that are merged as they fill.

``level=k/bucket=b/batch=n`` holds the ids of bucket ``b`` that micro-batches up
to ``n`` brought. A batch appends to level 0. Every ``FAN_IN`` batches a level's
folders become one folder of the next level, so a bucket has at most
``FAN_IN`` folders a level and an id is rewritten once a level. Ids are a set:
one that lies in two levels while a merge is cut short is known all the same,
and the next merge clears it up.

What a batch reads are the buckets its own ids fall into. With far more buckets
than ids in a batch that is in proportion to the batch; with fewer it is the
index, as any comparison must be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Raise the buckets for a state of very many ids; they are part of its layout.
BUCKETS, FAN_IN, LEVELS = 64, 8, 4
SCHEMA = "event_id string, bucket int, batch bigint"


def bucket_of(event_id: str = "event_id") -> Column:
    return F.pmod(F.xxhash64(F.col(event_id).cast("string")), F.lit(BUCKETS)).cast("int")


def folders(spark: SparkSession, path: str) -> list[tuple[int, int, int, str]]:
    """(level, bucket, batch, folder) of everything in the index, from the names of folders."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/level=*/bucket=*/batch=*")
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(hadoop) or []:
        folder = status.getPath().toString()
        level, bucket, batch = (int(part.partition("=")[2]) for part in folder.rsplit("/", 3)[1:])
        found.append((level, bucket, batch, folder))
    return found


def ids_in(spark: SparkSession, chosen: list[str]) -> DataFrame:
    if not chosen:
        return spark.createDataFrame([], "event_id string")
    return spark.read.schema("event_id string").parquet(*chosen)


def seen_ids(rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """(event_id) known from earlier batches, of the buckets that ids of ``rows`` fall into."""
    spark = rows.sparkSession
    there = folders(spark, path)
    if not there:
        return ids_in(spark, [])
    # At most one number for each bucket comes to the driver.
    wanted = {r.bucket for r in rows.select(bucket_of().alias("bucket")).distinct().collect()}
    return ids_in(spark, [folder for _, bucket, batch, folder in there if bucket in wanted and batch < batch_id])


def _write(ids: DataFrame, path: str, level: int, batch: int) -> None:
    ids.select("event_id", bucket_of().alias("bucket"), F.lit(batch).cast("bigint").alias("batch")).repartition(
        "bucket"
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{path}/level={level}")


def append_ids(rows: DataFrame, path: str, batch_id: int) -> None:
    """The ids a batch brought; writing it again replaces it."""
    _write(rows.where("event_id IS NOT NULL").select("event_id"), path, 0, batch_id)


def compact_ids(spark: SparkSession, path: str, batch_id: int) -> None:
    """Before batch ``batch_id``: merge levels that are due.

    Batches before it are complete, so a merge that a crash repeats reads the
    same ids or, where folders have gone already, finds them in the next level.
    """
    for level in range(LEVELS - 1):
        if batch_id <= 0 or batch_id % FAN_IN ** (level + 1):
            break
        old = [folder for at, _, batch, folder in folders(spark, path) if at == level and batch < batch_id]
        if not old:
            continue
        _write(ids_in(spark, old).distinct(), path, level + 1, batch_id - 1)
        for folder in old:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
