"""Rows of the files dropped into an inbox folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.functions.values import file_name, file_stem
from lakemill.operators.conform import merge_schemas
from lakemill.operators.events import BATCH_EVENT, normalize_rows
from lakemill.operators.numbering import with_row_index
from lakemill.sources.readers import FORMATS


def load_manifest(spark: SparkSession, folder: str, replay_id: str, schema: str | None = None) -> DataFrame:
    """Rows of the chunks a manifest lists; a manifest without chunks is an error.

    So is a listed chunk that is missing or has another number of rows than the
    manifest says. Without a schema all fields are inferred. The chunk folder is read once and joined to the manifest, so
    the number of chunks does not matter to the driver.
    """
    manifest = spark.read.schema("chunk_index int, chunk_key string, row_count bigint").json(f"{folder}/{replay_id}.manifest")
    if manifest.isEmpty():
        raise ValueError("Row batch manifest is missing chunk definitions")
    reader = spark.read.schema(f"{schema}, chunk_index int") if schema else spark.read
    rows = reader.json(f"{folder}/{replay_id}")
    found = rows.groupBy("chunk_index").agg(F.count(F.lit(1)).alias("found"))
    listed = manifest.groupBy("chunk_index").agg(F.max("row_count").alias("listed"))
    here = F.coalesce("found", F.lit(0))
    wrong = listed.join(found, "chunk_index", "left").filter((here != F.col("listed")) | (F.col("found").isNull() & F.col("listed").isNull()))
    first = wrong.select("chunk_index", here.alias("found"), "listed").orderBy("chunk_index").first()
    if first:
        raise ValueError(f"chunk {first.chunk_index} has {first.found} rows, the manifest lists {first.listed}")
    return rows.join(listed.select("chunk_index"), "chunk_index", "left_semi")


def flatten_rows(df: DataFrame) -> DataFrame:
    """A document ``{rows: […]}`` gives its rows; other documents are rows."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    if kinds.get("rows") != "array":
        return df
    return df.select(F.explode("rows").alias("r"), "source_file", "_block").select("r.*", "source_file", "_block")


def inbox_rows(spark: SparkSession, folder: str, order: Sequence[Column | str] = ()) -> DataFrame:
    """Rows of all JSON, Parquet, CSV and XML files of a folder with filled ids.

    Files of one type are read together. Rows that bring no id are named by
    their position in the file, so a rerun names them alike; ``order`` names
    columns to number them by instead.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for kind, read in FORMATS.items():
        pattern = f"{folder}/*.{kind}"
        path = hadoop(pattern)
        if not path.getFileSystem(conf).globStatus(path):
            continue
        df = read(spark.read, pattern, "row" if kind == "xml" else "order")
        placed = df.withColumns({"source_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})
        # Rows of a block come in the order of the file.
        parts.append(flatten_rows(placed).withColumn("_seq", F.monotonically_increasing_id()))
    if not parts:
        raise ValueError(f"no readable file in {folder}")
    rows = merge_schemas(parts)
    name = file_name(F.col("source_file"))
    named = rows.withColumns({"source_file_name": name, "_stem": file_stem(name)}).drop("source_file")
    own = [c for c in order if c in named.columns]
    numbered = with_row_index(named, [*own, "_block", "_seq"], ["source_file_name"], "_index", unique=True)
    return normalize_rows(numbered.drop("_block", "_seq"), "_stem", "_index", BATCH_EVENT).drop("_stem", "_index")
