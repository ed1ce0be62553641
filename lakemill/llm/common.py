"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from lakemill.session import checkpoint_dir, scratch_path

#: ASCII white space of every contract: space and \\t \\n \\v \\f \\r.
SPACES = r"[\x20\x09-\x0D]+"


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column):
    """(doc_id, text) for a Python operator, and what gives its result the type of the ids again.

    Other columns, whatever their names, are left out. Null text is empty. The
    id is a string on the way: pandas would turn whole numbers beside nulls into floats.
    """
    kind = docs.schema[id_col].dataType
    lean = docs.select(
        column(id_col).cast("string").alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"), *more
    )
    return lean, lambda out: out.withColumn("doc_id", F.col("doc_id").cast(kind))


def slices(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """Smaller batches, where an operator's results are as large as its texts."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later passes see the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """A small result cut off from its lineage in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def whole(docs: DataFrame) -> Column:
    """A row as one struct ``doc``: its columns can't clash with an operator's own, whatever their names."""
    return F.struct(*[column(c) for c in docs.columns]).alias("doc")


def field(name: str) -> Column:
    return F.col("doc").getField(name)


def unique_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether whole numbers in ``id_col`` tell all rows apart; reads that column alone."""
    if not isinstance(docs.schema[id_col].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return False
    counted = docs.select(column(id_col).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1 OR id IS NULL").isEmpty()


def with_rows(docs: DataFrame, id_col: str) -> DataFrame:
    """(doc, row): a number for each row that every later pass sees alike.

    That is the id if it is unique. Else rows are numbered and stored: another
    pass over the same plan may deal its rows differently.
    """
    if unique_ids(docs, id_col):
        return docs.select(whole(docs), column(id_col).cast("long").alias("row"))
    return stored(docs.select(whole(docs), F.monotonically_increasing_id().alias("row")), "rows")


def staying(rows: DataFrame, stay: DataFrame) -> DataFrame:
    """The rows of ``with_rows`` that are in ``stay``, with their own columns."""
    return rows.join(stay, "row", "left_semi").select("doc.*")


def part_bases(parts: DataFrame, count: str) -> DataFrame:
    """For rows (part, ``count``): how much all parts before each hold, as ``base``.

    Sums go over blocks of 1024 parts first, so no task sees more than the
    parts of one block or one total per block.
    """
    from pyspark.sql import Window

    blocks = parts.withColumn("__block", F.shiftright("part", 10))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("__block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("__block").agg(F.sum(count).alias("__total"))
    offsets = totals.select("__block", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    inner = blocks.withColumn("__inner", F.coalesce(F.sum(count).over(within), F.lit(0)))
    return inner.join(offsets, "__block").select("part", (F.col("__before") + F.col("__inner")).alias("base"))
