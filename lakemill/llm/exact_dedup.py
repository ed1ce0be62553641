"""Exact dedup: tree-merge of sorted digest runs, on DataFrame functions only.

Each input partition is a run. A run groups its rows by digest (a sort-based
aggregate, as the best row is a struct) into one record per text with the
smallest identifier and a count. Runs then merge in binomial rounds, ``fan_in``
runs at a time (three binary rounds folded into one exchange for 8): the run
number is divided by ``fan_in`` and records of one text meet. The answer goes
down the same tree: every level joins its parent level on (run, digest), so a
text that fills a third of the table is at most ``fan_in`` records per parent
and, at the leaves, one partition's rows per key.

Every level compares digest, length and a second hash, so records are merged
only when the texts are verified to agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemill.llm.common import SPACES, column, field, kept, staying, with_rows

#: What must agree for two texts to be one.
KEY = ("digest", "size", "check")


def digest_runs(docs: DataFrame, id_col: str, text_col: str, row: Column) -> DataFrame:
    """(doc_id, row, run, n_chars, digest, size, check) of every document."""
    bare = F.regexp_replace("text", SPACES, "")
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    lean = docs.select(
        column(id_col).alias("doc_id"), text.alias("text"), row.alias("row"), F.spark_partition_id().alias("run")
    )
    return lean.select("doc_id", "row", "run", F.char_length("text").alias("n_chars"), bare.alias("bare")).select(
        "doc_id", "row", "run", "n_chars", F.unhex(F.sha2("bare", 256)).alias("digest"),
        F.octet_length("bare").alias("size"), F.xxhash64("bare").alias("check"),
    )


def rank() -> Column:
    """Smallest first: most code points, then smallest doc_id (null last), then the row."""
    return F.struct(
        (-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row")
    )


def merged(records: DataFrame, fan_in: int) -> DataFrame:
    """One round: groups of ``fan_in`` runs become one run."""
    parent = F.floor(F.col("run") / fan_in).cast("int")
    return (
        records.withColumn("run", parent)
        .groupBy("run", *KEY)
        .agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, fan_in: int = 8
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (and ``row_col``).

    Texts are equal when identical without the characters of ``SPACES``. Of
    equal texts the longest original stays, then the smallest doc_id; among
    repeated rows with one doc_id exactly one is kept. Null and empty texts are
    one group; a null doc_id ranks last; an empty table gives an empty result.
    ``row_col``: a unique long that is stable between passes, returned as it is.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    runs = kept(digest_runs(docs, id_col, text_col, row))
    last = runs.agg(F.max("run")).first()[0] or 0
    levels = [runs.groupBy("run", *KEY).agg(F.min(rank()).alias("best"), F.count(F.lit(1)).alias("rows"))]
    while last > 0:
        levels.append(kept(merged(levels[-1], fan_in)))
        last //= fan_in
    answer = levels[-1]
    for level in reversed(levels[:-1]):
        up = answer.select(
            F.col("run").alias("parent"), *KEY, F.col("best").alias("all_best"), F.col("rows").alias("all_rows")
        )
        here = level.select("run", F.floor(F.col("run") / fan_in).cast("int").alias("parent"), *KEY)
        answer = here.join(up, ["parent", *KEY]).select(
            "run", *KEY, F.col("all_best").alias("best"), F.col("all_rows").alias("rows")
        )
    out = runs.join(answer, ["run", *KEY]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("rows").alias("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *([F.col("row").alias(row_col)] if row_col else []),
    )
    return out


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but one of each group of equal texts; columns stay as they are."""
    rows = with_rows(docs, id_col)
    view = rows.select(field(id_col).alias("doc_id"), field(text_col).alias("text"), "row")
    return staying(rows, exact_dedup(view, "doc_id", "text", "row").where("kept").select("row"))
