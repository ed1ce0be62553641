"""Reconciliation of two tables by a tree of fingerprints.

A fingerprint of some rows is their number and sums over two hashes of each: it
does not depend on their order, and equal sums of unequal rows are out of reach
of chance. Keys fall into 4096 cells by their hash, and each of these into 4096
again. Only cells whose fingerprints differ are looked into, so two equal tables
cost one scan each and a shuffle of fingerprints, and a few changed rows little
more. Rows meet only where the finer cells differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

#: Bits of a level; two levels.
LEVEL_BITS = 12


def _plain(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    # -0.0 is 0.0.
    return value + F.lit(0.0) if isinstance(df.schema[column].dataType, (DoubleType, FloatType)) else value


def _halves(hashed: Column) -> list[Column]:
    """Two parts of a hash whose sums stay within 64 bits for two billion rows a cell and task."""
    return [F.shiftrightunsigned(hashed, 33), hashed.bitwiseAND(F.lit((1 << 33) - 1).cast("bigint"))]


def _sides(truth: DataFrame, built: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of both sides as (sign, key, cell, values): 1 for the truth, -1 for what was built."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        kinds = {f.name: f.dataType for f in truth.schema}
        typed = df.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) for c in dict.fromkeys([key, *columns])])
        cell = F.xxhash64(F.col(f"`{key}`").cast("string")).bitwiseAND(F.lit((1 << (2 * LEVEL_BITS)) - 1).cast("bigint"))
        values = F.struct(*[_plain(typed, c).alias(c) for c in columns])
        return typed.select(F.lit(sign).cast("bigint").alias("sign"), F.col(f"`{key}`").alias("key"), cell.alias("cell"), values.alias("v"))

    return side(truth, 1).unionAll(side(built, -1))


def _differing(rows: DataFrame, cell: Column) -> DataFrame:
    """(cell): those whose fingerprints differ between the sides."""
    sums = [*_halves(F.xxhash64("key", "v")), *_halves(F.xxhash64(F.lit(7), "key", "v"))]
    found = rows.groupBy(cell.alias("cell")).agg(
        F.sum("sign").alias("rows"), *[F.sum(F.col("sign") * s).alias(f"s{i}") for i, s in enumerate(sums)]
    )
    return found.where("rows <> 0 OR s0 <> 0 OR s1 <> 0 OR s2 <> 0 OR s3 <> 0").select("cell")


def reconcile(truth: DataFrame, built: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(key, truth_rows, built_rows, status, changed) of every key whose rows differ.

    ``status`` is missing, extra, duplicate (more rows than the truth), short
    (fewer) or changed (as many rows, other values); ``changed`` lists the
    columns whose values differ. Without ``columns``, all that both sides have
    are compared, by name and in the types of the truth; a value that has no
    such type is NULL. Rows without a key are one key.
    """
    columns = [c for c in (columns or truth.columns) if c != key and (columns or c in built.columns)]
    rows = _sides(truth, built, key, columns)
    coarse = F.shiftright("cell", LEVEL_BITS)
    # At most 4096 numbers come to the driver.
    cells = [r.cell for r in _differing(rows, coarse).collect()]
    some = rows.where(coarse.isin(cells)) if cells else rows.where(F.lit(False))
    fine = _differing(some, F.col("cell")).withColumnRenamed("cell", "_cell")
    left = some.join(fine, F.col("cell") == F.col("_cell"), "left_semi")
    value = lambda c: F.xxhash64(F.col("v").getField(c))
    differs = [
        F.when((F.sum(F.col("sign") * a) != 0) | (F.sum(F.col("sign") * b) != 0), F.lit(c))
        for c in columns for a, b in [_halves(value(c))]
    ]
    sums = [F.sum(F.col("sign") * s) for s in _halves(F.xxhash64("v"))]
    whole = left.groupBy("key").agg(
        F.count_if(F.col("sign") == 1).alias("truth_rows"), F.count_if(F.col("sign") == -1).alias("built_rows"),
        ((sums[0] != 0) | (sums[1] != 0)).alias("other"), F.array_compact(F.array(*differs)).alias("changed"),
    )
    status = (
        F.when(F.col("built_rows") == 0, "missing").when(F.col("truth_rows") == 0, "extra")
        .when(F.col("built_rows") > F.col("truth_rows"), "duplicate").when(F.col("built_rows") < F.col("truth_rows"), "short")
        .otherwise("changed")
    )
    found = whole.where("truth_rows <> built_rows OR other").withColumn("status", status)
    # Which columns changed says nothing where the numbers of rows differ; a change of which rows go together has no column.
    listed = F.when(F.col("status") == "changed", F.concat_ws(",", "changed"))
    return found.select("key", "truth_rows", "built_rows", "status", listed.alias("changed"))


def reconcile_bins(truth: DataFrame, built: DataFrame, key: Sequence[str] = ("bucket",), count: str = "cnt") -> DataFrame:
    """Histogram bins whose counts differ, a bin that one side lacks counting as zero there."""
    sides = truth.select(*key, F.col(count).alias("t"), F.lit(0).alias("b")).unionByName(
        built.select(*key, F.lit(0).alias("t"), F.col(count).alias("b"))
    )
    sums = sides.groupBy(*key).agg(F.sum("t").cast("bigint").alias("truth_cnt"), F.sum("b").cast("bigint").alias("built_cnt"))
    return sums.where("truth_cnt <> built_cnt")
