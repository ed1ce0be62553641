"""Samples of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemill.operators.numbering import with_row_index


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def shuffled_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A sample in random order; only the sampled rows are sorted."""
    return sample_fraction(df, fraction, seed).orderBy(F.rand(seed))


def row_cap(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def json_bytes(df: DataFrame) -> int:
    """Length of all rows written as JSON lines."""
    size = F.sum(F.length(F.to_json(F.struct("*"))))
    return df.agg(size).first()[0] or 0


#: Bits of a row's place, and those that one pass tells apart.
PLACE_BITS, STEP_BITS = 48, 16


def row_json() -> Column:
    return F.to_json(F.struct("*"))


def place_of(key: Column, seed: int) -> Column:
    """A number of 48 bits from a hash of seed and key, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, PLACE_BITS // 4), 16, 10).cast("bigint")


def sample_to_bytes(
    df: DataFrame, target_bytes: int, seed: int, key: Column | None = None, size: Column | None = None
) -> DataFrame:
    """The rows of the lowest places whose sizes just reach the target; all rows if they never do.

    Places come from a hash of ``key`` (the row as JSON) and ``size`` is what a
    row counts for (the length of that JSON). One pass adds up sizes by the first
    16 bits of the place; where the cut falls among several places, passes over
    these alone look at the next bits, so the cut is exact: without its last row
    the sample is below the target. The same rows come out in every run. Rows of
    one key have one place; of equal rows there as many stay as it takes.
    """
    key, size = (row_json() if key is None else key), (F.length(row_json()) if size is None else size)
    # Columns made here must not clash with those of the table.
    placed = df.select(F.struct("*").alias("row"), place_of(key, seed).alias("place"), F.coalesce(size, F.lit(0)).cast("bigint").alias("size"))
    cells, before, shift = placed, 0, PLACE_BITS
    while True:
        shift -= STEP_BITS
        found = cells.groupBy(F.shiftright("place", shift).alias("cell")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("place").alias("lo"), F.max("place").alias("hi")
        )
        cut = None
        for cell in sorted(found.collect()):  # at most 65,536 of them
            if before + cell["size"] >= target_bytes:
                cut = cell
                break
            before += cell["size"]
        if cut is None:
            return df
        if cut.lo == cut.hi:
            break
        cells = placed.where(F.shiftright("place", shift) == F.lit(cut.cell))
    if cut.n == 1:
        return placed.where(F.col("place") <= F.lit(cut.lo)).select("row.*")
    each = max(cut["size"] // cut.n, 1)
    few = min(-(-max(target_bytes - before, 0) // each), cut.n)
    lower, equal = placed.where(F.col("place") < F.lit(cut.lo)), placed.where(F.col("place") == F.lit(cut.lo))
    # Equal rows may be very many: they are numbered over all tasks, and any so many are the same.
    some = with_row_index(equal, ["size"], name="number").where(F.col("number") <= F.lit(few))
    return lower.select("row.*").unionByName(some.select("row.*"))


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, ascending, without NULL."""
    value = F.col(column).try_cast("double").alias(column)
    return df.select(value).filter(F.col(column).isNotNull()).orderBy(column)
