"""Consecutive row numbers over a whole table without one giant window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemill.session import checkpoint_dir

_POSITION_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _order(columns: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def spread(df: DataFrame, order: Sequence[Column | str], unique: bool = False) -> DataFrame:
    """Range-partition and sort by ``order`` and note partition and position.

    The result is written to the checkpoint folder, so partition numbers stay
    valid when executors are lost and range boundaries would be sampled anew.

    Rows that are equal in ``order`` may be a third of the table. Unless the
    order is ``unique``, a random tie-break spreads them over partitions; it is
    written down first, so a repeated task sees the same values.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    columns = _order(order)
    if not unique:
        df = df.withColumn("_tie", F.rand(0)).checkpoint()
        columns.append(F.col("_tie"))
    placed = (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _POSITION_BITS).cast("int"))
        .withColumn("_position", F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_place")
    )
    return placed.checkpoint()


def part_offsets(placed: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Rows of each partition (and group) that lie before it, one row per part."""
    counts = placed.groupBy("_part", *within).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first")
    )
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def with_row_index(
    df: DataFrame,
    order: Sequence[Column | str],
    within: Sequence[str] = (),
    name: str = "row_index",
    unique: bool = False,
) -> DataFrame:
    """Number rows 1, 2, … in ``order``, restarting for each ``within`` group.

    Rows are placed by (group, order), so a group with a third of the table is
    spread over many tasks. Only one count per partition and group is combined.
    End ``order`` in a unique column, and say so, for numbers that do not depend
    on the run and for one write less.
    """
    if not order:
        raise ValueError("a row index needs an order")
    groups = [f"_group{i}" for i in range(len(within))]
    keyed = df.withColumns({g: F.col(c) for g, c in zip(groups, within)}) if within else df
    placed = spread(keyed, [*groups, *order], unique)
    offsets = part_offsets(placed, groups)
    shift = [F.col(f"o.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("_part", *groups)]
    numbered = placed.alias("p").join(offsets.alias("o"), shift, "inner")
    index = F.col("p._position") - F.col("o._first") + F.col("o._before") + 1
    return numbered.select(*[F.col(f"p.`{c}`") for c in df.columns], index.cast("bigint").alias(name))
