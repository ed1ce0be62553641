"""Mergeable summaries of a value column: a quantile sketch and counts of fixed cells.

A micro-batch adds its own summary to that of the batch before and stores the
sum, so what it reads and writes does not depend on how many rows came before.
Bounds come from the sketch, histogram counts from the cells. A cell is one unit
wide up to 2048 and at most a thousandth of its values beyond, so an edge in the
middle of a cell leaves only that cell to be shared out by the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.operators.histograms import EVENT_BINS, ceil_width
from lakemill.operators.profiling import MIN_UPPER_BOUND, TAIL_PROBABILITIES, fence

#: Cells of one octave; below twice as many, cells are one unit wide.
OCTAVE = 1024
#: The sketch keeps all values up to so many, and then ranks with an error of some 2.4 / size ** 0.94.
LARGEST_SKETCH, SMALLEST_SKETCH = 65_535, 256
SUMMARY = "cell bigint, cnt bigint, sketch binary"
#: Cells of negative values, which no bucket counts, and of NaN, which the last one does.
NEGATIVE, NOT_A_NUMBER = -1, -2


def sketch_size(relative_error: float) -> int:
    """Size of the sketch for an error of ranks; 0 asks for the largest."""
    if relative_error <= 0:
        return LARGEST_SKETCH
    return min(max(math.ceil((2.446 / relative_error) ** (1 / 0.9433)), SMALLEST_SKETCH), LARGEST_SKETCH)


def cell_of(value: Column) -> Column:
    """The cell of a double; infinity has the one after the last finite one."""
    power = F.floor(F.log2(value))
    # The logarithm is rounded; the power of two itself is exact.
    power = F.when(value < F.pow(F.lit(2.0), power), power - 1).when(value >= F.pow(F.lit(2.0), power + 1), power + 1).otherwise(power)
    octave = power - int(math.log2(OCTAVE))
    beyond = octave * OCTAVE + F.floor(value / F.pow(F.lit(2.0), octave))
    top = F.lit(1024 * OCTAVE + 2 * OCTAVE)
    return (
        F.when(F.isnan(value), F.lit(NOT_A_NUMBER)).when(value < 0, F.lit(NEGATIVE)).when(value < 2 * OCTAVE, F.floor(value))
        .when(value == F.lit(float("inf")), top).otherwise(beyond).cast("bigint")
    )


def cell_span(cell: int) -> tuple[float, float]:
    """Left edge and width of a cell."""
    if cell < 2 * OCTAVE:
        return float(cell), 1.0
    octave = cell // OCTAVE - 1
    if octave > 1013:
        return math.inf, 0.0
    return math.ldexp(cell - octave * OCTAVE, octave), math.ldexp(1.0, octave)


def place_of(edge: float) -> int:
    """The cell of an edge, as ``cell_of`` has it."""
    if edge < 2 * OCTAVE:
        return int(math.floor(edge))
    octave = math.frexp(edge)[1] - 1 - int(math.log2(OCTAVE))
    return octave * OCTAVE + int(math.floor(math.ldexp(edge, -octave)))


def summarise(rows: DataFrame, column: str, size: int) -> DataFrame:
    """The summary of a column: a row for each cell, and one with the sketch."""
    values = rows.select(F.col(column).try_cast("double").alias("v")).where(F.col("v").isNotNull())
    # NaN and infinity are no values to the sketch, and -0.0 is 0.0.
    finite = F.when(F.abs("v") < F.lit(math.inf), F.col("v") + F.lit(0.0))
    sketch = values.agg(F.kll_sketch_agg_double(finite, F.lit(size)).alias("sketch"))
    cells = values.groupBy(cell_of(F.col("v")).alias("cell")).agg(F.count(F.lit(1)).alias("cnt"))
    none = lambda kind: F.lit(None).cast(kind)
    return cells.select("cell", "cnt", none("binary").alias("sketch")).unionByName(
        sketch.select(none("bigint").alias("cell"), none("bigint").alias("cnt"), "sketch")
    )


def merged(summaries: DataFrame, size: int) -> DataFrame:
    """Several summaries as one. Without the size, an empty task would bring in a sketch of the default one."""
    cells = summaries.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("cnt").alias("cnt"))
    sketch = summaries.where("sketch IS NOT NULL").agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))
    return cells.withColumn("sketch", F.lit(None).cast("binary")).unionByName(
        sketch.select(F.lit(None).cast("bigint").alias("cell"), F.lit(None).cast("bigint").alias("cnt"), "sketch")
    )


@dataclass
class Ranks:
    """Questions to the sketch of a summary; each is a job over one row."""

    sketch: DataFrame

    def count(self) -> int:
        found = self.sketch.select(F.kll_sketch_get_n_double("sketch")).first()
        return found[0] if found and found[0] else 0

    def values(self, ranks: Sequence[int], n: int) -> list[float]:
        """The values of these ranks, counted from 1."""
        shares = F.array(*[F.lit((r - 0.5) / n) for r in ranks])
        return list(self.sketch.select(F.kll_sketch_get_quantile_double("sketch", shares)).first()[0])

    def up_to(self, edges: Sequence[float], n: int) -> list[int]:
        """How many values are at most each edge."""
        if not edges or not n:
            return [0] * len(edges)
        shares = self.sketch.select(F.kll_sketch_get_rank_double("sketch", F.array(*[F.lit(e) for e in edges]))).first()[0]
        return [round(s * n) for s in shares]


def bound_of(ranks: Ranks, n: int) -> float:
    """The two-stage upper bound, as of the values themselves: quartile fence, then the fence of what lies beyond."""
    if not n:
        return MIN_UPPER_BOUND
    rank = lambda p, rows: min(max(math.ceil(p * rows), 1), rows)
    high = fence(*ranks.values([rank(p, n) for p in TAIL_PROBABILITIES], n))
    low = ranks.up_to([high], n)[0]
    if low >= n:
        return max(high, MIN_UPPER_BOUND)
    tail = fence(*ranks.values([low + rank(p, n - low) for p in TAIL_PROBABILITIES], n))
    return max(high, tail, MIN_UPPER_BOUND)


def histogram_of(summary: DataFrame, bins: int = EVENT_BINS) -> DataFrame:
    """The event histogram of what a summary stands for: one row for each of ``bins`` buckets.

    All counts are exact but for cells that an edge cuts, which the sketch
    shares out; with values no more than the sketch's size it shares exactly.
    """
    spark = summary.sparkSession
    ranks = Ranks(summary.where("sketch IS NOT NULL").select("sketch"))
    n = ranks.count()
    bound = bound_of(ranks, n)
    width = ceil_width(bound, bins)
    # Edges of buckets below the bound; from the bound on all is the last bucket's.
    edges = [k * width for k in range(1, bins) if k * width < bound] + [bound]
    buckets = list(range(len(edges))) + [bins - 1]
    cut: dict[int, list[float]] = {}
    for edge in edges:
        cell = place_of(edge)
        if cell_span(cell)[0] < edge:
            cut.setdefault(cell, []).append(edge)
    cells = summary.where(f"cell IS NOT NULL AND cell <> {NEGATIVE}")
    starts = [place_of(e) + (1 if cell_span(place_of(e))[0] < e else 0) for e in edges]
    # How many edges lie at or before the cell: at most one bucket a row leaves the aggregation, and the cells that are cut.
    bucket = F.when(F.col("cell") == NOT_A_NUMBER, F.lit(len(edges))).otherwise(
        F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= F.col("cell")))
    )
    whose = F.when(F.col("cell").isin(*cut), F.col("cell")) if cut else F.lit(None).cast("bigint")
    found = cells.groupBy(bucket.alias("piece"), whose.alias("whose")).agg(F.sum("cnt").alias("cnt")).collect()
    counts = [0] * bins
    for piece, cell, cnt in found:
        if cell is None:
            counts[buckets[piece]] += cnt
            continue
        # A cell with edges inside: its rows between them, by the sketch, and no more than there are.
        left, inside = cell_span(cell)[0], cut[cell]
        below = [math.nextafter(e, -math.inf) for e in (left, *inside)]
        base, *upto = ranks.up_to(below, n)
        taken = 0
        for edge, reach in zip(inside, upto):
            part = min(max(reach - base - taken, 0), cnt - taken)
            counts[buckets[edges.index(edge)]] += part
            taken += part
        counts[buckets[edges.index(inside[-1]) + 1]] += cnt - taken
    rows = [(b, b * width, (b + 1) * width, width, float(bound), width * bins, c) for b, c in enumerate(counts)]
    return spark.createDataFrame(
        rows, "bucket int, left_edge double, right_edge double, bin_width double, upper_bound double, max_edge double, cnt bigint"
    )


def empty_summary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SUMMARY)
