"""Summaries of values against the values themselves."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lakemill.operators.histograms import ceil_histogram
from lakemill.streaming import summaries as M


def values(kind, n):
    draw = random.Random(kind)
    if kind == "money":
        return [round(draw.lognormvariate(2.5, 1.2), 2) for _ in range(n)]
    if kind == "large":
        return [draw.lognormvariate(9, 2) for _ in range(n)]
    return [draw.choice([0.0, -0.0, -5.0, 3.0, 10.0, 10.5, float("nan"), float("inf"), 1e300, 1e9]) for _ in range(n)]


@pytest.mark.parametrize("kind", ["money", "large", "odd"])
def test_merged_summaries_give_the_histogram_of_all_values(spark, tmp_path, kind):
    all_values = values(kind, 3000)
    frame = lambda part: spark.createDataFrame([(v,) for v in part], "v double")
    state = M.empty_summary(spark)
    for at in range(0, 3000, 1000):
        part = M.summarise(frame(all_values[at : at + 1000]), "v", M.LARGEST_SKETCH)
        M.merged(state.unionByName(part), M.LARGEST_SKETCH).write.parquet(str(tmp_path / f"{at}"))
        state = spark.read.parquet(str(tmp_path / f"{at}"))
    built = {r.bucket: tuple(r) for r in M.histogram_of(state).collect()}
    whole = frame(all_values)
    bound = next(iter(built.values()))[4]
    truth = {r.bucket: (r.bucket, r.left_edge, r.right_edge, r.bin_width, r.upper_bound, r.max_edge, r.cnt) for r in ceil_histogram(whole, "v", relative_error=0.0).collect()}
    assert bound == truth[0][4] and built == truth


def test_error_beyond_the_size_of_the_sketch(spark):
    rows = spark.range(200_000).select((F.col("id") * 0.01).alias("v"))
    built = M.histogram_of(M.summarise(rows, "v", M.sketch_size(0.02))).collect()
    assert sum(r.cnt for r in built) == 200_000
    exact = ceil_histogram(rows, "v", bound=built[0].upper_bound).collect()
    whole = {r.bucket: r.cnt for r in exact}
    assert all(abs(r.cnt - whole[r.bucket]) <= 0.02 * 200_000 for r in built)
    assert 0.9 * 1980 < built[0].upper_bound <= 2000


def test_cells():
    for cell in (0, 5, 2047, 2048, 3071, 3072, 4095, 4096, 50_000, 1_000_000):
        left, width = M.cell_span(cell)
        assert M.place_of(left) == cell == M.place_of(math.nextafter(left + width, 0))


def test_empty(spark):
    none = spark.createDataFrame([], "v double")
    made = M.histogram_of(M.merged(M.summarise(none, "v", 256), 256)).collect()
    assert len(made) == M.EVENT_BINS and sum(r.cnt for r in made) == 0 and made[0].upper_bound == 10.0
    only = M.histogram_of(M.summarise(spark.createDataFrame([(float("nan"),)], "v double"), "v", 256)).collect()
    assert sum(r.cnt for r in only) == 1 and only[-1].cnt == 1
