import math
import random

import pytest
from pyspark.sql import functions as F

from lakemill.operators import histograms as H
from lakemill.operators import profiling as P
from lakemill.operators import sampling


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def by_rank(values, p):
    values = sorted(v for v in values if v is not None)
    return float(values[max(math.ceil(p * len(values)), 1) - 1])


@pytest.mark.parametrize("kind", ["spread", "hot", "few", "tails"])
def test_exact_quantiles_with_small_limits(spark, kind):
    random.seed(7)
    values = {
        "spread": [random.gauss(0, 100) for _ in range(3000)],
        "hot": [5.0] * 1000 + [random.random() * 10 for _ in range(2000)],
        "few": [random.choice([1, 2, 3]) for _ in range(3000)],
        "tails": [random.random() for _ in range(2900)] + [10.0**i for i in range(100)],
    }[kind]
    shares = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = P.exact_quantiles(frame(spark, values + [None] * 50), ["x"], shares, small=50, accuracy=100)
    assert got["x"] == [by_rank(values, p) for p in shares]


def test_quantiles_of_nothing(spark):
    df = frame(spark, [None, None])
    assert P.exact_quantiles(df, ["x"], (0.5,)) == {"x": []}
    assert P.outlier_bounds(df, ["x"]) == {}
    assert P.upper_bound(df, "x") == 10.0


def test_bounds_modes(spark):
    values = list(range(1, 101)) + [1000, 1010, 1020, 5000]
    df = frame(spark, values)
    q25, q75, q99 = (by_rank(values, p) for p in (0.25, 0.75, 0.99))
    first = min(q99, q75 + 3 * (q75 - q25))
    tail = [v for v in values if v > first]
    t25, t75, t99 = (by_rank(tail, p) for p in (0.25, 0.75, 0.99))
    assert P.outlier_bounds(df, ["x"], "two_stage_iqr", 0.0)["x"] == (0.0, max(first, min(t99, t75 + 3 * (t75 - t25))))
    assert P.outlier_bounds(df, ["x"], "hard_cap", 0.0)["x"] == (0.0, max(first, 200.0))
    cover = P.outlier_bounds(df, ["x"], "coverage_quantile", 0.0, coverage=2.0)["x"]
    assert cover == (0.0, by_rank(values, 0.9999))
    with pytest.raises(ValueError):
        P.outlier_bounds(df, ["x"], "other")


def test_bounds_without_spread_or_tail(spark):
    assert P.outlier_bounds(frame(spark, [4.0] * 10), ["x"], relative_error=0.0)["x"] == (0.0, 4.0)
    assert P.outlier_bounds(frame(spark, [0.0] * 10), ["x"], relative_error=0.0)["x"] == (0.0, 1.0)


def test_min_max_with_floor_and_cap(spark):
    df = frame(spark, [-5, 3, 50])
    assert P.min_max(df, ["x"]) == {"x": (-5.0, 50.0)}
    assert P.min_max(df, ["x"], {"x": 0.0}, {"x": 10.0}) == {"x": (0.0, 10.0)}
    assert P.min_max(frame(spark, [2, 2]), ["x"]) == {"x": (2.0, 3.0)}
    assert P.min_max(frame(spark, [None]), ["x"]) == {}


def counts(df):
    return {r.bucket: r.cnt for r in df.collect() if r.cnt}


def test_rounded_width_overflow(spark):
    # Range 70 in 50 buckets: the width rounds to 1 and leaves 50..69 without one.
    df = frame(spark, range(71))
    clamped = H.histogram(df, ["x"], 50, {"x": (0.0, 70.0)})
    assert clamped.count() == 50 and sum(counts(clamped).values()) == 71 and counts(clamped)[49] == 22
    lossy = H.histogram(df, ["x"], 50, {"x": (0.0, 70.0)}, clamp=False)
    assert sum(counts(lossy).values()) == 51 and counts(lossy)[49] == 2


def test_half_even_width(spark):
    assert H.width_of(0, 100, 40, "int") == 2.0  # 2.5 rounds to the even 2
    assert H.width_of(0, 140, 40, "int") == 4.0
    assert H.width_of(0, 1, 40, "int") == 1.0
    assert H.width_of(0, 1, 4, "float") == 0.25


def test_values_below_the_first_edge(spark):
    df = frame(spark, [-3, 1])
    assert counts(H.histogram(df, ["x"], 4, {"x": (0.0, 4.0)})) == {0: 1, 1: 1}
    assert counts(H.histogram(df, ["x"], 4, {"x": (0.0, 4.0)}, clamp=False)) == {1: 1}


def test_fixed_width_edges(spark):
    got = H.fixed_histogram(frame(spark, [1.5, 2.0, 10.0, -1.0, None]), "x")
    assert got.count() == 5 and counts(got) == {0: 1, 1: 1, 4: 1}  # the last bucket is closed
    assert H.fixed_histogram(frame(spark, []), "x").count() == 5
    assert H.fixed_edge(10.1) == 12 and H.fixed_edge(None) == 10


def test_ceil_width(spark):
    empty = H.ceil_histogram(frame(spark, [None]), "x")
    assert empty.count() == 40 and empty.first().upper_bound == 10.0 and counts(empty) == {}
    got = H.ceil_histogram(frame(spark, [1, 2, 3, 50, 60]), "x", bound=50.0)
    assert got.first().bin_width == 2.0 and counts(got) == {0: 1, 1: 2, 39: 2}


def test_compare_uses_common_edges(spark):
    got = H.compare_histograms(frame(spark, [1, 3]), frame(spark, [1, 3, 15]), "x")
    assert got.count() == 8
    first = got.orderBy("bucket").first()
    assert (first.before_cnt, first.after_cnt, first.before_rows, first.after_rows) == (1, 1, 2, 3)


def test_peak_histogram_of_no_peak(spark):
    df = frame(spark, [1, 2])
    assert H.peak_histogram(df.filter("x > 5"), ["x"], 40, {"x": (0.0, 5.0)}).count() == 0


def test_missing_outputs(spark):
    wanted = H.output_keys(spark, "2024-01-01", "fhv_trip")
    assert wanted.count() == 2
    assert H.missing_outputs(wanted, wanted).count() == 0
    assert H.missing_outputs(wanted, wanted.filter("kind = 'peak'")).first().kind == "inrange"


def test_sample_to_bytes(spark):
    df = spark.range(5000).withColumn("t", F.lit("some text"))
    total = sampling.json_bytes(df)
    assert sampling.sample_to_bytes(df, total * 2, 1).count() == 5000
    part = sampling.sample_to_bytes(df, total // 3, 1)
    assert total // 3 <= sampling.json_bytes(part) < total // 3 + 40
    assert sorted(part.collect()) == sorted(sampling.sample_to_bytes(df.repartition(7), total // 3, 1).collect())


def test_sample_of_equal_rows_and_of_one_cell(spark, monkeypatch):
    """Equal rows have one place, of which as many stay as it takes; a narrow first step makes further passes."""
    df = spark.range(900).select(F.lit("same").alias("row"), F.lit(1).alias("size"))
    each = sampling.json_bytes(df) // 900
    for target in (0, 1, each, 10 * each + 1, 450 * each):
        assert sampling.sample_to_bytes(df, target, 3).count() == -(-target // each)
    monkeypatch.setattr(sampling, "STEP_BITS", 4)
    mixed = spark.range(3000).select(F.repeat(F.lit("ab"), (F.col("id") % 9).cast("int")).alias("place"), "id")
    total = sampling.json_bytes(mixed)
    part = sampling.sample_to_bytes(mixed, total // 5, 3)
    assert 0 <= sampling.json_bytes(part) - total // 5 < 60 and part.columns == mixed.columns
    assert sampling.sample_to_bytes(mixed.limit(0), 10, 3).count() == 0


def test_fixed_histogram_of_any_value(spark):
    """1e9, 1e300, infinity and NaN are counted, each in the bucket whose edges hold it, in a bounded number of rows."""
    values = [0.0, 1.9, 2.0, 8191.9, 8192.0, 8319.9, 8320.0, 16384.0, 1e9, 1e300, 1.7e308, float("inf"), float("nan"), -1.0]
    got = H.fixed_histogram(frame(spark, values), "x").collect()
    assert sum(r.cnt for r in got) == len(values) - 1 and len(got) <= 4096 + 64 * 1011 + 1
    for v in values[:11]:
        assert sum(r.cnt for r in got if r.left_edge <= v < r.right_edge) >= 1
        assert sum(1 for r in got if r.left_edge <= v < r.right_edge) == 1
    assert max(got, key=lambda r: r.bucket).cnt == 2 and {r.bucket for r in got} == set(range(len(got)))
    both = H.compare_histograms(frame(spark, values), frame(spark, values[:3]), "x").collect()
    assert {(r.before_rows, r.after_rows) for r in both} == {(14, 3)}
    assert sum(r.before_cnt for r in both) == 13 and sum(r.after_cnt for r in both) == 3
