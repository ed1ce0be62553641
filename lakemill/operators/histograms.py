"""Bucket counts of numeric columns as long tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.functions.values import half_even
from lakemill.operators.profiling import MIN_UPPER_BOUND, Bounds, min_max, upper_bound

# Bucket widths and numbers of the charts.
FIXED_WIDTH = 2
EVENT_BINS = 40
DEFAULT_BINS = 50

# Features with a chart of their peak values, by dataset.
PEAK_FEATURES = {
    "yellow_taxi": ("fare_amount", "mta_tax", "tolls_amount", "total_amount", "trip_distance", "trip_duration_minutes"),
    "green_taxi": ("fare_amount", "mta_tax", "tolls_amount", "total_amount", "trip_distance", "trip_duration_minutes"),
    "fhv_trip": ("trip_duration_minutes",),
    "fhvhv_trip": (
        "base_passenger_fare",
        "bcf",
        "driver_pay",
        "sales_tax",
        "tips",
        "tolls",
        "trip_duration_minutes",
        "trip_miles",
        "trip_time_seconds",
    ),
}


def bucket_counts(df: DataFrame, buckets: Mapping[str, Column]) -> DataFrame:
    """Count (feature, bucket) pairs of all features in one aggregation.

    Each row is turned upright and counted on its own partition first, so the
    shuffle carries at most features × buckets rows per task.
    """
    if not buckets:
        return df.sparkSession.createDataFrame([], "feature string, bucket int, cnt bigint")
    placed = df.select(*[b.cast("int").alias(c) for c, b in buckets.items()])
    return (
        placed.unpivot([], list(buckets), "feature", "bucket")
        .filter(F.col("bucket").isNotNull())
        .groupBy("feature", "bucket")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def width_of(low: float, high: float, bins: int, kind: str) -> float:
    """``int``: rounded half-even, at least 1. ``float``: the exact share."""
    share = (high - low) / bins
    return float(max(1, round(share))) if kind == "int" else share


def edges(spark: SparkSession, bounds: Bounds, bins: int, kind: str) -> DataFrame:
    """All buckets of all features: left and right edge and centre."""
    rows = [(c, low, width_of(low, high, bins, kind)) for c, (low, high) in bounds.items()]
    frame = spark.createDataFrame(rows, "feature string, low double, width double")
    bucket = F.col("bucket")
    centre = F.col("low") + (bucket + 0.5) * F.col("width")
    return frame.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bucket")).select(
        "feature",
        "bucket",
        (F.col("low") + bucket * F.col("width")).alias("left_edge"),
        (F.col("low") + (bucket + 1) * F.col("width")).alias("right_edge"),
        (half_even(centre) if kind == "int" else centre).alias("center"),
        F.col("width").alias("bin_width"),
    )


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int, bounds: Bounds, kind: str = "int", clamp: bool = True
) -> DataFrame:
    """Equal-width counts per feature, with zero rows for empty buckets.

    ``x >= high`` falls into the last bucket. A rounded width can leave values
    beyond the last edge or below the first: with ``clamp`` they count in the
    nearest bucket, so the counts add up; without it they are left out.
    """
    used = {c: bounds[c] for c in columns if c in bounds}
    buckets = {}
    for c, (low, high) in used.items():
        high = high if high > low else low + 1.0
        width = width_of(low, high, bins, kind)
        value = F.col(c)
        place = F.when(value >= F.lit(high), F.lit(bins - 1)).otherwise(F.floor((value - F.lit(low)) / F.lit(width)))
        if clamp:
            place = F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0))
        buckets[c] = F.when(value.isNotNull() & ~F.isnan(value.cast("double")), place)
    return fill_buckets(edges(df.sparkSession, used, bins, kind), bucket_counts(df, buckets))


def fill_buckets(frame: DataFrame, counts: DataFrame) -> DataFrame:
    filled = frame.join(counts, ["feature", "bucket"], "left")
    return filled.withColumn("cnt", F.coalesce("cnt", F.lit(0)))


def peak_histogram(
    peak: DataFrame, features: Sequence[str], bins: int, in_range: Bounds, clamp: bool = True
) -> DataFrame:
    """Counts of the peak rows above the in-range bound of each feature."""
    chosen = [c for c in features if c in in_range]
    floor = {c: in_range[c][1] for c in chosen}
    return histogram(peak, chosen, bins, min_max(peak, chosen, floor=floor), clamp=clamp)


def minmax_histogram(df: DataFrame, columns: Sequence[str], bins: int = DEFAULT_BINS) -> DataFrame:
    """First version: exact width over the raw range."""
    return histogram(df, columns, bins, min_max(df, columns), kind="float")


def fixed_edge(top: float | None) -> int:
    """Last edge of the width-2 histogram for the largest value."""
    reach = max(1.0 if top is None else float(top), MIN_UPPER_BOUND)
    return int(math.ceil(reach / FIXED_WIDTH) * FIXED_WIDTH)


#: Up to here buckets have one width (4096 of them); beyond, 64 buckets share each doubling of the value.
FIXED_REACH, OCTAVE_BUCKETS = 8192, 64
_REACH_POWER = int(math.log2(FIXED_REACH))


def _fixed_layout(top: float | None, endless: bool) -> tuple[int, int, bool]:
    """Last edge of the even buckets, number of wider ones beyond them, and whether an open one comes last."""
    last = fixed_edge(top if top is None else min(top, FIXED_REACH))
    wider = 0
    if top is not None and top > FIXED_REACH:
        power = math.frexp(top)[1] - 1
        wider = (power - _REACH_POWER) * OCTAVE_BUCKETS + int(math.ldexp(top, -power) * OCTAVE_BUCKETS - OCTAVE_BUCKETS) + 1
    return last, wider, endless


def _fixed_frame(spark: SparkSession, layout: tuple[int, int, bool]) -> DataFrame:
    last, wider, endless = layout
    even = last // FIXED_WIDTH
    place = F.col("id") - even
    left = lambda k: F.pow(F.lit(2.0), F.lit(_REACH_POWER) + F.floor(k / OCTAVE_BUCKETS)) * (
        1 + F.pmod(k, F.lit(OCTAVE_BUCKETS)) / OCTAVE_BUCKETS
    )
    beyond = F.lit(float("inf"))
    is_even, is_open = F.col("id") < even, F.col("id") >= even + wider
    low = F.when(is_even, (F.col("id") * FIXED_WIDTH).cast("double")).otherwise(left(place) if wider else F.lit(float(last)))
    high = F.when(is_even, ((F.col("id") + 1) * FIXED_WIDTH).cast("double")).when(is_open, beyond).otherwise(left(place + 1))
    framed = spark.range(even + wider + int(endless)).select(F.col("id").cast("int").alias("bucket"), low.alias("left_edge"), high.alias("right_edge"))
    return framed.withColumn("center", F.when(is_finite("right_edge"), F.col("left_edge") + (F.col("right_edge") - F.col("left_edge")) / 2).otherwise(beyond))


def is_finite(column: str | Column) -> Column:
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def _fixed_bucket(value: Column, layout: tuple[int, int, bool]) -> Column:
    """Bucket of a value; the last even bucket is closed if none follows, negatives are ignored.

    Infinity and NaN, which Spark orders last, fall into the open bucket.
    """
    last, wider, _ = layout
    even, value = last // FIXED_WIDTH, value.cast("double")
    power = F.floor(F.log2(value))
    # The logarithm is rounded; powers of two are exact.
    power = F.when(value < F.pow(F.lit(2.0), power), power - 1).when(value >= F.pow(F.lit(2.0), power + 1), power + 1).otherwise(power)
    within = F.floor(value / F.pow(F.lit(2.0), power) * OCTAVE_BUCKETS) - OCTAVE_BUCKETS
    place = F.least(F.floor(value / FIXED_WIDTH), F.lit(even - 1))
    return (
        F.when(F.isnan(value) | (value == F.lit(float("inf"))), F.lit(even + wider))
        .when((value >= FIXED_REACH) & F.lit(wider > 0), even + (power - _REACH_POWER) * OCTAVE_BUCKETS + within)
        .when(value >= 0, place)
        .cast("int")
    )


def _reach(column: str) -> list[Column]:
    """Largest finite value, and whether there are infinite ones or NaN."""
    value = F.col(column).cast("double")
    beyond = F.isnan(value) | (value == F.lit(float("inf")))
    return [F.max(F.when(is_finite(value), value)).alias("top"), F.coalesce(F.max(beyond), F.lit(False)).alias("endless")]


def fixed_histogram(df: DataFrame, column: str) -> DataFrame:
    """Counts over [0, 2), [2, 4), … up to the largest value, the last closed.

    Beyond 8192 buckets widen with the value, 64 to a doubling, and infinity and
    NaN have an open bucket at the end: the result stays bounded, and every value
    but negative ones is counted.
    """
    layout = _fixed_layout(*df.agg(*_reach(column)).first())
    counts = (
        df.select(_fixed_bucket(F.col(column), layout).alias("bucket"))
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return _fixed_frame(df.sparkSession, layout).join(counts, "bucket", "left").withColumn(
        "cnt", F.coalesce("cnt", F.lit(0))
    )


def compare_histograms(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Counts of two inputs over common edges, with the number of their values, NaN and infinity included."""
    tagged = before.select(F.col(column).alias("v"), F.lit(0).alias("side")).unionByName(
        after.select(F.col(column).alias("v"), F.lit(1).alias("side"))
    )
    tagged = tagged.filter(F.col("v").isNotNull())
    totals = tagged.agg(
        *_reach("v"), F.count_if(F.col("side") == 0).alias("before"), F.count_if(F.col("side") == 1).alias("after")
    ).first()
    layout = _fixed_layout(totals.top, totals.endless)
    counts = (
        tagged.select("side", _fixed_bucket(F.col("v"), layout).alias("bucket"))
        .groupBy("bucket")
        .agg(
            F.count_if(F.col("side") == 0).alias("before_cnt"),
            F.count_if(F.col("side") == 1).alias("after_cnt"),
        )
    )
    filled = _fixed_frame(before.sparkSession, layout).join(counts, "bucket", "left")
    return filled.withColumns(
        {
            "before_cnt": F.coalesce("before_cnt", F.lit(0)),
            "after_cnt": F.coalesce("after_cnt", F.lit(0)),
            "before_rows": F.lit(totals.before).cast("bigint"),
            "after_rows": F.lit(totals.after).cast("bigint"),
        }
    )


def ceil_width(bound: float, bins: int = EVENT_BINS) -> float:
    return float(max(1, math.ceil(max(bound, 1.0) / bins)))


def ceil_bucket(value: Column, bound: float, bins: int = EVENT_BINS) -> Column:
    """Values from the bound on fall into the last bucket, negatives into none."""
    place = F.floor(value / F.lit(ceil_width(bound, bins)))
    return F.when(value >= F.lit(bound), F.lit(bins - 1)).when(value >= 0, place).cast("int")


def ceil_frame(spark: SparkSession, bound: float, bins: int = EVENT_BINS) -> DataFrame:
    width = ceil_width(bound, bins)
    return spark.range(bins).select(
        F.col("id").cast("int").alias("bucket"),
        (F.col("id") * F.lit(width)).alias("left_edge"),
        ((F.col("id") + 1) * F.lit(width)).alias("right_edge"),
        F.lit(width).alias("bin_width"),
        F.lit(float(bound)).alias("upper_bound"),
        F.lit(width * bins).alias("max_edge"),
    )


def ceil_histogram(
    df: DataFrame, column: str, bins: int = EVENT_BINS, relative_error: float = 0.02, bound: float | None = None
) -> DataFrame:
    """Event histogram: whole-number width up to the two-stage bound."""
    values = df.select(F.col(column).try_cast("double").alias("v")).filter(F.col("v").isNotNull())
    bound = upper_bound(values, "v", relative_error) if bound is None else bound
    counts = (
        values.select(ceil_bucket(F.col("v"), bound, bins).alias("bucket"))
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return (
        ceil_frame(df.sparkSession, bound, bins).join(counts, "bucket", "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))
    )


def missing_outputs(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Output keys that still have to be computed."""
    return wanted.join(existing.select("key").distinct(), "key", "left_anti")


def output_keys(spark: SparkSession, day: str, dataset: str) -> DataFrame:
    """In-range and peak keys of every profiled feature of a dataset."""
    features = spark.createDataFrame([(f,) for f in PEAK_FEATURES[dataset]], "feature string")
    kinds = F.explode(F.array(F.lit("inrange"), F.lit("peak"))).alias("kind")
    return features.select("feature", kinds).withColumn(
        "key", F.concat_ws("/", F.lit(day), F.lit(dataset), "feature", F.concat("kind", F.lit(".png")))
    )


def histogram_document(buckets: DataFrame, row_count: int, feature: str, mode: str) -> DataFrame:
    """One row with edges and counts as arrays, from the buckets of one histogram."""
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "left_edge", "cnt")))
    made = buckets.agg(
        ordered.alias("b"),
        F.max("bin_width").alias("bin_width"),
        F.max("upper_bound").alias("upper_bound"),
        F.max("max_edge").alias("max_edge"),
    )
    return made.select(
        F.lit(feature).alias("feature"),
        F.lit(mode).alias("mode"),
        F.lit(row_count).cast("bigint").alias("row_count"),
        "bin_width",
        "upper_bound",
        "max_edge",
        F.array_append(F.transform("b", lambda x: x["left_edge"]), F.col("max_edge")).alias("bin_edges"),
        F.transform("b", lambda x: x["cnt"]).alias("counts"),
    )
