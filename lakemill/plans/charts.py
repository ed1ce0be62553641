"""The profiling run: bounds and both histograms of every feature of a dataset, once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.functions.labels import dataset_title, feature_title, feature_unit
from lakemill.operators import histograms as H
from lakemill.operators.profiling import DEFAULT_COVERAGE, min_max, outlier_bounds
from lakemill.operators.quality import split_range
from lakemill.operators.sampling import sample_fraction

KINDS = ("inrange", "peak")


def chart_folder(root: str, day: str, dataset: str, kind: str) -> str:
    return f"{root}/{day}/{dataset}/{kind}"


def finished(spark: SparkSession, folder: str) -> set[str]:
    """Features that a folder of histograms holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/feature=*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return {s.getPath().getName().split("=", 1)[1] for s in found}


def described(histogram: DataFrame, raw: DataFrame, dataset: str) -> DataFrame:
    """Buckets with what a chart shows around them."""
    named = histogram.join(raw, "feature", "left")
    return named.withColumns(
        {
            "dataset_title": dataset_title(F.lit(dataset)),
            "feature_title": feature_title(F.col("feature")),
            "unit": feature_unit(F.col("feature")),
        }
    )


def real(column: str) -> Column:
    """The numeric value; NaN, which has no bucket, is left to the quality rules."""
    value = F.col(column).try_cast("double")
    return F.when(~F.isnan(value), value).alias(column)


def profile_dataset(
    table: DataFrame,
    dataset: str,
    root: str,
    day: str = "latest",
    features: Sequence[str] | None = None,
    fraction: float = 1.0,
    seed: int = 42,
    bins: int = H.DEFAULT_BINS,
    relative_error: float = 0.02,
    mode: str = "two_stage_iqr",
    coverage: float = DEFAULT_COVERAGE,
    overwrite: bool = False,
) -> list[str]:
    """Write the missing histograms of a dataset; returns (kind/feature) of those written.

    Features whose charts exist are skipped before anything is read. The
    numeric columns are materialised once for quantiles, split and counts. One
    write per kind: each feature is a folder of its own, and a rerun replaces
    only the folders it makes.
    """
    spark = table.sparkSession
    wanted = [f for f in (features or H.PEAK_FEATURES[dataset]) if f in table.columns]
    done = {k: set() if overwrite else finished(spark, chart_folder(root, day, dataset, k)) for k in KINDS}
    missing = {k: [f for f in wanted if f not in done[k]] for k in KINDS}
    needed = sorted({f for names in missing.values() for f in names})
    if not needed:
        return []
    numbers = table.select(*[real(f) for f in needed])
    if fraction < 1.0:
        numbers = sample_fraction(numbers, fraction, seed)
    numbers = numbers.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bounds = outlier_bounds(numbers, needed, mode, relative_error, coverage)
        if not bounds:
            return []
        ranged, peak = split_range(numbers, bounds)
        span = min_max(numbers, list(bounds))
        raw = spark.createDataFrame([(c, *s) for c, s in span.items()], "feature string, raw_min double, raw_max double")
        made = {
            "inrange": H.histogram(ranged, missing["inrange"], bins, bounds),
            "peak": H.peak_histogram(peak, missing["peak"], bins, bounds),
        }
        written = []
        for kind, counts in made.items():
            names = [f for f in missing[kind] if f in bounds]
            if not names:
                continue
            target = chart_folder(root, day, dataset, kind)
            described(counts, raw, dataset).coalesce(1).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("feature").parquet(target)
            written += [f"{kind}/{f}" for f in names if f in finished(spark, target)]
        return written
    finally:
        numbers.unpersist()
