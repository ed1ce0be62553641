"""Register jobs with the query that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.plans.fixtures import Data, with_views

Job = Callable[[Data], DataFrame]
JOBS: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Add a job under ``name``; without SQL only its rows are checked."""

    def add(fn: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"job {name} is registered twice")
        JOBS[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as both engines store them in the tables."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def runner(fn: Job) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return wall_clock(fn(Data(spark, sf_dir)))

    run.__name__ = fn.__name__
    return run
