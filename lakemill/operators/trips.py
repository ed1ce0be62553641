"""Trip measures and the four gold trip tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakemill.functions.values import minutes_between, ratio

KEYS = ("domain", "vendor_id", "pickup_datetime")

# Payment codes that mean a card, and the parts of the fees.
CARD_CODES = {"yellow": ("CRD", "CRE", "1"), "green": ("1",)}
FEE_COLUMNS = {
    "yellow": ("surcharge", "mta_tax", "tolls_amount"),
    "green": ("extra", "mta_tax", "tolls_amount", "improvement_surcharge"),
}
PEAK_HOURS = ((7, 9), (16, 19))
WEEKEND_DAYS = (1, 7)  # 1 = Sunday
SHORT_BELOW, MEDIUM_BELOW = 2, 10


def with_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_duration_minutes", minutes_between("pickup_datetime", "dropoff_datetime"))


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"pickup_hour": F.hour("pickup_datetime"), "pickup_weekday": F.dayofweek("pickup_datetime")})


def with_trip_time(df: DataFrame) -> DataFrame:
    return with_calendar(with_duration(df))


def gold_tips(df: DataFrame) -> DataFrame:
    return df.select(
        *KEYS,
        "tip_amount",
        "fare_amount",
        ratio("tip_amount", "fare_amount", 2).alias("tip_ratio"),
        (F.col("tip_amount") > 0).alias("is_tipped"),
    )


def gold_performance(df: DataFrame) -> DataFrame:
    minutes = F.col("trip_duration_minutes")
    return df.select(
        *KEYS,
        "trip_distance",
        "trip_duration_minutes",
        ratio(F.col("trip_distance"), minutes / 60.0, 2).alias("avg_speed_mph"),
        ratio(F.col("total_amount"), minutes, 2).alias("revenue_per_minute"),
    )


def gold_financials(df: DataFrame, fee_columns: Sequence[str]) -> DataFrame:
    fees = sum((F.col(c) for c in fee_columns[1:]), F.col(fee_columns[0]))
    return df.select(
        *KEYS,
        F.round(fees, 2).alias("total_fees"),
        "total_amount",
        ratio("total_amount", "trip_distance", 2).alias("cost_per_mile"),
        ratio("total_amount", "passenger_count", 2).alias("fare_per_passenger"),
    )


def gold_classes(df: DataFrame, card_codes: Sequence[str]) -> DataFrame:
    """Needs the calendar columns of :func:`with_calendar`."""
    hour, distance = F.col("pickup_hour"), F.col("trip_distance")
    peak = F.lit(False)
    for first, last in PEAK_HOURS:
        peak = peak | hour.between(first, last)
    suspicious = F.lit(False)
    for measure in ("trip_distance", "fare_amount", "trip_duration_minutes"):
        suspicious = suspicious | (F.col(measure) <= 0)
    return df.select(
        *KEYS,
        peak.alias("is_peak_hour"),
        F.col("pickup_weekday").isin(*WEEKEND_DAYS).alias("is_weekend"),
        F.when(distance < SHORT_BELOW, "short").when(distance < MEDIUM_BELOW, "medium").otherwise("long").alias("trip_type"),
        F.col("payment_type").isin(*card_codes).alias("is_card_payment"),
        suspicious.alias("is_suspicious"),
    )


def gold_trip_tables(df: DataFrame, dataset: str) -> dict[str, DataFrame]:
    """The four gold tables of a silver trip table, by name suffix."""
    base = with_calendar(df)
    return {
        "tips": gold_tips(base),
        "performance": gold_performance(base),
        "financials": gold_financials(base, FEE_COLUMNS[dataset]),
        "classifications": gold_classes(base, CARD_CODES[dataset]),
    }


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough and zone names for both ends of a trip; unknown ids keep NULL.

    The lookup is left to the size check of the optimizer: a small zone table
    is broadcast, a large one is joined by sorting.
    """
    out = trips
    for side, key in (("pickup", "pu_location_id"), ("dropoff", "do_location_id")):
        named = zones.select(
            F.col("zone_id").alias(key), F.col("borough").alias(f"{side}_borough"), F.col("zone").alias(f"{side}_zone")
        )
        out = out.join(named, key, "left")
    return out
