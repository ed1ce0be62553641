"""Display formatting for dashboard rows."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Colours, thresholds and Vietnamese texts of the dashboard.
COLOR_CRITICAL = "#ff4d4f"
COLOR_WARNING = "#fa8c16"
COLOR_OK = "#52c41a"
COLOR_BLUE = "#1677ff"
COLOR_PURPLE = "#722ed1"
COLOR_GREY = "#8c8c8c"
CRITICAL_PERCENT = 85
WARNING_PERCENT = 70

# Unit of each profiled feature.
FEATURE_UNITS = {
    "trip_duration": "minutes",
    "trip_duration_minutes": "minutes",
    "duration_minutes": "minutes",
    "trip_time_seconds": "seconds",
    "trip_distance": "miles",
    "trip_miles": "miles",
    "distance_miles": "miles",
    "fare_amount": "USD",
    "tip_amount": "USD",
    "tips": "USD",
    "tolls": "USD",
    "tolls_amount": "USD",
    "extra": "USD",
    "mta_tax": "USD",
    "improvement_surcharge": "USD",
    "total_amount": "USD",
    "base_passenger_fare": "USD",
    "bcf": "USD",
    "sales_tax": "USD",
    "driver_pay": "USD",
    "pickup_latitude": "degrees",
    "pickup_longitude": "degrees",
    "dropoff_latitude": "degrees",
    "dropoff_longitude": "degrees",
    "passenger_count": "count",
}

# Name pattern → unit, first match wins.
UNIT_PATTERNS = (
    ("duration|_minutes$", "minutes"),
    ("distance|miles", "miles"),
    ("amount|fare|tip|toll|tax|surcharge|pay", "USD"),
    ("time_seconds|_seconds$", "seconds"),
    ("count", "count"),
    ("latitude|longitude", "degrees"),
)


def money(column: Column) -> Column:
    """NULL counts as zero; 24 digits are enough for any ledger total."""
    return F.coalesce(column.try_cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)"))


def dotted_thousands(column: Column) -> Column:
    """Integer part with ``.`` between groups of three digits."""
    whole = column.cast("decimal(38,0)") if isinstance(column, Column) else column
    return F.translate(F.format_number(whole, 0), ",", ".")


def short_currency(column: Column) -> Column:
    amount = money(column)
    scaled = lambda unit: F.round(amount / F.lit(unit).cast("decimal(10,0)"), 2).cast("decimal(28,2)").cast("string")
    truncated = F.when(amount < 0, F.ceil(amount)).otherwise(F.floor(amount))
    return (
        F.when(F.abs(amount) >= 1_000_000_000, F.concat(scaled(1_000_000_000), F.lit(" tỷ")))
        .when(F.abs(amount) >= 1_000_000, F.concat(scaled(1_000_000), F.lit(" triệu")))
        .otherwise(F.concat(dotted_thousands(truncated), F.lit(" VND")))
    )


def percent_of(ratio: Column) -> Column:
    """A ratio as a percentage with one half-up decimal."""
    return F.round(money(ratio) * 100, 1).cast("decimal(18,1)")


def load_color(percent: Column) -> Column:
    return (
        F.when(percent >= CRITICAL_PERCENT, COLOR_CRITICAL)
        .when(percent >= WARNING_PERCENT, COLOR_WARNING)
        .otherwise(COLOR_OK)
    )


def first_text(*columns: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def finance_bucket_label(bucket: Column) -> Column:
    text = F.trim(bucket)
    return (
        F.when(bucket.isNull(), "Không xác định")
        .when(text.startswith("invoice_type_"), F.concat(F.lit("Nhóm hóa đơn "), F.regexp_replace(text, "^invoice_type_", "")))
        .otherwise(text)
    )


def feature_unit(feature: Column) -> Column:
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(FEATURE_UNITS.items())])
    key = F.lower(feature)
    by_name = F.lit("value")
    for pattern, unit in reversed(UNIT_PATTERNS):
        by_name = F.when(key.rlike(pattern), unit).otherwise(by_name)
    return F.coalesce(F.try_element_at(known, key), by_name)


# Display names that are no mere capitals.
FEATURE_TITLES = {
    "trip_duration_minutes": "Trip Duration",
    "mta_tax": "MTA Tax",
    "tolls_amount": "Toll Charges",
    "trip_time_seconds": "Trip Time",
    "bcf": "Black Car Fund Surcharge",
}
DATASET_TITLES = {
    "yellow_taxi": "Yellow Taxi Trips",
    "green_taxi": "Green Taxi Trips",
    "fhv_trip": "For-Hired Vehicle (FHV) Trips",
    "fhvhv_trip": "High Volume For-Hired Vehicle (FHVHV) Trips",
}


def titled(name: Column, known: dict[str, str]) -> Column:
    """The display name, else the words of the name in capitals."""
    titles = F.create_map(*[F.lit(x) for x in chain.from_iterable(known.items())])
    return F.coalesce(F.try_element_at(titles, name), F.initcap(F.trim(F.translate(name, "_", " "))))


def feature_title(feature: Column) -> Column:
    return titled(feature, FEATURE_TITLES)


def dataset_title(dataset: Column) -> Column:
    return titled(dataset, DATASET_TITLES)
