"""Projections of varying source layouts onto fixed silver layouts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, NumericType, StringType, StructType

from lakemill.functions.values import blank_to_null, typed


@dataclass(frozen=True)
class Field:
    """One silver column: target name and type, source column, value for NULL."""

    name: str
    type: str
    source: str | None
    default: float | None = None

    def column(self) -> Column:
        value = F.lit(None) if self.source is None else F.col(f"`{self.source}`")
        value = value.try_cast(self.type)
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default).cast(self.type))
        return value.alias(self.name)


def layout(text: str) -> tuple[Field, ...]:
    """Read a layout table: name, type, source column (``-`` for none), default."""
    fields = []
    for line in text.strip().splitlines():
        name, type_name, source, *default = line.split()
        fields.append(Field(name, type_name, None if source == "-" else source, float(default[0]) if default else None))
    return tuple(fields)


# Silver layouts and the column names of the published trip files.
YELLOW_LEGACY = layout("""
    vendor_id           string     vendor_name
    pickup_datetime     timestamp  Trip_Pickup_DateTime
    dropoff_datetime    timestamp  Trip_Dropoff_DateTime
    passenger_count     int        Passenger_Count
    trip_distance       double     Trip_Distance
    payment_type        string     Payment_Type
    fare_amount         double     Fare_Amt
    tip_amount          double     Tip_Amt
    tolls_amount        double     Tolls_Amt
    total_amount        double     Total_Amt
    mta_tax             double     mta_tax
    surcharge           double     surcharge              0
    rate_code           string     Rate_Code
    store_and_fwd_flag  string     store_and_forward
    pickup_longitude    double     Start_Lon
    pickup_latitude     double     Start_Lat
    dropoff_longitude   double     End_Lon
    dropoff_latitude    double     End_Lat
""")
YELLOW_MODERN = layout("""
    vendor_id           string     VendorID
    pickup_datetime     timestamp  tpep_pickup_datetime
    dropoff_datetime    timestamp  tpep_dropoff_datetime
    passenger_count     int        passenger_count
    trip_distance       double     trip_distance
    payment_type        string     payment_type
    fare_amount         double     fare_amount
    tip_amount          double     tip_amount
    tolls_amount        double     tolls_amount
    total_amount        double     total_amount
    mta_tax             double     mta_tax
    surcharge           double     extra                  0
    rate_code           string     RatecodeID
    store_and_fwd_flag  string     store_and_fwd_flag
    pickup_longitude    double     -
    pickup_latitude     double     -
    dropoff_longitude   double     -
    dropoff_latitude    double     -
""")
YELLOW_INTERMEDIATE = layout("""
    vendor_id           string     vendor_id
    pickup_datetime     timestamp  pickup_datetime
    dropoff_datetime    timestamp  dropoff_datetime
    passenger_count     int        passenger_count
    trip_distance       double     trip_distance
    payment_type        string     payment_type
    fare_amount         double     fare_amount
    tip_amount          double     tip_amount
    tolls_amount        double     tolls_amount
    total_amount        double     total_amount
    mta_tax             double     mta_tax
    surcharge           double     surcharge              0
    rate_code           string     rate_code
    store_and_fwd_flag  string     store_and_fwd_flag
    pickup_longitude    double     pickup_longitude
    pickup_latitude     double     pickup_latitude
    dropoff_longitude   double     dropoff_longitude
    dropoff_latitude    double     dropoff_latitude
""")
GREEN = layout("""
    vendor_id              string     VendorID
    pickup_datetime        timestamp  lpep_pickup_datetime
    dropoff_datetime       timestamp  lpep_dropoff_datetime
    passenger_count        int        passenger_count
    trip_distance          double     trip_distance
    payment_type           string     payment_type
    fare_amount            double     fare_amount
    tip_amount             double     tip_amount
    tolls_amount           double     tolls_amount
    total_amount           double     total_amount
    mta_tax                double     mta_tax
    extra                  double     extra                  0
    improvement_surcharge  double     improvement_surcharge  0
    rate_code              string     RatecodeID
    store_and_fwd_flag     string     store_and_fwd_flag
    pu_location_id         int        PULocationID
    do_location_id         int        DOLocationID
    trip_type_raw          double     trip_type
""")
FHV = layout("""
    dispatching_base_num    string     dispatching_base_num
    pickup_datetime         timestamp  pickup_datetime
    dropoff_datetime        timestamp  dropOff_datetime
    pu_location_id          int        PUlocationID
    do_location_id          int        DOlocationID
    sr_flag                 string     SR_Flag
    affiliated_base_number  string     Affiliated_base_number
""")
FHVHV = layout("""
    hvfhs_license_num     string     hvfhs_license_num
    dispatching_base_num  string     dispatching_base_num
    originating_base_num  string     originating_base_num
    request_datetime      timestamp  request_datetime
    on_scene_datetime     timestamp  on_scene_datetime
    pickup_datetime       timestamp  pickup_datetime
    dropoff_datetime      timestamp  dropoff_datetime
    pu_location_id        int        PULocationID
    do_location_id        int        DOLocationID
    trip_miles            double     trip_miles
    trip_time_seconds     bigint     trip_time
    base_passenger_fare   double     base_passenger_fare
    tolls                 double     tolls
    bcf                   double     bcf
    sales_tax             double     sales_tax
    congestion_surcharge  double     congestion_surcharge
    airport_fee           double     airport_fee
    tips                  double     tips
    driver_pay            double     driver_pay
    shared_request_flag   string     shared_request_flag
    shared_match_flag     string     shared_match_flag
    access_a_ride_flag    string     access_a_ride_flag
    wav_request_flag      string     wav_request_flag
    wav_match_flag        string     wav_match_flag
""")
HR = layout("""
    employee_id        string     employee_id
    day_worked         timestamp  day_worked
    department         string     department
    hours_worked       double     hours_worked
    attendance_status  string     attendance_status
    topic              string     topic
""")
FINANCE = layout("""
    finance_id    string     finance_id
    report_date   timestamp  report_date
    money_input   double     money_input
    money_output  double     money_output
    profit        double     profit
    cost_center   string     cost_center
    topic         string     topic
""")
MARKETING = layout("""
    campaign_id  string     campaign_id
    lead_id      string     lead_id
    channel      string     channel
    spend_usd    double     spend_usd
    clicks       bigint     clicks
    conversions  bigint     conversions
    event_time   timestamp  event_time
    topic        string     topic
""")

YELLOW_LAYOUTS = {"legacy": YELLOW_LEGACY, "modern": YELLOW_MODERN, "intermediate": YELLOW_INTERMEDIATE}
DOMAIN_LAYOUTS = {"hr": HR, "finance": FINANCE, "marketing": MARKETING}


def require(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Return ``df`` unchanged, or name the columns it lacks."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"{what} lacks column(s): {', '.join(missing)}")
    return df


def conform(df: DataFrame, fields: Sequence[Field], what: str = "input") -> DataFrame:
    """One projection onto the layout; values that do not fit become NULL."""
    require(df, [f.source for f in fields if f.source], what)
    return df.select(*[f.column() for f in fields])


def detect_variant(columns: Iterable[str]) -> str:
    """Which yellow layout a file has, from its column names alone."""
    names = set(columns)
    marks = (("legacy", "Trip_Pickup_DateTime"), ("modern", "tpep_pickup_datetime"))
    return next((variant for variant, mark in marks if mark in names), "intermediate")


def conform_yellow(frames: Iterable[DataFrame]) -> DataFrame:
    """Bring files of any yellow layout to the silver columns.

    Files of one layout are merged first so each layout costs one projection.
    """
    by_variant: dict[str, list[DataFrame]] = {}
    for df in frames:
        by_variant.setdefault(detect_variant(df.columns), []).append(df)
    parts = [
        conform(merge_schemas(by_variant[v]), fields, f"{v} yellow trips")
        for v, fields in YELLOW_LAYOUTS.items()
        if v in by_variant
    ]
    return union_all(parts, strict=True)


def conform_domain(df: DataFrame, domain: str) -> DataFrame:
    """Projection of a business domain; a domain without a layout passes through."""
    fields = DOMAIN_LAYOUTS.get(domain)
    return conform(df, fields, domain) if fields else df


def wider_type(left: DataType, right: DataType) -> DataType:
    """Same class keeps the first; two numbers become DOUBLE; the rest STRING."""
    if type(left) is type(right):
        return left
    if isinstance(left, NumericType) and isinstance(right, NumericType):
        return DoubleType()
    return StringType()


def reconcile(schemas: Iterable[StructType]) -> dict[str, tuple[str, DataType]]:
    """Fold schemas in order to lower-case name → (first spelling, common type)."""
    merged: dict[str, tuple[str, DataType]] = {}
    for schema in schemas:
        for field in schema.fields:
            key = field.name.lower()
            if key in merged:
                spelling, known = merged[key]
                merged[key] = (spelling, wider_type(known, field.dataType))
            else:
                merged[key] = (field.name, field.dataType)
    return merged


def merge_schemas(frames: Sequence[DataFrame]) -> DataFrame:
    """Union frames with differing schemas; absent columns are NULL.

    Frames with the same schema are united before they are cast, so the plan
    grows with the number of distinct schemas, not with the number of files.
    """
    if not frames:
        raise ValueError("merge_schemas needs at least one frame")
    merged = reconcile(df.schema for df in frames)
    groups: dict[str, list[DataFrame]] = {}
    for df in frames:
        groups.setdefault(df.schema.simpleString(), []).append(df)
    parts = []
    for same in groups.values():
        part = reduce(DataFrame.union, same)
        own = {f.name.lower(): f for f in part.schema.fields}
        parts.append(part.select(*[_aligned(own.get(key), name, kind) for key, (name, kind) in merged.items()]))
    return reduce(DataFrame.union, parts)


def _aligned(field, name: str, kind: DataType) -> Column:
    if field is None:
        return F.lit(None).cast(kind).alias(name)
    source = F.col(f"`{field.name}`")
    return (source if type(field.dataType) is type(kind) else source.try_cast(kind)).alias(name)


def union_all(frames: Sequence[DataFrame], strict: bool = False) -> DataFrame:
    """Union by column name; without ``strict`` absent columns are NULL."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), frames)


def normalize_to(df: DataFrame, reference: StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, add what is missing, and convert to the types of a sample schema."""
    renames = renames or {}
    renamed = df.withColumnsRenamed(dict(renames))
    have = {c.lower() for c in renamed.columns}
    return renamed.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in reference.fields
        ]
    )


def clean_strings(df: DataFrame) -> DataFrame:
    """Strip every string column and turn empty strings into NULL."""
    return df.select(
        *[
            blank_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def numeric_features(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The chosen columns, or every numeric one, as DOUBLE."""
    return df.select(*[typed(f"`{c}`", "double").alias(c) for c in (columns or numeric_columns(df))])
