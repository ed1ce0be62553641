"""Trip layouts, rules and gold tables."""

from pyspark.sql import functions as F

from lakemill.checks.registry import job
from lakemill.checks.sqltext import cents, flags, half_up
from lakemill.operators import conform as C
from lakemill.operators import marts, quality, regression, trips
from lakemill.operators.lineage import metadata_last, with_lineage

LEGACY = """
    SELECT vendor_id AS vendor_name, cast(pickup_datetime AS string) AS Trip_Pickup_DateTime,
      cast(dropoff_datetime AS string) AS Trip_Dropoff_DateTime, passenger_count AS Passenger_Count,
      trip_distance AS Trip_Distance, payment_type AS Payment_Type, fare_amount AS Fare_Amt, tip_amount AS Tip_Amt,
      tolls_amount AS Tolls_Amt, total_amount AS Total_Amt, mta_tax, surcharge, rate_code AS Rate_Code,
      store_and_fwd_flag AS store_and_forward, cast(pu_location_id AS double) AS Start_Lon,
      cast(do_location_id AS double) AS Start_Lat, 1e0 AS End_Lon, 2e0 AS End_Lat
    FROM trips WHERE store_and_fwd_flag = 'A'"""
MODERN = """
    SELECT cast(vendor_id AS bigint) AS VendorID, pickup_datetime AS tpep_pickup_datetime,
      dropoff_datetime AS tpep_dropoff_datetime, cast(passenger_count AS double) AS passenger_count, trip_distance,
      payment_type, fare_amount, tip_amount, tolls_amount, total_amount, mta_tax, extra, rate_code AS RatecodeID,
      store_and_fwd_flag
    FROM trips WHERE store_and_fwd_flag = 'N'"""
INTERMEDIATE = """
    SELECT vendor_id, cast(pickup_datetime AS string) AS pickup_datetime,
      cast(dropoff_datetime AS string) AS dropoff_datetime, passenger_count, trip_distance, payment_type, fare_amount,
      tip_amount, tolls_amount, total_amount, mta_tax, surcharge, rate_code, store_and_fwd_flag,
      cast(pu_location_id AS double) AS pickup_longitude, cast(do_location_id AS double) AS pickup_latitude,
      1e0 AS dropoff_longitude, 2e0 AS dropoff_latitude
    FROM trips WHERE store_and_fwd_flag = 'R'"""
GREEN = """
    SELECT vendor_id AS VendorID, pickup_datetime AS lpep_pickup_datetime, dropoff_datetime AS lpep_dropoff_datetime,
      passenger_count, trip_distance, payment_type, fare_amount, tip_amount, tolls_amount, total_amount, mta_tax, extra,
      improvement_surcharge, rate_code AS RatecodeID, store_and_fwd_flag, pu_location_id AS PULocationID,
      do_location_id AS DOLocationID, 1 AS trip_type
    FROM trips"""
FHV = """
    SELECT dispatching_base_num, pickup_datetime, dropoff_datetime AS dropOff_datetime, pu_location_id AS PUlocationID,
      do_location_id AS DOlocationID, sr_flag AS SR_Flag, affiliated AS Affiliated_base_number
    FROM fhv"""
FHVHV = """
    SELECT hvfhs_license_num, dispatching_base_num, dispatching_base_num AS originating_base_num,
      pickup_datetime AS request_datetime, pickup_datetime AS on_scene_datetime, pickup_datetime, dropoff_datetime,
      pu_location_id AS PULocationID, do_location_id AS DOLocationID, trip_miles, 600 AS trip_time, base_passenger_fare,
      0e0 AS tolls, 0e0 AS bcf, 1e0 AS sales_tax, cast(NULL AS double) AS congestion_surcharge, 0e0 AS airport_fee, tips,
      driver_pay, shared_request_flag, 'N' AS shared_match_flag, 'N' AS access_a_ride_flag, 'N' AS wav_request_flag,
      'N' AS wav_match_flag
    FROM hv"""
MONEY = "fare_amount, tip_amount, tolls_amount, total_amount, mta_tax"
YELLOW_SQL = f"""
    SELECT vendor_id, pickup_datetime, dropoff_datetime, passenger_count::int AS passenger_count, trip_distance,
      payment_type, {MONEY},
      coalesce(CASE store_and_fwd_flag WHEN 'N' THEN extra ELSE surcharge END, 0)::double AS surcharge, rate_code,
      store_and_fwd_flag,
      CASE WHEN store_and_fwd_flag <> 'N' THEN pu_location_id::double END AS pickup_longitude,
      CASE WHEN store_and_fwd_flag <> 'N' THEN do_location_id::double END AS pickup_latitude,
      CASE WHEN store_and_fwd_flag <> 'N' THEN 1::double END AS dropoff_longitude,
      CASE WHEN store_and_fwd_flag <> 'N' THEN 2::double END AS dropoff_latitude
    FROM trips"""
GREEN_COLUMNS = f"""vendor_id, pickup_datetime, dropoff_datetime, passenger_count::int AS passenger_count, trip_distance,
      payment_type, {MONEY}, coalesce(extra, 0)::double AS extra,
      coalesce(improvement_surcharge, 0)::double AS improvement_surcharge, rate_code, store_and_fwd_flag, pu_location_id,
      do_location_id, 1::double AS trip_type_raw"""
FHVHV_SQL = """
    SELECT hvfhs_license_num, dispatching_base_num, dispatching_base_num AS originating_base_num,
      pickup_datetime AS request_datetime, pickup_datetime AS on_scene_datetime, pickup_datetime, dropoff_datetime,
      pu_location_id, do_location_id, trip_miles, 600::bigint AS trip_time_seconds, base_passenger_fare,
      0::double AS tolls, 0::double AS bcf, 1::double AS sales_tax, NULL::double AS congestion_surcharge,
      0::double AS airport_fee, tips, driver_pay, shared_request_flag, 'N' AS shared_match_flag,
      'N' AS access_a_ride_flag, 'N' AS wav_request_flag, 'N' AS wav_match_flag
    FROM hv"""
MINUTES = "(epoch(dropoff_datetime)::bigint - epoch(pickup_datetime)::bigint) / 60e0"


def yellow(d):
    return C.conform_yellow([d.sql(LEGACY), d.sql(MODERN), d.sql(INTERMEDIATE)])


def silver_yellow(d):
    """Silver trips of the current layout: conform, time, rules, lineage."""
    timed = trips.with_duration(C.conform_yellow([d.sql(MODERN.rsplit(" WHERE ", 1)[0])]))
    return with_lineage(quality.apply_rules(timed, quality.TRIP_RULES), "taxi", "yellow")


def silver_green(d):
    timed = trips.with_duration(C.conform(d.sql(GREEN), C.GREEN))
    return with_lineage(quality.apply_rules(timed, quality.TRIP_RULES), "taxi", "green")


def vendor_summary(d):
    """Flagship: fees and revenue per vendor over the silver trips."""
    gold = trips.gold_financials(silver_yellow(d), trips.FEE_COLUMNS["yellow"])
    return gold.groupBy("domain", "vendor_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        marts.money_sum("total_fees").alias("total_fees"),
        marts.money_sum("total_amount").alias("total_amount"),
    )


# Silver trips as a query, with the surcharge of the yellow layout.
SILVER_SQL = """
    WITH silver AS (
      SELECT * REPLACE (coalesce(extra, 0)::double AS surcharge),
        hour(pickup_datetime) AS pickup_hour, dayofweek(pickup_datetime) + 1 AS pickup_weekday
      FROM silver_trips)"""
GREEN_SILVER_SQL = """
    WITH silver AS (
      SELECT * REPLACE (coalesce(extra, 0)::double AS extra),
        hour(pickup_datetime) AS pickup_hour, dayofweek(pickup_datetime) + 1 AS pickup_weekday
      FROM silver_trips)"""


@job(
    "detect_schema_variant",
    """SELECT CASE store_and_fwd_flag WHEN 'A' THEN 'legacy' WHEN 'N' THEN 'modern' ELSE 'intermediate' END AS variant,
         count(*) AS n FROM trips GROUP BY ALL""",
)
def _(d):
    files = [d.sql(text) for text in (LEGACY, MODERN, INTERMEDIATE)]
    marked = [f.select(F.lit(C.detect_variant(f.columns)).alias("variant")) for f in files]
    return C.union_all(marked).groupBy("variant").agg(F.count(F.lit(1)).alias("n"))


@job("conform_yellow", YELLOW_SQL)
def _(d):
    return yellow(d)


@job("conform_green", f"SELECT {GREEN_COLUMNS} FROM trips")
def _(d):
    return C.conform(d.sql(GREEN), C.GREEN)


@job(
    "conform_fhv",
    """SELECT dispatching_base_num, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id, sr_flag,
         affiliated AS affiliated_base_number FROM fhv""",
)
def _(d):
    return C.conform(d.sql(FHV), C.FHV)


@job("conform_fhvhv", FHVHV_SQL)
def _(d):
    return C.conform(d.sql(FHVHV), C.FHVHV)


@job(
    "trip_time_parts",
    f"""SELECT trip_key, {MINUTES} AS trip_duration_minutes, hour(pickup_datetime)::int AS pickup_hour,
          (dayofweek(pickup_datetime) + 1)::int AS pickup_weekday FROM trips""",
)
def _(d):
    timed = trips.with_trip_time(d.view("trips"))
    return timed.select("trip_key", "trip_duration_minutes", "pickup_hour", "pickup_weekday")


@job(
    "quality_trip",
    f"""SELECT vendor_id, pickup_datetime, dropoff_datetime, trip_distance, {MONEY}, trip_duration_minutes
        FROM silver_trips""",
)
def _(d):
    kept = quality.apply_rules(trips.with_duration(d.view("trips")), quality.TRIP_RULES)
    return kept.select(
        "vendor_id", "pickup_datetime", "dropoff_datetime", "trip_distance", *MONEY.split(", "), "trip_duration_minutes"
    )


@job(
    "quality_fhv",
    f"""SELECT dispatching_base_num, pickup_datetime, dropoff_datetime, sr_flag, {MINUTES} AS trip_duration_minutes
        FROM fhv WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND {MINUTES} > 0""",
)
def _(d):
    kept = quality.apply_rules(trips.with_duration(C.conform(d.sql(FHV), C.FHV)), quality.FHV_RULES)
    return kept.select("dispatching_base_num", "pickup_datetime", "dropoff_datetime", "sr_flag", "trip_duration_minutes")


HV_KEPT = f"""FROM hv WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND trip_miles >= 0 AND base_passenger_fare >= 0 AND {MINUTES} > 0"""


@job(
    "quality_fhvhv",
    f"""SELECT hvfhs_license_num, pickup_datetime, dropoff_datetime, trip_miles, base_passenger_fare, tips, driver_pay,
          {MINUTES} AS trip_duration_minutes {HV_KEPT}""",
)
def _(d):
    kept = quality.apply_rules(trips.with_duration(C.conform(d.sql(FHVHV), C.FHVHV)), quality.FHVHV_RULES)
    return kept.select(
        "hvfhs_license_num", "pickup_datetime", "dropoff_datetime", "trip_miles", "base_passenger_fare", "tips",
        "driver_pay", "trip_duration_minutes",
    )


def _tips_sql(silver):
    return f"""{silver} SELECT domain, vendor_id, pickup_datetime, tip_amount, fare_amount,
      CASE WHEN fare_amount > 0 THEN {half_up("tip_amount / fare_amount", 2)} ELSE 0 END AS tip_ratio,
      tip_amount > 0 AS is_tipped FROM silver"""


def _performance_sql(silver):
    speed = half_up("trip_distance / (trip_duration_minutes / 60e0)", 2)
    revenue = half_up("total_amount / trip_duration_minutes", 2)
    return f"""{silver} SELECT domain, vendor_id, pickup_datetime, trip_distance, trip_duration_minutes,
      {speed} AS avg_speed_mph, {revenue} AS revenue_per_minute FROM silver"""


def _financials_sql(silver, fees):
    return f"""{silver} SELECT domain, vendor_id, pickup_datetime, {half_up(fees, 2)} AS total_fees, total_amount,
      CASE WHEN trip_distance > 0 THEN {half_up("total_amount / trip_distance", 2)} ELSE 0 END AS cost_per_mile,
      CASE WHEN passenger_count > 0 THEN {half_up("total_amount / passenger_count", 2)} ELSE 0 END AS fare_per_passenger
      FROM silver"""


def _classes_sql(silver, cards):
    return f"""{silver} SELECT domain, vendor_id, pickup_datetime,
      pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 19 AS is_peak_hour,
      pickup_weekday IN (1, 7) AS is_weekend,
      CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance < 10 THEN 'medium' ELSE 'long' END AS trip_type,
      payment_type IN ({cards}) AS is_card_payment,
      trip_distance <= 0 OR fare_amount <= 0 OR trip_duration_minutes <= 0 AS is_suspicious FROM silver"""


for _name, _make, _silver_sql, _cards, _fees in (
    ("yellow", silver_yellow, SILVER_SQL, "'CRD', 'CRE', '1'", "surcharge + mta_tax + tolls_amount"),
    ("green", silver_green, GREEN_SILVER_SQL, "'1'", "extra + mta_tax + tolls_amount + improvement_surcharge"),
):
    _suffix = "" if _name == "yellow" else "_green"

    def _register(make=_make, name=_name, suffix=_suffix, silver_sql=_silver_sql, cards=_cards, fees=_fees):
        job(f"gold_trip_tips{suffix}", _tips_sql(silver_sql))(lambda d: trips.gold_tips(make(d)))
        job(f"gold_trip_performance{suffix}", _performance_sql(silver_sql))(lambda d: trips.gold_performance(make(d)))
        job(f"gold_trip_financials{suffix}", _financials_sql(silver_sql, fees))(
            lambda d: trips.gold_financials(make(d), trips.FEE_COLUMNS[name])
        )
        job(f"gold_trip_classifications{suffix}", _classes_sql(silver_sql, cards))(
            lambda d: trips.gold_classes(trips.with_calendar(make(d)), trips.CARD_CODES[name])
        )

    _register()


VENDOR_SQL = f"""{SILVER_SQL}, gold AS (
      SELECT domain, vendor_id, {half_up("surcharge + mta_tax + tolls_amount", 2)} AS total_fees, total_amount FROM silver)
    SELECT domain, vendor_id, count(*) AS trip_count, {cents("total_fees")} AS total_fees,
      {cents("total_amount")} AS total_amount FROM gold GROUP BY ALL"""


@job("vendor_summary", VENDOR_SQL)
def _(d):
    return vendor_summary(d)


@job(
    "agg_fhv_summary",
    f"""SELECT 'taxi' AS domain, dispatching_base_num, count(*) AS trip_count, {cents(MINUTES)} AS total_trip_minutes,
          {flags("sr_flag IS NOT NULL")} AS sr_flag_trip_count
        FROM fhv WHERE {MINUTES} > 0 GROUP BY ALL""",
)
def _(d):
    kept = quality.apply_rules(trips.with_duration(C.conform(d.sql(FHV), C.FHV)), quality.FHV_RULES)
    return marts.fhv_summary(with_lineage(kept, "taxi", "fhv"))


@job(
    "agg_fhvhv_summary",
    f"""SELECT 'taxi' AS domain, hvfhs_license_num, count(*) AS trip_count, {cents("trip_miles")} AS total_trip_miles,
          {cents("base_passenger_fare")} AS total_base_passenger_fare, {cents("tips")} AS total_tips,
          {cents("driver_pay")} AS total_driver_pay {HV_KEPT} GROUP BY ALL""",
)
def _(d):
    kept = quality.apply_rules(trips.with_duration(C.conform(d.sql(FHVHV), C.FHVHV)), quality.FHVHV_RULES)
    return marts.fhvhv_summary(with_lineage(kept, "taxi", "fhvhv"))


@job(
    "zone_enrich",
    """SELECT trip_key, pu_location_id, do_location_id, p.borough AS pickup_borough, p.zone AS pickup_zone,
         q.borough AS dropoff_borough, q.zone AS dropoff_zone
       FROM trips LEFT JOIN zones p ON pu_location_id = p.zone_id LEFT JOIN zones q ON do_location_id = q.zone_id""",
)
def _(d):
    named = trips.with_zones(d.view("trips"), d.view("zones"))
    return named.select(
        "trip_key", "pu_location_id", "do_location_id", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"
    )


@job("add_lineage_columns", "SELECT trip_key, 'taxi' AS domain, 'yellow' AS dataset, true AS stamped FROM trips")
def _(d):
    marked = with_lineage(d.view("trips"), "taxi", "yellow")
    return marked.select("trip_key", "domain", "dataset", F.col("silver_processed_ts").isNotNull().alias("stamped"))


@job("reorder_metadata_last", "SELECT c_custkey, c_name, 'x' AS _source_schema, 'customer' AS _source_table FROM customer")
def _(d):
    mixed = d.sql("SELECT 'x' AS _source_schema, c_custkey, 'customer' AS _source_table, c_name FROM customer")
    return metadata_last(mixed)


@job(
    "linear_regression_fit",
    """SELECT trip_distance, total_amount, round(regr_intercept(total_amount, trip_distance) OVER ()
         + regr_slope(total_amount, trip_distance) OVER () * trip_distance, 4) AS prediction FROM silver_trips""",
)
def _(d):
    _, predicted = regression.fit_linear(silver_yellow(d), ["trip_distance"])
    return predicted.withColumn("prediction", F.round("prediction", 4))


@job("linear_regression_two_features")
def _(d):
    _, predicted = regression.fit_linear(silver_yellow(d))
    return predicted


RULES_SQL = {
    "pickup_datetime_present": "pickup_datetime IS NOT NULL",
    "dropoff_datetime_present": "dropoff_datetime IS NOT NULL",
    "trip_distance_present": "trip_distance IS NOT NULL",
    "fare_amount_present": "fare_amount IS NOT NULL",
    "tip_amount_present": "tip_amount IS NOT NULL",
    "total_amount_present": "total_amount IS NOT NULL",
    "fare_amount_not_negative": "fare_amount >= 0",
    "tip_amount_not_negative": "tip_amount >= 0",
    "total_amount_not_negative": "total_amount >= 0",
    "trip_distance_not_negative": "trip_distance >= 0",
    "tolls_amount_not_negative": "tolls_amount >= 0",
    "trip_duration_minutes_positive": f"{MINUTES} > 0",
}
FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN coalesce({c}, false) THEN NULL ELSE '{n}' END" for n, c in RULES_SQL.items()) + ")"


@job("dq_rules_quarantine", f"SELECT * FROM (SELECT trip_key, {FAILED} AS failed_rules FROM trips) x WHERE failed_rules <> ''")
def _(d):
    _, bad = quality.quarantine(trips.with_duration(d.view("trips")), quality.TRIP_RULES)
    return bad.select("trip_key", F.array_join("failed_rules", ",").alias("failed_rules"))


def _metric_sql(name, condition):
    rejected = flags(f"NOT coalesce({condition}, false)")
    return f"""SELECT input_count, '{name}' AS rule, reject_count, round(reject_count / input_count, 6) AS reject_ratio,
        CASE WHEN reject_count / input_count >= 0.05 THEN 'fail' WHEN reject_count / input_count >= 0.01 THEN 'warn'
          ELSE 'pass' END AS verdict
      FROM (SELECT count(*) AS input_count, {rejected} AS reject_count FROM trips) m"""


@job("dq_rule_metrics", " UNION ALL ".join(_metric_sql(n, c) for n, c in RULES_SQL.items()))
def _(d):
    return quality.rule_metrics(trips.with_duration(d.view("trips")), quality.TRIP_RULES)


@job(
    "dq_step_counts",
    f"""SELECT vendor_id, input_count, output_count, input_count - output_count AS reject_count FROM (
          SELECT vendor_id, count(*) AS input_count,
            {flags(" AND ".join(f"coalesce({c}, false)" for c in RULES_SQL.values()))} AS output_count
          FROM trips GROUP BY vendor_id) m""",
)
def _(d):
    return quality.step_counts(trips.with_duration(d.view("trips")), quality.TRIP_RULES, ["vendor_id"])
