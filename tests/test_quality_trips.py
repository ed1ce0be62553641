import datetime as dt

import pytest

from conftest import rows
from lakemill.operators import quality, trips
from lakemill.operators.lineage import with_lineage

T0 = dt.datetime(2024, 1, 6, 7, 30)  # a Saturday
SCHEMA = (
    "domain string, vendor_id string, pickup_datetime timestamp, dropoff_datetime timestamp, trip_distance double, "
    "fare_amount double, tip_amount double, tolls_amount double, total_amount double, passenger_count int, "
    "payment_type string, surcharge double, mta_tax double"
)


def trip(spark, **changes):
    base = dict(
        domain="taxi", vendor_id="1", pickup_datetime=T0, dropoff_datetime=T0 + dt.timedelta(seconds=90), trip_distance=2.0,
        fare_amount=10.0, tip_amount=1.0, tolls_amount=0.0, total_amount=12.0, passenger_count=2, payment_type="CRD",
        surcharge=1.0, mta_tax=0.5,
    )
    row = base | changes
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in SCHEMA.split(", "))], SCHEMA)


@pytest.mark.parametrize(
    "changes, kept",
    [
        ({}, 1),
        ({"tolls_amount": None}, 0),
        ({"fare_amount": -0.01}, 0),
        ({"fare_amount": 0.0}, 1),
        ({"dropoff_datetime": T0}, 0),
        ({"dropoff_datetime": T0 - dt.timedelta(minutes=1)}, 0),
        ({"passenger_count": None}, 1),
    ],
)
def test_trip_rules(spark, changes, kept):
    df = trips.with_duration(trip(spark, **changes))
    assert quality.apply_rules(df, quality.TRIP_RULES).count() == kept
    good, bad = quality.quarantine(df, quality.TRIP_RULES)
    assert good.count() == kept and bad.count() == 1 - kept


def test_rejected_rows_name_their_rules(spark):
    df = trips.with_duration(trip(spark, tolls_amount=None, dropoff_datetime=T0))
    _, bad = quality.quarantine(df, quality.TRIP_RULES)
    assert bad.first().failed_rules == ["tolls_amount_not_negative", "trip_duration_minutes_positive"]


def test_thresholds(spark):
    df = trips.with_duration(trip(spark).union(trip(spark, tolls_amount=None)))
    metrics = quality.rule_metrics(df, quality.TRIP_RULES, 0.1, 0.9)
    verdicts = {r.rule: (r.reject_count, r.verdict) for r in metrics.collect()}
    assert verdicts["tolls_amount_not_negative"] == (1, "warn") and verdicts["fare_amount_present"] == (0, "pass")
    quality.check_thresholds(metrics)
    with pytest.raises(ValueError, match="tolls_amount"):
        quality.check_thresholds(quality.rule_metrics(df, quality.TRIP_RULES, 0.1, 0.5))


def test_gold_measures(spark):
    df = trips.with_trip_time(trip(spark))
    assert df.first().trip_duration_minutes == 1.5
    assert trips.gold_tips(df).first().tip_ratio == 0.1
    speed = trips.gold_performance(df).first()
    assert speed.avg_speed_mph == 80.0 and speed.revenue_per_minute == 8.0
    money = trips.gold_financials(df, trips.FEE_COLUMNS["yellow"]).first()
    assert (money.total_fees, money.cost_per_mile, money.fare_per_passenger) == (1.5, 6.0, 6.0)
    kind = trips.gold_classes(df, trips.CARD_CODES["yellow"]).first()
    assert kind.is_peak_hour and kind.is_weekend and kind.is_card_payment
    assert kind.trip_type == "medium" and kind.is_suspicious is False


def test_gold_measures_without_a_base(spark):
    df = trips.with_trip_time(trip(spark, fare_amount=None, trip_distance=0.0, passenger_count=0, surcharge=None))
    assert trips.gold_tips(df).first().tip_ratio == 0.0
    money = trips.gold_financials(df, trips.FEE_COLUMNS["yellow"]).first()
    assert money.total_fees is None and money.cost_per_mile == 0.0 and money.fare_per_passenger == 0.0
    assert trips.gold_classes(df, ("1",)).first().is_suspicious is True


def test_filters_reach_the_scan(spark, tmp_path):
    trip(spark).write.parquet(str(tmp_path / "t"))
    df = with_lineage(trips.with_duration(spark.read.parquet(str(tmp_path / "t"))), "taxi", "yellow")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = trips.gold_tips(quality.apply_rules(df, quality.TRIP_RULES))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(tolls_amount,0.0)" in plan
    assert "payment_type" not in plan.split("ReadSchema")[-1]


def test_split_and_clip(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (9.0,), (None,)], "x double")
    ranged, peak = quality.split_range(df, {"x": (2.0, 5.0)})
    assert rows(peak) == [(9.0,)] and ranged.count() == 3
    assert rows(quality.clip(df, {"x": (2.0, 5.0)})) == sorted([(2.0,), (5.0,), (5.0,), (None,)], key=repr)
