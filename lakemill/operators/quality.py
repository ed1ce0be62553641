"""Declarative row rules: filter, quarantine and count.

A rule is a named condition; a row passes only if the condition is true, so a
NULL in a compared column fails.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    severity: str = "fail"

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def present(*columns: str) -> tuple[Rule, ...]:
    return tuple(Rule(f"{c}_present", f"{c} IS NOT NULL") for c in columns)


def not_negative(*columns: str) -> tuple[Rule, ...]:
    return tuple(Rule(f"{c}_not_negative", f"{c} >= 0") for c in columns)


def positive(*columns: str) -> tuple[Rule, ...]:
    return tuple(Rule(f"{c}_positive", f"{c} > 0") for c in columns)


TRIP_RULES = (
    present("pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount", "tip_amount", "total_amount")
    + not_negative("fare_amount", "tip_amount", "total_amount", "trip_distance", "tolls_amount")
    + positive("trip_duration_minutes")
)
FHV_RULES = present("pickup_datetime", "dropoff_datetime") + positive("trip_duration_minutes")
FHVHV_RULES = (
    present("pickup_datetime", "dropoff_datetime", "trip_miles", "base_passenger_fare")
    + not_negative("trip_miles", "base_passenger_fare")
    + positive("trip_duration_minutes")
)
HR_RULES = present("employee_id", "day_worked", "hours_worked") + not_negative("hours_worked")
FINANCE_RULES = present("finance_id", "report_date", "money_input", "money_output", "profit") + not_negative(
    "money_input", "money_output"
)
MARKETING_RULES = present("campaign_id", "event_time", "spend_usd", "clicks", "conversions") + not_negative(
    "spend_usd", "clicks", "conversions"
)
DOMAIN_RULES = {"hr": HR_RULES, "finance": FINANCE_RULES, "marketing": MARKETING_RULES}


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep the rows that pass every rule."""
    # Plain conditions (no coalesce) so the scan can use them as pushed filters.
    return df.filter(reduce(and_, [F.expr(r.condition) for r in rules]))


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def with_date(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in rule order."""
    return F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass and rows kept as evidence with their reasons.

    Plain conditions make the split; names are only worked out for bad rows.
    """
    passed = reduce(and_, [r.passes() for r in rules])
    return apply_rules(df, rules), df.filter(~passed).withColumn("failed_rules", failed_rules(rules))


def rule_metrics(
    df: DataFrame,
    rules: Sequence[Rule],
    warn_ratio: float = 0.01,
    fail_ratio: float = 0.05,
    by: Iterable[str] = (),
) -> DataFrame:
    """One row per rule: rows seen, rows rejected, ratio and pass / warn / fail.

    A single aggregation counts every rule; the wide row is then turned upright.
    """
    by = list(by)
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("input_count"),
        *[F.count_if(~r.passes()).alias(f"r{i}") for i, r in enumerate(rules)],
    )
    entries = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("reject_count")) for i, r in enumerate(rules)]
    )
    upright = counted.select(*by, "input_count", F.inline(entries))
    share = F.coalesce(F.try_divide(F.col("reject_count"), F.col("input_count")), F.lit(0.0))
    return upright.withColumn("reject_ratio", F.round(share, 6)).withColumn(
        "verdict", F.when(share >= fail_ratio, "fail").when(share >= warn_ratio, "warn").otherwise("pass")
    )


def step_counts(df: DataFrame, rules: Sequence[Rule], by: Iterable[str]) -> DataFrame:
    """Input, output and reject counts of a quality step per domain, dataset, …"""
    passed = reduce(and_, [r.passes() for r in rules])
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("input_count"), F.count_if(passed).alias("output_count"))
        .withColumn("reject_count", F.col("input_count") - F.col("output_count"))
    )


def check_thresholds(metrics: DataFrame) -> None:
    """Stop the step when a rule is beyond its fail threshold (rules are few)."""
    broken = [r.rule for r in metrics.filter(F.col("verdict") == "fail").select("rule").collect()]
    if broken:
        raise ValueError(f"quality threshold exceeded: {', '.join(sorted(broken))}")


def split_range(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> tuple[DataFrame, DataFrame]:
    """In-range rows (every bounded column NULL or within) and their complement."""
    above = [F.coalesce(F.col(c) > F.lit(float(high)), F.lit(False)) for c, (_, high) in bounds.items()]
    peak = reduce(or_, above, F.lit(False))
    return df.filter(~peak), df.filter(peak)


def clip(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Pull values into their bounds; NULL stays NULL."""
    limited = {
        c: F.when(F.col(c).isNotNull(), F.greatest(F.lit(float(low)), F.least(F.col(c), F.lit(float(high)))))
        for c, (low, high) in bounds.items()
    }
    return df.withColumns(limited) if limited else df
