"""Column helpers shared by the jobs. Bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def typed(column: Column | str, type_name: str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).try_cast(type_name)


def as_date(column: Column | str) -> Column:
    return typed(column, "date")


def blank_to_null(column: Column | str) -> Column:
    """Strip spaces; an empty remainder counts as missing."""
    return F.nullif(F.trim(column), F.lit(""))


def minutes_between(start: str, end: str) -> Column:
    """Whole seconds between two timestamps, as minutes."""
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return seconds / F.lit(60.0)


def ratio(top: Column | str, bottom: Column | str, digits: int) -> Column:
    """``top / bottom`` rounded half-up; 0 unless the bottom is positive."""
    top = F.col(top) if isinstance(top, str) else top
    bottom = F.col(bottom) if isinstance(bottom, str) else bottom
    return F.round(F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0)), digits)


MICROS = 1_000_000


def money_sum(column: Column | str, digits: int = 2) -> Column:
    """Sum of a double column with an answer that does not depend on row order.

    Whole units and millionths are added as a decimal and an integer, so every
    run and every partitioning gives the same cents and no sum overflows.
    Values that are no 64-bit whole number of units (9e18 and more, infinite,
    NaN) are added as a plain double sum, which then carries into the total.
    """
    value = typed(column, "double")
    plain = F.abs(value) < F.lit(9e18)
    whole = F.floor(F.when(plain, value))
    rest = F.rint((F.when(plain, value) - whole) * MICROS).cast("bigint")
    parts = F.sum(rest).cast("decimal(28,0)") / F.lit(MICROS).cast("decimal(7,0)")
    units = F.sum(whole.cast("decimal(20,0)")).cast("decimal(38,6)")
    exact = F.round(units + parts, digits).cast("double")
    beyond = F.sum(F.when(~plain, value))
    return F.when(beyond.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + beyond)


def flag_count(condition: Column) -> Column:
    """How many rows satisfy the condition; NULL does not count."""
    return F.count_if(condition)


def half_even(column: Column) -> Column:
    return F.rint(column)


def lineage_id(*columns: str) -> Column:
    """Content hash of some columns, independent of their order in the row."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def file_name(path: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(path, "/"), -1)


def url_file_name(url: Column) -> Column:
    """Last path segment of a URL without query and fragment."""
    return file_name(F.regexp_replace(url, r"[?#].*$", ""))


def file_extension(name: Column) -> Column:
    """Lower-case extension without the dot; ``unknown`` when there is none."""
    found = F.lower(F.regexp_extract(name, r"[^.].*\.([^.]+)$", 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("unknown"))


def file_stem(name: Column) -> Column:
    """File name without its extension."""
    return F.regexp_replace(name, r"^(\.*[^.].*)\.[^.]*$", "$1")
