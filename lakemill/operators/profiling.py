"""Summaries and exact quantiles of numeric columns."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from lakemill.functions.values import typed

Bounds = dict[str, tuple[float, float]]
Interval = tuple[str, float | None, float | None]


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum and maximum, one row per column."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], relative_error: float = 0.02
) -> dict[str, list[float]]:
    """Quantiles of all columns at once; an empty column has none.

    With an error above zero one pass builds mergeable summaries of bounded
    size. With zero the exact values are found by :func:`exact_quantiles`.
    """
    if not columns:
        return {}
    if relative_error <= 0:
        return exact_quantiles(df, columns, probabilities)
    found = df.approxQuantile(list(columns), list(probabilities), relative_error)
    return dict(zip(columns, found))


@dataclass
class _Target:
    """One wanted rank; its value lies strictly between ``low`` and ``high``.

    ``before`` rows of the column lie at or below ``low``, ``rows`` in between.
    """

    column: str
    probability: float
    rank: int = 0
    low: float | None = None
    high: float | None = None
    before: int = 0
    rows: int = -1  # not counted yet
    room: float = 1.0

    @property
    def interval(self) -> Interval:
        return self.column, self.low, self.high

    def share(self) -> float:
        return self.probability if self.rows < 0 else (self.rank - self.before) / self.rows


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    small: int = 10_000,
    accuracy: int = 2_000,
) -> dict[str, list[float]]:
    """Exact order statistics without sorting the table.

    A sketch of bounded size gives a cut on either side of each wanted rank, and
    one aggregation counts the rows below and at the cuts exactly. Either a cut
    is the answer or the rank lies strictly between the two. This repeats until
    at most ``small`` rows lie between, whose values are then counted. Nothing
    larger leaves the executors, and a value that fills a third of the table is
    only ever a count. An input that is costly to build should be persisted.
    """
    # NaN is no value here, and -0.0 is 0.0.
    clean = df.select(*[_finite(c).alias(c) for c in columns])
    found: dict[tuple[str, float], float] = {}
    waiting = [_Target(c, p) for c in columns for p in probabilities]
    margin = 2.0 / accuracy
    while waiting:
        few = [t for t in waiting if 0 < t.rows <= small]
        many = [t for t in waiting if not 0 < t.rows <= small]
        if few:
            _count_values(clean, few, found)
        if many:
            cuts = _sketch(clean, many, accuracy, margin)
            wide = [t for t in many if t.rows > small]
            if wide:
                _cut(clean, wide, cuts, found)
        waiting = [t for t in many if t.rows > 0 and (t.column, t.probability) not in found]
    return {c: [found[(c, p)] for p in probabilities if (c, p) in found] for c in columns}


def _finite(column: str) -> Column:
    value = typed(f"`{column}`", "double")
    return F.when(~F.isnan(value), value + F.lit(0.0))


def _inside(interval: Interval, value: Column) -> Column:
    _, low, high = interval
    inside = value.isNotNull()
    if low is not None:
        inside = inside & (value > F.lit(low))
    return inside if high is None else inside & (value < F.lit(high))


def _sketch(df: DataFrame, targets: Sequence[_Target], accuracy: int, margin: float) -> dict[Interval, list[float]]:
    """Cuts around the ranks of each interval; sets ranks and row counts once."""
    groups: dict[Interval, list[_Target]] = {}
    for t in targets:
        groups.setdefault(t.interval, []).append(t)
    parts = []
    for k, (interval, members) in enumerate(groups.items()):
        value = F.col(interval[0])
        inside = value if interval[1:] == (None, None) else F.when(_inside(interval, value), value)
        shares = [min(max(t.share() + m, 0.0), 1.0) for t in members for m in (-margin * t.room, margin * t.room)]
        parts.append(F.struct(F.count(inside), F.percentile_approx(inside, shares, accuracy)).alias(f"i{k}"))
    cuts = {}
    for (interval, members), (rows, found) in zip(groups.items(), df.agg(*parts).first()):
        for t in members:
            if t.rows < 0:
                t.rows, t.rank = rows, min(max(math.ceil(t.probability * rows), 1), rows)
        cuts.update({(t.column, t.probability): found[2 * j : 2 * j + 2] if found else [] for j, t in enumerate(members)})
    return cuts


def _cut(df: DataFrame, targets: Sequence[_Target], cuts: Mapping, found: dict[tuple[str, float], float]) -> None:
    """Count rows below and at both cuts of every target in one aggregation."""
    counts = []
    for t in targets:
        low, high = cuts[(t.column, t.probability)]
        value = F.col(t.column)
        inside = _inside(t.interval, value)
        tests = (value < F.lit(low), value <= F.lit(low), value < F.lit(high), value <= F.lit(high))
        counts += [F.count_if(inside & test) for test in tests]
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    for i, t in enumerate(targets):
        low, high = cuts[(t.column, t.probability)]
        below_low, to_low, below_high, to_high = row[4 * i : 4 * i + 4]
        wanted = t.rank - t.before
        if not below_low < wanted <= to_high:
            t.room *= 2.0  # the cuts missed the rank; leave more room next time
        if wanted <= below_low:
            t.high, t.rows = low, below_low
        elif wanted <= to_low:
            found[(t.column, t.probability)] = low
        elif wanted <= below_high:
            t.low, t.high, t.before, t.rows = low, high, t.before + to_low, below_high - to_low
        elif wanted <= to_high:
            found[(t.column, t.probability)] = high
        else:
            t.low, t.before, t.rows = high, t.before + to_high, t.rows - to_high


def _count_values(df: DataFrame, targets: Sequence[_Target], found: dict[tuple[str, float], float]) -> None:
    """Settle targets whose interval holds a checked small number of rows."""
    columns = list(dict.fromkeys(t.column for t in targets))
    value = F.col("v")
    wanted = reduce(or_, [(F.col("feature") == t.column) & _inside(t.interval, value) for t in targets])
    long = df.select(*columns).unpivot([], columns, "feature", "v").filter(value.isNotNull() & wanted)
    values: dict[str, list[tuple[float, int]]] = {}
    for row in long.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")).collect():
        values.setdefault(row.feature, []).append((row.v, row.n))
    for t in targets:
        seen = t.before
        for v, n in sorted(values[t.column]):
            if (t.low is not None and v <= t.low) or (t.high is not None and v >= t.high):
                continue
            seen += n
            if seen >= t.rank:
                found[(t.column, t.probability)] = v
                break


def min_max(
    df: DataFrame,
    columns: Sequence[str],
    floor: Mapping[str, float] | None = None,
    cap: Mapping[str, float] | None = None,
) -> Bounds:
    """Minimum and maximum of every column in one pass, limited to floor and cap.

    A column without values has no bounds; an empty span is widened by one.
    """
    if not columns:
        return {}
    floor, cap = floor or {}, cap or {}
    row = df.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]).first()
    bounds = {}
    for c in columns:
        if row[c].low is None:
            continue
        low = max(float(row[c].low), float(floor.get(c, -math.inf)))
        high = min(float(row[c].high), float(cap.get(c, math.inf)))
        bounds[c] = (low, high if high > low else low + 1.0)
    return bounds


# Probabilities, fences and caps of the outlier rules.
PROBABILITIES = (0.01, 0.25, 0.50, 0.75, 0.99)
TAIL_PROBABILITIES = (0.25, 0.75, 0.99)
FENCE = 3.0
COVERAGE_RANGE = (0.90, 0.9999)
DEFAULT_COVERAGE = 0.995
DEFAULT_CAP = 200.0
CAPS = {"tolls_amount": 200.0, "mta_tax": 20.0, "tips": 200.0, "tip_amount": 200.0}
MODES = ("two_stage_iqr", "coverage_quantile", "hard_cap")


def fence(q25: float, q75: float, q99: float) -> float:
    """Upper fence of a distribution, never above its 99th percentile."""
    spread = q75 - q25
    return q99 if spread <= 0 else min(q99, q75 + FENCE * spread)


def _usable(values: Sequence[float | None], n: int) -> bool:
    return len(values) == n and all(v is not None and not math.isnan(v) for v in values)


def tail_fences(df: DataFrame, high: Mapping[str, float], relative_error: float) -> dict[str, float]:
    """Fence of the values beyond ``high``, for every column in one pass."""
    tails = df.select(*[F.when(F.col(c) > F.lit(h), F.col(c)).alias(c) for c, h in high.items()])
    found = quantiles(tails, list(high), TAIL_PROBABILITIES, relative_error)
    return {c: fence(*q) for c, q in found.items() if _usable(q, 3)}


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str],
    mode: str = "two_stage_iqr",
    relative_error: float = 0.02,
    coverage: float = DEFAULT_COVERAGE,
) -> Bounds:
    """Range [0, high] of the ordinary values of each column.

    All columns share each pass: one for the quantiles and, in the two-stage
    mode, one for the tails. Columns without usable quantiles are left out.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}; one of {', '.join(MODES)}")
    cover = min(max(float(coverage), COVERAGE_RANGE[0]), COVERAGE_RANGE[1])
    wanted = PROBABILITIES + ((cover,) if mode == "coverage_quantile" else ())
    found = {c: q for c, q in quantiles(df, columns, wanted, relative_error).items() if _usable(q, len(wanted))}
    high = {c: fence(q[1], q[3], q[4]) for c, q in found.items()}
    if mode == "coverage_quantile":
        other = {c: q[-1] for c, q in found.items()}
    elif mode == "hard_cap":
        other = {c: CAPS.get(c, DEFAULT_CAP) for c in found}
    else:
        other = tail_fences(df, high, relative_error)
    high = {c: max(h, other.get(c, h)) for c, h in high.items()}
    return {c: (0.0, h if h > 0 else 1.0) for c, h in high.items()}


# Fixed value: the event histogram always reaches at least to here.
MIN_UPPER_BOUND = 10.0


def upper_bound(df: DataFrame, column: str, relative_error: float = 0.02) -> float:
    """Two-stage bound of one column for the event histogram, at least 10.

    Infinite values, which have no place on a finite axis, do not move it.
    """
    value = typed(f"`{column}`", "double")
    df = df.select(F.when(F.abs(value) != F.lit(math.inf), value).alias(column))
    quartiles = quantiles(df, [column], TAIL_PROBABILITIES, relative_error)[column]
    if not _usable(quartiles, 3):
        top = df.agg(F.max(column)).first()[0]
        return MIN_UPPER_BOUND if top is None or math.isnan(top) else max(float(top), MIN_UPPER_BOUND)
    high = fence(*quartiles)
    tail = tail_fences(df, {column: high}, relative_error)
    return max(high, tail.get(column, high), MIN_UPPER_BOUND)
