"""One row per key, and rows that are not known yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

SPREAD = 1024


def total_order(df: DataFrame, first: Sequence[Column | str] = (), without: Sequence[str] = ()) -> list[Column]:
    """The given order, then every other sortable column, so the survivor is fixed."""
    given = [F.col(c) if isinstance(c, str) else c for c in first]
    done = {c for c in first if isinstance(c, str)} | set(without)
    sortable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    rest = [F.col(f"`{c}`") for c in sortable if c not in done]
    return (given + rest) or [F.lit(0)]


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """Keep the first row of each key in the given order.

    The rank filter is applied on each input partition before the shuffle
    (group limit), so a key that holds a third of the table sends one row per
    partition, not the whole group.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*total_order(df, order, keys)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def not_in(df: DataFrame, known: DataFrame, keys: Mapping[str, str], distinct: bool = False) -> DataFrame:
    """Rows whose key is not among ``known``; a key with a NULL part is kept.

    ``keys`` maps columns of ``df`` to columns of ``known``. Rows with a NULL
    part can match nothing; they get a spread value in the join key, so they do
    not all meet in the one task of the NULL key. Rows that are already
    ``distinct`` in the key need none, and keep the partitioning of that step.
    """
    if distinct:
        seen = known.select(*[F.col(k).alias(f"_known_{c}") for c, k in keys.items()]).dropna().distinct()
        return df.join(seen, [F.col(c) == F.col(f"_known_{c}") for c in keys], "left_anti")
    complete = reduce(and_, [F.col(c).isNotNull() for c in keys])
    parts = [c for c in df.columns if df.schema[c].dataType.typeName() not in ("map", "variant")]
    spread = F.when(complete, 0).otherwise(1 + F.pmod(F.xxhash64(*parts), F.lit(SPREAD)).cast("int"))
    seen = known.select(*[F.col(k).alias(f"_known_{c}") for c, k in keys.items()]).dropna().distinct()
    # Always 0, but computed from the row: a literal would leave the join key.
    seen = seen.withColumn("_known_spread", F.pmod(F.hash(seen.columns[0]), F.lit(1)))
    condition = [F.col(c) == F.col(f"_known_{c}") for c in keys]
    condition.append(F.col("_spread") == F.col("_known_spread"))
    return df.withColumn("_spread", spread).join(seen, condition, "left_anti").drop("_spread")


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows; give an order that ends in a unique column."""
    return df.orderBy(*order).limit(n)


def children_of(child: DataFrame, parent: DataFrame, key: str, n: int) -> DataFrame:
    """Children of the first ``n`` parents by key (a bounded extract)."""
    first = parent.select(key).distinct().orderBy(key).limit(n)
    return child.join(first, key, "left_semi")
